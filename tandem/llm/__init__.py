"""Operators for training-data pipelines over documents, pages and embeddings; nothing else in the package imports them."""
