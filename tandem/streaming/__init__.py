"""Structured Streaming form of batch scoring."""
