"""Queries over the given tables, one or more per operator, each with the SQL that checks it."""

from tandem.catalog import corpora, evaluation, pairs, sampling, scoring  # noqa: F401
from tandem.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
