"""Reproducible shuffles, samples and splits, ordered by a seeded digest of the row key."""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tandem.functions import hashing
from tandem.operators.indexing import number_rows


def shuffled(df: DataFrame, keys: list[str], seed: int = 42) -> DataFrame:
    """All rows in a seeded order; the sort is range-partitioned on an evenly spread digest."""
    return df.orderBy(hashing.seeded_digest(seed, *map(F.col, keys)), *keys)


def shuffled_positions(df: DataFrame, keys: list[str], seed: int = 42, into: str = "position") -> DataFrame:
    """Add each row's place in the seeded order, counted from 0."""
    digested = df.withColumn("_digest", hashing.seeded_digest(seed, *map(F.col, keys)))
    return number_rows(digested, ["_digest", *keys], into=into).drop("_digest")


def rows_at(df: DataFrame, indices: DataFrame, index: str) -> DataFrame:
    """The rows whose ``index`` is listed in a table of that column."""
    return df.join(indices.select(index), index, "left_semi")


def sample_rows(df: DataFrame, keys: list[str], count: int, seed: int = 10) -> DataFrame:
    """The first ``count`` rows of the seeded order; each task keeps only its own ``count`` best."""
    return shuffled(df, keys, seed).limit(count)


def with_split(df: DataFrame, keys: list[str], test_size: float = 0.1, seed: int = 42) -> DataFrame:
    """Mark rows ``test`` or ``train`` by hash threshold: no shuffle, and stable as the data grows."""
    is_test = hashing.falls_below(test_size, seed, *map(F.col, keys))
    return df.withColumn("split", F.when(is_test, "test").otherwise("train"))


BIN_DIGITS = 4


def rank_threshold(df: DataFrame, digest: str, count: int) -> tuple[str, int]:
    """Where the ``count`` smallest of a column of equally long hex digests end, by radix selection.

    Returns a prefix and how many rows with that prefix are still among them; all rows with smaller prefixes are. Each
    pass counts the next ``BIN_DIGITS`` digits of the rows in the bin that holds the rank, at most 65 536 counts, and
    nothing is sorted or stored; a bin that is wanted whole ends the search.
    """
    prefix = ""
    while True:
        held = df.filter(F.col(digest).startswith(prefix)) if prefix else df
        digits = F.substring(digest, len(prefix) + 1, BIN_DIGITS)
        bins = sorted((row.bin, row.n) for row in held.groupBy(digits.alias("bin")).agg(F.count("*").alias("n")).collect())
        for bin_, rows in bins:
            if count <= rows:
                break
            count -= rows
        if not bin_:  # the digest is used up: these rows are equal
            return prefix, count
        prefix += bin_
        if count == rows:
            return prefix, count


def with_exact_split(df: DataFrame, keys: list[str], test_size: float = 0.1, seed: int = 42) -> DataFrame:
    """Like :func:`with_split`, with exactly ``ceil(test_size * rows)`` test rows: those first in the seeded order.

    The digest where they end is found by counting, so the keys are read a few times and no row is moved; a costly
    input should be a stored table. Only where rows of one key lie on both sides are these few numbered.
    """
    digested = df.withColumn("_digest", hashing.seeded_digest(seed, *map(F.col, keys)))
    total = df.count()
    tests = min(ceil(test_size * total), total)
    if not tests:
        return df.withColumn("split", F.lit("train"))
    prefix, wanted = rank_threshold(digested.select("_digest"), "_digest", tests)
    here = F.substring("_digest", 1, len(prefix))
    marked = digested.withColumn("split", F.when(here <= prefix, "test").otherwise("train"))
    ties = digested.filter(here == prefix)
    if len(prefix) == 32 and ties.count() > wanted:
        numbered = number_rows(ties, keys, into="_place")
        split = F.when(F.col("_place") < wanted, "test").otherwise("train")
        marked = marked.filter(here != prefix).unionByName(numbered.withColumn("split", split).drop("_place"))
    return marked.drop("_digest")


def completion_point(length: Column, seed: int, *keys: Column) -> Column:
    """Seeded cut in the middle 40 % of a text of ``length`` characters, at least 1 from either end."""
    low = F.floor(F.lit(0.3) * length)
    high = F.floor(F.lit(0.7) * length)
    drawn = low + F.pmod(hashing.seeded_number(seed, *keys), F.greatest(high - low, F.lit(1)))
    return F.greatest(F.least(drawn, length - 1), F.lit(1))


def completion_pairs(df: DataFrame, text: str, keys: list[str], seed: int = 42) -> DataFrame:
    """Cut each text of two or more characters into ``head`` and ``tail`` at a seeded point."""
    point = completion_point(F.length(text), seed, *map(F.col, keys)).cast("int")
    cut = df.withColumn("_point", point)
    return cut.withColumns({
        "head": F.substring(F.col(text), F.lit(1), F.col("_point")),
        "tail": F.substring(F.col(text), F.col("_point") + 1, F.length(text)),
    }).drop("_point")


def distinct_texts(df: DataFrame, column: str) -> DataFrame:
    """Each text once; copies are dropped before the shuffle as well as after it."""
    return df.select(column).distinct()
