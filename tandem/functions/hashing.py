"""Seeded hashes that give the same value in every engine, cluster size and run."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HASH_BITS = 60


def seeded_digest(seed: int, *keys: Column) -> Column:
    """Hex digest of seed and keys; sorting by it is a reproducible shuffle."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[key.cast("string") for key in keys]))


def seeded_number(seed: int, *keys: Column) -> Column:
    """Uniform BIGINT in ``[0, 2**60)``."""
    return F.conv(F.substring(seeded_digest(seed, *keys), 1, 15), 16, 10).cast("bigint")


def falls_below(fraction: float, seed: int, *keys: Column) -> Column:
    """True for a stable ``fraction`` of the keys; a key keeps its side as the data grows."""
    return seeded_number(seed, *keys) < F.lit(int(fraction * 2**HASH_BITS)).cast("bigint")
