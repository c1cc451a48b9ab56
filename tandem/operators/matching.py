"""Greedy embedding match: the arithmetic of BERTScore over token vectors the caller supplies.

Precision is the mean over hypothesis tokens of the best cosine with any reference token, recall the
same from the reference side (Zhang et al. 2020). A best match needs every token of the other side: a small segment is
gathered whole into one row, and a large one is met tile by tile, where a tile of thousands of tokens per side is
multiplied block by block and only the running maxima are kept. So a vector crosses the shuffle once per tile of the
other side, and even one giant segment is spread over its pairs of tiles.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tandem.operators.indexing import small_list
from tandem.session import stage

BLOCK = 512
TILE = 1 << 15
_BEST = "side string, pos bigint, best double"


def _unit_rows(vectors) -> np.ndarray:
    matrix = np.stack([np.asarray(vector, dtype=np.float64) for vector in vectors])
    norms = np.linalg.norm(matrix, axis=1, keepdims=True)
    return np.divide(matrix, norms, out=np.zeros_like(matrix), where=norms > 0)


def _whole_segments(tokens: DataFrame, keys: list[str]) -> DataFrame:
    """Every segment with both sides as one row, from one shuffle."""
    cells = F.struct(F.col("pos").cast("bigint").alias("pos"), "vec")
    gathered = tokens.groupBy(*keys).agg(*[
        F.collect_list(F.when(F.col("side") == side, cells)).alias(f"_cells_{side}") for side in ("mt", "ref")])
    return gathered.filter((F.size("_cells_mt") > 0) & (F.size("_cells_ref") > 0))


def _tiles(tokens: DataFrame, large: DataFrame, rows: int, keys: list[str], tile: int) -> DataFrame:
    """The tokens of large segments with the numbers of the pairs of tiles (_mt, _ref) that each is needed for."""
    own = F.floor(F.col("pos") / tile).cast("int")
    others = F.explode(F.sequence(F.lit(0), F.when(F.col("side") == "mt", F.col("_last_ref")).otherwise(F.col("_last_mt"))))
    met = tokens.join(small_list(large, rows), keys).filter(F.col("side").isin("mt", "ref")).select(
        *keys, "side", F.col("pos").cast("bigint").alias("pos"), "vec", own.alias("_own"), others.alias("_other"))
    of_mt = F.col("side") == "mt"
    return met.select(*keys, "side", "pos", "vec", F.when(of_mt, F.col("_own")).otherwise(F.col("_other")).alias("_mt"),
                      F.when(of_mt, F.col("_other")).otherwise(F.col("_own")).alias("_ref"))


def token_bests(
    tokens: DataFrame, keys: list[str], block: int | None = BLOCK, tile: int = TILE
) -> DataFrame:
    """Best cosine of every token with the other side's tokens of its segment.

    ``tokens`` has the segment ``keys`` (not null), side (``mt`` or ``ref``), pos (unique in its segment and side,
    counted from 0) and vec. A side with no partner gets no row. Segments of up to ``block`` tokens a side are gathered
    whole; the others are cut into tiles of ``tile`` tokens a side, every pair of which is one group, multiplied
    ``block`` by ``block``. With ``block=None`` a caller who knows that all segments are small saves the count.
    """
    small, pieces = tokens, []
    key_schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in tokens.select(*keys).schema.fields)
    columns = [*keys, "side", "pos", "best"]
    step = block or BLOCK

    def bests(mt, ref) -> tuple[np.ndarray, np.ndarray]:
        """Row and column maxima of all cosines, a block of them at a time."""
        best = {"mt": np.full(len(mt), -np.inf), "ref": np.full(len(ref), -np.inf)}
        for i in range(0, len(mt), step):
            left = _unit_rows(mt[i: i + step])
            for j in range(0, len(ref), step):
                cosine = left @ _unit_rows(ref[j: j + step]).T
                np.maximum(best["mt"][i: i + step], cosine.max(axis=1), out=best["mt"][i: i + step])
                np.maximum(best["ref"][j: j + step], cosine.max(axis=0), out=best["ref"][j: j + step])
        return best["mt"], best["ref"]

    def of_segments(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for record in frame.to_dict("records"):
                cells = [record["_cells_mt"], record["_cells_ref"]]
                found = bests(*[[cell["vec"] for cell in side] for side in cells])
                own = tuple(record[key] for key in keys)
                for side, listed, best in zip(("mt", "ref"), cells, found):
                    rows += [(*own, side, cell["pos"], value) for cell, value in zip(listed, best.tolist())]
            yield pd.DataFrame(rows, columns=columns)

    def of_tiles(frame: pd.DataFrame) -> pd.DataFrame:
        sides = [frame[frame["side"] == side] for side in ("mt", "ref")]
        if not all(map(len, sides)):
            return pd.DataFrame(columns=columns)
        for side, best in zip(sides, bests(*[side["vec"].tolist() for side in sides])):
            side["best"] = best
        return pd.concat(sides)[columns]

    if block is not None:
        ends = [F.max(F.when(F.col("side") == side, F.col("pos"))) for side in ("mt", "ref")]
        counted = tokens.groupBy(*keys).agg(ends[0].alias("_mt"), ends[1].alias("_ref")).filter(
            (F.greatest("_mt", "_ref") >= block) & F.col("_mt").isNotNull() & F.col("_ref").isNotNull())
        large = stage(counted.select(*keys, *[
            F.floor(F.col(f"_{side}") / tile).cast("int").alias(f"_last_{side}") for side in ("mt", "ref")]), "large")
        rows = large.count()
        if rows:
            pieces.append(_tiles(tokens, large, rows, keys, tile).groupBy(*keys, "_mt", "_ref").applyInPandas(
                of_tiles, f"{key_schema}, {_BEST}").groupBy(*keys, "side", "pos").agg(F.max("best").alias("best")))
            small = tokens.join(small_list(large, rows), keys, "left_anti")
    pieces.append(_whole_segments(small, keys).mapInPandas(of_segments, f"{key_schema}, {_BEST}"))
    return pieces[0] if len(pieces) == 1 else pieces[0].unionByName(pieces[1])


def greedy_match(
    tokens: DataFrame, keys: list[str], block: int | None = BLOCK, segments: DataFrame | None = None, tile: int = TILE
) -> DataFrame:
    """Precision ``p``, recall ``r`` and their harmonic mean ``f1`` per segment.

    A segment with a side without tokens has 0 for all three. ``segments`` (of the ``keys``) lists the segments;
    without it they are those with a token on either side.
    """
    segments = (tokens if segments is None else segments).select(*keys).distinct()
    bests = token_bests(tokens, keys, block, tile)
    means = bests.groupBy(*keys).agg(
        F.avg(F.when(F.col("side") == "mt", F.col("best"))).alias("p"),
        F.avg(F.when(F.col("side") == "ref", F.col("best"))).alias("r"),
    )
    harmonic = F.when(F.col("p") + F.col("r") != 0, 2 * F.col("p") * F.col("r") / (F.col("p") + F.col("r")))
    found = segments.join(means, keys, "left")
    return found.select(
        *keys, F.coalesce("p", F.lit(0.0)).alias("p"), F.coalesce("r", F.lit(0.0)).alias("r"),
        F.coalesce(harmonic, F.lit(0.0)).alias("f1"))
