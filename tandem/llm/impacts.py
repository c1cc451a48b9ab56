"""Exact top-k inner products of integer vectors by an impact-ordered index, read score-at-a-time.

Vectors are dealt into blocks. In a block every dimension is a posting list in the order of its values, cut into
segments of equal value width. What a segment adds to a query's score, above the least that its dimension can add, is
its impact; segments of all dimensions are read in steps of descending quantised impact into one accumulator per
vector. What a vector may still gain from lists it has not appeared in is bounded by their next segments, so reading
stops as soon as the bounds prove that most vectors cannot be among the k best; the others are rescored exactly.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tandem.session import Scratch

BLOCK = 16384
TILE = 8192
SEGMENTS = 128
IMPACT_BITS = 24
SUM_BITS = 44
STEPS = 16
CHECKS = 8
RESCORED = 3
UNKNOWN = -(1 << 62)


@dataclass
class Segments:
    """A block's index: ids and integer vectors, and per dimension a row of ``order`` and one of ``starts``.

    ``order`` has the vectors' places by ascending value, ``starts`` the first entry of each segment and the end;
    ``low`` is a dimension's least value, ``width`` its segments' width.
    """

    ids: np.ndarray
    vectors: np.ndarray
    order: np.ndarray
    starts: np.ndarray
    low: np.ndarray
    width: np.ndarray

    @classmethod
    def of(cls, ids: np.ndarray, vectors: np.ndarray) -> Segments:
        low, high = vectors.min(axis=0), vectors.max(axis=0)
        width = (high - low) // SEGMENTS + 1
        order = np.argsort(vectors, axis=0, kind="stable").T
        segment = (np.take_along_axis(vectors.T, order, axis=1) - low[:, None]) // width[:, None]
        starts = np.array([np.searchsorted(row, np.arange(SEGMENTS + 1)) for row in segment], np.int64)
        return cls(ids, vectors, np.ascontiguousarray(order), starts, low, width)

    def stored(self) -> dict[str, bytes]:
        return {name: getattr(self, name).astype(kind).tobytes() for name, kind in self.kinds(len(self.ids)).items()}

    @classmethod
    def restored(cls, row: dict[str, bytes], dimension: int) -> Segments:
        size = len(row["ids"]) // 8
        parts = {name: np.frombuffer(row[name], kind) for name, kind in cls.kinds(size).items()}
        return cls(parts["ids"], parts["vectors"].reshape(size, dimension).astype(np.int64),
                   parts["order"].reshape(dimension, size).astype(np.int64),
                   parts["starts"].reshape(dimension, SEGMENTS + 1).astype(np.int64), parts["low"], parts["width"])

    @staticmethod
    def kinds(size: int) -> dict[str, type]:
        place = np.uint16 if size <= 1 << 16 else np.int32
        return {"ids": np.int64, "vectors": np.int32, "order": place, "starts": np.int32, "low": np.int64,
                "width": np.int64}

    def best(self, query: np.ndarray, own: int, k: int, floor: int) -> tuple[np.ndarray, np.ndarray, int]:
        """Places and exact scores of all that may be among the k best and reach ``floor``; entries read."""
        size, dimensions = self.vectors.shape
        if not dimensions:
            others = np.flatnonzero(self.ids != own)
            return others, np.zeros(len(others), np.int64), 0
        slope = query * self.width
        # the most a segment adds above the least of its dimension: first + slope * segment
        first = np.where(slope > 0, slope, -slope * SEGMENTS)
        most = np.abs(slope) * SEGMENTS
        base = int((query * np.where(query > 0, self.low, self.low + self.width * SEGMENTS)).sum())
        top = int(most.max())
        # an accumulator holds the sum of quantised impacts, and above it the number of lists that gave them
        unit = (top >> IMPACT_BITS) + 1
        impacts = (first[:, None] + slope[:, None] * np.arange(SEGMENTS)) // unit + 1 + (1 << SUM_BITS)
        sizes = np.diff(self.starts, axis=1)
        sums = np.zeros(size, np.int64)
        others = self.ids != own
        steep = np.maximum(np.abs(slope), 1)
        unread = np.where(slope != 0, SEGMENTS, 0)  # segments not read yet, those of least impact
        read = since = 0
        for step in range(STEPS - 1, -1, -1):
            # all segments whose impact exceeds the step's are read by now
            left = np.minimum(unread, (top // STEPS + 1) * step // steep)
            near = np.where(slope < 0, SEGMENTS - unread, left)
            far = np.where(slope < 0, SEGMENTS - left, unread)
            for d in np.flatnonzero(left < unread).tolist():
                a, b = int(near[d]), int(far[d])
                entries = self.order[d, self.starts[d, a]: self.starts[d, b]]
                np.add.at(sums, entries, np.repeat(impacts[d, a:b], sizes[d, a:b]))
                since += len(entries)
            unread = left
            if since * CHECKS < size * dimensions and step:
                continue
            read, since = read + since, 0
            rest = np.abs(slope) * unread  # the next segment of each list
            begun = rest[(rest < most) & (slope != 0)]
            seen = sums >> SUM_BITS
            bound = (sums & ((1 << SUM_BITS) - 1)) * unit - seen * (begun.min() if len(begun) else 0) + (
                base + int(rest.sum()))
            ahead = np.argpartition(bound, -k - 1)[-k - 1:] if size > k + 1 else np.arange(size)
            exact = np.sort(self.scores(ahead[others[ahead]], query))
            if len(exact) >= k:
                floor = max(floor, int(exact[-k]))
            possible = np.flatnonzero((bound >= floor) & others)
            if len(possible) * RESCORED <= size or not step:
                break
        scores = self.scores(possible, query)
        reached = scores >= floor
        return possible[reached], scores[reached], read

    def scores(self, places: np.ndarray, query: np.ndarray) -> np.ndarray:
        return self.vectors[places] @ query


def exact_top(
    vectors: DataFrame, queries: Column, k: int = 5, id: str = "vec_id", vector: str = "embedding", scale: int = 256,
    block: int = BLOCK, tile: int = TILE,
) -> DataFrame:
    """Per row that ``queries`` selects its ``k`` best other rows: query_id, rank, vec_id, score, and entries read.

    Components become floor(scale * x), the score is the integer inner product; equal scores go to the smaller id. The
    result is exact. Every tile of up to ``tile`` queries meets every block of about ``block`` vectors; a first pass
    over a square root of the blocks finds a score that the k best reach, which later blocks must beat, so that they
    return few rows. ``entries`` is the number of postings that were read for a query in all blocks.

    Vectors that are null or hold null or non-finite components, or components so large that a score could leave 64
    bits, and rows without id, take no part; all-zero and empty vectors do. Vectors of different length are not
    compared. Of different vectors under one id the smallest stands, so repeated rows count once. Without queries or
    others the result is empty; with fewer than k others all are listed.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark)
    value = F.col(vector).cast("array<double>")
    largest = F.sqrt(F.lit(2.0 ** 58) / F.greatest(F.size(value), F.lit(1)))
    usable = F.forall(value, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x * scale) < largest), F.lit(False)))
    rows = vectors.select(F.col(id).cast("bigint").alias("id"), queries.alias("asks"), value.alias("v")).filter(
        F.col("id").isNotNull() & F.coalesce(usable & value.isNotNull(), F.lit(False)))
    table = scratch.stage(rows.withColumn("v", F.transform("v", lambda x: F.floor(x * scale))).groupBy("id").agg(
        F.min("v").alias("v"), F.max("asks").alias("asks")).withColumn("dimension", F.size("v")), "integers")
    n_rows, n_queries = table.agg(F.count("*"), F.count_if("asks")).first()
    blocks = max(1, -(-n_rows // block))
    # few blocks meet more tiles, so that all tasks have work
    tiles = max(1, -(-n_queries // tile), min(n_queries, -(-2 * spark.sparkContext.defaultParallelism // blocks)))
    seeds = int(np.ceil(np.sqrt(blocks)))

    def index(batch: pd.DataFrame) -> pd.DataFrame:
        dimension = int(batch["dimension"].iloc[0])
        entries = np.stack(batch["v"].to_numpy()).astype(np.int64).reshape(len(batch), dimension)
        built = Segments.of(batch["id"].to_numpy(np.int64), entries)
        return pd.DataFrame({"block": batch["block"][:1], "dimension": [dimension], **{
            name: [part] for name, part in built.stored().items()}})

    def search(tile: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        columns = ["query_id", "vec_id", "score", "entries"]
        found = []
        if len(tile) and len(block):
            built = Segments.restored(block.iloc[0], int(block["dimension"].iloc[0]))
            for own, query, floor in zip(tile["id"], tile["v"], tile["floor"]):
                places, scores, read = built.best(np.asarray(query, np.int64), own, k, floor)
                order = np.lexsort((built.ids[places], -scores))[:k]
                # the entries read stand in a row of their own
                found.append((own, None, None, read))
                found += zip([own] * len(order), built.ids[places[order]].tolist(), scores[order].tolist(), [0] * k)
        return pd.DataFrame(found, columns=columns).astype({"query_id": "int64", "entries": "int64"} | dict.fromkeys(
            ["vec_id", "score"], "Int64"))

    stored = scratch.stage(
        table.select("id", "v", "dimension", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int").alias("block")).groupBy(
            "block", "dimension").applyInPandas(
            index, "block int, dimension int, " + ", ".join(f"{name} binary" for name in Segments.kinds(0))), "blocks")
    asking = table.filter("asks").select(
        "id", "v", "dimension", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(tiles)).cast("int").alias("tile"))
    tile_numbers = F.explode(F.sequence(F.lit(0), F.lit(tiles - 1))).alias("tile")

    def visit(asked: DataFrame, first: int, end: int) -> DataFrame:
        """Every tile of the queries meets blocks ``first`` up to ``end``, each pair a group of its own."""
        keys = ["block", "tile", "dimension"]
        met = asked.withColumn("block", F.explode(F.sequence(F.lit(first), F.lit(end - 1))))
        there = stored.filter(F.col("block").between(first, end - 1)).select("*", tile_numbers)
        return met.groupBy(*keys).cogroup(there.groupBy(*keys)).applyInPandas(
            search, "query_id bigint, vec_id bigint, score bigint, entries bigint")

    best_first = Window.partitionBy("query_id").orderBy(F.desc_nulls_last("score"), "vec_id")
    found = scratch.stage(visit(asking.withColumn("floor", F.lit(UNKNOWN)), 0, seeds), "found")
    if seeds < blocks:
        floors = found.filter("vec_id IS NOT NULL").withColumn("n", F.row_number().over(best_first)).filter(
            F.col("n") == k).select(F.col("query_id").alias("id"), F.col("score").alias("floor"))
        floored = asking.join(floors, "id", "left").withColumn("floor", F.coalesce("floor", F.lit(UNKNOWN)))
        found = found.unionByName(visit(floored, seeds, blocks))
    of_query = Window.partitionBy("query_id")
    result = scratch.stage(found.withColumn("rank", F.row_number().over(best_first)).withColumn(
        "entries", F.sum("entries").over(of_query)).filter(
        (F.col("rank") <= k) & F.col("vec_id").isNotNull()).select("query_id", "rank", "vec_id", "score", "entries"),
        "result")
    scratch.release("result")
    return result
