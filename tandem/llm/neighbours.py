"""Nearest neighbours by inner product: a hash-prefix forest per block of vectors.

Equal vectors are one class. The classes are dealt into blocks of bounded size; a block has several trees, each a
sorted array of long bit strings, the signs of random projections. A query descends in every tree to its longest
matching prefix, and ascends in all trees at once, a bit at a time, until the prefixes' ranges hold enough entries;
the classes in those ranges are scored exactly. For inner products the vectors of a block get one more component
that makes their lengths equal.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tandem.session import Scratch

TREES = 32
BITS = 32
BLOCK = 8192
CHUNK = 1024
SHARE = 1.25
TILE = 64
SALTS = 1024


def projections(dimension: int, trees: int) -> np.ndarray:
    return np.random.default_rng(dimension).standard_normal((dimension, trees * BITS))


def bit_strings(vectors: np.ndarray, planes: np.ndarray, trees: int) -> np.ndarray:
    """One row per tree, one string of ``BITS`` bits per vector."""
    signs = (vectors @ planes > 0).reshape(len(vectors), trees, BITS)
    strings = np.packbits(signs, axis=2).view(">u4")[:, :, 0].astype(np.uint64)
    return np.ascontiguousarray(strings.T)


class Forest:
    """The trees of one block: sorted bit strings, and the vectors they belong to."""

    def __init__(self, vectors: np.ndarray, strings: np.ndarray, order: np.ndarray):
        self.vectors, self.strings, self.order = vectors, strings, order

    @classmethod
    def plant(cls, vectors: np.ndarray, trees: int) -> Forest:
        squares = np.einsum("ij,ij->i", vectors, vectors)
        level = np.sqrt(np.maximum(squares.max() - squares, 0.0))
        strings = bit_strings(np.hstack((vectors, level[:, None])), projections(vectors.shape[1] + 1, trees), trees)
        order = np.argsort(strings, axis=1, kind="stable")
        return cls(vectors, np.take_along_axis(strings, order, axis=1), order)

    def search(self, queries: np.ndarray, share: float, keep: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per query the places of its best candidates, best first, and their inner products."""
        trees, size = self.strings.shape
        padded = np.hstack((queries, np.zeros((len(queries), 1))))
        asked = bit_strings(padded, projections(padded.shape[1], trees), trees)
        # an entry may be the same vector in every tree, so this many hold at least ``keep`` vectors
        enough = max(min(keep, size) * trees, min(size * trees, int(np.ceil(share * size))))
        low = np.zeros((trees, len(queries)), np.int64)
        high = np.full((trees, len(queries)), size, np.int64)
        climbing = np.ones(len(queries), bool)
        for depth in range(BITS, -1, -1):  # all trees ascend together; a query stops when its ranges hold enough
            free = np.uint64(BITS - depth)
            at = np.flatnonzero(climbing)
            for t in range(trees):
                prefix = asked[t, at] >> free
                low[t, at] = np.searchsorted(self.strings[t], prefix << free)
                high[t, at] = np.searchsorted(self.strings[t], (prefix + np.uint64(1)) << free)
            climbing[at] = (high[:, at] - low[:, at]).sum(axis=0) < enough
            if not climbing.any():
                break
        found = []
        for q in range(len(queries)):
            if q % TILE == 0:  # one product for some queries is cheaper than gathering each one's candidates
                products = queries[q: q + TILE] @ self.vectors.T
            near = np.zeros(size, bool)
            for t in range(trees):
                near[self.order[t, low[t, q]: high[t, q]]] = True
            places = np.flatnonzero(near)
            scores = products[q % TILE, places]
            if len(places) > keep:  # all that tie with the last one stay for now
                places, scores = (x[scores >= np.partition(scores, -keep)[-keep]] for x in (places, scores))
            found.append((places, scores))
        return found


def _usable(vector: Column) -> Column:
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~bad & F.exists(vector, lambda x: x != 0)


def nearest(
    vectors: DataFrame, queries: Column, k: int = 20, id: str = "vec_id", vector: str = "embedding",
    trees: int = TREES, block: int = BLOCK, chunk: int = CHUNK, share: float = SHARE,
) -> DataFrame:
    """Per row that ``queries`` selects its ``k`` nearest other rows found: query_id, rank, vec_id, score.

    Nearness is the inner product in double precision on the vectors as they are, ties go to the smaller id. Every
    block of about ``block`` classes is searched until its trees' ranges hold ``share`` of its size, so recall does not
    fall as blocks are added; entries count once per tree. Equal vectors are searched once and listed in full; only the k + 1 smallest ids of a
    class can be in a result. Vectors that are null, empty, all zero, or hold null or non-finite components, and rows
    without id, take no part; vectors of different length are not compared. A repeated row counts once. Without queries
    or vectors the result is empty; with fewer than k others all are listed.
    """
    scratch = Scratch(vectors.sparkSession)
    rows = vectors.select(
        F.col(id).cast("bigint").alias("id"), F.col(vector).cast("array<double>").alias("vector"),
        queries.alias("asks")).filter(F.col("id").isNotNull() & F.coalesce(_usable(F.col("vector")), F.lit(False)))

    def smallest(ids: Column) -> Column:
        return F.slice(F.array_sort(F.array_distinct(ids)), 1, k + 1)

    # a class's smallest ids, first by salt: a class may hold any share of the rows
    salted = rows.groupBy("vector", F.pmod(F.xxhash64("id"), F.lit(SALTS)).alias("salt")).agg(
        smallest(F.collect_set("id")).alias("ids"))
    classes = scratch.stage(salted.groupBy("vector").agg(
        smallest(F.flatten(F.collect_list("ids"))).alias("members")
    ).select(F.col("members")[0].alias("class"), F.size("vector").alias("dimension"), "vector", "members",
             F.xxhash64("vector").alias("h")), "classes")
    asking = scratch.stage(rows.filter("asks").select("id", "vector").join(
        classes.select("class", "dimension", "vector", "h"), "vector").select(
        F.col("id").alias("query_id"), "class", "dimension", "h").distinct(), "asking")
    n_classes = classes.count()
    n_blocks = max(1, -(-n_classes // block))
    asked = asking.select("class", "dimension", "h").distinct()
    n_chunks = max(1, -(-asked.count() // chunk))

    def matrix(batch: pd.DataFrame) -> np.ndarray:
        return np.stack(batch["vector"].to_numpy()).astype(np.float64)

    def plant(batch: pd.DataFrame) -> pd.DataFrame:
        forest = Forest.plant(matrix(batch), trees)
        return pd.DataFrame({
            "block": batch["block"][:1], "dimension": batch["dimension"][:1], "classes": [batch["class"].to_numpy()],
            "vectors": [forest.vectors.tobytes()], "strings": [forest.strings.astype(np.uint32).tobytes()],
            "places": [forest.order.astype(np.int32).tobytes()]})

    def pack(batch: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({
            "chunk": batch["chunk"][:1], "dimension": batch["dimension"][:1], "asked": [batch["class"].to_numpy()],
            "queries": [matrix(batch).tobytes()]})

    def search(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                row = {name: batch.column(name)[i] for name in batch.schema.names}
                ids, asked = (row[name].values.to_numpy() for name in ("classes", "asked"))
                parts = {name: np.frombuffer(row[name].as_buffer(), kind) for name, kind in (
                    ("vectors", np.float64), ("strings", np.uint32), ("places", np.int32), ("queries", np.float64))}
                forest = Forest(parts["vectors"].reshape(len(ids), -1),
                                parts["strings"].reshape(trees, -1).astype(np.uint64),
                                parts["places"].reshape(trees, -1))
                found = forest.search(parts["queries"].reshape(len(asked), -1), share, k + 1)
                best = []
                for places, scores in found:
                    order = np.lexsort((ids[places], -scores))[: k + 1]
                    best.append((ids[places[order]], scores[order]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(asked, [len(near) for near, _ in best])),
                     pa.array(np.concatenate([near for near, _ in best])),
                     pa.array(np.concatenate([scores for _, scores in best]))], names=["asked", "class", "score"])

    blocks = scratch.stage(
        classes.withColumn("block", F.pmod(F.xxhash64("class"), F.lit(n_blocks)).cast("int")).select(
            "block", "dimension", "class", "vector").groupBy("block", "dimension").applyInPandas(
            plant, "block int, dimension int, classes array<bigint>, vectors binary, strings binary, places binary"),
        "blocks")
    chunks = asked.join(classes.select("class", "dimension", "vector"), ["class", "dimension"]).withColumn(
        "chunk", F.pmod(F.xxhash64("class", F.lit(1)), F.lit(n_chunks)).cast("int")).select(
        "chunk", "dimension", "class", "vector").groupBy("chunk", "dimension").applyInPandas(
        pack, "chunk int, dimension int, asked array<bigint>, queries binary")
    # every chunk of queries visits every block
    visits = chunks.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1)))).join(
        blocks, ["block", "dimension"]).select("asked", "queries", "classes", "vectors", "strings", "places")
    near = visits.mapInArrow(search, "asked bigint, class bigint, score double")
    by_score = Window.partitionBy("asked").orderBy(F.desc("score"), "class")
    best = near.withColumn("n", F.row_number().over(by_score)).filter(F.col("n") <= k + 1)
    listed = best.join(classes.select("class", "members"), "class").select(
        "asked", "score", F.explode("members").alias("vec_id"))
    by_id = Window.partitionBy("asked").orderBy(F.desc("score"), "vec_id")
    listed = listed.withColumn("n", F.row_number().over(by_id)).filter(F.col("n") <= k + 1).drop("n")
    answers = asking.select("query_id", F.col("class").alias("asked")).join(listed, "asked").filter(
        "vec_id <> query_id")
    ranks = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    result = scratch.stage(answers.withColumn("rank", F.row_number().over(ranks)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"), "result")
    scratch.release("result")
    return result
