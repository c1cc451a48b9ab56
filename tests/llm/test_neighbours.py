import numpy as np
from pyspark.sql import functions as F

from tandem.llm.neighbours import nearest
from tandem.llm.queries import QUERIES


def table(spark, rows):
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, score int")


def exact(vectors, query, k):
    scores = sorted((-float(np.dot(vectors[query], vector)), i) for i, vector in vectors.items() if i != query)
    return [(i, -score) for score, i in scores[:k]]


def test_small_tables_are_searched_whole(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.integers(-3, 4, 6)], 1) for i in range(60)]
    rows += [(100, None, 1), (101, [], 1), (102, [0.0] * 6, 1), (103, [1.0, None, 0.0, 0.0, 0.0, 0.0], 1),
             (104, [float("nan")] * 6, 1), (105, [float("inf")] * 6, 1), (None, [1.0] * 6, 1), (106, [1.0, 2.0], 1),
             (60, [9.0] * 6, 1), (60, [9.0] * 6, 1)]
    rows += [(200 + i, [2.0, 1.0, 0.0, 0.0, 0.0, 1.0], 1) for i in range(50)]
    found = nearest(table(spark, rows), F.col("vec_id") % 20 == 0, k=7, share=100.0).collect()
    vectors = {i: np.array(v) for i, v, _ in rows if i is not None and v and len(v) == 6 and None not in v
               and np.isfinite(v).all() and np.any(v)}
    by_query = {}
    for row in sorted(found, key=lambda row: (row.query_id, row.rank)):
        by_query.setdefault(row.query_id, []).append((row.vec_id, row.score))
    queries = [i for i in vectors if i % 20 == 0]
    assert sorted(by_query) == sorted(queries)
    for query in queries:
        assert by_query[query] == exact(vectors, query, 7)


def test_few_or_no_vectors(spark):
    found = nearest(table(spark, [(0, [1.0, 0.0], 1), (1, [0.5, 0.0], 1)]), F.col("vec_id") == 0).collect()
    assert [tuple(row) for row in found] == [(0, 1, 1, 0.5)]
    assert nearest(table(spark, [(0, [1.0], 1)]), F.col("vec_id") == 0).count() == 0
    assert nearest(table(spark, []), F.col("vec_id") == 0).count() == 0
    assert nearest(table(spark, [(1, [1.0], 1)]), F.col("vec_id") == 0).count() == 0


def test_blocks_and_chunks_find_what_one_block_finds(spark):
    rng = np.random.default_rng(6)
    rows = [(i, [float(x) for x in rng.standard_normal(8)], 1) for i in range(300)]
    whole = nearest(table(spark, rows), F.col("vec_id") % 20 == 0, k=5, share=100.0)
    parts = nearest(table(spark, rows), F.col("vec_id") % 20 == 0, k=5, share=100.0, block=50, chunk=4)
    assert sorted((r.query_id, r.rank, r.vec_id) for r in whole.collect()) == sorted(
        (r.query_id, r.rank, r.vec_id) for r in parts.collect())


def test_recall_of_the_query(spark):
    sf_dir = "/root/testdata/sf0.001"
    vectors = {r.vec_id: np.array(r.embedding) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()}
    found = {}
    for row in QUERIES["op3_nearest"](spark, sf_dir).collect():
        found.setdefault(row.query_id, set()).add(row.vec_id)
    hits = [len(found[query] & {i for i, _ in exact(vectors, query, 20)}) for query in vectors if query % 20 == 0]
    assert np.mean(hits) / 20 >= 0.9
