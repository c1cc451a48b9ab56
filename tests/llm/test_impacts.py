import numpy as np
import pytest
from pyspark.sql import functions as F

from tandem.llm.impacts import UNKNOWN, Segments, exact_top
from tandem.llm.queries import ORACLES, QUERIES
from tests.oracle import connect, difference


def plain(vectors, query, k):
    scores = sorted((-int(np.dot(vectors[query], vector)), i) for i, vector in vectors.items()
                    if i != query and len(vector) == len(vectors[query]))
    return [(i, -score) for score, i in scores[:k]]


def clustered(rng):
    centres = rng.standard_normal((20, 16))
    return np.floor(64 * (centres[rng.integers(0, 20, 2000)] + 0.2 * rng.standard_normal((2000, 16)))).astype(np.int64)


@pytest.mark.parametrize("vectors", [
    clustered(np.random.default_rng(1)), np.random.default_rng(2).integers(-2, 3, (300, 5)),
    np.random.default_rng(3).integers(-2 ** 29, 2 ** 29, (200, 1)), np.zeros((30, 3), np.int64),
    np.random.default_rng(4).integers(-2 ** 26, 2 ** 26, (300, 40)), np.ones((4, 2), np.int64)])
def test_stops_only_on_proof(vectors):
    index = Segments.of(np.arange(len(vectors)), vectors)
    index = Segments.restored(index.stored(), vectors.shape[1])
    for query in range(0, len(vectors), 7):
        places, scores, _ = index.best(vectors[query], query, 5, UNKNOWN)
        order = np.lexsort((places, -scores))[:5]
        assert list(zip(places[order], scores[order])) == plain(dict(enumerate(vectors)), query, 5)
        floor = int(scores[order][-1])
        again, _, _ = index.best(vectors[query], query, 5, floor)
        assert set(places[order]) <= set(again)
        assert not len(index.best(vectors[query], query, 5, int(scores.max()) + 1)[0])


def test_structure_saves_reading():
    vectors = clustered(np.random.default_rng(1))
    index = Segments.of(np.arange(len(vectors)), vectors)
    read = [index.best(vectors[query], query, 5, UNKNOWN)[2] for query in range(50)]
    assert np.mean(read) < 0.6 * vectors.size


def table(spark, rows):
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, score int, rank int")


def searched(spark, rows, **options):
    found = {}
    for row in sorted(exact_top(table(spark, rows), F.col("vec_id") % 5 == 0, **options).collect()):
        found.setdefault(row.query_id, []).append((row.rank, row.vec_id, row.score))
    return found


def test_blocks_tiles_and_odd_rows(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.integers(-40, 40, 6) / 64], 1, 1) for i in range(90)]
    rows += [(200 + i, [0.5, 0.25, 0.0, 0.0, 0.0, 1.0], 1, 1) for i in range(60)]
    rows += [(90, None, 1, 1), (95, [0.1, None, 0.0, 0.0, 0.0, 0.0], 1, 1), (100, [float("nan")] * 6, 1, 1),
             (105, [float("inf")] * 6, 1, 1), (110, [3e38] * 6, 1, 1), (None, [1.0] * 6, 1, 1), (115, [], 1, 1),
             (116, [], 1, 1), (120, [1.0, 2.0], 1, 1), (125, [0.0] * 6, 1, 1), (3, rows[3][1], 2, 2), (3, rows[3][1], 2, 2)]
    kept = {}
    for i, vector, *_ in rows:
        if i is not None and vector is not None and all(x is not None and abs(x) < 1e6 for x in vector):
            kept[i] = np.floor(256 * np.array(vector)).astype(np.int64)
    expected = {i: [(n, *found) for n, found in enumerate(plain(kept, i, 7), 1)] for i in kept if i % 5 == 0}
    expected = {i: found for i, found in expected.items() if found}
    assert searched(spark, rows, k=7) == expected
    assert searched(spark, rows, k=7, block=20, tile=10) == expected


def test_few_or_no_vectors(spark):
    assert searched(spark, []) == {}
    assert searched(spark, [(5, [1.0], 1, 1)]) == {}
    assert searched(spark, [(4, [1.0], 1, 1), (6, [2.0], 1, 1)]) == {}
    assert searched(spark, [(0, [1.0, 0.5], 1, 1), (1, [0.5, 0.0], 1, 1)]) == {0: [(1, 1, 256 * 128)]}


def test_one_id_with_several_vectors_counts_once(spark):
    rows = [(0, [1.0], 1, 1), (1, [0.5], 1, 1), (1, [0.25], 1, 1), (2, [0.375], 1, 1)]
    assert searched(spark, rows) == {0: [(1, 2, 256 * 96), (2, 1, 256 * 64)]}


def test_query_matches_its_sql(spark):
    sf_dir, name = "/root/testdata/sf0.001", "op12_exact_top"
    assert difference(QUERIES[name](spark, sf_dir), connect(sf_dir), ORACLES[name]) is None
