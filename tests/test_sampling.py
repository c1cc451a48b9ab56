import hashlib
from math import ceil, floor

import pytest
from pyspark.sql import functions as F

from tandem.operators import sampling


def digest(seed, *keys):
    return hashlib.md5(":".join(map(str, (seed, *keys))).encode()).hexdigest()


def number(seed, *keys):
    return int(digest(seed, *keys)[:15], 16)


@pytest.fixture
def rows(spark):
    return spark.range(2000).withColumnRenamed("id", "k")


def test_shuffle_and_sample(rows):
    expected = sorted(range(2000), key=lambda k: (digest(42, k), k))
    assert [r.k for r in sampling.shuffled(rows, ["k"]).collect()] == expected
    positions = {r.k: r.position for r in sampling.shuffled_positions(rows, ["k"]).collect()}
    assert [positions[k] for k in expected] == list(range(2000))
    best = sorted(range(2000), key=lambda k: (digest(10, k), k))[:20]
    assert [r.k for r in sampling.sample_rows(rows, ["k"], 20).collect()] == best


def test_splits(rows, spark):
    found = {r.k: r.split for r in sampling.with_split(rows, ["k"]).collect()}
    assert found == {k: "test" if number(42, k) < int(0.1 * 2**60) else "train" for k in range(2000)}
    more = {r.k: r.split for r in sampling.with_split(spark.range(3000).withColumnRenamed("id", "k"), ["k"]).collect()}
    assert {k: more[k] for k in found} == found
    exact = sampling.with_exact_split(rows.limit(1995).filter("k < 1995"), ["k"])
    counts = {r.split: r["count"] for r in exact.groupBy("split").count().collect()}
    assert counts == {"test": 200, "train": 1795}


def test_exact_split_by_radix_selection(spark):
    # one key holds half of the rows, and lies across the threshold for some sizes
    keys = [i if i % 2 else 7 for i in range(900)]
    df = spark.createDataFrame([(k, i, "clash") for i, k in enumerate(keys)], "k bigint, i int, split string").drop("split")
    order = sorted(keys, key=lambda k: (digest(42, k), k))
    for size in (0.0, 0.001, 0.1, 0.37, 0.5, 0.77, 1.0):
        found = sampling.with_exact_split(df, ["k"], size).collect()
        tests = ceil(size * len(keys))
        assert len(found) == len(keys)
        assert sorted(r.k for r in found if r.split == "test") == sorted(order[:tests])
    assert sampling.with_exact_split(df.limit(0), ["k"]).count() == 0


def test_exact_split_moves_no_rows(rows):
    split = sampling.with_exact_split(rows, ["k"])
    assert "Exchange" not in split._jdf.queryExecution().executedPlan().toString()


def test_completion_pairs(spark):
    texts = ["ab", "abc", "好" * 10, "\U00020bb7" * 7, "x" * 101, " y"]
    df = spark.createDataFrame(list(enumerate(texts)), "k bigint, text string")
    for r in sampling.completion_pairs(df, "text", ["k"]).collect():
        n = len(r.text)
        low, high = floor(0.3 * n), floor(0.7 * n)
        point = max(min(low + number(42, r.k) % max(high - low, 1), n - 1), 1)
        assert (r.head, r.tail) == (r.text[:point], r.text[point:])


def test_distinct_and_rows_at(spark, texts):
    assert sorted(r.text for r in sampling.distinct_texts(texts(["a", "b", "a", "a"]), "text").collect()) == ["a", "b"]
    df = spark.range(10).withColumn("v", F.col("id") * 2)
    wanted = spark.createDataFrame([(3,), (3,), (99,)], "id bigint")
    assert [tuple(r) for r in sampling.rows_at(df, wanted, "id").collect()] == [(3, 6)]
