import itertools
import random
import re

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tandem.llm.components import components
from tandem.llm.near_dups import deduplicated, least_matches, near_duplicates
from tandem.llm.queries import QUERIES
from tandem.session import Scratch, small_batches


def shingles(text, n):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(lower))
    return {tuple(words[i:i + n]) for i in range(len(words) - n + 1)} or ({tuple(words)} if words else set())


def classes(texts, n, percent):
    """Component by document id, by comparing all pairs."""
    sets = {i: shingles(text, n) for i, text in texts.items()}
    parent = {i: i for i in texts}

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in itertools.combinations(sorted(texts), 2):
        common = len(sets[a] & sets[b])
        if common and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
            x, y = sorted((top(a), top(b)))
            parent[y] = x
    return {i: top(i) for i in texts}, {i: len(s) for i, s in sets.items()}


def check(spark, texts, n, percent):
    documents = spark.createDataFrame(
        [(i, text, 1, 2) for i, text in texts.items()], "doc_id bigint, text string, kept int, component_id int")
    wanted, sizes = classes(texts, n, percent)
    found = near_duplicates(documents, shingle=n, percent=percent).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in found} == {
        i: (sizes[i], wanted[i], wanted[i] == i) for i in texts}
    return wanted


@pytest.mark.parametrize("n, percent", [(3, 85), (5, 80)])
def test_groups_of_edited_copies(spark, n, percent):
    rng = random.Random(n)
    words = [f"w{i}" for i in range(3000)]
    texts = {}
    for group in range(12):
        base = rng.choices(words, k=rng.choice([8, 60, 150, 400]))
        for _ in range(rng.choice([1, 2, 10, 40])):
            copy = list(base)
            for _ in range(rng.choice([0, 1, 2, 5, 12])):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            texts[rng.randrange(10**9)] = " ".join(copy)
    assert len(set(check(spark, texts, n, percent).values())) < len(texts)


def test_chains_reach_the_smallest_id(spark):
    words = [f"w{i}" for i in range(140)]
    check(spark, {100 - i: " ".join(words[2 * i: 2 * i + 100]) for i in range(20)}, 3, 85)


def test_odd_texts(spark):
    texts = {1: None, 2: "", 3: " \t\n", 4: "A b", 5: "a\x0bB ", 6: "a", 7: "a b c", 8: "É b", 9: "é b",
             10: "x y z " * 9000, 11: "X y z " * 9000, 12: "q " * 30000}
    wanted = check(spark, texts, 3, 85)
    assert wanted[5] == 4 and wanted[11] == 10 and wanted[9] == 9 and wanted[2] == 2


def test_null_ids_repeated_rows_and_empty_table(spark):
    rows = [(None, "a b c d"), (3, "a b c d"), (3, "a b c d"), (4, "a b c d"), (None, None), (5, "other words here now")]
    documents = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = near_duplicates(documents, shingle=3, percent=85).collect()
    assert sorted((r.doc_id or 0, r.component_id or 0, r.kept) for r in found) == [
        (0, 0, False), (0, 3, False), (3, 3, True), (3, 3, True), (4, 3, False), (5, 5, True)]
    kept = deduplicated(documents.withColumnRenamed("text", "body"), text="body", shingle=3, percent=85)
    assert kept.columns == ["doc_id", "body"]
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 0, 3, 3, 5]
    assert near_duplicates(documents.limit(0)).count() == 0


def test_same_id_with_different_texts(spark):
    words = [f"w{i}" for i in range(60)]
    other = [f"v{i}" for i in range(60)]
    rows = [(1, " ".join(words)), (1, " ".join(other)), (2, " ".join(words[1:])), (3, " ".join(other[1:]))]
    found = near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"), shingle=3, percent=85)
    assert {r.component_id for r in found.collect()} == {1}


def test_near_threshold_group_with_repeated_rows(spark):
    rng = random.Random(4)
    words = [f"w{i}" for i in range(3000)]
    texts = {}
    for group in range(20):
        base = rng.choices(words, k=150)
        for _ in range(30):
            copy = list(base)
            for _ in range(rng.choice([1, 2, 3, 4])):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            texts[rng.randrange(10**9)] = " ".join(copy)
    wanted, sizes = classes(texts, 3, 85)
    rows = [row for row in texts.items() for _ in range(rng.choice([1, 1, 2]))]
    documents = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = near_duplicates(documents, shingle=3, percent=85).collect()
    assert sorted(tuple(r) for r in found) == sorted((i, sizes[i], wanted[i], wanted[i] == i) for i, _ in rows)


def test_nothing_is_missed_by_shingle_prefixes(spark):
    rng = random.Random(9)
    words = [f"w{i}" for i in range(200)]
    texts = {1: None, 2: "", 3: "one", 4: "one", 5: "one two"}
    for group in range(30):
        base = rng.choices(words, k=rng.choice([2, 4, 8, 20, 60]))
        for _ in range(rng.choice([1, 2, 5, 15])):
            copy = list(base)
            for _ in range(rng.choice([0, 1, 1, 2])):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            texts[rng.randrange(10**9)] = " ".join(copy)
    wanted, sizes = classes(texts, 2, 70)
    documents = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    found = near_duplicates(documents, shingle=2, percent=70, missed=0).collect()
    assert sorted(tuple(r) for r in found) == sorted((i, sizes[i], wanted[i], wanted[i] == i) for i in texts)


def test_least_matches():
    assert 1 <= least_matches(16, 50) < least_matches(16, 90) <= 16
    assert least_matches(64, 85) == 41


def test_components(spark):
    rng = random.Random(1)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(40)]
    parent = {}

    def top(i):
        while parent.setdefault(i, i) != i:
            i = parent[i]
        return i

    for a, b in links:
        x, y = sorted((top(a), top(b)))
        parent[y] = x
    table = spark.createDataFrame(links, "a bigint, b bigint")
    found = {r.id: r.component for r in components(table, Scratch(spark), "c").collect()}
    assert all(found.get(i, i) == top(i) for i in parent)


def test_driver_has_few_tasks_to_keep_where_there_are_many_partitions(spark):
    """Every task and job leaves its mark on the driver, which holds them until the session ends."""
    rng = random.Random(3)
    words = [f"w{i}" for i in range(500)]
    texts = {}
    for group in range(6):
        base = rng.choices(words, k=80)
        for i in range(12):
            texts[100 * group + i] = " ".join(base[:rng.randrange(80)] + rng.choices(words, k=rng.choice([0, 1, 3])) + base)
    held = {"spark.sql.shuffle.partitions": "60", "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {key: spark.conf.get(key) for key in held}
    context = spark.sparkContext
    try:
        for key, value in held.items():
            spark.conf.set(key, value)
        context.setJobGroup("tasks of near duplicates", "")
        check(spark, texts, 3, 85)
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
        for key, value in before.items():
            spark.conf.set(key, value)
    tracker = context.statusTracker()
    stages = {k for job in tracker.getJobIdsForGroup("tasks of near duplicates") for k in tracker.getJobInfo(job).stageIds}
    tasks = sum(info.numTasks for info in map(tracker.getStageInfo, stages) if info and info.numCompletedTasks)
    assert tasks < 2500


def test_query_against_all_pairs(spark):
    sf_dir = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    wanted, sizes = classes(texts, 3, 85)
    found = QUERIES["op5_near_duplicates"](spark, sf_dir).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in found} == {
        i: (sizes[i], wanted[i], wanted[i] == i) for i in texts}


def test_batches_of_long_sets_are_bounded(spark):
    """Spark's own 64 MB a batch are held by every task, in the JVM and in Python."""
    key, rows = "spark.sql.execution.arrow.maxBytesPerBatch", "id bigint, text string"
    spark.conf.unset(key)
    try:
        near_duplicates(spark.createDataFrame([(1, "a b c d e f"), (2, "a b c d e f")], rows), "id").collect()

        def sizes(batches):
            for batch in batches:
                yield pa.RecordBatch.from_arrays([pa.array([len(batch)]), pa.array([batch.nbytes])], names=["n", "held"])

        long = spark.range(0, 400, 1, 1).select(F.repeat(F.lit("x"), 100_000).alias("text"))
        found = long.mapInArrow(sizes, "n bigint, held bigint").agg(F.sum("n"), F.max("held")).first()
        assert found[0] == 400 and found[1] < 5 << 20
        spark.conf.set(key, "8m")
        small_batches(spark)
        assert spark.conf.get(key) == "8m"
    finally:
        spark.conf.unset(key)
