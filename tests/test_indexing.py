import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tandem.operators.indexing import batch_number, first_of_groups, first_rows, number_lines, number_rows, row_slice
from tandem.session import scratch_path, scratch_scope
from tandem.sinks.writers import write_lines
from tandem.sources.lines import LineIndex, numbered_lines, scan_lines
from tests.conftest import plan


@pytest.fixture
def small_splits(spark):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_lines_keep_their_position_over_many_splits(spark, files, small_splits):
    draw = random.Random(3)
    contents = {f"f{i}.txt": [f"{i}:{j}" + "x" * draw.randint(0, 60) for j in range(n)]
                for i, n in enumerate([1, 0, 700, 2500, 30])}
    root = files({name: "\n".join(lines) for name, lines in contents.items()})
    scan = scan_lines(spark, root)
    assert scan.select("path", "block").distinct().count() > 20
    found = {(r.name, r.line_no): r.text for r in numbered_lines(spark, root).collect()}
    assert found == {(name, i): line for name, lines in contents.items() for i, line in enumerate(lines)}


def test_slices_open_only_the_files_they_meet(spark, files, small_splits):
    contents = {f"name=f{i}.txt/part-0000{p}-x.txt": [f"{i}:{p}:{j}" for j in range(n)]
                for i in range(3) for p, n in enumerate([400, 0, 1, 900, 300])}
    root = files({name: "\n".join(lines) for name, lines in contents.items()})
    index = LineIndex(spark, root)
    whole = {i: sum((contents[f"name=f{i}.txt/part-0000{p}-x.txt"] for p in range(5)), []) for i in range(3)}
    for start, end, opened in ((0, 1, 3), (399, 402, 9), (500, 1300, 3), (1299, 1302, 6), (1601, 9999, 0)):
        found = index.lines(start, end)
        assert sorted((r.name, r.line_no, r.text) for r in found.collect()) == sorted(
            (f"f{i}.txt", n, lines[n]) for i, lines in whole.items() for n in range(start, min(end, len(lines))))
        assert index.files(start, end).count() == opened
        read = {file.rpartition("/name=")[2] for file in found.inputFiles() if "/name=" in file}
        assert len(read) == opened
    assert sorted(r.text for r in index.lines(7).collect()) == ["0:0:7", "1:0:7", "2:0:7"]


def test_changed_splits_fail_the_job(spark, files):
    root = files({"a.txt": "line\n" * 5000})
    numbered = numbered_lines(spark, root)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        with pytest.raises(Exception, match="splits of the files have changed"):
            numbered.filter("line_no >= 0").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert sorted(r.line_no for r in numbered_lines(spark, root).collect()) == list(range(5000))


def test_numbering_through_a_group_follows_file_names(spark, files, small_splits):
    root = files({"dev.x": "a\n\nb\n", "devtest.x": "c\r\nd", "dev.y": "e\rf"})
    scan = scan_lines(spark, root, "dev").withColumn("lang", F.split_part("name", F.lit("."), F.lit(2)))
    found = {(r.lang, r.line_no): r.text for r in number_lines(scan, ["lang"]).collect()}
    assert found == {("x", 0): "a", ("x", 1): "", ("x", 2): "b", ("x", 3): "c", ("x", 4): "d", ("y", 0): "e", ("y", 1): "f"}


def test_written_lines_come_back_in_order_from_many_part_files(spark, tmp_path, small_splits):
    # one logical file holds most lines
    rows = spark.range(30000).select(
        F.when(F.col("id") % 10 == 0, F.col("id") % 3).otherwise(9).cast("string").alias("file"),
        "id", F.concat(F.lit("line "), F.col("id").cast("string")).alias("text"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_lines(rows.repartition(7), str(tmp_path / "out"), F.concat(F.lit("f "), F.col("file"), F.lit(".txt")), ["id"])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(list((tmp_path / "out" / "name=f 9.txt").glob("part-*"))) > 3
    found = numbered_lines(spark, str(tmp_path / "out")).withColumn("id", F.expr("cast(substring(text, 6) as bigint)"))
    pairs = sorted((r.name, r.line_no, r.id) for r in found.collect())
    expected = {}
    for r in rows.collect():
        expected.setdefault(f"f {r.file}.txt", []).append(r.id)
    assert pairs == sorted((name, i, value) for name, ids in expected.items() for i, value in enumerate(sorted(ids)))


@pytest.mark.parametrize("partitions", ["1", "3", "16"])
def test_number_rows_with_a_hot_group(spark, partitions):
    rows = [("hot" if i % 3 else f"g{i % 30}", i * 7919 % 5000) for i in range(5000)]
    df = spark.createDataFrame(rows, "g string, k bigint")
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        found = sorted((r.g, r.k, r.row_id) for r in number_rows(df, ["k"], ["g"]).collect())
        whole = sorted((r.k, r.row_id) for r in number_rows(df, ["k"]).collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    groups = {}
    for g, k in rows:
        groups.setdefault(g, []).append(k)
    assert found == sorted((g, k, i) for g, keys in groups.items() for i, k in enumerate(sorted(keys)))
    assert whole == [(k, k) for k in range(5000)]


def test_slices_and_batches(spark):
    df = spark.range(10).withColumnRenamed("id", "line_no")
    ids = lambda frame: sorted(r.line_no for r in frame.collect())
    assert ids(row_slice(df, 3)) == [3]
    assert ids(row_slice(df, 3, 6)) == [3, 4, 5]
    assert ids(first_rows(df, 4)) == [0, 1, 2, 3]
    assert ids(first_rows(df, 0)) == ids(first_rows(df, None)) == list(range(10))
    assert [r[0] for r in df.select(batch_number(F.col("line_no"), 4)).collect()] == [0] * 4 + [1] * 4 + [2] * 2
    with pytest.raises(ValueError):
        batch_number(F.col("line_no"), 0)


def test_first_of_groups_keeps_a_few_rows_per_task(spark):
    rows = [("hot" if i % 3 else f"g{i % 30}", i * 7919 % 5000) for i in range(5000)]
    df = spark.createDataFrame(rows, "g string, k bigint").repartition(4)
    found = first_of_groups(df, ["k"], ["g"], 7)
    groups = {}
    for g, k in rows:
        groups.setdefault(g, []).append(k)
    assert sorted((r.g, r.k, r.row_id) for r in found.collect()) == sorted(
        (g, k, i) for g, keys in groups.items() for i, k in enumerate(sorted(keys)[:7]))
    executed = plan(found)
    assert executed.index("Window [") < executed.index("WindowGroupLimit")  # rows are left out before they are moved
    assert executed.index("Exchange hashpartitioning") < executed.rindex("WindowGroupLimit")
    assert first_of_groups(df.limit(0), ["k"], ["g"], 7).count() == 0


def test_empty_inputs(spark, files):
    assert numbered_lines(spark, files({"empty.txt": ""})).count() == 0
    assert number_rows(spark.range(0), ["id"]).count() == 0


def test_input_is_computed_once_and_scratch_tables_go(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    root = Path(scratch_path(spark, "probe")).parent
    before = set(root.iterdir()) if root.exists() else set()
    with scratch_scope(spark):
        numbered = number_rows(spark.range(0, 100, 1, 4).mapInArrow(count, "id bigint"), ["id"])
        assert sorted((r.id, r.row_id) for r in numbered.collect()) == [(i, i) for i in range(100)]
        assert set(root.iterdir()) - before
    assert seen.value == 100 and set(root.iterdir()) == before
