import threading

import pytest

from tandem.sinks.store import PredictionStore

SCHEMA = "run string, model string, src_lang string, tgt_lang string, line_no bigint, text string"


def rows(spark, model, texts, tgt="B C"):
    return spark.createDataFrame([("r", model, "A", tgt, i, text) for i, text in enumerate(texts)], SCHEMA)


def seen(store, version=None):
    return sorted((r.model, r.tgt_lang, r.line_no, r.text) for r in store.read(version).collect())


@pytest.fixture
def store(spark, tmp_path):
    return PredictionStore(spark, str(tmp_path / "store"))


def test_writes_replace_their_own_keys(spark, store):
    assert seen(store) == [] and store.versions() == []
    assert store.write(rows(spark, "m", ["old\nline", "old", "old"])) == 1
    assert store.write(rows(spark, "n 2", ["other"])) == 2
    assert store.write(rows(spark, "m", ["new", "new"])) == 3
    assert seen(store) == [("m", "B_C", 0, "new"), ("m", "B_C", 1, "new"), ("n 2", "B_C", 0, "other")]
    assert seen(store, 2) == [("m", "B_C", 0, "old line"), ("m", "B_C", 1, "old"), ("m", "B_C", 2, "old"),
                              ("n 2", "B_C", 0, "other")]
    store.write(rows(spark, "m", []))
    assert len(seen(store)) == 3
    assert store.vacuum() == 2 and len(seen(store)) == 3  # the replaced one and the one without rows


def test_a_writer_that_dies_changes_nothing(spark, store):
    store.write(rows(spark, "m", ["old", "old"]))

    def dying(batches):
        for batch in batches:
            yield batch
            raise RuntimeError("lost")

    with pytest.raises(Exception, match="lost"):
        store.write(rows(spark, "m", ["new"] * 50).mapInPandas(dying, SCHEMA))
    staged = store.stage(rows(spark, "m", ["new"]))  # dies before its commit
    assert seen(store) == [("m", "B_C", 0, "old"), ("m", "B_C", 1, "old")]
    assert store.vacuum() == 0
    store.commit(staged)
    assert seen(store) == [("m", "B_C", 0, "new")]


def test_an_unfinished_commit_is_not_followed(spark, store, tmp_path):
    store.write(rows(spark, "m", ["old"]))
    (tmp_path / "store" / "log" / f"{2:012d}.json").write_text('{"write": "half", "keys": [{"run": "r", "mo')
    assert seen(store) == [("m", "B_C", 0, "old")]
    assert store.write(rows(spark, "m", ["new"])) == 3
    assert seen(store) == [("m", "B_C", 0, "new")]


def test_two_writers_at_once(spark, store):
    versions, errors = [], []

    def write(model, text):
        try:
            versions.append(store.write(rows(spark, model, [text] * 3).unionByName(rows(spark, "both", [text] * 2))))
        except Exception as error:
            errors.append(error)

    threads = [threading.Thread(target=write, args=(f"m{i}", f"t{i}")) for i in range(4)]
    for thread in threads:
        thread.start()
    for thread in threads:
        thread.join()
    assert not errors and sorted(versions) == [1, 2, 3, 4]
    found = seen(store)
    assert [row for row in found if row[0] != "both"] == [(f"m{i}", "B_C", n, f"t{i}") for i in range(4) for n in range(3)]
    both = [row for row in found if row[0] == "both"]
    assert len(both) == 2 and len({text for *_, text in both}) == 1


def test_only_live_folders_are_read(spark, store):
    store.write(rows(spark, "m", ["x"]))
    store.write(rows(spark, "m", ["y"]))
    plan = store.read()._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan.lower()
    with pytest.raises(ValueError, match="nothing is staged"):
        store.commit("unknown")


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_long_lines_of_one_key_are_written_by_many_tasks(spark, store, tmp_path, adaptive):
    """Far fewer lines than a stretch holds, and far more bytes than a task should read."""
    options = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k", "spark.sql.adaptive.enabled": adaptive}
    lines = spark.range(0, 2000, 1, 8).selectExpr(
        "'r' AS run", "'m' AS model", "'A' AS src_lang", "'B' AS tgt_lang", "id AS line_no",
        "concat_ws(' ', transform(sequence(1, 40), i -> sha2(concat(id, '-', i), 256))) AS text")
    for name, value in options.items():
        spark.conf.set(name, value)
    try:
        store.write(lines)
        files = list((tmp_path / "store" / "data").rglob("*.parquet"))
        found = store.read().select("line_no", "text")
        assert len(files) >= 8
        assert found.count() == 2000 and found.exceptAll(lines.select("line_no", "text")).count() == 0
    finally:
        for name in options:
            spark.conf.unset(name)
