import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tandem.catalog.evaluation import jaccard_scorer, overlap_scorer
from tandem.catalog.scoring import code_point_tokenizer, labelled_scorer, reversing_scorer
from tandem.operators.scoring import pieces, score_batches, score_segments, together, tokenize_batches, tokenize_columns
from tandem.operators.translation import towards, translate
from tandem.plans.jobs import evaluate, monolingual_corpus, translate_file, translation_run
from tandem.session import scratch_path, shared_dir, stage
from tandem.streaming.incoming import incoming_lines, numbered_scores, start_numbered_scoring, start_scoring
from tests.conftest import plan


def sizing_scorer():
    import os
    import uuid

    token = f"{os.getpid()}-{uuid.uuid4()}"
    return lambda batch: {"size": [len(batch)] * len(batch), "maker": [token] * len(batch)}


def test_batches_and_one_scorer_per_task(spark):
    df = spark.range(0, 25, 1, 2).withColumn("t", F.col("id").cast("string")).withColumn("task", F.spark_partition_id())
    found = score_batches(df, sizing_scorer, ["t"], "size int, maker string", batch_size=8).collect()
    assert sorted(r.id for r in found) == list(range(25))
    assert max(r.size for r in found) == 8
    makers = {}
    for r in found:
        makers.setdefault(r.task, set()).add(r.maker)
    assert [len(names) for names in makers.values()] == [1, 1]
    with pytest.raises(ValueError):
        score_batches(df, sizing_scorer, ["t"], "size int", batch_size=0)


def test_scoring_keeps_keys_whatever_the_partitioning(spark):
    df = spark.range(100).withColumn("text", F.concat(F.lit("t"), F.col("id").cast("string")))
    found = score_batches(df, reversing_scorer, ["text"], "result string", 7, partitions=5, spread_by=["id"])
    assert {r.id: r.result for r in found.collect()} == {i: f"t{i}"[::-1] for i in range(100)}


def test_empty_input(spark):
    empty = spark.createDataFrame([], "text string")
    assert score_batches(empty, reversing_scorer, ["text"], "result string").count() == 0


def test_tokenize(texts):
    found = tokenize_batches(texts(["ab", "", "\U00020bb7"]), code_point_tokenizer).collect()
    assert [r.ids for r in found] == [[97, 98], [], [0x20BB7]]


def test_results_leave_a_task_in_pieces(spark):
    """The values of a piece are let go before the next one: rows that a task holds are bounded by bytes."""
    def held():
        def score(batch):
            return {"rows": [len(batch)] * len(batch)}

        return score

    long = spark.range(0, 4000, 1, 1).withColumn("t", F.repeat(F.lit("x"), 10_000))
    found = score_batches(long, held, ["t"], "rows int", 1000).select("id", "rows")
    assert found.agg(F.count("*"), F.countDistinct("id"), F.max("rows") * 10_000 <= 1 << 20).first() == (4000, 4000, True)
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(100)), pa.array(["x" * 100] * 99 + ["y" * 5000]), pa.array([[i] for i in range(100)])], names=["id", "t", "ids"])
    cut = list(pieces(batch, ["t", "ids"], 8, 1000))
    assert pa.Table.from_batches(cut).equals(pa.Table.from_batches([batch]))
    assert all(len(piece) == 1 or piece.select(["t", "ids"]).nbytes <= 1000 for piece in cut)
    assert [len(piece) for piece in pieces(batch, ["id"], 8, 1000)] == [100]


def test_tokenize_columns(spark):
    df = spark.createDataFrame([(1, "ab", "c"), (2, "", "de")], "id int, a string, b string")
    found = tokenize_columns(df, code_point_tokenizer, {"a": "x", "b": "y"})
    assert plan(found).count("MapInArrow ") == plan(tokenize_batches(df, code_point_tokenizer, "a")).count("MapInArrow ")
    assert sorted(map(tuple, found.collect())) == [(1, "ab", "c", [97, 98], [99]), (2, "", "de", [], [100, 101])]


def test_segments(spark):
    df = spark.createDataFrame([("k", "abc", "abd", "abd")], "model string, src string, mt string, ref string")
    row = score_segments(df, jaccard_scorer, "score double").first()
    assert row.score == pytest.approx((1 + 2 / 4) / 2)


def test_translation_run_all_directions(spark):
    wide = spark.createDataFrame([(0, "好", "good", None), (1, "係", "yes", "oui"), (2, "x", "y", "z")],
                                 "line_no bigint, Cantonese string, English string, French string")
    found = translation_run(wide, ["Cantonese", "English", "French"], labelled_scorer, "r", "m", sample_size=2, partitions=3)
    assert sorted((r.line_no, r.src_lang, r.tgt_lang, r.text) for r in found.collect()) == sorted([
        (0, "Cantonese", "English", "English:\n好"), (0, "Cantonese", "French", "French:\n好"),
        (0, "English", "Cantonese", "Cantonese:\ndoog"), (1, "Cantonese", "English", "English:\n係"),
        (1, "Cantonese", "French", "French:\n係"), (1, "English", "Cantonese", "Cantonese:\nsey"),
        (1, "French", "Cantonese", "Cantonese:\niuo")])


def test_translate_file_and_refusals(spark, files):
    root = files({"s.txt": " a\n\nb\nc"})
    found = translate_file(spark, f"{root}/s.txt", "English", False, labelled_scorer, "r", "m", sample_size=3)
    assert sorted((r.line_no, r.src_lang, r.tgt_lang, r.text) for r in found.collect()) == [
        (0, "English", "Cantonese", "Cantonese:\na "), (1, "English", "Cantonese", "Cantonese:\n"),
        (2, "English", "Cantonese", "Cantonese:\nb")]
    bad = spark.createDataFrame([("English", "French", "x")], "src_lang string, tgt_lang string, text string")
    with pytest.raises(Exception, match="either side must be Cantonese"):
        translate(bad, reversing_scorer).collect()
    default = spark.createDataFrame([(None, "French", "xy")], "src_lang string, tgt_lang string, text string")
    assert translate(default, reversing_scorer).first()[:2] == ("Cantonese", "French")


def test_evaluate_matches_names_with_blanks(spark):
    truth = spark.createDataFrame([(lang, i, f"{i} same words in here") for lang in ("Cantonese", "Simplified Chinese")
                                   for i in range(3)], "lang string, line_no bigint, text string")
    predictions = truth.filter("lang = 'Cantonese'").select(
        F.lit("m").alias("model"), F.lit("Simplified_Chinese").alias("src_lang"), F.lit("Cantonese").alias("tgt_lang"),
        "line_no", "text")
    row = evaluate(predictions, truth, overlap_scorer, jaccard_scorer).first()
    assert (row.bleu_score, row.bert_f1, row.comet_score) == (100.0, 1.0, 1.0)
    with pytest.raises(ValueError, match="misaligned"):
        evaluate(predictions.limit(2), truth, overlap_scorer, jaccard_scorer, strict=True)


def test_monolingual_plan(spark, files):
    root = files({"a.txt": "abcde\n"})
    assert [r.text for r in monolingual_corpus(spark, [root], 3, markers=True).orderBy("chunk_no").collect()] == [
        "<|startoftext|>abc<|endoftext|>", "<|startoftext|>de<|endoftext|>"]


def test_stream_resumes_after_the_last_batch(spark, files, tmp_path):
    output, checkpoint = str(tmp_path / "out"), str(tmp_path / "progress")

    def run():
        lines = incoming_lines(spark, root)
        scored = translate(towards(lines, "English", False), reversing_scorer).drop("messages")
        start_scoring(scored, output, checkpoint).awaitTermination()
        return sorted((r.src_lang, r.tgt_lang, r.text, r.result) for r in spark.read.parquet(output).collect())

    root = files({"a.txt": "ab\ncd"})
    assert run() == [("English", "Cantonese", "ab", "ba"), ("English", "Cantonese", "cd", "dc")]
    files({"b.txt": "ef"})
    assert run() == run() and len(run()) == 3
    with pytest.raises(ValueError):
        towards(incoming_lines(spark, root), "Cantonese", False)


def test_numbered_stream_over_splits_parts_and_a_failure(spark, files, tmp_path):
    output, checkpoint = str(tmp_path / "out"), str(tmp_path / "progress")
    contents = {"name=a.txt/part-00001-x.txt": [f"late {i}" for i in range(700)], "b.txt": ["only", "", "two"],
                "name=a.txt/part-00000-x.txt": [f"early {i}" for i in range(900)]}
    calls = []

    def score(batch):
        calls.append(batch)
        if len(calls) == 2:
            raise RuntimeError("lost")
        return translate(towards(batch, "English", False), reversing_scorer).drop("messages")

    def run():
        lines = incoming_lines(spark, f"{root}/*", files_per_batch=1)
        start_numbered_scoring(lines, score, output, checkpoint).awaitTermination()

    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        for name, lines in contents.items():
            root = files({name: "\n".join(lines)})
        with pytest.raises(Exception, match="lost"):
            run()
        run()
        run()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    found = sorted((r.name, r.line_no, r.text, r.result) for r in numbered_scores(spark, output).collect())
    whole = {"a.txt": contents["name=a.txt/part-00000-x.txt"] + contents["name=a.txt/part-00001-x.txt"],
             "b.txt": contents["b.txt"]}
    assert found == [(name, i, text, text[::-1]) for name, lines in whole.items() for i, text in enumerate(lines)]


class FakeConf:
    def __init__(self, values):
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)


class FakeSession:
    def __init__(self, **values):
        self.conf = FakeConf({key.replace("_", "."): value for key, value in values.items()})


def test_shared_folder_follows_the_session(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    assert shared_dir(spark) == folder and scratch_path(spark, "x").startswith(f"{folder}/tandem-local-")
    assert "/t-" in stage(spark.range(3), "t").inputFiles()[0]
    assert shared_dir(FakeSession(spark_checkpoint_dir="hdfs://h/c/", spark_master="yarn")) == "hdfs://h/c"
    assert shared_dir(FakeSession(spark_sql_warehouse_dir="hdfs://h/w")) == "hdfs://h/w"


def test_a_wrong_number_of_values_is_an_error(spark):
    def one_off():
        return lambda batch: {"result": ["x"] * (len(batch) + (1 if batch["id"][0] == 0 else -1))}

    with pytest.raises(Exception, match="result: 3 values for 2 rows"):
        score_batches(spark.range(0, 4, 1, 1), one_off, ["id"], "result string").collect()


def test_two_scorers_in_one_pass(spark):
    makers = [lambda: lambda batch: {"a": (batch["id"] + 1).tolist()}, lambda: lambda batch: {"b": (batch["id"] * 2).tolist()}]
    found = score_batches(spark.range(5), together(*makers), ["id"], "a bigint, b bigint")
    assert sorted(map(tuple, found.collect())) == [(i, i + 1, 2 * i) for i in range(5)]
