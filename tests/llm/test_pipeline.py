import re

import corpus_pipeline
from __spark_entry__ import queries
from tandem.llm.decontaminate import WINDOW
from tests.llm.test_decontaminate import brute, words
from tests.llm.test_near_dups import classes


def test_stages_against_plain_versions(spark, tmp_path):
    sf_dir = "/root/testdata/sf0.001"
    columns = None
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = {r.doc_id: r for r in docs.collect()}
        columns = columns or docs.columns
        stage(spark, docs, sf_dir).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        after = {r.doc_id: r for r in docs.collect()}
        assert after.keys() <= before.keys() and after
        if number < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns
        if name == "language_id":
            assert after.keys() == {i for i, r in before.items() if re.search(r"[^\W\d_]", r.text or "")}
        if name == "quality":
            labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
            told = [(i in after, quality) for i, quality in labels.items() if i in before]
            assert sum(kept == bool(quality) for kept, quality in told) > 0.95 * len(told)
        if name == "near_duplicates":
            groups, _ = classes({i: r.text for i, r in before.items()}, 5, 80)
            assert after.keys() == {i for i, group in groups.items() if i == group}
        if name == "decontamination":
            items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
            for i, row in before.items():
                n, hit, _ = brute(row.text, items, WINDOW)
                if not hit:
                    assert after[i] == row
                elif i in after:
                    left = [word for place, word in enumerate(words(row.text)) if place not in hit]
                    assert words(after[i].text) == left and after[i].n_chars == len(after[i].text)
        if name == "mixing":
            assert all(0 < r.taken <= 3 * r.size for r in after.values())
            assert abs(sum(r.taken for r in after.values()) - sum(len(re.findall(r"[^\x20\x09-\x0D]+", r.text))
                                                                 for r in before.values())) <= 60


def test_query_is_the_stages_in_a_row(spark):
    found = queries()["pipeline"](spark, "/root/testdata/sf0.001")
    assert found.columns == ["doc_id", "source", "size", "source_size", "target", "taken"] and found.count() > 50


def test_odd_documents(spark, tmp_path):
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, taken int"
    rows = [(1, None, None, None, None, 1), (2, "", "en", "a", 0, 1), (None, "some words here", "en", None, 15, 1),
            (7, "some words here", "en", "a", 15, 1), (7, "some words here", "en", "a", 15, 1), (8, "12 34", "de", "b", 5, 1)]
    sf_dir = str(tmp_path / "in")
    spark.createDataFrame(rows, schema).write.parquet(f"{sf_dir}/documents.parquet")
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(f"{sf_dir}/labels.parquet")
    spark.createDataFrame([(1, None)], "item_id bigint, text string").write.parquet(f"{sf_dir}/benchmark.parquet")
    found = corpus_pipeline.run(spark, sf_dir).collect()
    assert {r.doc_id for r in found} <= {7, None} and found
    empty = str(tmp_path / "empty")
    spark.createDataFrame([], schema).write.parquet(f"{empty}/documents.parquet")
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(f"{empty}/labels.parquet")
    spark.createDataFrame([], "item_id bigint, text string").write.parquet(f"{empty}/benchmark.parquet")
    assert corpus_pipeline.run(spark, empty).count() == 0
