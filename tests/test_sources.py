import pytest
from pyspark.sql import functions as F

from tandem.functions.languages import LANGUAGE_NAMES, inverted, mapped, metric_language
from tandem.sinks import writers
from tandem.sources import evaluation, lines, parallel


def test_clean_lines_of_files_and_folders(spark, files):
    root = files({
        "a.txt": "  x \r\n\u3000y\u00a0\rz\u200b\n\n \t \nlast", "sub/b.txt": "q\n", "sub/c.txt": "\n"})
    found = lines.clean_lines(lines.scan_lines(spark, [f"{root}/a.txt", f"{root}/sub"]))
    assert sorted((r.name, r.text) for r in found.collect()) == [
        ("a.txt", "last"), ("a.txt", "x"), ("a.txt", "y"), ("a.txt", "z\u200b"), ("b.txt", "q")]


def test_raw_lines_keep_blanks_and_spaces(spark, files):
    root = files({"a.txt": " x \n\ny"})
    found = lines.numbered_lines(spark, root, stripped=False)
    assert sorted((r.line_no, r.text) for r in found.collect()) == [(0, " x "), (1, ""), (2, "y")]


def test_monolingual_chunks_in_reading_order(spark, files):
    root = files({"a.txt": "abcdefg\n\n hi \n"})
    found = lines.load_monolingual(spark, root, 3).orderBy("name", "path", "block", "row", "chunk_no")
    assert [(r.chunk_no, r.text) for r in found.collect()] == [(0, "abc"), (1, "def"), (2, "g"), (0, "hi")]
    assert "Exchange" not in lines.load_monolingual(spark, root, 3)._jdf.queryExecution().executedPlan().toString()


def test_manifest(spark, files):
    root = files({"paths.txt": " a.csv \n\nb.csv", "none.txt": "\n \n"})
    assert lines.read_manifest(spark, f"{root}/paths.txt") == ["a.csv", "b.csv"]
    with pytest.raises(ValueError):
        lines.read_manifest(spark, f"{root}/none.txt")


def dictionaries(files):
    root = files({
        "a.csv": 'Cantonese,English\n"佢話""好""","he said ""fine"""\n"兩\n行",two lines\n"",empty\n,missing\nnull,NA\n',
        "b.csv": "Cantonese,Traditional Chinese\n係,是\n",
    })
    return [f"{root}/a.csv", f"{root}/b.csv"]


def test_dictionaries_quotes_nulls_and_schema_union(spark, files):
    paths = dictionaries(files)
    found = parallel.load_dictionaries(spark, paths, multi_line=True)
    assert found.columns == ["Cantonese", "English", "Traditional Chinese"]
    assert set(map(tuple, found.collect())) == {
        ('佢話"好"', 'he said "fine"', None), ("兩\n行", "two lines", None), (None, "empty", None),
        (None, "missing", None), ("null", "NA", None), ("係", None, "是")}
    numbered = parallel.load_numbered_dictionaries(spark, paths, multi_line=True)
    assert sorted((r.source_no, r.line_no, r.Cantonese) for r in numbered.collect() if r.Cantonese) == [
        (0, 0, '佢話"好"'), (0, 1, "兩\n行"), (0, 4, "null"), (1, 0, "係")]


def test_dictionary_manifest(spark, files, tmp_path):
    paths = dictionaries(files)
    (tmp_path / "manifest.txt").write_text("\n".join(paths))
    assert parallel.load_dictionary_manifest(spark, str(tmp_path / "manifest.txt"), multi_line=True).count() == 6


ALIGNED = {
    "dev.yue_Hant": "一\n二\n", "devtest.yue_Hant": "三", "dev.eng_Latn": "one\n\n", "devtest.eng_Latn": " three ",
    "dev.cmn_Hans": "1\n2", "devtest.cmn_Hans": "3", "dev.cmn_Hant": "I\nII", "devtest.cmn_Hant": "III",
    "README": "not a language file\n",
}


def test_aligned_files(spark, files):
    found = parallel.load_aligned(spark, files(ALIGNED), strict=True).orderBy("line_no")
    assert found.columns == ["line_no", "Simplified Chinese", "Traditional Chinese", "English", "Cantonese"]
    assert list(map(tuple, found.collect())) == [
        (0, "1", "I", "one", "一"), (1, "2", "II", "", "二"), (2, "3", "III", "three", "三")]


def test_uneven_aligned_files(spark, files):
    root = files(ALIGNED | {"devtest.yue_Hant": "三\n四"})
    found = parallel.load_aligned(spark, root).filter("line_no = 3").first()
    assert (found.Cantonese, found.English) == ("四", None)
    with pytest.raises(Exception, match="line 3 is missing for Simplified Chinese, Traditional Chinese, English"):
        parallel.load_aligned(spark, root, strict=True).collect()


def test_unknown_language_code_fails(spark, files):
    with pytest.raises(Exception, match="unknown language: xx"):
        parallel.load_aligned(spark, files(ALIGNED | {"dev.xx": "?"})).collect()


def test_language_lookups(spark):
    df = spark.createDataFrame([("eng_Latn",), ("nope",), (None,)], "code string")
    assert [r[0] for r in df.select(mapped(F.col("code"), LANGUAGE_NAMES, strict=False)).collect()] == ["English", None, None]
    assert inverted(LANGUAGE_NAMES)["Cantonese"] == "yue_Hant"
    with pytest.raises(ValueError):
        inverted({"a": "x", "b": "x"})
    assert [r[0] for r in df.select(metric_language(F.lit("English")), ).distinct().collect()] == ["en"]


def test_predictions_and_truth(spark, files):
    root = files({
        "m1/Cantonese_to_English.txt": "a \n\nc", "m1/English_to_Cantonese.txt": "甲", "m1/notes.txt": "-",
        "m2/Cantonese_to_Simplified_Chinese.txt": "乙", "truth/English.txt": "A\nB\nC"})
    found = evaluation.read_predictions(spark, [f"{root}/m1", f"{root}/m2"])
    assert sorted(map(tuple, found.collect())) == [
        ("m1", "Cantonese", "English", 0, "a"), ("m1", "Cantonese", "English", 1, ""),
        ("m1", "Cantonese", "English", 2, "c"), ("m1", "English", "Cantonese", 0, "甲"),
        ("m2", "Cantonese", "Simplified_Chinese", 0, "乙")]
    assert sorted(map(tuple, evaluation.list_predictions(spark, [f"{root}/m1", f"{root}/m2"]).collect())) == [
        ("m1", "Cantonese", "English"), ("m1", "English", "Cantonese"), ("m2", "Cantonese", "Simplified_Chinese")]
    assert sorted(map(tuple, evaluation.read_truth(spark, f"{root}/truth").collect())) == [
        ("English", 0, "A"), ("English", 1, "B"), ("English", 2, "C")]


def test_prediction_store_and_exports(spark, tmp_path):
    rows = [("r", "m", "Cantonese", "Simplified Chinese", i, f"t{i}\nx") for i in range(5)]
    df = spark.createDataFrame(rows, "run string, model string, src_lang string, tgt_lang string, line_no bigint, text string")
    writers.write_predictions(df, str(tmp_path / "store"))
    stored = spark.read.parquet(str(tmp_path / "store")).filter("tgt_lang = 'Simplified_Chinese'")
    assert sorted((r.line_no, r.text) for r in stored.collect()) == [(i, f"t{i} x") for i in range(5)]
    both = df.unionByName(df.withColumn("model", F.lit("n 2")))
    writers.export_predictions(both, str(tmp_path / "m"))
    again = evaluation.read_predictions(spark, str(tmp_path / "m"))
    assert sorted(map(tuple, again.collect())) == [
        (model, "Cantonese", "Simplified_Chinese", i, f"t{i} x") for model in ("m", "n 2") for i in range(5)]
    writers.write_evaluation(df.select("model", "line_no"), str(tmp_path / "csv"))
    assert spark.read.csv(str(tmp_path / "csv"), header=True).count() == 5


def test_run_stamps(spark):
    df = spark.sql("select timestamp_ntz'2024-07-09 21:59:54' as ts")
    assert df.select(writers.run_stamp(F.col("ts")), writers.run_stamp(F.col("ts"), "compact")).first()[:] == (
        "2024-07-09_21-59-54", "20240709-215954")


def test_texts_stay_on_their_lines(spark, tmp_path):
    rows = [("r", "m", "A", "B", 0, "one\rtwo\r\nthree\nfour"), ("r", "m", "A", "B", 1, "five")]
    schema = "run string, model string, src_lang string, tgt_lang string, line_no bigint, text string"
    for mode in ("space", "remove", "none"):
        path = str(tmp_path / mode)
        writers.export_predictions(spark.createDataFrame(rows, schema), path, mode)
        found = {r.line_no: r.text for r in evaluation.read_predictions(spark, path).collect()}
        assert found == {0: "onetwothreefour" if mode == "remove" else "one two three four", 1: "five"}
    truth = spark.createDataFrame([("A", 0, "a\rb"), ("A", 1, None), ("A", 2, "c")], "lang string, line_no bigint, text string")
    writers.export_truth(truth, str(tmp_path / "truth"))
    assert {r.line_no: r.text for r in evaluation.read_truth(spark, str(tmp_path / "truth")).collect()} == {0: "a b", 1: "", 2: "c"}


def test_a_run_written_again_replaces_itself(spark, tmp_path):
    schema = "run string, model string, src_lang string, tgt_lang string, line_no bigint, text string"
    path = str(tmp_path / "store")

    def write(model, texts):
        rows = [("r", model, "A", "B", i, text) for i, text in enumerate(texts)]
        writers.write_predictions(spark.createDataFrame(rows, schema), path)

    write("m", ["old", "old", "old"])
    write("n", ["other"])
    write("m", ["new", "new"])
    found = spark.read.schema(schema).parquet(path).collect()
    assert sorted((r.model, r.line_no, r.text) for r in found) == [("m", 0, "new"), ("m", 1, "new"), ("n", 0, "other")]


def test_columns_go_by_name_in_every_file(spark, files):
    root = files({"d/1.csv": "en,fr\nhello,bonjour\n", "d/2.csv": 'fr,en\n"sa\nlut",hi\n', "d/3.csv": "en\nNA\n", "d/4.csv": ""})
    found = parallel.read_dictionary(spark, f"{root}/d", multi_line=True)
    assert sorted((r.en, r.fr or "") for r in found.collect()) == [("NA", ""), ("hello", "bonjour"), ("hi", "sa\nlut")]
    blank = parallel.read_dictionary(spark, f"{root}/d", multi_line=True, null_words=("NA",))
    assert blank.filter("en IS NULL").count() == 1
    many = files({f"m/{i}.csv": f"en,de\nx{i},y{i}\n" for i in range(30)}, "in2")
    merged = parallel.load_dictionaries(spark, [f"{many}/m/{i}.csv" for i in range(30)], multi_line=False)
    assert merged.count() == 30 and "Union" not in merged._jdf.queryExecution().optimizedPlan().toString()
    numbered = parallel.load_numbered_dictionaries(spark, [f"{many}/m/3.csv", f"{root}/d"], multi_line=True)
    assert sorted((r.source_no, r.line_no, r.en) for r in numbered.collect()) == [
        (0, 0, "x3"), (1, 0, "hello"), (1, 1, "hi"), (1, 2, "NA")]


def test_truth_files_of_one_name_are_refused(spark, files):
    root = files({"a/English.txt": "x\n", "b/English.txt": "y\n"})
    with pytest.raises(ValueError, match="English.txt"):
        evaluation.read_truth(spark, root)


def test_other_files_are_not_opened(spark, files):
    root = files({"m/A_to_B.txt": "x\n", "m/notes.txt": "y\n"})
    found = evaluation.scan_lines(spark, root, name_pattern=evaluation.PREDICTION_NAME)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "file_path" in plan[plan.index("Filters: ["):].split("]")[0]
    assert [r.text for r in found.collect()] == ["x"]
