import pytest
from pyspark.sql import functions as F

from tandem.functions import prompts
from tandem.operators import directions, pairs
from tandem.operators.directions import valid_directions
from tandem.operators.pairs import zip_columns
from tandem.plans.jobs import dictionary_examples, training_examples
from tests.conftest import plan

WIDE = [
    (0, "a", "b", "c", "d"), (1, "a", None, "", None), (2, None, None, None, None), (3, "x", None, None, None),
    (4, "p", "q", "r", None),
]


@pytest.fixture
def wide(spark):
    return spark.createDataFrame(WIDE, "row_id bigint, w string, x string, y string, z string")


def test_ordered_pairs_by_brute_force(wide):
    found = pairs.ordered_pairs(wide, ["w", "x", "y", "z"], ["row_id"])
    expected = [
        (row[0], s, t, row[1 + "wxyz".index(s)], row[1 + "wxyz".index(t)])
        for row in WIDE for s in "wxyz" for t in "wxyz"
        if s != t and row[1 + "wxyz".index(s)] is not None and row[1 + "wxyz".index(t)] is not None]
    assert list(map(tuple, found.collect())) == expected
    assert "Exchange" not in plan(found)


def test_both_directions_keep_nulls(wide):
    found = pairs.both_directions(wide, "w", "x", ["row_id"]).filter("row_id = 1")
    assert sorted(map(tuple, found.collect())) == [(1, "w", "x", "a", None), (1, "x", "w", None, "a")]
    assert pairs.both_directions(wide, "w", "x", ["row_id"], keep_nulls=False).count() == 4


def test_interleave_and_long(wide):
    found = pairs.interleave(wide.filter("row_id = 0"), ["w", "z"], ["row_id"])
    assert list(map(tuple, found.collect())) == [(0, 0, "a"), (0, 1, "d")]
    assert pairs.to_long(wide, ["w", "x"], ["row_id"]).count() == 10


PAIR = {"src_lang": "English", "tgt_lang": "Cantonese", "src_text": "50 % {x}\n", "tgt_text": "好"}


@pytest.mark.parametrize("name, expected", [
    ("inference", "<|im_start|> system Translate the given English words to Cantonese. <|im_end|> <|im_start|> user 50 % {x}\n <|im_end|>"),
    ("sft", "<|im_start|>system\nTranslate the given English words into Cantonese.<|im_end|>\n<|im_start|>user\n50 % {x}\n<|im_end|>\n<|im_start|>assistant\n好<|im_end|>\n"),
    ("sft_one_line", "<|im_start|>system Translate the given English words into Cantonese. <|im_end|><|im_start|>user 50 % {x}\n <|im_end|><|im_start|>assistant 好 <|im_end|>"),
    ("eval", "<|im_start|> system\n    Translate the given English words to Cantonese.<|im_end|>\n    <|im_start|> user\n    50 % {x}\n<|im_end|>\n    <|im_start|> assistant\n    "),
])
def test_templates_byte_for_byte(spark, name, expected):
    df = spark.createDataFrame([PAIR], "src_lang string, tgt_lang string, src_text string, tgt_text string")
    assert df.select(prompts.prompt(name)).first()[0] == expected


def test_completion_template(spark):
    df = spark.createDataFrame([("he", "llo")], "head string, tail string")
    assert df.select(prompts.prompt("completion")).first()[0] == (
        "<|im_start|> user\n        Complete the following text: he <|im_end|> \n        <|im_start|> assistant\n"
        "        llo <|im_end|>")


def test_chat_messages(spark):
    df = spark.createDataFrame([PAIR], "src_lang string, tgt_lang string, src_text string, tgt_text string")
    found = df.select(prompts.chat(F.col("src_lang"), F.col("tgt_lang"), F.col("src_text"))).first()[0]
    assert [tuple(m) for m in found] == [
        ("system", "Translate the given English words into Cantonese."), ("user", "50 % {x}\n")]
    both = df.select(prompts.chat_both_ways(
        F.col("src_lang"), F.col("tgt_lang"), F.col("src_text"), F.col("tgt_text"))).first()[0]
    assert [m[0].content for m in both] == [
        "Translate the given English words to Cantonese.", "Translate the given Cantonese words to English."]
    assert [m[1].content for m in both] == ["50 % {x}\n", "好"]


def test_direction_rules(spark):
    rows = [("Cantonese", "English"), ("English", "Cantonese"), ("Cantonese", "Cantonese"), ("English", "French"),
            (None, "English"), (None, None)]
    df = spark.createDataFrame(rows, "src_lang string, tgt_lang string")
    good, bad = directions.split_directions(df)
    assert sorted(map(tuple, good.collect())) == [
        ("Cantonese", "English"), ("Cantonese", "English"), ("English", "Cantonese")]
    assert sorted(r.error for r in bad.collect()) == ["both sides are Cantonese"] * 2 + ["either side must be Cantonese"]
    assert directions.valid_directions(df.limit(2)).count() == 2
    with pytest.raises(Exception, match="Cantonese"):
        directions.valid_directions(df).collect()


def test_grid_and_all_directions(spark):
    names = ["A", "Cantonese", "B"]
    assert directions.without_pivot(names) == ["A", "B"]
    assert directions.pivot_grid(names) == [("Cantonese", "A"), ("Cantonese", "B"), ("A", "Cantonese"), ("B", "Cantonese")]
    models = spark.createDataFrame([("m",)], "model string")
    assert directions.with_grid(models, names).count() == 4
    long = spark.createDataFrame([(0, "A", "a"), (0, "Cantonese", "c"), (0, "B", "b")], "line_no bigint, lang string, text string")
    found = directions.in_all_directions(long, names)
    assert sorted((r.src_lang, r.tgt_lang, r.text) for r in found.collect()) == [
        ("A", "Cantonese", "a"), ("B", "Cantonese", "b"), ("Cantonese", "A", "c"), ("Cantonese", "B", "c")]
    picked = long.select(directions.direction(F.col("lang"), F.lit(True)).alias("d")).select("d.*")
    assert set(map(tuple, picked.collect())) >= {("Cantonese", "A"), ("Cantonese", "B")}


def test_training_examples_are_row_local_and_accept_a_function(wide):
    found = training_examples(wide, ["row_id"])
    assert found.count() == 12 + 2 + 6 and "Exchange" not in plan(found)
    own = training_examples(wide, ["row_id"], formatting=lambda p: p.select(F.concat("src_text", F.lit("=>"), "tgt_text")))
    assert own.count() == 20


def test_dictionary_examples_scatter_copies(spark, files):
    root = files({"a.csv": "A,B\n" + "x,y\n" * 300 + "".join(f"p{i},q{i}\n" for i in range(300))})
    found = [r.prompt for r in dictionary_examples(spark, [f"{root}/a.csv"], multi_line=True).collect()]
    again = [r.prompt for r in dictionary_examples(spark, [f"{root}/a.csv"], multi_line=True).collect()]
    assert found == again and len(found) == 1200
    copies = [i for i, text in enumerate(found) if "\nx<" in text or "\ny<" in text]
    assert len(copies) == 600 and min(copies) < 100 and max(copies) > 1100
    assert sum(b - a > 3 for a, b in zip(copies, copies[1:])) > 30


def test_checks_hold_whatever_is_selected(spark):
    long = spark.createDataFrame([(0, "en", "a"), (0, "fr", "b"), (1, "en", "c")], "line_no bigint, lang string, text string")
    uneven = zip_columns(long, ["en", "fr"], strict=True)
    even = zip_columns(long.filter("line_no = 0"), ["en", "fr"], strict=True)
    asked = spark.createDataFrame([("A", "B", 1)], "src_lang string, tgt_lang string, n int")
    for action in (lambda df: df.count(), lambda df: df.select(df.columns[-1]).collect()):
        assert action(even)
        with pytest.raises(Exception, match="line 1 is missing for fr"):
            action(uneven)
        with pytest.raises(Exception, match="either side must be"):
            action(valid_directions(asked))


def test_dictionary_examples_parse_their_files_once(spark, files):
    """The range sort reads its input twice: that is the stored rows, not the files and their records."""
    root = files({"a.csv": 'en,fr\n"one\nline",un\ntwo,deux\n'})
    found = dictionary_examples(spark, [f"{root}/a.csv"], multi_line=True)
    assert "MapInArrow" not in plan(found) and "from_csv" not in plan(found)
    assert found.count() == 4
