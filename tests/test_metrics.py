import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tandem.operators import alignment, bleu, report
from tandem.operators.bleu import corpus_bleu
from tandem.operators.matching import _tiles, greedy_match, token_bests
from tandem.operators.profile import corpus_profile
from tests.conftest import plan
from tests.test_text import rules_one_by_one


def brute_force(pairs):
    """(score, bp, sys_len, ref_len, correct, total, precision) of a corpus."""
    correct, total, sys_len, ref_len = [0] * 4, [0] * 4, 0, 0
    for mt, ref in pairs:
        h, r = rules_one_by_one(mt), rules_one_by_one(ref)
        sys_len, ref_len = sys_len + len(h), ref_len + len(r)
        for n in range(1, 5):
            hyp, gold = (Counter(tuple(x[i:i + n]) for i in range(len(x) - n + 1)) for x in (h, r))
            correct[n - 1] += sum((hyp & gold).values())
            total[n - 1] += sum(hyp.values())
    penalty = 1.0 if sys_len >= ref_len else math.exp(1 - ref_len / sys_len) if sys_len else 0.0
    precision, smooth = [0.0] * 4, 1
    if any(correct):
        for n in range(4):
            if not total[n]:
                break
            if correct[n]:
                precision[n] = 100 * correct[n] / total[n]
            else:
                smooth *= 2
                precision[n] = 100 / (smooth * total[n])
    score = penalty * math.exp(sum(map(math.log, precision)) / 4) if all(precision) else 0.0
    return score, penalty, sys_len, ref_len, correct, total, precision


CASES = {
    "identical": [("the cat sat on the mat .", "the cat sat on the mat .")],
    "empty": [("", "a b c d")],
    "both_empty": [("", "")],
    "shorter": [("the cat sat on the", "the cat sat on the mat today")],
    "longer": [("the cat sat on the mat today", "the cat sat on the")],
    "three_tokens": [("a b c", "a b c")],
    "no_match": [("x y z w", "a b c d")],
    "clipping": [("the the the the the the", "the cat the dog")],
    "mixed": [("Good morning, 你好嗎？3.5-4 (ok)", "Good morning, 你好！3.5 - 4 (ok)"), ("x", "x")],
    "partial": [("a b x d", "a b c d"), ("a a a b b", "a a b b b a")],
}


def as_frame(spark, cases):
    rows = [(name, i, *pair) for name, pairs in cases.items() for i, pair in enumerate(pairs)]
    return spark.createDataFrame(rows, "model string, line_no int, mt string, ref string")


def check_bleu(spark, cases):
    found = {r.model: r for r in bleu.corpus_bleu(as_frame(spark, cases), ["model"]).collect()}
    for name, pairs in cases.items():
        score, penalty, sys_len, ref_len, correct, total, precision = brute_force(pairs)
        row = found[name]
        assert (row.sys_len, row.ref_len, row.correct, row.total) == (sys_len, ref_len, correct, total), name
        assert row.precision == pytest.approx(precision) and row.bp == pytest.approx(penalty), name
        assert row.bleu == pytest.approx(score), name


def test_bleu_cases(spark):
    check_bleu(spark, CASES)
    assert bleu.corpus_bleu(as_frame(spark, {"i": CASES["identical"]}), ["model"]).first().bleu == pytest.approx(100)


def test_bleu_random_corpora(spark):
    draw = random.Random(5)
    words = ["a", "b", "c", "好", "3.5", ",", "the", "\u0001"]
    text = lambda: " ".join(draw.choice(words) for _ in range(draw.choice([0, 1, 3, 8, 40])))
    check_bleu(spark, {f"c{i}": [(text(), text()) for _ in range(draw.randint(1, 12))] for i in range(40)})


def test_bleu_shuffles_only_sums(spark):
    executed = plan(bleu.corpus_bleu(as_frame(spark, CASES), ["model"]))
    assert executed.split("== Physical Plan ==")[1].count("Exchange") == 1


def test_overlap_of_long_repetitive_texts(spark):
    pairs = [("a " * 3000 + "b", "a " * 2500 + "b b")]
    check_bleu(spark, {"long": pairs})


def matches_of(hyp, ref):
    """Clipped matches of one pair of token lists."""
    if hyp is None or ref is None:
        return [None] * 4
    return [sum((Counter(zip(*[hyp[i:] for i in range(n)])) & Counter(zip(*[ref[i:] for i in range(n)]))).values())
            for n in range(1, 5)]


@pytest.mark.parametrize("words", [1, 2, 5, 50])
def test_matches_of_many_rows_at_once(words):
    draw = random.Random(words)

    def tokens():
        return None if draw.random() < 0.1 else [f"t{draw.randrange(words)}" for _ in range(draw.choice([0, 1, 2, 3, 4, 9, 60]))]

    for rows in (0, 1, 2, 200):
        hyp, ref = ([tokens() for _ in range(rows)] for _ in range(2))
        # as slices of longer columns, whose other rows do not count
        sides = [pa.array([["t0"], *side, ["t1", "t0"]], pa.list_(pa.string())).slice(1, rows) for side in (hyp, ref)]
        found = [counts.to_pylist() for counts in bleu.clipped_matches(*sides)]
        assert list(map(list, zip(*found))) == [matches_of(*pair) for pair in zip(hyp, ref)]


def test_bleu_counts_no_match_row_by_row(spark):
    """Array functions are interpreted element by element: they took most of the time of an evaluation."""
    physical = plan(bleu.segment_statistics(as_frame(spark, CASES), ["model"])).split("== Physical Plan ==")[1]
    assert "MapInArrow" in physical and "array_intersect" not in physical and "lambda" not in physical


def test_statistics_of_a_missing_text(spark):
    df = spark.createDataFrame([("m", None, "a b"), ("n", "a b", None), ("o", "a b", "b")], "model string, mt string, ref string")
    found = {r.model: r for r in bleu.segment_statistics(df, ["model"]).collect()}
    assert [found[m].correct_1 for m in "mno"] == [None, None, 1]
    assert [found[m].total_2 for m in "mno"] == [0, 1, 1] and found["n"].sys_len == 2 and found["m"].ref_len == 2


def vectors(spark, segments, size=8, seed=1):
    draw = np.random.default_rng(seed)
    return [(seg, side, pos, draw.normal(size=size).astype("float32").tolist())
            for seg, counts in segments.items() for side, count in zip(("mt", "ref"), counts) for pos in range(count)]


@pytest.mark.parametrize("block", [1, 3, 512, None])
def test_greedy_match_by_brute_force(spark, block):
    segments = {1: (5, 7), 2: (1, 1), 3: (0, 4), 4: (23, 2), 5: (40, 50)}
    rows = vectors(spark, segments) + [(6, "mt", 0, [0.0] * 8), (6, "ref", 0, [1.0] * 8)]
    df = spark.createDataFrame(rows, "seg bigint, side string, pos int, vec array<float>")
    found = {r.seg: (r.p, r.r, r.f1) for r in greedy_match(df, ["seg"], block, tile=16).collect()}
    assert set(found) == {1, 2, 3, 4, 5, 6} and found[3] == (0, 0, 0)
    for seg in set(found) - {3}:
        unit = {}
        for side in ("mt", "ref"):
            m = np.array([v for s, d, _, v in rows if (s, d) == (seg, side)])
            norm = np.linalg.norm(m, axis=1, keepdims=True)
            unit[side] = np.divide(m, norm, out=np.zeros_like(m), where=norm > 0)
        cosine = unit["mt"] @ unit["ref"].T
        p, r = cosine.max(axis=1).mean(), cosine.max(axis=0).mean()
        assert found[seg] == pytest.approx((p, r, 2 * p * r / (p + r) if p + r else 0), abs=1e-6)


def test_a_hot_segment_is_spread(spark):
    df = spark.createDataFrame(vectors(spark, {1: (60, 60), 2: (2, 2)}), "seg bigint, side string, pos int, vec array<float>")
    bests = token_bests(df, ["seg"], 4, tile=8)
    assert bests.count() == 124
    assert bests.groupBy("seg", "side", "pos").count().count() == 124


def test_vectors_cross_once_per_tile_of_the_other_side(spark):
    df = spark.createDataFrame(vectors(spark, {1: (60, 90), 2: (2, 2)}), "seg bigint, side string, pos int, vec array<float>")
    large = df.filter("seg = 1").select("seg").distinct()
    for tile, copies in ((128, 150), (45, 60 * 2 + 90 * 2), (30, 60 * 3 + 90 * 2)):
        ends = large.withColumns({"_last_mt": F.lit(59 // tile), "_last_ref": F.lit(89 // tile)})
        assert _tiles(df, ends, 1, ["seg"], tile).count() == copies


TRUTH = [("A", i, f"a{i}") for i in range(5)] + [("B", i, f"b{i}") for i in range(5)]


def test_alignment(spark):
    truth = spark.createDataFrame(TRUTH, "lang string, line_no bigint, text string")
    rows = [("m", "A", "B", i, f"m{i}") for i in range(4)] + [("m", "B", "A", i, f"n{i}") for i in range(5)]
    rows += [("m", "A", "C", 0, "no truth")]
    predictions = spark.createDataFrame(rows, "model string, src_lang string, tgt_lang string, line_no bigint, text string")
    triples = alignment.aligned_triples(predictions, truth)
    assert sorted((r.tgt_lang, r.line_no, r.src, r.mt, r.ref) for r in triples.collect()) == [
        ("A", i, f"b{i}", f"n{i}", f"a{i}") for i in range(5)] + [("B", i, f"a{i}", f"m{i}", f"b{i}") for i in range(4)]
    assert alignment.aligned_pairs(predictions, truth).count() == 9
    counts = {r.tgt_lang: (r.n_src, r.n_mt, r.n_ref, r.aligned) for r in alignment.alignment_report(predictions, truth).collect()}
    assert counts == {"A": (5, 5, 5, True), "B": (5, 4, 5, False), "C": (5, 1, 0, False)}
    with pytest.raises(ValueError, match=r"2 misaligned directions: m A->B \(5/4/5\); m A->C"):
        alignment.require_alignment(predictions, truth)
    with pytest.raises(ValueError, match=r"2 misaligned directions: m A->B \(5/4/5\)$"):
        alignment.require_alignment(predictions, truth, shown=1)
    flags = alignment.availability(predictions.select("model", "src_lang", "tgt_lang").distinct(), predictions.limit(0))
    assert flags.filter("available").count() == 0 and flags.count() == 3
    alignment.require_alignment(predictions.filter("tgt_lang = 'A'"), truth)
    grid = spark.createDataFrame([("m", "A", "B"), ("m", "B", "D")], "model string, src_lang string, tgt_lang string")
    assert [r.tgt_lang for r in alignment.available(grid, predictions).collect()] == ["B"]
    assert [r.tgt_lang for r in alignment.missing(grid, predictions).collect()] == ["D"]


def test_leaderboard_ties(spark):
    rows = [("x", "A", "B", 3.0, 0.5), ("y", "A", "B", 2.0, 0.5), ("z", "A", "B", 3.0, 0.5), ("x", "B", "A", 1.0, 0.2),
            ("y", "B", "A", 2.0, 0.1)]
    df = spark.createDataFrame(rows, "model string, src_lang string, tgt_lang string, bleu_score double, bert_f1 double")
    board = report.leaderboard(df, ["bleu_score", "bert_f1"]).collect()
    best = {(r.tgt_lang, r.metric, r.model) for r in board if r.best}
    assert best == {("B", "bleu_score", "x"), ("B", "bleu_score", "z"), ("A", "bleu_score", "y"), ("A", "bert_f1", "x")}
    assert {(r.tgt_lang, r.model) for r in board if r.best_model} == {("B", "x"), ("B", "z"), ("A", "y")}
    deltas = report.against_baseline(df, "x", ["bleu_score"]).collect()
    assert sorted((r.model, r.tgt_lang, r.delta_bleu_score) for r in deltas) == [("y", "A", 1.0), ("y", "B", -1.0), ("z", "B", 0.0)]
    lonely = report.against_baseline(df.filter("model <> 'x' OR tgt_lang = 'B'"), "x", ["bleu_score"]).collect()
    assert {(r.model, r.tgt_lang): r.delta_bleu_score for r in lonely} == {
        ("y", "A"): None, ("y", "B"): -1.0, ("z", "B"): 0.0}
    table = report.score_table(df, ["x", "y", "z"]).filter("tgt_lang = 'A'").first()
    assert (table.x, table.y, table.z) == (1.0, 2.0, None)


def test_side_by_side(spark):
    rows = [("m", "A", "B", 0, "s"), ("n", "A", "B", 0, "s"), ("m", "A", "B", 1, "s"), ("n", "A", "B", 1, "t"),
            ("m", "A", "B", 2, "s")]
    df = spark.createDataFrame(rows, "model string, src_lang string, tgt_lang string, line_no bigint, text string")
    found = report.side_by_side(df, ["m", "n"]).orderBy("line_no").collect()
    assert [(r.m, r.n, r.same) for r in found] == [("s", "s", True), ("s", "t", False), ("s", None, False)]


def test_rounding_is_half_up(spark):
    df = spark.createDataFrame([(2.675,), (0.125,)], "v double")
    assert [r[0] for r in df.select(report.rounded(F.col("v"))).collect()] == [2.68, 0.13]


def test_tokens_with_control_characters_are_not_confused(spark):
    rows = [("k", "w x\u0001y z", "w x y\u0001z"), ("l", "a\u0001 \u0002b", "a\u0002a b"), ("m", "x\u0001y z", "x\u0001y z")]
    df = spark.createDataFrame(rows, "model string, mt string, ref string")
    found = {r.model: r.correct for r in corpus_bleu(df, ["model"]).collect()}
    assert found["k"][1:] == [0, 0, 0] and found["l"][1] == 0 and found["m"][1] == 1


def test_two_truth_texts_for_one_line(spark):
    truth = spark.createDataFrame([*TRUTH, ("A", 2, "again")], "lang string, line_no bigint, text string")
    predictions = spark.createDataFrame(
        [("m", "A", "B", 2, "t")], "model string, src_lang string, tgt_lang string, line_no bigint, text string")
    with pytest.raises(Exception, match="two truth texts of one language for line 2"):
        alignment.aligned_triples(predictions, truth).collect()


def test_a_null_source_is_not_the_total(spark):
    df = spark.createDataFrame([("a", "xx"), (None, "yyy")], "source string, text string")
    found = {(r.source, r.is_total): r.chars for r in corpus_profile(df).collect()}
    assert found == {("a", False): 2, (None, False): 3, (None, True): 5}
