import math
import zlib

import numpy as np
import pyarrow as pa
import pytest

from tandem.llm.quality import Leader, _vectors, good_documents, quality_scores, quality_weights, scores
from tandem.llm.queries import QUERIES


def test_leader_learns_a_line():
    rng = np.random.default_rng(2)
    leader = Leader(6)
    for _ in range(2000):
        label = rng.integers(0, 2)
        leader.update(np.array([0, 3 + label]), np.array([1.0, 1.0]), float(label))
    weights = leader.weights(slice(None))
    assert weights[4] > 0.5 > -0.5 > weights[3] and weights[10] == 0


def test_odd_rows(spark):
    rows = [(i, f"fine words here number{i} and more." if i % 2 else f"BAD!! WORDS!! X{i}!! AND!!", 0.5) for i in range(60)]
    rows += [(100, None, 0.5), (101, "", 0.5), (101, "", 0.5), (None, "fine words", 0.5), (102, "ok " * 40000, 0.5)]
    documents = spark.createDataFrame(rows, "doc_id bigint, text string, score double")
    labels = [(i, i % 2) for i in range(60)] + [(5, 1), (7, None), (None, 1), (3, 9), (100, 1), (5000, 0)]
    labels = spark.createDataFrame(labels, "doc_id bigint, quality int")
    weights = quality_weights(documents, labels)
    assert (weights == quality_weights(documents, labels)).all()
    found = quality_scores(documents, weights)
    assert found.dtypes == [("doc_id", "bigint"), ("score", "double"), ("predicted", "int")]
    result = {r.doc_id: r for r in found.collect()}
    assert found.count() == len(rows)
    assert all(result[i].predicted == i % 2 for i in range(60))
    assert result[100].score == result[101].score and 0 <= result[102].score <= 1
    assert all(r.predicted == (r.score >= 0.5) for r in result.values())
    kept = good_documents(documents, weights)
    assert kept.columns == documents.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, r in result.items() if r.predicted}
    nothing = quality_weights(documents, labels.limit(0))
    assert not nothing.any() and scores(pa.array(["x", ""]), nothing).tolist() == [0.5, 0.5]
    assert quality_scores(documents.limit(0), weights).count() == 0


def test_repeated_rows_teach_once(spark):
    rows = [(i, f"fine words here number{i}" if i % 2 else f"BAD!! WORDS!! X{i}!!") for i in range(10)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(10)], "doc_id bigint, quality int")
    once, often = (spark.createDataFrame(r, "doc_id bigint, text string") for r in (rows, rows + rows[:1] * 40))
    assert (quality_weights(once, labels) == quality_weights(often, labels)).all()


def test_scores_do_not_depend_on_neighbours():
    weights = np.random.default_rng(0).standard_normal(1 << 18).astype(np.float32)
    texts = ["a b", "", "c!! D", "x " * 50]
    whole = scores(pa.array(texts), weights)
    assert np.allclose(whole, [scores(pa.array([text]), weights)[0] for text in texts])


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    rows = {r.doc_id: r for r in QUERIES["op6_quality"](spark, sf_dir).collect()}
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in rows.items())
    held = [(rows[i].predicted, quality) for i, quality in labels.items() if rows[i].held_out]
    assert len(held) > 50 and np.mean([a == b for a, b in held]) > 0.97


def plain_probability(text, weights):
    """The score as a plain sparse dot product, a feature at a time."""
    (at, values), = _vectors(pa.array([text]), int(len(weights)).bit_length() - 1)
    total = sum(float(weights[i]) * float(v) for i, v in zip(at.tolist(), values.tolist()))
    return 1 / (1 + math.exp(-max(-35.0, min(35.0, total))))


def test_scores_are_sparse_dot_products():
    weights = np.random.default_rng(3).standard_normal(1 << 10).astype(np.float32) / 40
    texts = ["", "one two three", "one two three one two three", "Ünïcode wörds, and 12 marks!!", "x " * 500]
    for text, score in zip(texts, scores(pa.array(texts), weights)):
        assert score == pytest.approx(plain_probability(text, weights), abs=1e-6)


def test_learner_against_a_plain_loop():
    rng = np.random.default_rng(4)
    bits, rows = 6, []
    for _ in range(60):
        at = np.unique(np.append(0, rng.integers(1, 64, 8)))
        rows.append((at, rng.random(len(at)) + 0.1, float(rng.integers(0, 2))))
    leader = Leader(bits)
    z, n = [0.0] * 64, [0.0] * 64

    def weight(i):
        if abs(z[i]) <= leader.l1:
            return 0.0
        return -(z[i] - math.copysign(leader.l1, z[i])) / ((leader.beta + math.sqrt(n[i])) / leader.alpha + leader.l2)

    for at, values, label in rows:
        leader.update(at, values, label)
        total = sum(weight(i) * v for i, v in zip(at.tolist(), values.tolist()))
        error = 1 / (1 + math.exp(-max(-35.0, min(35.0, total)))) - label
        for i, v in zip(at.tolist(), values.tolist()):
            g = error * v
            step = (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / leader.alpha
            old = weight(i)
            z[i] += g - step * old
            n[i] += g * g
    assert leader.weights(slice(None)) == pytest.approx([weight(i) for i in range(64)], abs=1e-9)


def test_the_sample_is_bounded_by_bytes(spark):
    docs = [(i, f"{'good' if i % 2 else 'bad'} text number {i}", "u") for i in range(40)]
    long = [(100 + i, "good and long " * 5000, "u") for i in range(4)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)] + [(100 + i, 0) for i in range(4)], "doc_id bigint, quality int")
    schema = "doc_id bigint, text string, h string"

    def learnt(rows, **options):
        return quality_weights(spark.createDataFrame(rows, schema), labels, **options)

    assert np.array_equal(learnt(docs + long, sample_bytes=1 << 16), learnt(docs, sample_bytes=1 << 16))
    assert not np.array_equal(learnt(docs + long), learnt(docs))
    assert not np.any(learnt(docs, sample_bytes=16))
    repeated = docs + [(1, "zz other text under one id " * n, "u") for n in range(1, 50)]
    assert np.array_equal(learnt(repeated), learnt(docs))
