"""Quality classifier: logistic regression on hashed word n-grams, trained by follow-the-regularised-leader updates.

A token is a run of letters and digits, or a run of marks. Its surface is its lower-case text; its form tells for a
word how it is written (lower case, capitals, first letter, digits), how long it is and whether it repeats one of the
two tokens before it, and for marks it is the surface. Features are hashed n-grams of one and two surfaces and of one
to three forms, weighted by their share of the text; a score is the sparse dot product with the weights.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tandem.llm.arrow import lists, slices, texts_of
from tandem.llm.words import TOKENS, cut, grams, salted

BITS = 18
SAMPLE_PER_CLASS = 1024
SAMPLE_BYTES = 32 << 20
EPOCHS = 4
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True


def features(texts: pa.Array, bits: int = BITS) -> tuple[list[np.ndarray], np.ndarray]:
    """Feature numbers by family, one array each, in token order; and where each text's tokens begin and end.

    An n-gram is listed at its first token; one that would leave its text is the number 0, which is not learnt.
    """
    words = cut(texts, TOKENS, lower=False)
    first, n = words.first, len(words.starts)
    if not n:
        return [], first
    raw = words.data
    words.data = np.where(_UPPER[raw], raw + 32, raw).astype(np.uint8)
    surface = words.hashes()
    sums = {}
    for name, kind in (("upper", _UPPER), ("digit", _DIGIT)):
        total = np.concatenate(([0], np.cumsum(kind[raw])))
        sums[name] = total[words.ends] - total[words.starts]
    length = words.ends - words.starts
    marks = TOKENS[raw[words.starts]] == 2
    case = np.where(sums["upper"] == 0, 0, np.where(sums["upper"] >= np.maximum(2, length // 2), 3,
                    np.where(_UPPER[raw[words.starts]], 1, 2)))
    again = np.zeros(n, np.int64)
    again[2:] = 2 * (surface[2:] == surface[:-2])
    again[1:][surface[1:] == surface[:-1]] = 1
    size = np.minimum(length, 24) // 6
    form = case + 4 * (sums["digit"] > 0) + 8 * again + 32 * size
    form = np.where(marks, surface, salted(form.astype(np.uint64), 3))
    text = words.text_of
    found = []
    for family, (values, order) in enumerate(((surface, 1), (surface, 2), (form, 1), (form, 2), (form, 3))):
        runs = grams(values, order, family) >> np.uint64(64 - bits)
        numbers = np.zeros(n, np.int64)
        numbers[: len(runs)] = np.where(text[: len(runs)] == text[order - 1:], np.maximum(runs.astype(np.int64), 1), 0)
        found.append(numbers)
    return found, first


class Leader:
    """Follow-the-regularised-leader with a learning rate per weight."""

    def __init__(self, bits: int, alpha: float = 0.5, beta: float = 1.0, l1: float = 0.02, l2: float = 0.1):
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z, self.n = np.zeros(1 << bits), np.zeros(1 << bits)

    def weights(self, at) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        return np.where(np.abs(z) <= self.l1, 0.0,
                        -(z - np.sign(z) * self.l1) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2))

    def update(self, at: np.ndarray, values: np.ndarray, label: float) -> None:
        weights = self.weights(at)
        gradient = (1 / (1 + np.exp(-np.clip(weights @ values, -35, 35))) - label) * values
        n = self.n[at]
        self.z[at] += gradient - (np.sqrt(n + gradient**2) - np.sqrt(n)) / self.alpha * weights
        self.n[at] = n + gradient**2


SCALE = 16.0


def _vectors(texts: pa.Array, bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Distinct features of each text and their values; feature 0 is the constant."""
    families, first = features(texts, bits)
    for start, end in zip(first[:-1].tolist(), first[1:].tolist()):
        numbers = np.concatenate([family[start:end] for family in families]) if end > start else np.zeros(0, np.int64)
        at, counts = np.unique(numbers[numbers > 0], return_counts=True)
        yield np.append(0, at), np.append(1.0, counts * (SCALE / max(1, end - start)))


def quality_weights(
    documents: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "quality",
    bits: int = BITS, sample_per_class: int = SAMPLE_PER_CLASS, epochs: int = EPOCHS,
    sample_bytes: int = SAMPLE_BYTES,
) -> np.ndarray:
    """Weights learnt from documents labelled 0 or 1: at most ``sample_per_class`` of each, those of least id hash.

    Ids are ranked first. Of the sample's texts those of more than a sixteenth of ``sample_bytes`` are left out, and
    the others of a class as soon as they exceed it together; the rest is learnt whole in one task, whose size these
    bounds fix. Of several texts under one id the smallest counts. Other labels, null labels and ids, and labels of no
    document are left out, a repeated label counts once, null texts count as empty, repeated rows count once. Without
    any row all weights are 0 and every score is 0.5.
    """
    marked = labels.select(F.col(id).alias("id"), F.col(label).cast("int").alias("label")).join(
        documents.select(F.col(id).alias("id")), "id", "left_semi").withColumn("h", F.xxhash64("id"))
    chosen = [
        marked.filter(F.col("label") == value).distinct().orderBy("h", "id").limit(sample_per_class)
        for value in (0, 1)]
    texts = documents.select(F.col(id).alias("id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    # at most 2 * sample_per_class ids
    known = texts.join(F.broadcast(chosen[0].unionByName(chosen[1])), "id").filter(
        F.octet_length("text") * 16 <= sample_bytes).groupBy("h", "label").agg(F.min("text").alias("text"))
    so_far = F.sum(F.octet_length("text")).over(Window.partitionBy("label").orderBy("h"))
    sample = known.withColumn("so_far", so_far).filter(F.col("so_far") <= sample_bytes).drop("so_far")

    def vectors(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                found = list(_vectors(texts_of(part.column("text")), bits))
                sizes = np.array([len(at) for at, _ in found])
                yield pa.RecordBatch.from_arrays(
                    [part.column("h"), part.column("label"),
                     lists(np.concatenate([at for at, _ in found]), sizes, pa.int64()),
                     lists(np.concatenate([values for _, values in found]), sizes, pa.float64())],
                    names=["h", "label", "at", "values"])

    def train(batch: pd.DataFrame) -> pd.DataFrame:
        leader = Leader(bits)
        batch = batch.sort_values(["h", "label"], ignore_index=True)
        order = np.random.default_rng(1)
        for _ in range(epochs):
            for i in order.permutation(len(batch)):
                leader.update(batch["at"][i], batch["values"][i], float(batch["label"][i]))
        weights = leader.weights(slice(None)).astype(np.float32)
        return pd.DataFrame({"weights": [weights.tobytes()]})

    learnt = sample.mapInArrow(vectors, "h bigint, label int, at array<bigint>, values array<double>").groupBy(
        F.lit(0).alias("all")).applyInPandas(train, "weights binary").collect()
    return np.frombuffer(learnt[0].weights, np.float32) if learnt else np.zeros(1 << bits, np.float32)


def scores(texts: pa.Array, weights: np.ndarray) -> np.ndarray:
    """The probability of label 1 for each text (strings without nulls)."""
    families, first = features(texts, int(len(weights)).bit_length() - 1)
    sizes = np.diff(first)
    totals = np.zeros(len(sizes))
    if families:
        learnt = weights.astype(np.float64)
        learnt[0] = 0.0
        sums = np.zeros(len(families[0]) + 1)
        np.cumsum(sum(learnt[family] for family in families), out=sums[1:])
        totals = (sums[first[1:]] - sums[first[:-1]]) * (SCALE / np.maximum(1, sizes))
    return 1 / (1 + np.exp(-np.clip(totals + float(weights[0]), -35, 35)))


def quality_scores(documents: DataFrame, weights: np.ndarray, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``documents``: id, score (0 to 1) and predicted (1 from 0.5 on) for the whole text.

    A null or empty text has the score of the constant alone. Rows are independent, repeated rows repeat, a null id
    stays null, an empty table gives an empty one; other columns are not read. Nothing is shuffled.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "_text"):
                found = scores(texts_of(part.column("_text")), weights)
                yield pa.RecordBatch.from_arrays(
                    [part.column("_id"), pa.array(found), pa.array((found >= 0.5).astype(np.int32))],
                    names=[id, "score", "predicted"])

    rows = documents.select(F.col(id).alias("_id"), F.col(text).cast("string").alias("_text"))
    kind = rows.schema["_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"`{id}` {kind}, score double, predicted int")


def good_documents(documents: DataFrame, weights: np.ndarray, text: str = "text", least: float = 0.5) -> DataFrame:
    """The rows, all columns, whose text scores at least ``least``."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text):
                yield part.filter(pa.array(scores(texts_of(part.column(text)), weights) >= least))

    return documents.mapInArrow(run, documents.schema)
