"""Language identification by cross-parsing: the language whose sample explains a text in the fewest phrases.

Of the labelled text of each language a bounded sample becomes a suffix automaton. A text is parsed greedily into the
longest phrases that occur in the sample; the automata of all languages run over all texts of a batch in step, one
table look-up per letter. A language's cost is its number of phrases times the logarithm of its sample's length.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tandem.llm.arrow import SLICE_BYTES, bytes_of, has_letter, slices, texts_of
from tandem.llm.words import LOWER, PLAIN

SAMPLE_DOCUMENTS = 64
SAMPLE_BYTES = 1 << 14
ALL_SAMPLES_BYTES = 1 << 18
SEGMENT = 1024
SPACE = 0x20
UNKNOWN = "und"


def letters(data: np.ndarray) -> np.ndarray:
    """Bytes of text as the automata see them: lower case in ASCII and Latin-1, marks and digits as blanks."""
    data = LOWER[data]
    capital = np.zeros(len(data), bool)
    capital[1:] = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
    data = np.where(capital, data + 0x20, data).astype(np.uint8)
    return np.where(PLAIN[data] & ~((data >= 0x30) & (data <= 0x39)), data, SPACE).astype(np.uint8)


def suffix_automaton(symbols: list[int], kinds: int) -> np.ndarray:
    """Transitions by state and symbol; 0 is no state, 1 the root."""
    moves: list[dict[int, int]] = [{}, {}]
    link, length, last = [0, 0], [0, 0], 1
    for symbol in symbols:
        state = len(moves)
        moves.append({})
        link.append(1)
        length.append(length[last] + 1)
        p = last
        while p and symbol not in moves[p]:
            moves[p][symbol] = state
            p = link[p]
        if p:
            q = moves[p][symbol]
            if length[q] == length[p] + 1:
                link[state] = q
            else:
                copy = len(moves)
                moves.append(dict(moves[q]))
                link.append(link[q])
                length.append(length[p] + 1)
                while p and moves[p].get(symbol) == q:
                    moves[p][symbol] = copy
                    p = link[p]
                link[q] = link[state] = copy
        last = state
    table = np.zeros((len(moves), kinds), np.int32)
    for state, targets in enumerate(moves):
        for symbol, target in targets.items():
            table[state, symbol] = target
    return table


@dataclass
class CrossParser:
    """One table for all languages. An entry holds the next state's row, and the phrases that end with the step."""

    names: list[str]
    codes: np.ndarray
    table: np.ndarray
    roots: np.ndarray
    weights: np.ndarray

    @classmethod
    def learn(cls, samples: dict[str, bytes]) -> CrossParser:
        names = sorted(name for name, sample in samples.items() if sample)
        seen = {name: letters(np.frombuffer(samples[name], np.uint8)) for name in names}
        known = np.unique(np.concatenate([*seen.values(), np.array([SPACE], np.uint8)]))
        codes = np.zeros(256, np.uint8)  # 0: a byte of no sample
        codes[known] = np.arange(1, len(known) + 1)
        kinds = len(known) + 1
        rows, roots, start = [], [], 0
        for name in names:
            moves = suffix_automaton(codes[seen[name]].tolist(), kinds)
            root = moves[1].copy()
            again = np.where(root > 0, root, 1)
            ends = 1 + (root == 0)  # the phrase so far, and an unknown letter by itself
            # in place, some rows at a time: the driver keeps the most memory that it once took
            for first in range(0, len(moves), 1024):
                part = moves[first: first + 1024]
                phrases = np.where(part > 0, 0, ends)
                if not first:
                    phrases[1] = part[1] == 0
                part[:] = ((np.where(part > 0, part, again) + start) * kinds) << 2 | phrases
            rows.append(moves)
            roots.append((start + 1) * kinds)
            start += len(moves)
        lengths = np.array([max(2, len(seen[name])) for name in names])
        table = np.concatenate(rows).ravel() if rows else np.zeros(0, np.int32)
        return cls(names, codes, table, np.array(roots, np.int32), np.log2(lengths))

    def shared(self, rows: DataFrame):
        """The parser's parts as a broadcast variable, whose size the samples bound."""
        return rows.sparkSession.sparkContext.broadcast(
            (self.names, self.codes, self.table, self.roots, self.weights))

    def costs(self, texts: pa.Array) -> np.ndarray:
        """Per text (row) and language (column): phrases times the logarithm of the sample's length."""
        data, offsets = bytes_of(texts)
        sizes = np.diff(offsets)
        if not len(data) or not self.names:
            return np.zeros((len(sizes), len(self.names)))
        symbols = self.codes[letters(data)]
        parts = -(-sizes // SEGMENT)
        text = np.repeat(np.arange(len(sizes)), parts)
        within = np.arange(len(text)) - np.repeat(np.cumsum(parts) - parts, parts)
        starts = offsets[:-1][text] + within * SEGMENT
        lengths = np.minimum(SEGMENT, sizes[text] - within * SEGMENT)
        order = np.argsort(-lengths, kind="stable")
        text, starts, lengths = text[order], starts[order], lengths[order]
        active = np.searchsorted(-lengths, -np.arange(lengths[0]), side="left")  # segments longer than the step
        states = np.repeat(self.roots[:, None], len(text), axis=1)
        phrases = np.zeros(states.shape, np.int32)
        for step, count in enumerate(active.tolist()):
            entry = self.table[states[:, :count] + symbols[starts[:count] + step]]
            phrases[:, :count] += entry & 3
            states[:, :count] = entry >> 2
        phrases += states != self.roots[:, None]
        totals = np.stack([np.bincount(text, row, len(sizes)) for row in phrases], axis=1)
        return totals * self.weights

    def predict(self, texts: pa.Array) -> tuple[list[str], np.ndarray]:
        """The language of each text and the runner-up's share of both costs; ``und`` and 0 without a letter."""
        costs = self.costs(texts)
        names, sure = [UNKNOWN] * len(texts), np.zeros(len(texts))
        if not self.names:
            return names, sure
        best = np.argmin(costs, axis=1)
        ranked = np.sort(costs, axis=1)
        second = ranked[:, 1] if len(self.names) > 1 else ranked[:, 0]
        share = np.divide(second, ranked[:, 0] + second, out=np.full(len(texts), 0.5), where=ranked[:, 0] + second > 0)
        for i, value in enumerate(texts):
            if has_letter(value.as_py()):
                names[i], sure[i] = self.names[best[i]], share[i]
        return names, sure


def language_parser(
    labelled: DataFrame, id: str = "doc_id", text: str = "text", lang: str = "lang",
    sample_documents: int = SAMPLE_DOCUMENTS, sample_bytes: int = SAMPLE_BYTES,
    all_samples_bytes: int = ALL_SAMPLES_BYTES,
) -> CrossParser:
    """Learns from a bounded sample: per language at most ``sample_documents`` whole texts and ``sample_bytes``.

    The sample is spread over the ids by hash and taken in hash order, texts that no longer fit are passed over; with
    many languages each gets its part of ``all_samples_bytes``. If no text fits, the start of the shortest is
    learnt. Repeated rows count once. Null languages, texts and ids teach nothing.
    """
    rows = labelled.select(
        F.col(lang).cast("string").alias("lang"), F.xxhash64(F.col(id)).alias("h"),
        F.col(text).cast("string").alias("text")).filter(F.col("lang").isNotNull() & F.col(id).isNotNull())
    picks = rows.groupBy("lang", F.pmod("h", F.lit(sample_documents)).alias("part")).agg(F.min("h").alias("h"))
    sample = rows.join(F.broadcast(picks.select("lang", "h")), ["lang", "h"]).distinct()
    languages = rows.select("lang").distinct().count()
    limit = min(sample_bytes, all_samples_bytes // max(1, languages))

    def gather(batch: pd.DataFrame) -> pd.DataFrame:
        kept, size = [], 0
        for value in batch.sort_values(["h", "text"])["text"].dropna().drop_duplicates():
            data = value.encode()
            if size + len(data) < limit:
                kept.append(data)
                size += len(data) + 1
        if not kept:  # every text is longer than the limit
            shortest = sorted((value.encode() for value in batch["text"].dropna()), key=len)[:1]
            kept = [data[:max(0, limit - 1)].decode(errors="ignore").encode() for data in shortest]
        return pd.DataFrame({"lang": batch["lang"][:1], "sample": [b" ".join(kept)]})

    samples = sample.groupBy("lang").applyInPandas(gather, "lang string, sample binary").collect()
    return CrossParser.learn({row.lang: bytes(row.sample) for row in samples})


def languages_of(documents: DataFrame, parser: CrossParser, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``documents``: id, lang_pred (a learnt language, or ``und``) and score (0 to 1) of the whole text.

    ``und`` and score 0 stand for null texts, texts without a letter, and everything if no language was learnt. Ties go
    to the language first in order. The parse starts anew every ``SEGMENT`` bytes, whatever the text's length. Rows are
    independent, repeated rows repeat, a null id stays null; other columns are not read. Nothing is shuffled.
    """
    shared = parser.shared(documents)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "_text", 2 * SLICE_BYTES):
                names, sure = CrossParser(*shared.value).predict(texts_of(part.column("_text")))
                yield pa.RecordBatch.from_arrays(
                    [part.column("_id"), pa.array(names, pa.string()), pa.array(sure)],
                    names=[id, "lang_pred", "score"])

    rows = documents.select(F.col(id).alias("_id"), F.col(text).cast("string").alias("_text"))
    kind = rows.schema["_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"`{id}` {kind}, lang_pred string, score double")


def identified(documents: DataFrame, parser: CrossParser, text: str = "text") -> DataFrame:
    """The rows, all columns, that have a language; those predicted as ``und`` go."""
    shared = parser.shared(documents)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text, 2 * SLICE_BYTES):
                names, _ = CrossParser(*shared.value).predict(texts_of(part.column(text)))
                yield part.filter(pa.array([name != UNKNOWN for name in names]))

    return documents.mapInArrow(run, documents.schema)
