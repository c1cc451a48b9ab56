"""Benchmark passages in documents by an FM-index per shard of documents.

A shard (a slice of an Arrow batch) is indexed over the words of the test phrases: a word that no phrase has cannot
be in an occurrence, so it only separates, and what lies between two such words is left out if it is shorter than
the shortest phrase. Phrases are searched backward through wavelet-tree ranks, their places come from sampled suffix
positions, and overlapping places merge into removal spans.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tandem.llm.arrow import bytes_of, slices, texts_of
from tandem.llm.words import PLAIN, cut
from tandem.session import Scratch

WINDOW = 10
PHRASE_BYTES = 4 << 20
SAMPLED = 8


class WaveletRanks:
    """A wavelet tree, level by level: how often a symbol stands before a place."""

    def __init__(self, symbols: np.ndarray, kinds: int):
        self.levels = max(1, int(kinds - 1).bit_length())
        self.ones, self.zeros = [], []
        for level in reversed(range(self.levels)):
            bits = (symbols >> level) & 1
            self.ones.append(np.concatenate(([0], np.cumsum(bits))))
            self.zeros.append(int(len(bits) - self.ones[-1][-1]))
            symbols = np.concatenate((symbols[bits == 0], symbols[bits == 1]))

    def rank(self, symbols: np.ndarray, places: np.ndarray) -> np.ndarray:
        start = np.zeros(len(symbols), np.int64)
        for i, level in enumerate(reversed(range(self.levels))):
            up = ((symbols >> level) & 1).astype(bool)
            ones, zeros = self.ones[i], self.zeros[i]
            places = np.where(up, zeros + ones[places], places - ones[places])
            start = np.where(up, zeros + ones[start], start - ones[start])
        return places - start


class FMIndex:
    """An index of runs of symbols from 1; the symbol 0 ends each run, and no pattern reaches over it."""

    def __init__(self, symbols: np.ndarray, kinds: int, sampled: int = SAMPLED):
        n = len(symbols)
        ends = symbols == 0
        n_ends = int(ends.sum())
        ranks = np.where(ends, np.cumsum(ends) - 1, symbols + n_ends - 1).astype(np.int64)
        span = 1
        while True:  # each round sorts suffixes by twice as many symbols; the ends of runs differ from one another
            behind = np.zeros(n, np.int64)
            behind[:-span] = ranks[span:] + 1
            keys = ranks * (n + kinds + 1) + behind
            order = np.argsort(keys, kind="stable")
            steps = np.diff(keys[order]) != 0
            ranks = np.empty(n, np.int64)
            ranks[order] = np.concatenate(([0], np.cumsum(steps)))
            if steps.all():
                break
            span *= 2
        self.before = symbols[order - 1]
        self.before[order == 0] = 0
        self.below = n_ends + np.concatenate(([0], np.cumsum(np.bincount(symbols[~ends], minlength=kinds + 1))))
        self.tree = WaveletRanks(self.before, kinds + 1)
        self.at = np.where((self.before == 0) | (order % sampled == 0), order, -1)

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The range of suffixes that start with each pattern (rows of symbols)."""
        low, high = np.zeros(len(patterns), np.int64), np.full(len(patterns), len(self.at), np.int64)
        alive = np.arange(len(patterns))
        for column in reversed(range(patterns.shape[1])):
            symbols = patterns[alive, column]
            low[alive] = self.below[symbols] + self.tree.rank(symbols, low[alive])
            high[alive] = self.below[symbols] + self.tree.rank(symbols, high[alive])
            alive = alive[low[alive] < high[alive]]
        found = np.zeros(len(patterns), bool)
        found[alive] = True
        return low, np.where(found, high, low)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """The places of suffixes: steps back to a sampled one."""
        rows, places, steps = rows.copy(), np.empty(len(rows), np.int64), 0
        waiting = np.arange(len(rows))
        while len(waiting):
            there = self.at[rows[waiting]]
            places[waiting[there >= 0]] = there[there >= 0] + steps
            waiting = waiting[there < 0]
            symbols = self.before[rows[waiting]]
            rows[waiting] = self.below[symbols] + self.tree.rank(symbols, rows[waiting])
            steps += 1
        return places


class Phrases:
    """The windows of test items: runs of ``window`` words, or the whole item if it has fewer (but some)."""

    def __init__(self, names: list[str | None], texts: list[str | None], window: int):
        words = cut(texts_of(pa.array(texts, pa.string())), PLAIN)
        hashes = words.hashes()
        self.vocabulary = np.unique(hashes)
        # a table of leading bits turns away most of the other words
        self.leading = np.zeros(1 << 20, bool)
        self.leading[self.vocabulary >> np.uint64(44)] = True
        ids = np.searchsorted(self.vocabulary, hashes) + 1
        by_length: dict[int, list[tuple[np.ndarray, str | None]]] = {}
        for name, start, end in zip(names, words.first[:-1].tolist(), words.first[1:].tolist()):
            length = min(window, end - start)
            if length:
                views = np.lib.stride_tricks.sliding_window_view(ids[start:end], length)
                by_length.setdefault(length, []).append((views, name))
        self.patterns: list[tuple[np.ndarray, list[list[str]]]] = []
        for length, parts in sorted(by_length.items()):
            windows, inverse = np.unique(np.concatenate([views for views, _ in parts]), axis=0, return_inverse=True)
            owners: list[list[str]] = [[] for _ in windows]
            owner = np.repeat(np.arange(len(parts)), [len(views) for views, _ in parts])
            for row, part in sorted(set(zip(inverse.ravel().tolist(), owner.tolist()))):
                if parts[part][1] is not None:
                    owners[row].append(parts[part][1])
            self.patterns.append((windows, owners))
        self.shortest = min(by_length, default=0)

    def ids(self, hashes: np.ndarray) -> np.ndarray:
        """The number of each word in the vocabulary, or 0."""
        ids = np.zeros(len(hashes), np.int64)
        likely = np.flatnonzero(self.leading[hashes >> np.uint64(44)])
        at = np.minimum(np.searchsorted(self.vocabulary, hashes[likely]), len(self.vocabulary) - 1)
        same = self.vocabulary[at] == hashes[likely]
        ids[likely[same]] = at[same] + 1
        return ids


def _hits(texts: pa.Array, phrases: Phrases) -> tuple[object, np.ndarray, list[set[str]]]:
    """The words of the texts, which of them are hit, and the names of the items hit in each text."""
    words = cut(texts, PLAIN)
    hit, names = np.zeros(len(words.starts), bool), [set() for _ in range(len(texts))]
    if not phrases.patterns or not len(words.starts):
        return words, hit, names
    ids = phrases.ids(words.hashes())
    known = np.flatnonzero(ids)
    owner = np.searchsorted(words.first, known, side="right") - 1
    breaks = np.ones(len(known), bool)
    breaks[1:] = (np.diff(known) != 1) | (np.diff(owner) != 0)
    starts = np.flatnonzero(breaks)
    sizes = np.diff(np.append(starts, len(known)))
    kept = sizes >= phrases.shortest
    known = known[np.repeat(kept, sizes)]
    sizes = sizes[kept]
    if not len(known):
        return words, hit, names
    runs = np.repeat(np.arange(len(sizes)), sizes)
    symbols, places = np.zeros(len(known) + len(sizes), np.int64), np.zeros(len(known) + len(sizes), np.int64)
    at = np.arange(len(known)) + runs
    symbols[at], places[at] = ids[known], known
    index = FMIndex(symbols, len(phrases.vocabulary))
    edges = np.zeros(len(hit) + 1, np.int64)
    for windows, owners in phrases.patterns:
        low, high = index.search(windows)
        found = np.flatnonzero(high > low)
        if not len(found):
            continue
        counts = high[found] - low[found]
        rows = np.repeat(low[found] - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
        word = places[index.locate(rows)]
        np.add.at(edges, word, 1)
        np.add.at(edges, word + windows.shape[1], -1)
        pairs = np.unique(np.stack((np.repeat(found, counts), np.searchsorted(words.first, word, side="right") - 1)),
                          axis=1)
        for window, text in pairs.T.tolist():
            names[text].update(owners[window])
    return words, np.cumsum(edges[:-1]) > 0, names


SPANS = "array<struct<start:bigint,end:bigint,first_byte:bigint,last_byte:bigint>>"


def _spans(words, hit: np.ndarray, offsets: np.ndarray) -> list[list[dict]]:
    """Merged runs of hit words of each text: word places, and byte places in the text."""
    spans: list[list[dict]] = [[] for _ in range(len(words.first) - 1)]
    text = words.text_of
    at = np.flatnonzero(hit)
    if len(at):
        opens = np.concatenate(([True], (np.diff(at) != 1) | (np.diff(text[at]) != 0)))
        begins, ends = at[opens], at[np.append(opens[1:], True)]
        for t, begin, end in zip(text[begins].tolist(), begins.tolist(), ends.tolist()):
            first, base = int(words.first[t]), int(offsets[t])
            spans[t].append({"start": begin - first, "end": end + 1 - first,
                             "first_byte": int(words.starts[begin]) - base, "last_byte": int(words.ends[end]) - base})
    return spans


def _removed(text: str, spans: list[dict]) -> str:
    """The text without the spans; what stood on both sides of one stays apart by a line break."""
    data, kept, last = text.encode(), [], 0
    for span in spans:
        kept.append(data[last: span["first_byte"]].decode().rstrip())
        last = span["last_byte"]
    kept.append(data[last:].decode().lstrip())
    return "\n".join(part for part in kept if part)


def _marked(rows: DataFrame, text: str, items: DataFrame, item_id: str, item_text: str, window: int,
            phrase_bytes: int, remove: str | None = None) -> DataFrame:
    """``rows`` (with a text column, ``__words``, ``__spans`` and ``__items``) with what the items hit filled in.

    With ``remove`` (the name of a column for the number of characters, or "") the spans are cut out of the texts.
    """
    scratch = Scratch(rows.sparkSession)
    named = items.select(
        F.col(item_id).cast("string").alias("name"), F.col(item_text).cast("string").alias("text")).distinct()
    size = named.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-size // phrase_bytes))
    schema = rows.schema
    for part in range(parts):
        chosen = named.filter(F.pmod(F.xxhash64("name", "text"), F.lit(parts)) == part).collect()
        phrases = Phrases([row.name for row in chosen], [row.text for row in chosen], window)
        final = remove is not None and part == parts - 1

        def run(batches: Iterable[pa.RecordBatch], phrases: Phrases = phrases,
                final: bool = final) -> Iterable[pa.RecordBatch]:
            for batch in batches:
                for piece in slices(batch, text):
                    texts = texts_of(piece.column(text))
                    words, hit, names = _hits(texts, phrases)
                    for i, spans in enumerate(piece.column("__spans").to_pylist()):
                        for span in spans:
                            hit[words.first[i] + span["start"]: words.first[i] + span["end"]] = True
                    for known, earlier in zip(names, piece.column("__items").to_pylist()):
                        known.update(earlier)
                    spans = _spans(words, hit, bytes_of(texts)[1])
                    columns = dict(zip(piece.schema.names, piece.columns))
                    columns["__words"] = pa.array(words.counts.astype(np.int64))
                    columns["__spans"] = pa.array(spans, piece.schema.field("__spans").type)
                    columns["__items"] = pa.array([sorted(known) for known in names],
                                                  piece.schema.field("__items").type)
                    if final and any(spans):
                        left = piece.column(text).to_pylist()
                        left = [_removed(old, found) if found else old for old, found in zip(left, spans)]
                        columns[text] = pa.array(left, piece.schema.field(text).type)
                        if remove:
                            sizes = [len(new) if found else old for new, found, old in
                                     zip(left, spans, piece.column(remove).to_pylist())]
                            columns[remove] = pa.array(sizes, piece.schema.field(remove).type)
                    yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

        rows = rows.mapInArrow(run, schema)
        if part < parts - 1:  # a task and the driver hold one part at a time
            rows = scratch.stage(rows, "marked")
    return rows


def _unmarked(rows: DataFrame) -> DataFrame:
    return rows.withColumns({
        "__words": F.lit(0).cast("bigint"), "__spans": F.array().cast(SPANS),
        "__items": F.array().cast("array<string>")})


def contamination(
    documents: DataFrame, items: DataFrame, id: str = "doc_id", text: str = "text", item_id: str = "item_id",
    item_text: str = "text", window: int = WINDOW, phrase_bytes: int = PHRASE_BYTES,
) -> DataFrame:
    """Per row of ``documents``: id, n_words, spans (merged, by word and by byte) and items (sorted names).

    A document word inside any occurrence of ``window`` consecutive words of an item is hit; an item of fewer words is
    one window. Items travel to the tasks in parts of about ``phrase_bytes``, each in a pass over the documents that is
    stored before the next, so any number of items works and one part is held at a time. A null text, of document or item, has no words; an item without words hits nothing, one
    without id hits but is not named; repeated items are named once. Without items nothing is hit. Rows of documents
    are independent; a null id stays null; other columns are not read.
    """
    rows = _unmarked(documents.select(F.col(id).alias("__id"), F.col(text).cast("string").alias("__text")))
    marked = _marked(rows, "__text", items, item_id, item_text, window, phrase_bytes)
    return marked.select(
        F.col("__id").alias(id), F.col("__words").alias("n_words"), F.col("__spans").alias("spans"),
        F.col("__items").alias("items"))


def decontaminated(
    documents: DataFrame, items: DataFrame, text: str = "text", chars: str = "n_chars", item_id: str = "item_id",
    item_text: str = "text", window: int = WINDOW, phrase_bytes: int = PHRASE_BYTES,
) -> DataFrame:
    """``documents``, all columns, with the spans of ``contamination`` cut out and ``chars``, if there, counted anew.

    A document of which nothing is left goes; every other row stays, those without a hit unchanged, null texts too.
    """
    columns = documents.columns
    rows = _unmarked(documents)
    marked = _marked(rows, text, items, item_id, item_text, window, phrase_bytes, chars if chars in columns else "")
    return marked.filter(F.size("__spans").eqNullSafe(0) | (F.col(text) != "")).select(*columns)
