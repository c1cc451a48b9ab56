"""Token counts by rank-synchronous merging of byte pairs.

The distinct pre-tokens of a batch lie one behind another in one array of symbols. In each round every pre-token
merges all places of its own lowest-ranked pair at once; pre-tokens without a listed pair leave the array, and
the number of symbols they have left is their number of tokens.
"""

from __future__ import annotations

import json
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tandem.llm.arrow import SLICE_BYTES, offsets_of, slices, texts_of

# Fixed value: the pattern that splits text before the merges of byte-level vocabularies.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
NONE = np.iinfo(np.int32).max
REMEMBERED = 1 << 19


def _byte_symbols() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class PairMerger:
    """Counts the symbols that are left of pre-tokens when no listed pair remains."""

    def __init__(self, vocabulary: dict[str, int], merges: list[tuple[str, str]]):
        self.size = max(vocabulary.values()) + 1
        self.first = np.zeros(256, np.int64)
        for symbol, byte in _byte_symbols().items():
            self.first[byte] = vocabulary[symbol]
        left = np.array([vocabulary[a] for a, _ in merges], np.int64)
        right = np.array([vocabulary[b] for _, b in merges], np.int64)
        keys = left * self.size + right
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = np.append(keys[order], np.iinfo(np.int64).max), np.append(order, NONE).astype(np.int32)
        self.made = np.array([vocabulary[a + b] for a, b in merges], np.int64)
        self.from_bytes = self._look_up(np.add.outer(self.first * self.size, self.first).ravel())

    def _look_up(self, pairs: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.keys, pairs)
        return np.where(self.keys[at] == pairs, self.ranks[at], NONE)

    def counts(self, pieces: list[bytes]) -> np.ndarray:
        """Tokens of each piece; no piece is empty."""
        left = np.array([len(piece) for piece in pieces], np.int64)
        data = np.frombuffer(b"".join(pieces), np.uint8)
        symbols = self.first[data]
        ranks = np.full(len(data), NONE, np.int32)
        ranks[:-1] = self.from_bytes[data[:-1].astype(np.int64) * 256 + data[1:]]
        lengths, number = left, np.arange(len(left))
        ranks[np.cumsum(lengths) - 1] = NONE
        while len(lengths):
            starts = np.cumsum(lengths) - lengths
            lowest = np.minimum.reduceat(ranks, starts)
            going = lowest != NONE
            if not going.all():
                left[number[~going]] = lengths[~going]
                stay = np.repeat(going, lengths)
                symbols, ranks = symbols[stay], ranks[stay]
                lengths, number, lowest = lengths[going], number[going], lowest[going]
                if not len(lengths):
                    break
            at = np.flatnonzero(ranks == np.repeat(lowest, lengths))
            # a pair of equal symbols may overlap itself: of each run of neighbouring places, every other one merges
            opens = np.ones(len(at), bool)
            opens[1:] = np.diff(at) != 1
            order = np.arange(len(at))
            within = order - np.maximum.accumulate(np.where(opens, order, 0))
            at = at[within % 2 == 0]
            sequence = np.searchsorted(np.cumsum(lengths), at, side="right")
            symbols[at] = self.made[ranks[at]]
            last = at + 1 == np.cumsum(lengths)[sequence] - 1
            keep = np.ones(len(symbols), bool)
            keep[at + 1] = False
            symbols, ranks = symbols[keep], ranks[keep]
            lengths = lengths - np.bincount(sequence, minlength=len(lengths))
            at = at - np.arange(len(at))  # where the merged symbols are now
            after = at[~last]
            ranks[after] = self._look_up(symbols[after] * self.size + symbols[after + 1])
            ranks[at[last]] = NONE
            heads = np.cumsum(lengths) - lengths
            before = at[~np.isin(at, heads, assume_unique=True)] - 1
            ranks[before] = self._look_up(symbols[before] * self.size + symbols[before + 1])
        return left


class TokenCounter:
    """Counts tokens of texts; remembers the counts of pre-tokens, a bounded number of them."""

    def __init__(self, specification: dict):
        model = specification["model"]
        merges = [tuple(pair.split(" ")) if isinstance(pair, str) else tuple(pair) for pair in model["merges"]]
        special = sorted((token["content"] for token in specification["added_tokens"]), key=len, reverse=True)
        self.merger = PairMerger(model["vocab"], merges)
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        self.pieces = regex.compile(PATTERN)
        self.known: dict[str, int] = {}

    def count(self, texts: list[str]) -> np.ndarray:
        """Number of tokens of each text; strings of special tokens count as one."""
        split, extra = [], np.zeros(len(texts), np.int64)
        for i, text in enumerate(texts):
            if self.special is not None and self.special.search(text):
                parts = self.special.split(text)
                extra[i] = len(parts) - 1
                split.append([piece for part in parts for piece in self.pieces.findall(part)])
            else:
                split.append(self.pieces.findall(text))
        if len(self.known) > REMEMBERED:
            self.known.clear()
        known = self.known
        fresh = [piece for piece in set().union(*split) if piece not in known]
        if fresh:
            counts = self.merger.counts([piece.encode() for piece in fresh])
            known.update(zip(fresh, counts.tolist()))
        return extra + np.array([sum(map(known.__getitem__, pieces)) for pieces in split], np.int64)


def token_counts(
    documents: DataFrame, specification: str, id: str = "doc_id", text: str = "text", limit: int = 1024,
) -> DataFrame:
    """Per row of ``documents``: id, n_bytes (UTF-8), n_tokens and over_limit (n_tokens > limit).

    ``specification`` is the JSON text of a byte-level vocabulary. Counts are those of the whole text without added
    tokens; a special token's string inside a text is one token. Null texts count as empty: 0 bytes, 0 tokens. Rows
    are independent: repeated rows give repeated results, an empty table an empty one, other columns are not read,
    a null id stays null. Nothing is shuffled; a text of any length is one slice of work.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        counter = TokenCounter(json.loads(specification))
        for batch in batches:
            for part in slices(batch, "_text", 4 * SLICE_BYTES):
                column = texts_of(part.column("_text"))
                tokens = counter.count(column.to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column("_id"), pa.array(np.diff(offsets_of(column))), pa.array(tokens),
                     pa.array(tokens > limit)],
                    names=[id, "n_bytes", "n_tokens", "over_limit"],
                )

    rows = documents.select(F.col(id).alias("_id"), F.col(text).cast("string").alias("_text"))
    kind = rows.schema["_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"`{id}` {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean")
