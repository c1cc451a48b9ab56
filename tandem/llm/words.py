"""Words of many texts at once: their places and 64-bit hashes, from whole byte buffers.

Two kinds of words, both after lower-casing A to Z: ``SPACED`` words are runs without ASCII white space,
``[^\\x20\\x09-\\x0D]+``; ``PLAIN`` words are runs of digits, letters and all code points from U+0080,
``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``. A word never crosses from one text to the next.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from tandem.llm.arrow import bytes_of

_CODES = np.arange(256)
LOWER = np.where((_CODES >= 65) & (_CODES <= 90), _CODES + 32, _CODES).astype(np.uint8)
SPACED = ~((_CODES == 0x20) | ((_CODES >= 0x09) & (_CODES <= 0x0D)))
# white space 0, runs of plain characters 1, runs of marks 2
TOKENS = np.where(~SPACED, 0, 1).astype(np.uint8)
PLAIN = ~((_CODES <= 0x2F) | ((_CODES >= 0x3A) & (_CODES <= 0x60)) | ((_CODES >= 0x7B) & (_CODES <= 0x7F)))

TOKENS[SPACED & ~(PLAIN | ((_CODES >= 0x41) & (_CODES <= 0x5A)))] = 2

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The powers of the hash's base and of its inverse modulo 2**64, kept between calls."""
    if not _POWERS or len(_POWERS["up"]) < n:
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            steps = np.full(max(n, 1 << 16), base, np.uint64)
            steps[0] = 1
            _POWERS[name] = np.cumprod(steps)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads their bits."""
    values = values ^ (values >> np.uint64(33))
    values = values * np.uint64(0xFF51AFD7ED558CCD)
    values ^= values >> np.uint64(33)
    values *= np.uint64(0xC4CEB9FE1A85EC53)
    values ^= values >> np.uint64(33)
    return values


def salted(values: np.ndarray, salt: int) -> np.ndarray:
    """Hashes of the values under another function for each salt."""
    return mixed(values + np.uint64(salt * 0xD1B54A32D192ED03 % (1 << 64)))


@dataclass
class Words:
    """Words of a slice of texts, in order; ``first[i]`` is the index of text i's first word (one entry more)."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def text_of(self) -> np.ndarray:
        """The index of each word's text."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word's bytes."""
        if not len(self.starts):
            return np.zeros(0, np.uint64)
        up, down = _powers(len(self.data) + 1)
        sums = np.empty(len(self.data) + 1, np.uint64)
        sums[0] = 0
        terms = self.data.astype(np.uint64)
        terms += np.uint64(1)
        terms *= up[:-1]
        np.cumsum(terms, out=sums[1:])
        del terms
        values = (sums[self.ends] - sums[self.starts]) * down[self.starts]
        return salted(values, 1) ^ (self.ends - self.starts).astype(np.uint64)


def cut(texts: pa.Array, kind: np.ndarray, lower: bool = True) -> Words:
    """The words of the texts (strings without nulls): runs of bytes of one kind; bytes of kind 0 stand between."""
    data, offsets = bytes_of(texts)
    if lower:
        data = LOWER[data]
    inside = kind[data]
    begins, stops = inside != 0, inside != 0
    begins[1:] &= inside[1:] != inside[:-1]
    stops[:-1] &= inside[:-1] != inside[1:]
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    begins[edges] = inside[edges] != 0
    stops[edges - 1] = inside[edges - 1] != 0
    starts = np.flatnonzero(begins)
    return Words(data, starts, np.flatnonzero(stops) + 1, np.searchsorted(starts, offsets))


def grams(hashes: np.ndarray, n: int, salt: int = 0) -> np.ndarray:
    """Hashes of n consecutive words, by the index of the first; runs that leave their text are included."""
    if len(hashes) < n:
        return np.zeros(0, np.uint64)
    total = np.zeros(len(hashes) - n + 1, np.uint64)
    for i in range(n):
        total = mixed(total * np.uint64(0x9FB21C651E98DF25) + hashes[i: i + len(total)])
    return salted(total, 1000 * n + salt)
