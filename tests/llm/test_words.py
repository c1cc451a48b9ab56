import re

import numpy as np
import pyarrow as pa
import pytest

from tandem.llm.arrow import slices, texts_of
from tandem.llm.words import PLAIN, SPACED, cut, grams

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
TEXTS = ["", "A b", "c", "\x00x\x0b\x1cY ", "É-é ß", "a" * 500 + " b", "日本 語", " ", "x\x7fy\x80z", "1.2,3"]


@pytest.mark.parametrize("kind, pattern", [
    (SPACED, r"[^\x20\x09-\x0D]+"), (PLAIN, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")])
def test_words_and_hashes(kind, pattern):
    words = cut(pa.array(TEXTS), kind)
    wanted = [re.findall(pattern, text.translate(LOWER)) for text in TEXTS]
    flat = [word for found in wanted for word in found]
    assert words.counts.tolist() == [len(found) for found in wanted]
    assert [bytes(words.data[a:b]).decode() for a, b in zip(words.starts, words.ends)] == flat
    hashes = words.hashes()
    assert len(set(hashes.tolist())) == len(set(flat))
    alone = [cut(pa.array([word]), kind).hashes()[0] for word in flat]
    assert hashes.tolist() == [int(h) for h in alone]


def test_sliced_columns_and_nulls():
    column = texts_of(pa.array(["zz", None, "a b", "c"]).slice(1))
    assert cut(column, SPACED).counts.tolist() == [0, 2, 1]
    batch = pa.record_batch([pa.array(["x" * 10, "y" * 50, None, "z", "z"])], names=["t"])
    parts = list(slices(batch, "t", 12))
    assert [len(part) for part in parts] == [1, 1, 3]
    assert list(slices(batch.slice(0, 0), "t")) == []


def test_grams():
    hashes = cut(pa.array(["a b a b"]), SPACED).hashes()
    pairs = grams(hashes, 2)
    assert pairs[0] == pairs[2] != pairs[1] and len(grams(hashes, 5)) == 0
    assert np.unique(grams(hashes[:2], 2)).tolist() == [pairs[0]]
