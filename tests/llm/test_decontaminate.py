import random
import re

import numpy as np
import pytest

from tandem.llm.decontaminate import FMIndex, WaveletRanks, contamination, decontaminated
from tandem.llm.queries import ORACLES, QUERIES
from tests.oracle import connect, difference

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def brute(text, items, window=10):
    """Hit word places and names of items, by comparing every window with every place."""
    found, hit, names = words(text), set(), set()
    for name, item in items:
        parts = words(item)
        size = min(window, len(parts))
        for start in range(len(parts) - size + 1) if size else ():
            for at in range(len(found) - size + 1):
                if found[at:at + size] == parts[start:start + size]:
                    hit.update(range(at, at + size))
                    names.add(name)
    return len(found), hit, {str(name) for name in names if name is not None}


def test_wavelet_ranks():
    rng = np.random.default_rng(1)
    symbols = rng.integers(0, 11, 200)
    tree = WaveletRanks(symbols, 11)
    for symbol in range(11):
        places = np.arange(201)
        assert tree.rank(np.full(201, symbol), places).tolist() == [
            int((symbols[:p] == symbol).sum()) for p in places]


@pytest.mark.parametrize("kinds", [1, 2, 5])
def test_every_place_of_every_pattern(kinds):
    rng = np.random.default_rng(kinds)
    symbols = np.append(rng.integers(0, kinds + 1, 300), 0)
    index = FMIndex(symbols, kinds, sampled=4)
    for length in (1, 2, 3, 6):
        patterns = rng.integers(1, kinds + 1, (40, length))
        low, high = index.search(patterns)
        for pattern, a, b in zip(patterns, low, high):
            wanted = [i for i in range(len(symbols) - length + 1) if (symbols[i:i + length] == pattern).all()]
            assert sorted(index.locate(np.arange(a, b)).tolist()) == wanted


@pytest.mark.parametrize("phrase_bytes", [4 << 20, 200])
def test_hits_of_random_texts(spark, phrase_bytes):
    rng = random.Random(3)
    few = ["a", "b", "c", "De", "é"]
    items = [(i, " ".join(rng.choices(few, k=rng.choice([1, 3, 9, 10, 11, 14])))) for i in range(20)]
    items += [(None, "x y"), (3, "x y"), (77, None), (78, ""), (79, "--"), (5, items[5][1])]
    texts = {i: " ".join(rng.choices(few + ["z"], weights=[9, 9, 9, 9, 9, 1], k=rng.choice([0, 5, 40, 200])))
             for i in range(30)}
    texts |= {100: None, 101: items[4][1].upper() + ". x, Y!", 102: "z " * 20000}
    documents = spark.createDataFrame(
        [(i, text, "s", 1) for i, text in texts.items()], "doc_id bigint, text string, spans string, n_words int")
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    for row in contamination(documents, benchmark, phrase_bytes=phrase_bytes).collect():
        n, hit, names = brute(texts[row.doc_id], items)
        assert row.n_words == n
        assert {p for span in row.spans for p in range(span.start, span.end)} == hit
        assert set(row["items"]) == names and len(row["items"]) == len(names)
        data = (texts[row.doc_id] or "").encode()
        for span in row.spans:
            assert words(data[span.first_byte: span.last_byte].decode()) == words(texts[row.doc_id])[span.start: span.end]


def test_removal(spark):
    item = "one two three four five six seven eight nine ten eleven"
    rows = [(1, f"Before it. {item.title()}! After.", 9, "a"), (2, item, 9, "b"), (3, "clean text", 9, "c"),
            (4, None, None, "d"), (5, "", 0, "e"), (3, "clean text", 9, "c"), (None, item + " tail é", 9, "f")]
    documents = spark.createDataFrame(rows, "doc_id bigint, text string, n_chars bigint, `__id` string")
    benchmark = spark.createDataFrame([(1, item)], "item_id bigint, text string")
    found = decontaminated(documents, benchmark)
    assert found.columns == documents.columns
    left = {(r.doc_id, r.text, r.n_chars) for r in found.collect()}
    assert left == {(1, "Before it.\n! After.", 19), (3, "clean text", 9), (4, None, None), (5, "", 0), (None, "tail é", 6)}
    assert found.count() == 6
    same = decontaminated(documents, benchmark.limit(0)).collect()
    assert sorted(map(str, same)) == sorted(map(str, documents.collect()))
    assert decontaminated(documents.limit(0), benchmark).count() == 0


def test_query_matches_its_sql(spark):
    sf_dir = "/root/testdata/sf0.001"
    name = "op8_decontamination"
    assert difference(QUERIES[name](spark, sf_dir), connect(sf_dir), ORACLES[name]) is None
