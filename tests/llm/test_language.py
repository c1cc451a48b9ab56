import itertools
import random
import tracemalloc

import numpy as np
import pyarrow as pa

from tandem.llm.language import SEGMENT, CrossParser, identified, language_parser, languages_of, letters, suffix_automaton
from tandem.llm.queries import QUERIES

SAMPLES = {"en": b"the quick brown fox jumps over the lazy dog and then some more words of the tongue",
           "de": "der schnelle braune fuchs springt über den faulen hund und noch mehr wörter".encode(), "xx": b""}


def phrases(text: bytes, sample: bytes) -> int:
    """Greedy parse into the longest pieces of the sample; a letter that it lacks is a piece."""
    text, sample = bytes(letters(np.frombuffer(text, np.uint8))), bytes(letters(np.frombuffer(sample, np.uint8)))
    count, place = 0, 0
    while place < len(text):
        size = 1
        while place + size < len(text) and text[place: place + size + 1] in sample and text[place: place + 1] in sample:
            size += 1
        count, place = count + 1, place + size
    return count


def test_automaton_knows_just_the_pieces():
    symbols = [1, 2, 1, 2, 2, 3, 1, 2]
    table = suffix_automaton(symbols, 4)
    pieces = {tuple(symbols[a:b]) for a in range(9) for b in range(a + 1, 9)}
    for length in (1, 2, 3, 4):
        for word in itertools.product([1, 2, 3], repeat=length):
            state = 1
            for symbol in word:
                state = table[state, symbol] if state else 0
            assert (state > 0) == (word in pieces)


def test_costs_are_those_of_a_plain_parse():
    parser = CrossParser.learn(SAMPLES)
    assert parser.names == ["de", "en"]
    texts = ["", "the dog", "FUCHS über Über ÜBER", "zzz qq 123 !!", "dog" * 200, "日本", "a", "quick der braune"]
    costs = parser.costs(pa.array(texts))
    for text, row in zip(texts, costs):
        wanted = [phrases(text.encode(), SAMPLES[name]) * np.log2(len(SAMPLES[name])) for name in parser.names]
        assert np.allclose(row, wanted), text


def test_long_texts_are_parsed_in_segments():
    parser = CrossParser.learn(SAMPLES)
    text = "the lazy dog and the quick brown fox " * 400
    data = text.encode()
    wanted = sum(phrases(data[i: i + SEGMENT], SAMPLES["en"]) for i in range(0, len(data), SEGMENT))
    assert np.isclose(parser.costs(pa.array([text]))[0, 1], wanted * np.log2(len(SAMPLES["en"])))


def test_odd_rows(spark):
    rows = [(1, SAMPLES["en"].decode(), "en", 1), (2, SAMPLES["de"].decode(), "de", 1), (3, None, "en", 1),
            (4, "12 !?", "en", 1), (5, "", None, 1), (None, "the dog", None, 1), (6, "der hund", None, 1),
            (6, "der hund", None, 1), (7, "the fox " * 30000, None, 1), (8, "x", None, 1)]
    documents = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, score int")
    parser = language_parser(documents)
    found = languages_of(documents, parser)
    assert found.dtypes == [("doc_id", "bigint"), ("lang_pred", "string"), ("score", "double")]
    result = {r.doc_id: r for r in found.collect()}
    assert {i: r.lang_pred for i, r in result.items()} == {
        1: "en", 2: "de", 3: "und", 4: "und", 5: "und", None: "en", 6: "de", 7: "en", 8: "en"} | {8: result[8].lang_pred}
    assert all(0 <= r.score <= 1 for r in result.values()) and result[3].score == 0
    kept = identified(documents, parser)
    assert kept.columns == documents.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 2, 6, 6, 7, 8]
    blank = language_parser(documents.filter("lang IS NULL"))
    assert {r.lang_pred for r in languages_of(documents, blank).collect()} == {"und"}
    assert languages_of(documents.limit(0), parser).count() == 0


def test_sample_is_bounded_when_no_text_fits(spark):
    rows = [(i, "é" + f"word{i} " * 500, "en") for i in range(3)]
    documents = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    parser = language_parser(documents, sample_bytes=100)
    assert parser.names == ["en"] and 90 <= round(2 ** parser.weights[0]) < 100


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.01"
    langs = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    held = [(r.lang_pred, langs[r.doc_id]) for r in QUERIES["op7_language"](spark, sf_dir).collect() if r.held_out]
    assert len(held) > 200 and np.mean([a == b for a, b in held]) > 0.98


def test_learning_takes_little_more_than_the_tables():
    rng = random.Random(2)
    samples = {name: bytes(rng.choices(b"abcdefghijklmnopqrstuvwxyz    ", k=1 << 13)) for name in "abcd"}
    tracemalloc.start()
    try:
        parser = CrossParser.learn(samples)
        _, most = tracemalloc.get_traced_memory()
    finally:
        tracemalloc.stop()
    assert most < 4 * parser.table.nbytes
