import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tandem.llm.queries import ORACLES, QUERIES
from tandem.llm.spelling import by_length, edits, hashes, variant_groups, word_counts
from tests.oracle import connect, difference


def are_near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(a) + 1 == len(b) and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain(counts, times=10):
    result = {}
    for word, n in counts.items():
        near = sorted((-counts[other], other) for other in counts if are_near(word, other))
        form = near[0] if near and -near[0][0] >= times * n else None
        result[word] = (form and form[1], n, len(near), form and -form[0])

    def root(word):
        return root(result[word][0]) if result[word][0] else word

    return {word: (form, root(word), *rest) for word, (form, *rest) in result.items()}


def grouped(spark, counts, **options):
    table = spark.createDataFrame(list(counts.items()), "word string, n bigint").withColumn("form", F.lit("clash"))
    rows = variant_groups(table, **options).collect()
    assert len(rows) == len(counts)
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}


def vocabulary(seed, size):
    rng = random.Random(seed)
    counts = {}
    for _ in range(size):
        word = "".join(rng.choice("abé") for _ in range(rng.randint(1, 6)))
        counts[word] = rng.choice([1, 2, 3, 20, 25, 300, 4000])
    return counts


def test_near_words_of_a_dense_vocabulary(spark):
    counts = vocabulary(1, 400) | {"": 3, "ab" * 60: 2, "ab" * 60 + "a": 30, "ab" * 59 + "aÿ": 400, "aaa\U0001F600": 5}
    assert grouped(spark, counts) == plain(counts)


def test_filters_in_parts(spark):
    counts = vocabulary(2, 300)
    assert grouped(spark, counts, filter_bytes=128) == plain(counts)


def test_chain_of_forms(spark):
    word, counts = "aaaaaaaa", {}
    for i in range(9):
        counts[word[:i].replace("a", "b") + word[i:]] = 10 ** i
    found = grouped(spark, counts)
    assert found == plain(counts)
    assert {root for _, root, *_ in found.values()} == {"bbbbbbbb"}


def test_long_words_and_nulls(spark):
    long = "x" * 30_000
    counts = {long: 50, long + "y": 2, "y" + long: 3}
    table = spark.createDataFrame([*counts.items(), (None, 7)], "word string, n bigint")
    assert {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in variant_groups(table).collect()} == plain(counts)


def test_empty_table(spark):
    assert variant_groups(spark.createDataFrame([], "word string, n bigint")).count() == 0
    assert word_counts(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


def plain_counts(docs, garbled):
    counts = Counter()
    for doc_id, text, *_ in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda x: x.group().lower(), run)
            h = zlib.crc32(f"{doc_id}:{run}".encode())
            if garbled and doc_id is not None and h % garbled == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= 7:
                counts[run] += 1
    return {word: n for word, n in counts.items() if n >= 2}


def test_counted_words(spark):
    rng = random.Random(3)
    docs = [(i % 40 if i % 13 else None, " ".join(rng.choice(
        ["Straßen", "ÉTUDIANT", "mÿstery×", "shorty", "abcdefgh", "ABCDEFG1HIJKLMN", "naïvetés_x"])
        for _ in range(50)), "clash", 1) for i in range(80)]
    docs += [(100, None, None, None), (101, "", "", 1), (102, "Wordily " * 50_000, "x", 1)]
    table = spark.createDataFrame(docs, "doc_id bigint, text string, word string, n int")
    for garbled in (0, 3, 31):
        found = {r.word: r.n for r in word_counts(table, garbled=garbled).collect()}
        assert found == plain_counts(docs, garbled)


def test_hashes_of_edits_are_those_of_the_edited_words():
    words = pa.array(["abca", "aabb", "zz", "", "é"])
    for places, codes in by_length(words):
        for rows, positions, letter, values, length in edits(codes, np.array([98, 233], np.uint32)):
            for row, at, value in zip(rows, positions, values):
                word = words[int(places[row])].as_py()
                new = word[:at] + letter + word[at + 1:]
                assert len(new) == length
                (_, edited), = by_length(pa.array([new]))
                assert hashes(edited)[0] == value


def test_query_matches_its_sql(spark):
    sf_dir, name = "/root/testdata/sf0.001", "op11_spelling_variants"
    assert difference(QUERIES[name](spark, sf_dir), connect(sf_dir), ORACLES[name]) is None
