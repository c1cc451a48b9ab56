import json
from pathlib import Path

import public_tokenizers
from tokenizers import Tokenizer

from tandem.llm.tokens import TokenCounter, token_counts

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
TEXTS = [
    "", " ", "  \n\n x", "Hello world, it's 2024!", "aaaa a aaa", "a" * 3000, "don't I'll WE'VE", "日本語テキスト é", "\x1c\x85\x00",
    "a<|endoftext|>b<|endoftext|>", "<|endoftext|>", "　  x", "éê" * 400, "🙂🙂 ok", "1234567 x1y2", "\t\ttab",
]


def library(texts):
    return [len(found.ids) for found in LIBRARY.encode_batch(texts, add_special_tokens=False)]


def test_counts_are_those_of_the_library():
    counter = TokenCounter(json.loads(Path(PATH).read_text()))
    assert counter.count(TEXTS).tolist() == library(TEXTS)
    assert counter.count(TEXTS[::-1]).tolist() == library(TEXTS[::-1])  # from remembered pieces


def test_every_kind_of_character():
    counter = TokenCounter(json.loads(Path(PATH).read_text()))
    texts = [f"a{chr(c)} {chr(c)}{chr(c)}1" for c in range(0, 0x3100) if not 0xD800 <= c < 0xE000]
    assert counter.count(texts).tolist() == library(texts)


def test_table_with_nulls_repeats_and_clashing_columns(spark):
    rows = [(1, "a b", 9), (1, "a b", 9), (None, None, 9), (2, "", 9), (3, "word " * 2000, 9)]
    documents = spark.createDataFrame(rows, "doc_id bigint, text string, n_tokens int")
    found = token_counts(documents, Path(PATH).read_text())
    assert found.dtypes == [
        ("doc_id", "bigint"), ("n_bytes", "bigint"), ("n_tokens", "bigint"), ("over_limit", "boolean")]
    assert sorted(map(tuple, found.collect()), key=str) == sorted(
        [(1, 3, 2, False), (1, 3, 2, False), (None, 0, 0, False), (2, 0, 0, False),
         (3, 10000, library(["word " * 2000])[0], True)], key=str)
    assert token_counts(documents.limit(0), Path(PATH).read_text()).count() == 0
