import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from tandem.llm.merkle import build_manifest, folded_proofs
from tandem.llm.queries import ORACLES, QUERIES
from tests.oracle import connect, difference

SCHEMA = "doc_id bigint, text string, lang string, n int, leaf string, place int"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def row_text(values):
    return "".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values)


def climb(nodes):
    """The root of some digests and, per digest, the siblings on its way as (left, right)."""
    ways, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, place in enumerate(at):
            pair = place ^ 1
            other = nodes[pair] if pair < len(nodes) else ""
            ways[i].append((other, "") if place % 2 else ("", other))
            at[i] = place // 2
        nodes = [sha("".join(nodes[i: i + 2])) for i in range(0, len(nodes), 2)]
    return nodes[0], ways


def plain(rows, changed):
    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append(row)
    order = sorted(groups, key=lambda lang: (lang is not None, (lang or "").encode()))
    lower = []
    for lang in order:
        kept = sorted(((row[0] is not None, row[0] or 0, sha(row_text(row[:4]))), row) for row in groups[lang])
        lower.append(([(key[2], row) for key, row in kept], *climb([key[2] for key, _ in kept])))
    root, ways_up = climb([subroot for _, subroot, _ in lower])
    result = []
    for (kept, subroot, ways), up in zip(lower, ways_up):
        for (leaf, row), way in zip(kept, ways):
            doc_id, text, lang, n = row[:4]
            folded = sha(row_text((doc_id, text, lang, None if n is None else n + 1))) if changed(doc_id) else leaf
            for left, right in way + up:
                folded = sha(left + folded + right)
            proof = "".join(left + right for left, right in way + up)
            result.append((doc_id, lang, leaf, subroot, root, proof, folded, folded == root))
    return result


def sevenths(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 0


def proofs(spark, rows, **options):
    table = spark.createDataFrame(rows, SCHEMA)
    manifest = build_manifest(
        table, ["doc_id", "text", "lang", "n"], altered={"n": F.col("n") + 1},
        changed=F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, F.lit(False)), **options)
    columns = ["id", "group", "leaf", "subroot", "root", "proof", "folded_root", "verified"]
    return sorted((tuple(row) for row in folded_proofs(spark, manifest).select(*columns).collect()), key=repr)


def make(sizes):
    return [(i * 10 + j, f"text {i} {j} é", lang, i + j, "clash", 0)
            for j, (lang, size) in enumerate(sizes.items()) for i in range(size)]


@pytest.mark.parametrize("sizes, stride", [
    ({"a": 1}, 8), ({"a": 5}, 2), ({"a": 1, "b": 1, None: 1}, 1), ({"a": 9, None: 4, "b": 1, "é": 17, "z": 3}, 3)])
def test_small_trees(spark, sizes, stride):
    rows = make(sizes)
    assert proofs(spark, rows, stride=stride) == sorted(plain(rows, sevenths), key=repr)


def test_more_leaves_than_a_stretch(spark):
    rows = make({"a": 2500, "b": 3})
    assert proofs(spark, rows, stride=4) == sorted(plain(rows, sevenths), key=repr)
    assert proofs(spark, rows) == sorted(plain(rows, sevenths), key=repr)


def test_nulls_repeats_and_long_texts(spark):
    rows = [(None, None, None, None, None, None), (None, "x", "a", 1, None, None), (7, "", "a", 2, None, 1),
            (7, "", "a", 2, None, 1), (7, "b", "a", 2, None, 1), (7, None, "a", None, "q", 1),
            (8, "long " * 200_000, "", 3, "q", 2), (9, "-", "", 0, "q", 2)]
    assert proofs(spark, rows) == sorted(plain(rows, sevenths), key=repr)


def test_changed_rows_are_found(spark):
    rows = make({"a": 40, "b": 2})
    found = proofs(spark, rows)
    assert {row[0] for row in found if not row[-1]} == {row[0] for row in rows if sevenths(row[0])}


def test_empty_table(spark):
    assert proofs(spark, []) == []


def test_query_matches_its_sql(spark):
    sf_dir = "/root/testdata/sf0.001"
    name = "op13_merkle_manifest"
    assert difference(QUERIES[name](spark, sf_dir), connect(sf_dir), ORACLES[name]) is None
