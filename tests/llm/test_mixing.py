from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tandem.llm.mixing import mixed, permuted, source_targets
from tandem.llm.queries import ORACLES, QUERIES
from tests.oracle import connect, difference


def shared(sizes, weights, most=3):
    """Targets by resharing until none is above its limit."""
    total, targets = sum(sizes.values()), {}
    while True:
        free = [s for s in sizes if s not in targets]
        left = total - sum(targets.values())
        shares = {s: left * weights[s] / sum(weights[x] for x in free) for s in free}
        over = [s for s in free if shares[s] > most * sizes[s]]
        if not over:
            return targets | shares
        targets |= {s: float(most * sizes[s]) for s in over}


@pytest.mark.parametrize("sizes", [
    {"a": 100, "b": 10, "c": 1}, {"a": 5, "b": 5, "c": 5, "d": 5}, {"a": 1, "b": 1000, "c": 1, "d": 2, "e": 0}, {"a": 0}])
def test_targets(spark, sizes):
    weights = {s: i % 3 + 1 for i, s in enumerate(sizes)}
    table = spark.createDataFrame([(s, n, weights[s]) for s, n in sizes.items()], "source string, source_size bigint, w int")
    found = {r.source: r.target for r in source_targets(table, F.col("w")).collect()}
    assert found == pytest.approx(shared(sizes, weights))


@pytest.mark.parametrize("size", [1, 2, 3, 17, 256, 1000])
def test_permutations(spark, size):
    found = spark.range(size).select(permuted(F.col("id"), F.lit(size).cast("bigint"), F.lit(7).cast("bigint")).alias("p"))
    places = [r.p for r in found.collect()]
    assert sorted(places) == list(range(size))
    assert size < 100 or places != sorted(places)


def test_mix_is_what_its_slots_say(spark):
    rows = [(i, "w " * (i * 7 % 40), "big" if i % 3 else f"s{i % 2}", 1, 5) for i in range(200)]
    rows += [(None, None, None, 1, 5), (7, "x y z", None, 1, 5), (7, "x y z", None, 1, 5), (900, "q " * 9000, "s0", 1, 5)]
    documents = spark.createDataFrame(rows, "doc_id bigint, text string, source string, size int, target int")
    mix = {name: table.collect() for name, table in mixed(documents, block=16, shard_slots=64).items()}
    assert len(mix["documents"]) == len(rows)
    again = mixed(documents, block=16, shard_slots=64)["documents"].collect()
    assert sorted(map(str, again)) == sorted(map(str, mix["documents"]))
    pieces = defaultdict(list)
    for piece in mix["pieces"]:
        pieces[piece.source_no, piece.block].append(piece)
    taken, by_source = Counter(), Counter()
    for slot in mix["slots"]:
        by_source[slot.source_no] += slot.words
        held = 0
        for piece in pieces[slot.source_no, slot.block]:
            words = max(0, min(piece.high, slot.words) - piece.low)
            taken[piece.source_no, piece.row] += words
            held += words
        assert held == slot.words <= 16
    for document in mix["documents"]:
        assert document.taken == taken[document.source_no, document.row] <= 3 * document.size
    for source in mix["sources"]:
        assert by_source[source.source_no] == int(source.target)
    shards = Counter(slot.shard for slot in mix["slots"])
    assert all(shards[shard] == 64 for shard in range(len(shards) - 1))
    drawn = Counter((slot.shard, slot.source_no) for slot in mix["slots"])
    assert len({n for (shard, source), n in drawn.items() if source == 0}) > 1  # drawn, not dealt out evenly


def test_no_words(spark):
    documents = spark.createDataFrame([(1, None, "a"), (2, "", None)], "doc_id bigint, text string, source string")
    found = mixed(documents)["documents"].collect()
    assert sorted((r.doc_id, r.size, r.target, r.taken) for r in found) == [(1, 0, 0.0, 0), (2, 0, 0.0, 0)]
    assert mixed(documents.limit(0))["documents"].count() == 0


def test_query_matches_its_sql(spark):
    sf_dir = "/root/testdata/sf0.001"
    df = QUERIES["op2_mixing"](spark, sf_dir)
    assert difference(df, connect(sf_dir), ORACLES["op2_mixing"]) is None
    assert "Python" not in df._jdf.queryExecution().toString() and "Arrow" not in df._jdf.queryExecution().toString()
