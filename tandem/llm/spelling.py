"""Groups of spelling variants: words one edit apart, found through broadcast Bloom filters.

The vocabulary's words are hashed into blocked Bloom filters, one per word length; a block is 64 bits. Tasks then
generate the edits of their words, whose hashes follow from the word's in a few operations, and probe the filters.
Only positives are shuffled, as pairs of hashes, to the join with the vocabulary, and texts decide at the end. An
insertion is the deletion of the other word and a replacement works both ways, so deletions and replacements by larger
letters find every pair once.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tandem.llm.words import mixed, salted
from tandem.session import Scratch

LETTERS = "A-Za-zÀ-ÿ"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LONGEST = 64  # longer words share one filter
BITS_PER_WORD = 16
FILTER_BYTES = 64 << 20
POINTS = 1 << 16
_BASE = 0x9E3779B97F4A7C15
_INVERSE = np.uint64(pow(_BASE, -1, 1 << 64))


def word_counts(
    docs: DataFrame, id: str = "doc_id", text: str = "text", shortest: int = 7, least: int = 2, garbled: int = 0
) -> DataFrame:
    """(word, n): runs of letters of all whole texts, A to Z lower-cased, with ``shortest`` code points at least.

    ``garbled`` > 0 makes typing errors to group: where it divides the CRC-32 of ``<id>:<run>``, the run's code point
    at that value modulo its length is left out. A null text has no runs, a null id garbles none. Words that occur less
    than ``least`` times are left out. Counts are combined before the shuffle, so a frequent word is no hot key.
    """
    # maximal runs of fewer letters cannot become words
    found = F.regexp_extract_all(F.translate(F.col(text), UPPER, LOWER), F.lit(f"[{LETTERS}]{{{shortest},}}"), F.lit(0))
    runs = docs.select(F.col(id).cast("string").alias("id"), F.explode(found).alias("run"))
    word = F.col("run")
    if garbled:
        h = F.crc32(F.concat("id", F.lit(":"), "run"))
        at = (h % F.length("run")).cast("int")
        cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
        word = F.when(h % garbled == 0, cut).otherwise(word)
    return (
        runs.select(word.alias("word")).filter(F.length("word") >= shortest)
        .groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= least)
    )


def _powers(length: int) -> np.ndarray:
    steps = np.full(max(length, 1), _BASE, np.uint64)
    steps[0] = 1
    return np.cumprod(steps)


def _finished(sums: np.ndarray, length: int) -> np.ndarray:
    return mixed(sums + np.uint64(length))


def by_length(words: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of words of one length, about ``POINTS`` code points at a time, and a matrix of their code points."""
    if not len(words):
        return
    lengths = pc.utf8_length(words).to_numpy(zero_copy_only=False)
    order = np.argsort(lengths, kind="stable")
    bounds = np.flatnonzero(np.diff(lengths[order])) + 1
    for group in np.split(order, bounds):
        length = int(lengths[group[0]])
        rows = max(1, POINTS // max(length, 1))
        for start in range(0, len(group), rows):
            places = group[start: start + rows]
            joined = "".join(words.take(pa.array(places)).to_pylist())
            yield places, np.frombuffer(joined.encode("utf-32-le"), np.uint32).reshape(len(places), length)


def hashes(codes: np.ndarray) -> np.ndarray:
    return _finished((salted(codes.astype(np.uint64), 3) * _powers(codes.shape[1])).sum(axis=1, dtype=np.uint64),
                     codes.shape[1])


def edits(codes: np.ndarray, letters: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, str, np.ndarray, int]]:
    """Words' rows, positions and new letter (none: deleted) of edits, their hashes and length."""
    length = codes.shape[1]
    powers = _powers(length)
    terms = salted(codes.astype(np.uint64), 3) * powers
    sums = np.zeros((len(codes), length + 1), np.uint64)
    np.cumsum(terms, axis=1, out=sums[:, 1:])
    whole = sums[:, -1:]
    if length:
        # deleting any of several equal neighbours gives the same word
        first = np.ones(codes.shape, bool)
        first[:, 1:] = codes[:, 1:] != codes[:, :-1]
        rows, places = np.nonzero(first)
        shorter = sums[:, :-1] + (whole - sums[:, 1:]) * _INVERSE
        yield rows, places, "", _finished(shorter[rows, places], length - 1), length - 1
    for letter in letters:
        rows, places = np.nonzero(codes < letter)
        new = salted(np.array([letter], np.uint64), 3) * powers
        changed = whole[rows, 0] - terms[rows, places] + new[places]
        yield rows, places, chr(letter), _finished(changed, length), length


def places_in_filter(values: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """The block of each hash in a filter, and the bits it sets there."""
    block = ((values >> np.uint64(32)) * np.uint64(blocks)) >> np.uint64(32)
    mask = np.zeros(len(values), np.uint64)
    for shift in range(0, 30, 6):
        mask |= np.uint64(1) << ((values >> np.uint64(shift)) & np.uint64(63))
    return block, mask


def _part(values: np.ndarray, parts: int) -> np.ndarray:
    return (salted(values, 9) % np.uint64(parts)).astype(np.int64)


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.astype(np.uint64).view(np.int64))


def _hashed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        values = np.zeros(len(batch), np.uint64)
        for places, codes in by_length(batch.column("word")):
            values[places] = hashes(codes)
        yield pa.RecordBatch.from_arrays([*batch.columns, _signed(values)], names=[*batch.schema.names, "h"])


def near_words(words: DataFrame, scratch: Scratch, filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """Every two words of the stored table (word, n, h, shard) one edit apart, once: word, n, near, near_n.

    Filters hold ``BITS_PER_WORD`` bits a word, and at most about ``filter_bytes`` are collected and broadcast at a
    time: a larger vocabulary has its filters in parts, with one pass over the words per part.
    """
    spark = words.sparkSession
    sizes = {row.shard: row.n for row in words.groupBy("shard").agg(F.count("*").alias("n")).collect()}
    letters = np.array(sorted(ord(row.c) for row in words.select(
        F.explode(F.array_distinct(F.split("word", ""))).alias("c")).filter("c <> ''").distinct().collect()), np.uint32)
    parts = max(1, -(-sum(sizes.values()) * BITS_PER_WORD // (8 * filter_bytes)))
    blocks = {shard: n * BITS_PER_WORD // (64 * parts) + 1 for shard, n in sizes.items()}

    def located(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column("h").to_numpy().view(np.uint64)
            shards = batch.column("shard").to_numpy()
            block, mask = np.zeros(len(batch), np.uint64), np.zeros(len(batch), np.uint64)
            for shard in np.unique(shards):
                at = np.flatnonzero(shards == shard)
                block[at], mask[at] = places_in_filter(values[at], blocks[shard])
            yield pa.RecordBatch.from_arrays(
                [pa.array(_part(values, parts)), pa.array(shards), _signed(block), _signed(mask)],
                names=["part", "shard", "block", "mask"])

    bits = scratch.stage(words.select("h", "shard").mapInArrow(
        located, "part bigint, shard int, block bigint, mask bigint").groupBy("part", "shard", "block").agg(
        F.bit_or("mask").alias("mask")), "bits")

    def probe(part: int) -> DataFrame:
        filters = {shard: np.zeros(n, np.uint64) for shard, n in blocks.items()}
        # bounded by filter_bytes
        held = bits.filter(F.col("part") == part).select("shard", "block", "mask").toArrow()
        shards, block, mask = (held.column(name).to_numpy() for name in ("shard", "block", "mask"))
        for shard, filter_ in filters.items():
            at = shards == shard
            filter_[block[at]] = mask[at].view(np.uint64)
        sent = spark.sparkContext.broadcast(filters)

        def probed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                own = batch.column("h").to_numpy()
                for places, codes in by_length(batch.column("word")):
                    for rows, positions, letter, values, length in edits(codes, letters):
                        filter_ = sent.value.get(min(length, LONGEST))
                        if filter_ is None:
                            continue
                        block, mask = places_in_filter(values, len(filter_))
                        hit = np.flatnonzero((filter_[block] & mask) == mask)
                        if parts > 1:
                            hit = hit[_part(values[hit], parts) == part]
                        if len(hit):
                            yield pa.RecordBatch.from_arrays(
                                [pa.array(own[places[rows[hit]]]), pa.array(positions[hit].astype(np.int32)),
                                 pa.repeat(letter, len(hit)), _signed(values[hit])],
                                names=["own", "position", "letter", "h"])

        positives = scratch.stage(words.select("word", "h").repartition("h").mapInArrow(
            probed, "own bigint, position int, letter string, h bigint"), f"positives{part}")
        sent.destroy()
        return positives

    positives = probe(0)
    for part in range(1, parts):
        positives = positives.unionByName(probe(part))
    targets = words.select(F.col("word").alias("near"), F.col("n").alias("near_n"), "h")
    sources = words.select("word", "n", F.col("h").alias("own"))
    after = F.substring("word", F.col("position") + 2, F.length("word"))
    edited = F.concat(F.substring("word", F.lit(1), F.col("position")), "letter", after)
    # equal hashes of different words do no harm: the texts decide
    return positives.join(targets, "h").join(sources, "own").filter(edited == F.col("near")).select(
        "word", "n", "near", "near_n").distinct()


def _roots(links: DataFrame, scratch: Scratch) -> DataFrame:
    """(word, root) for the links (word, form): the end of each chain, by doubling the way that is known."""
    ways = scratch.stage(links.select("word", F.col("form").alias("root")), "ways")
    while True:
        further = ways.select(F.col("word").alias("root"), F.col("root").alias("end"))
        ways = scratch.stage(ways.join(further, "root", "left").select(
            "word", F.coalesce("end", "root").alias("root"), F.col("end").isNotNull().alias("moved")), "ways")
        if ways.filter("moved").isEmpty():
            return ways.select("word", "root")
        ways = ways.drop("moved")


def variant_groups(counts: DataFrame, times: int = 10, filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """Per row of (word, n): form, root, n, n_near and form_n.

    Words are near if they differ by exactly one inserted, deleted or replaced code point; ``n_near`` counts a word's
    near words. Its ``form`` is the near word of largest n (ties: smallest in code-point order), null if that n is less
    than ``times`` the word's own. ``root`` is the end of the chain of forms, the word itself without one. Words are
    expected once each and not null (other rows are left out); other columns are not read. An empty table gives none.
    """
    scratch = Scratch(counts.sparkSession)
    words = scratch.stage(
        counts.filter(F.col("word").isNotNull()).select(
            "word", "n", F.least(F.length("word"), F.lit(LONGEST)).alias("shard")).mapInArrow(
            _hashed, "word string, n bigint, shard int, h bigint"), "words")
    pairs = scratch.stage(near_words(words, scratch, filter_bytes), "pairs")
    both = pairs.unionByName(pairs.select(
        F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n")))
    best = both.groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("order"), "near")).alias("best"))
    large = -F.col("best.order") >= F.col("n") * times
    formed = scratch.stage(words.select("word", "n").join(best, "word", "left").select(
        "word", F.when(large, F.col("best.near")).alias("form"), "n",
        F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"),
        F.when(large, -F.col("best.order")).alias("form_n")), "formed")
    roots = _roots(formed.filter("form IS NOT NULL"), scratch)
    result = scratch.stage(formed.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"), "groups")
    scratch.release("groups")
    return result
