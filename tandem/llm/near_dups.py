"""Near-duplicate documents by an inverted join of signature coordinates, confirmed on whole shingle sets.

Documents with equal shingle sets are one class from the start. A class's representative has a MinHash signature;
each (coordinate, value) pair is a token with a posting list. A pair of documents above the similarity has at least
``matches`` tokens in common, so it meets in a list of the first ``coordinates - matches + 1`` tokens of each, counted
from the rarest: the longest lists are skipped. In a list all members are first paired with one hub, then, where the
confirmed links have not joined the list, with the member whose shingles most others have. What is left are pairs of
different components; of these those go that cannot have enough in common, by what each shares with the hub and
with other components besides. Asked to miss nothing, the shingles themselves take the signature's place: the least
number of shingles in common follows from a set's size, and all else is the same.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tandem.llm.arrow import lists, slices, texts_of
from tandem.llm.components import components, extended
from tandem.llm.words import SPACED, cut, grams, salted
from tandem.session import Scratch, small_batches

COORDINATES = 64
MISSED = 1e-5


def least_matches(coordinates: int, percent: int, missed: float = MISSED) -> int:
    """The match threshold: a pair of just this similarity has fewer equal coordinates with probability ``missed``."""
    p, below, matches = percent / 100, 0.0, 0
    while matches < coordinates:
        below += comb(coordinates, matches) * p**matches * (1 - p) ** (coordinates - matches)
        if below > missed:
            break
        matches += 1
    return max(1, matches)


def shingle_sets(texts: pa.Array, n: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    words = cut(texts, SPACED)
    hashes = words.hashes()
    runs = grams(hashes, n)
    sets = []
    for start, end in zip(words.first[:-1].tolist(), words.first[1:].tolist()):
        if end - start >= n:
            values = np.sort(runs[start: end - n + 1])
            sets.append(values[np.concatenate(([True], values[1:] != values[:-1]))])
        else:
            sets.append(grams(hashes[start:end], end - start) if end > start else np.zeros(0, np.uint64))
    return sets


def signatures(sets: list[np.ndarray], coordinates: int) -> np.ndarray:
    """One row of tokens per set that is not empty: the least hash under each function, marked with its coordinate."""
    full = [values for values in sets if len(values)]
    tokens = np.empty((len(full), coordinates), np.uint64)
    if full:
        flat = np.concatenate(full)
        starts = np.cumsum([0] + [len(values) for values in full[:-1]])
        for k in range(coordinates):
            odd = np.uint64(int(salted(np.array([k], np.uint64), 7)[0]) | 1)
            tokens[:, k] = salted(np.minimum.reduceat(flat * odd, starts), k)
    return tokens


def sketches(documents: DataFrame, n: int, coordinates: int) -> DataFrame:
    """Per row of (id, text): id, n_shingles, digest of the set, tokens; the digest is null for an empty set.

    Without coordinates the tokens are the shingles.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                sets = shingle_sets(texts_of(part.column("text")), n)
                sizes = np.array([len(values) for values in sets], np.int64)
                digests = [hashlib.blake2b(values.tobytes(), digest_size=16).digest() if len(values) else None
                           for values in sets]
                tokens = signatures(sets, coordinates).ravel() if coordinates else np.concatenate(sets)
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.array(sizes), pa.array(digests, pa.binary()),
                     lists(tokens.view(np.int64), np.where(sizes > 0, coordinates, 0) if coordinates else sizes, pa.int64())],
                    names=["id", "n_shingles", "digest", "tokens"],
                )

    return documents.mapInArrow(run, "id bigint, n_shingles bigint, digest binary, tokens array<bigint>")


def set_table(documents: DataFrame, n: int) -> DataFrame:
    """Per row of (id, text): id and the sorted shingle hashes as bytes."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                sets = shingle_sets(texts_of(part.column("text")), n)
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.array([values.tobytes() for values in sets], pa.binary())],
                    names=["id", "shingles"],
                )

    return documents.mapInArrow(run, "id bigint, shingles binary")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole sets have 100 * intersection >= percent * union."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(len(batch), bool)
            for i, (left, right) in enumerate(zip(batch.column("left"), batch.column("right"))):
                x, y = (np.frombuffer(side.as_buffer(), np.uint64) for side in (left, right))
                least, most = sorted((len(x), len(y)))
                if 100 * least < percent * most:
                    continue
                at = np.minimum(np.searchsorted(y, x), len(y) - 1)
                common = int(np.count_nonzero(y[at] == x))
                keep[i] = 100 * common >= percent * (len(x) + len(y) - common)
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    # by b first: pairs that were compared by their tokens lie by b already
    with_right = pairs.join(sets.select(F.col("id").alias("b"), F.col("shingles").alias("right")), "b")
    both = with_right.join(sets.select(F.col("id").alias("a"), F.col("shingles").alias("left")), "a")
    return both.select("a", "b", "left", "right").mapInArrow(run, "a bigint, b bigint")


def _lists_of_several(postings: DataFrame) -> DataFrame:
    """The tokens whose lists have members of more than one component."""
    return postings.groupBy("token").agg(
        F.min("component").alias("low"), F.max("component").alias("high")).filter("low < high").select("token")


def outward_sets(sets: DataFrame) -> DataFrame:
    """Per set of (id, shingles, component): id, own (the set's number), component, size, outward and popularity.

    ``outward`` holds the shingles that a document of another component also has: a link to another component has
    none but these in common. ``popularity`` is high for a text that others are copies of.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                values = np.frombuffer(batch.column("shingles")[i].as_buffer(), np.int64)
                keys = [pa.array(np.full(len(values), batch.column(name)[i].as_py()))
                        for name in ("id", "own", "component")]
                yield pa.RecordBatch.from_arrays([*keys, pa.array(values)], names=["id", "own", "component", "shingle"])

    found = sets.select("id", F.xxhash64("shingles").alias("own"), "component", "shingles").mapInArrow(
        run, "id bigint, own bigint, component bigint, shingle bigint")
    shared = found.groupBy("shingle").agg(
        F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("n")
    ).filter("low < high").select("shingle", F.log2("n").alias("weight"))
    return found.join(shared, "shingle", "left").groupBy("id", "own", "component").agg(
        F.count("*").alias("size"), F.sort_array(F.collect_list(F.when(F.col("weight").isNotNull(), F.col("shingle"))))
        .alias("outward"), F.coalesce(F.sum("weight"), F.lit(0.0)).alias("popularity"))


def beside_hub(pairs: DataFrame) -> DataFrame:
    """Per row of (id, own, hub, outward, shingles of the hub): inside and outside, the outward shingles that the hub
    has and those that it lacks."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            inside, outside = [], []
            for outward, shingles in zip(batch.column("outward"), batch.column("shingles")):
                values = outward.values.to_numpy().view(np.uint64)
                hub = np.frombuffer(shingles.as_buffer(), np.uint64)
                at = np.minimum(np.searchsorted(hub, values), len(hub) - 1)
                inside.append(int(np.count_nonzero(hub[at] == values)))
                outside.append(len(values) - inside[-1])
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(name) for name in ("id", "own", "hub")), pa.array(inside, pa.int64()),
                 pa.array(outside, pa.int64())], names=["id", "own", "hub", "inside", "outside"])

    return pairs.select("id", "own", "hub", "outward", "shingles").mapInArrow(
        run, "id bigint, own bigint, hub bigint, inside bigint, outside bigint")


def near_duplicates(
    documents: DataFrame, id: str = "doc_id", text: str = "text", shingle: int = 5, percent: int = 80,
    coordinates: int = COORDINATES, missed: float = MISSED,
) -> DataFrame:
    """Per row of ``documents``: id, n_shingles, component_id (smallest id reachable by links) and kept (id is it).

    A document's set holds its distinct shingles of ``shingle`` words (with fewer words the whole sequence as one);
    documents are linked if 100 * intersection >= percent * union, which is checked on the whole sets. A pair of just
    that similarity goes unseen with probability ``missed``, a closer one more rarely; equal sets never do. With
    ``missed=0`` no pair does: all shingles are posted instead of signatures, which shuffles as much as the texts hold.
    Null texts and texts without words have an empty set and are linked with nothing. Rows with the same id count as
    one document. A null id gets its class's component, or null, and is not kept. An empty table gives an empty one;
    other columns are not read.
    """
    small_batches(documents.sparkSession)
    scratch = Scratch(documents.sparkSession)
    rows = documents.select(F.col(id).cast("bigint").alias("id"), F.col(text).cast("string").alias("text"))
    whole = missed == 0
    matches = 1 if whole else least_matches(coordinates, percent, missed)
    # so many tokens a linked document has in common with another
    common = F.floor((F.size("tokens") * percent + 99) / 100).cast("int") if whole else F.lit(matches)
    sketched = scratch.stage(sketches(rows, shingle, 0 if whole else coordinates), "sketches")
    classes = scratch.stage(
        sketched.filter("digest IS NOT NULL").groupBy("digest").agg(F.min("id").alias("rep")), "classes")
    members = scratch.stage(
        sketched.select("id", "n_shingles", "digest").join(classes, "digest", "left").drop("digest"), "members")
    chosen = sketched.join(
        classes.select("digest", F.col("rep").alias("id")), ["digest", "id"], "left_semi"
    ).dropDuplicates(["digest", "id"]).select("id", "tokens")

    # tokens of more than one representative, and of each representative all but its most frequent
    posted = chosen.select("id", common.alias("common"), F.explode("tokens").alias("token"))
    shared = posted.groupBy("token").agg(F.count("*").alias("n")).filter("n > 1")
    # a set: an id with several texts may have a token twice
    ranked = posted.join(shared, "token").groupBy("id", "common").agg(
        F.sort_array(F.collect_set(F.struct("n", "token"))).alias("ranked")
    ).withColumn("weight", F.expr("aggregate(ranked, 0L, (sum, x) -> sum + x.n)"))
    prefixes = scratch.stage(
        ranked.filter(F.size("ranked") >= F.col("common")).select(
            "id", "weight",
            F.expr("transform(slice(ranked, 1, size(ranked) - common + 1), x -> x.token)").alias("prefix")),
        "prefixes")
    postings = prefixes.select("id", "weight", F.explode("prefix").alias("token"))
    hubs = postings.groupBy("token").agg(F.max(F.struct("weight", "id")).alias("hub"), F.count("*").alias("n"))
    stars = postings.join(hubs.filter("n > 1").select("token", F.col("hub.id").alias("hub")), "token").filter(
        "id <> hub").select(F.least("id", "hub").alias("a"), F.greatest("id", "hub").alias("b")).distinct()

    needed = prefixes.select("id")
    tokens = chosen if whole else scratch.stage(chosen.join(needed, "id", "left_semi"), "tokens")
    # a repeated row is one set: the bounds below count its shingles once
    sets = scratch.stage(set_table(rows.join(needed, "id", "left_semi"), shingle).distinct(), "sets")

    def colliding(pairs: DataFrame) -> DataFrame:
        # distinct pairs stay so, but for ids with several texts
        if whole:
            return pairs
        left = tokens.select(F.col("id").alias("a"), F.col("tokens").alias("left"))
        right = tokens.select(F.col("id").alias("b"), F.col("tokens").alias("right"))
        return pairs.join(left, "a").join(right, "b").filter(
            F.size(F.array_intersect("left", "right")) >= matches).select("a", "b")

    stars = scratch.stage(stars, "stars")
    first = scratch.stage(confirmed(colliding(stars), sets, percent), "first")
    joined = components(first, scratch, "joined")

    # lists that the links of the hubs have not joined: once more with the hub whose shingles most others have
    def placed(lists_: DataFrame, labels: DataFrame) -> DataFrame:
        return lists_.join(labels, "id", "left").withColumn("component", F.coalesce("component", "id"))

    members_left = placed(postings.select("id", "token"), joined)
    rest = scratch.stage(members_left.join(_lists_of_several(members_left), "token", "left_semi"), "rest")
    outward = scratch.stage(
        outward_sets(sets.join(rest.select("id", "component").distinct(), "id")), "outward")
    lists_left = rest.select("token", "id").join(outward.drop("outward"), "id")
    chosen_hubs = lists_left.groupBy("token").agg(F.max(F.struct("popularity", "id", "component", "size")).alias("best"))
    hubbed = scratch.stage(lists_left.join(chosen_hubs, "token").select(
        "token", "id", "own", "component", "size", F.col("best.id").alias("hub"),
        F.col("best.component").alias("hub_component"), F.col("best.size").alias("hub_size")), "hubbed")
    beside = scratch.stage(beside_hub(
        hubbed.select("id", "own", "hub").distinct().join(outward.select("id", "own", "outward"), ["id", "own"]).join(
            sets.select(F.col("id").alias("hub"), "shingles"), "hub")), "beside")
    measured = hubbed.join(beside, ["id", "own", "hub"])
    # a document and a hub of different components have only outward shingles in common
    beside_enough = measured.filter(
        (F.col("component") != F.col("hub_component"))
        & (F.col("inside") * (100 + percent) >= (F.col("size") + F.col("hub_size")) * percent)
    ).select(F.least("id", "hub").alias("a"), F.greatest("id", "hub").alias("b")).distinct()
    second = scratch.stage(confirmed(beside_enough, sets, percent), "second")
    joined = extended(joined, second, scratch, "rejoined")

    # what is left then: pairs across components that could share enough, each in one list
    across = placed(measured.select("token", "id", "size", "inside", "outside"), joined)
    across = scratch.stage(across.join(_lists_of_several(across), "token", "left_semi"), "across")
    least = across.groupBy("token").agg(F.min("size").alias("least"))
    able = across.join(least, "token").filter(
        (F.col("inside") + F.col("outside")) * (100 + percent) >= (F.col("size") + F.col("least")) * percent).drop("least")
    able = scratch.stage(able.join(
        able.groupBy("id").agg(F.sort_array(F.collect_set("token")).alias("tokens")), "id"), "able")
    other = able.select("token", *[F.col(name).alias(f"other_{name}") for name in able.columns if name != "token"])
    most_common = F.least("inside", "other_inside") + F.least("outside", "other_outside")
    pairs = able.join(other, "token").filter(
        (F.col("component") < F.col("other_component"))
        & (most_common * (100 + percent) >= (F.col("size") + F.col("other_size")) * percent)
        & (F.array_min(F.array_intersect("tokens", "other_tokens")) == F.col("token"))
    ).select(F.least("id", "other_id").alias("a"), F.greatest("id", "other_id").alias("b")).distinct()
    third = scratch.stage(confirmed(colliding(pairs), sets, percent), "third")
    found = extended(joined, third, scratch, "found")
    result = scratch.stage(members.join(
        found.select(F.col("id").alias("rep"), F.col("component").alias("component_id")), "rep", "left"
    ).select(
        "id", "n_shingles", F.coalesce("component_id", "rep", "id").alias("component_id")
    ).withColumn("kept", F.coalesce(F.col("id") == F.col("component_id"), F.lit(False))), "result")
    scratch.release("result")
    return result.withColumnRenamed("id", id)


def deduplicated(documents: DataFrame, id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``documents``, all columns, without those that ``near_duplicates`` does not keep; rows without id stay."""
    found = near_duplicates(documents, id, text, **options)
    # a table of its own, whose true size decides how it is joined
    dropped = Scratch(documents.sparkSession).stage(
        found.filter(~F.col("kept") & F.col(id).isNotNull()).select(id).distinct(), "dropped")
    return documents.join(dropped, id, "left_anti").select(*documents.columns)
