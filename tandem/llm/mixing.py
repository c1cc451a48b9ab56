"""Mixing sources to target weights, with DataFrame functions only.

The documents of a source, in the order of their ids, are packed into blocks of a fixed number of words. The mix is
a row of slots, cut into output shards; each shard draws how many of its slots go to each source from a multinomial
distribution, and slots drawn beyond a source's target pass to the sources that are short. A source's slots are
numbered through all shards, number i takes block p(i), where p is a pseudorandom permutation of the source's blocks
(another one for each pass over the source), and slots and blocks meet in a join on (source, block).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tandem.session import Scratch

BLOCK = 256
SHARD_SLOTS = 1 << 16
BUCKETS = 4096
MOST_REPEATS = 3
ROUNDS = 16
SEED = 20
# the two largest primes below 2**31, and two below 2**30
STEPS = [(48271, 2147483647), (692871, 1073741789), (40692, 2147483629), (16807, 1073741783)]
PRIME = 2147483647
SALT = 69621
CHUNK = 1024
CELLS = 4096


def scrambled(value: Column, salt: Column | int) -> Column:
    """A number below 2**31 that looks random: linear steps modulo different primes, which every engine repeats."""
    salt = F.lit(salt).cast("bigint") if isinstance(salt, int) else salt
    for factor, prime in STEPS:
        value = F.pmod(F.pmod(value, F.lit(prime).cast("bigint")) * factor + salt * SALT + factor,
                       F.lit(prime).cast("bigint"))
    return value


def permuted(index: Column, size: Column, key: Column, rounds: int = ROUNDS) -> Column:
    """Where a pseudorandom permutation of 0..size-1 sends an index: swap-or-not, for any size."""
    def swap(x, r):
        partner = F.pmod(scrambled(key, r * 2 + 1) - x, size)
        coin = scrambled(F.greatest(x, partner) + key * 7, r * 2 + 2)
        return F.when(F.pmod(F.shiftright(coin, 9), F.lit(2)) == 1, partner).otherwise(x)

    turns = F.array(*[F.lit(r).cast("bigint") for r in range(rounds)])
    return F.aggregate(turns, index.cast("bigint"), swap)


def words_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def source_targets(sizes: DataFrame, weights: Column, most_repeats: int = MOST_REPEATS) -> DataFrame:
    """Per source its size and target: shares by weight of all sizes, none above ``most_repeats`` times its size.

    ``sizes`` has source, source_size and what ``weights`` needs. What a capped source leaves is shared anew by weight:
    the capped sources are the first in the order of size by weight, so one level of sharing fits all others. The
    windows run over the list of sources.
    """
    everything = Window.orderBy("source_size").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    table = sizes.withColumn("weight", weights.cast("double"))
    table = table.withColumn("limit", F.col("source_size") * most_repeats).withColumn(
        "fill", F.col("limit") / F.col("weight"))
    total, weight = F.sum("source_size").over(everything), F.sum("weight").over(everything)
    ordered = Window.orderBy("fill", F.col("source").asc_nulls_last())
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    # the level that would fit if exactly the sources before this one were capped
    level = (total - F.coalesce(F.sum("limit").over(before), F.lit(0))) / (
        weight - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    table = table.withColumn("level", level)
    free = F.min(F.when(F.col("level") <= F.col("fill"), F.struct("fill", F.col("level").alias("level")))).over(everything)
    level = free["level"]
    return table.withColumn("shared", level).withColumn(
        "target", F.when(F.col("shared").isNull() | (F.col("fill") < F.col("shared")), F.col("limit").cast("double"))
        .otherwise(F.col("shared") * F.col("weight"))).select("source", "source_size", "weight", "target")


def mixed(
    documents: DataFrame, id: str = "doc_id", text: str = "text", source: str = "source", block: int = BLOCK,
    shard_slots: int = SHARD_SLOTS, weights: tuple[int, ...] = (1, 2, 3), seed: int = SEED, buckets: int = BUCKETS,
) -> dict[str, DataFrame]:
    """The mix as tables: ``documents``, ``sources``, ``slots`` and ``pieces``.

    * ``documents``: row (a number), id, size, source, source_size, target and taken, one row per document.
    * ``sources``: source, source_size, weight, target.
    * ``slots``: shard, slot (place in the shard), source_no, pass, block, words.
    * ``pieces``: source_no, block, row, word (first of the document's words), low and high (places in the block).

    A slot holds ``block`` words, but the last of a source's blocks and its last slot may hold fewer, so that the words
    taken of a source are its target rounded down. Weights repeat over the sources by code point, null last. A source
    may be null or hold most of the rows; positions are summed by bucket of ids first. Null and empty texts have size 0,
    are in no block and are never taken. Rows may repeat; each is a document of its own. Without any word nothing is
    taken and targets are 0. Reruns give the same mix.
    """
    scratch = Scratch(documents.sparkSession)
    sized = scratch.stage(documents.select(
        F.col(id).cast("bigint").alias("id"), F.col(source).cast("string").alias("source"),
        words_of(F.col(text).cast("string")).alias("size"), F.xxhash64(F.col(text)).alias("tie")), "sized")

    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    number = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("source_no") % len(weights) + 1).cast("int"))
    numbered = totals.withColumn("source_no", number)
    targets = source_targets(numbered, weight)
    sources = scratch.stage(
        targets.join(numbered.select(F.col("source").alias("s"), "source_no"),
                     F.col("source").eqNullSafe(F.col("s"))).drop("s"), "sources")

    # blocks: first places of the documents in their source, by bucket and then within it
    placed = sized.join(sources.select(F.col("source").alias("s"), "source_no"), F.col("source").eqNullSafe(F.col("s"))
                        ).withColumn("bucket", F.coalesce(F.pmod(scrambled(F.col("id"), seed), F.lit(buckets)), F.lit(0)))
    by_bucket = placed.groupBy("source_no", "bucket").agg(F.sum("size").alias("words"), F.count("*").alias("rows"))
    earlier = Window.partitionBy("source_no").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = by_bucket.select(
        "source_no", "bucket", F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("first"),
        F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("first_row"))
    inside = Window.partitionBy("source_no", "bucket").orderBy("id", "tie", "size")
    before = inside.rowsBetween(Window.unboundedPreceding, -1)
    local = placed.withColumn("at", F.coalesce(F.sum("size").over(before), F.lit(0))).withColumn(
        "nth", F.row_number().over(inside) - 1)
    positions = scratch.stage(local.join(starts, ["source_no", "bucket"]).select(
        "source_no", (F.col("first_row") + F.col("nth")).alias("row"), "id", "size", "source",
        (F.col("first") + F.col("at")).alias("start")), "positions")
    pieces = positions.filter("size > 0").select(
        "source_no", "row", "start", (F.col("start") + F.col("size")).alias("end"),
        F.explode(F.expr(f"sequence(start div {block}, (start + size - 1) div {block})")).alias("block")).select(
        "source_no", "block", "row", F.greatest(F.lit(0), F.col("block") * block - F.col("start")).alias("word"),
        F.greatest(F.lit(0), F.col("start") - F.col("block") * block).alias("low"),
        F.least(F.lit(block), F.col("end") - F.col("block") * block).alias("high"))

    # slots that each source needs: whole passes, then as many blocks as the rest of its target has words
    need = sources.withColumn("words", F.floor("target")).filter("words > 0").withColumns({
        "blocks": F.expr(f"source_size div {block} + if(source_size % {block} > 0, 1, 0)"),
        "full": F.expr(f"source_size div {block}"),
        "passes": F.expr("words div source_size"), "rest": F.expr("words % source_size")})
    need = need.withColumn("slots", F.expr(
        f"passes * blocks + rest div {block} + if(rest % {block} > 0, 1, 0)"))
    need = scratch.stage(need.withColumn("until", F.sum("slots").over(
        Window.orderBy("source_no").rowsBetween(Window.unboundedPreceding, 0))), "need")
    scratch.release("sources", "positions", "need")
    n_slots = need.agg(F.max("until")).first()[0] or 0
    shards = scratch.stage(_drawn(need, n_slots, shard_slots, seed), "shards")
    # the rows are few, their slots many: as many tasks as there are shards
    chunks = shards.select("shard", "source_no", (F.col("first") + F.col("n")).alias("end"), F.explode(F.expr(
        f"sequence(first, first + n - 1, {CHUNK}L)")).alias("begin")).repartition(
        max(1, -(-n_slots // shard_slots)), "source_no", "begin")
    filled = chunks.select("shard", "source_no", F.explode(F.expr(
        f"sequence(begin, least(end, begin + {CHUNK}) - 1)")).alias("i")).join(need.select("source_no", "source_size", "blocks", "full", "passes", "rest"),
                                               "source_no")
    filled = filled.withColumn("pass", F.expr("i div blocks")).withColumn("turn", F.expr("i % blocks"))
    # the short last block of a source is the last of every pass
    key = F.col("source_no") * 1009 + F.col("pass") * 31 + seed
    filled = filled.withColumn("block", F.when(F.col("turn") < F.col("full"), permuted(
        F.col("turn"), F.greatest(F.col("full"), F.lit(1)), key)).otherwise(F.col("turn")))
    left = F.when(F.col("pass") < F.col("passes"), block).otherwise(F.col("rest") - F.col("turn") * block)
    filled = filled.withColumn("words", F.least(
        F.lit(block), left, F.col("source_size") - F.col("block") * block))
    place = scrambled(F.col("i") + F.col("source_no") * 65537, seed + 1)
    slots = filled.select("shard", place.alias("slot"), "source_no", "pass", "block", "words")

    used = slots.groupBy("source_no", "block", "words").agg(F.count("*").alias("times"))
    taken = used.join(pieces, ["source_no", "block"]).groupBy("source_no", "row").agg(
        F.sum(F.greatest(F.lit(0), F.least("high", "words") - F.col("low")) * F.col("times")).alias("taken"))
    result = positions.join(taken, ["source_no", "row"], "left").join(
        sources.select("source_no", "source_size", "target"), "source_no").select(
        "source_no", "row", "id", "size", "source", "source_size", "target",
        F.coalesce("taken", F.lit(0)).cast("bigint").alias("taken"))
    return {"documents": result.withColumnRenamed("id", id), "sources": sources, "slots": slots, "pieces": pieces}


def _drawn(need: DataFrame, n_slots: int, shard_slots: int, seed: int) -> DataFrame:
    """Per (shard, source_no) the number n of its slots and the first of their numbers within the source.

    Every slot draws a source by the sources' numbers of slots, which gives each shard multinomial counts. Over all
    shards a source may have drawn too many: those beyond its number, in the order of shards, go to the sources that
    have drawn too few, in the order of sources.
    """
    spark = need.sparkSession
    n_shards = -(-n_slots // shard_slots)
    width = max(1, -(-n_slots // CELLS))
    draw = F.pmod(scrambled(F.col("id"), seed + 2) * PRIME + scrambled(F.col("id"), seed + 3), F.lit(max(1, n_slots)))
    draws = spark.range(n_slots).select(
        F.expr(f"id div {shard_slots}").alias("shard"), draw.alias("draw")).withColumn(
        "cell", F.expr(f"draw div {width}"))
    # a draw meets the few sources whose slots reach into its cell
    cells = need.select("source_no", (F.col("until") - F.col("slots")).alias("from"), "until", F.explode(F.expr(
        f"sequence((until - slots) div {width}, (until - 1) div {width})")).alias("cell"))
    counts = draws.join(cells, "cell").filter("draw >= from AND draw < until").groupBy("shard", "source_no").agg(
        F.count("*").alias("drawn"))
    running = Window.partitionBy("source_no").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("source_no")
    settled = counts.join(need.select("source_no", "slots"), "source_no").withColumns({
        "earlier": F.coalesce(F.sum("drawn").over(running), F.lit(0)), "all": F.sum("drawn").over(whole)})
    settled = settled.withColumn(
        "kept", F.greatest(F.lit(0), F.least(F.col("drawn"), F.col("slots") - F.col("earlier"))))
    surplus = settled.groupBy("shard").agg(F.sum(F.col("drawn") - F.col("kept")).alias("free")).filter("free > 0")
    surplus = surplus.withColumn("upto", F.sum("free").over(
        Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, 0)))
    got = settled.groupBy("source_no").agg(F.sum("kept").alias("got"))
    short = need.select("source_no", "slots").join(got, "source_no", "left").withColumn(
        "lack", F.col("slots") - F.coalesce("got", F.lit(0))).filter("lack > 0")
    short = short.withColumn("upto", F.sum("lack").over(
        Window.orderBy("source_no").rowsBetween(Window.unboundedPreceding, 0)))
    # both lists are stretches of the same row of free slots: they are cut at the ends of either
    cuts = surplus.select("upto").union(short.select("upto")).distinct()
    row = Window.orderBy("upto")
    cuts = cuts.withColumn("n", F.col("upto") - F.coalesce(F.lag("upto").over(row), F.lit(0)))
    ahead = row.rowsBetween(0, Window.unboundedFollowing)
    moved = cuts.join(surplus.select("upto", "shard"), "upto", "left").join(
        short.select("upto", "source_no"), "upto", "left").select(
        F.first("shard", True).over(ahead).alias("shard"), F.first("source_no", True).over(ahead).alias("source_no"), "n")
    final = settled.select("shard", "source_no", F.col("kept").alias("n")).unionByName(moved).groupBy(
        "shard", "source_no").agg(F.sum("n").alias("n")).filter("n > 0")
    return final.select(
        "shard", "source_no", "n", F.coalesce(F.sum("n").over(running), F.lit(0)).alias("first"))
