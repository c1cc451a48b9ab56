"""Merkle manifest of a table: a tree of SHA-256 digests per group, one tree over their roots, a proof per row.

A built tree is stored as parent-linked node rows. To keep proofs short to walk, a row links its node to the ancestor
``stride`` levels above and holds the siblings on that way; a recursive query starts from the leaves, joins each one's
next row, appends its siblings to the proof and folds the leaf's digest over them, until all leaves stand at the root.
Nothing of a tree is ever in one task: leaves are numbered over a range sort, a task builds runs of 2**stride nodes,
and node rows are dealt by stretches of leaves, so no join key has more than 2**STRETCH of them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tandem.operators.indexing import number_rows
from tandem.session import Scratch

STRIDE = 8
STRETCH = 10
TOP = -1

CLIMB = """
WITH RECURSIVE ascent(id, tree, place, step, last, leaf, folded, proof) AS (
  SELECT id, tree, place, 1, last, leaf, {fold_leaf}, {siblings} FROM {{leaves}} n
  UNION ALL
  SELECT a.id, a.tree, a.place, a.step + 1, a.last, a.leaf, {fold_step}, concat(a.proof, {siblings})
  FROM ascent a JOIN {{nodes}} n
    ON n.tree = a.tree AND n.step = a.step AND n.stretch = a.place >> least(a.step * {stride}, {stretch}))
SELECT id, tree, place, leaf, folded, proof FROM ascent WHERE step = last LIMIT ALL
"""
FOLD = """aggregate(n.siblings, {start}, (h, s) -> unhex(sha2(concat(
    coalesce(lower(hex(s.left)), ''), lower(hex(h)), coalesce(lower(hex(s.right)), '')), 256)))"""
SIBLINGS = "aggregate(n.siblings, X'', (all, s) -> concat(all, coalesce(s.left, s.right, X'')))"


def digest_text(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def row_digest(fields: list[Column]) -> Column:
    """SHA-256 of the fields one behind another: byte count, colon and value of each, a dash for a null."""
    texts = [field.cast("string") for field in fields]
    parts = [F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")) for text in texts]
    return F.unhex(F.sha2(F.concat(*parts), 256))


def _parent(left: Column, right: Column) -> Column:
    return F.unhex(F.sha2(F.concat(digest_text(left), F.coalesce(digest_text(right), F.lit(""))), 256))


def _height(leaves: Column) -> Column:
    """Levels above the leaves until one node is left."""
    return F.when(leaves > 1, F.length(F.bin(leaves - 1))).otherwise(0)


def _steps(height: Column, stride: int) -> Column:
    return F.greatest(F.ceil(height / stride).cast("int"), F.lit(1))


def _runs(nodes: DataFrame, step: int, stride: int) -> DataFrame:
    """Runs of 2**stride nodes of (tree, height, place, digest, id, altered): top, and the siblings of each node."""
    runs = nodes.groupBy("tree", "height", F.shiftright("place", stride).alias("run")).agg(
        F.array_sort(F.collect_list(F.struct("place", "digest", "id", "altered"))).alias("members"))
    levels = F.least(F.lit(stride), F.col("height") - step * stride)
    numbers = F.when(levels > 0, F.sequence(F.lit(0), levels - 1)).otherwise(F.array().cast("array<int>"))

    def above(built: Column, _: Column) -> Column:
        below = F.element_at(built, -1)
        pairs = F.sequence(F.lit(0), F.floor((F.size(below) - 1) / 2).cast("int"))
        return F.concat(built, F.array(F.transform(
            pairs, lambda i: _parent(F.get(below, i * 2), F.get(below, i * 2 + 1)))))

    def linked(built: Column) -> Column:
        def siblings(i: Column) -> Column:
            def at(level: Column) -> Column:
                index, nodes_ = F.call_function("shiftright", i, level), F.get(built, level)
                odd = index % 2 == 1
                return F.struct(F.when(odd, F.get(nodes_, index - 1)).alias("left"),
                                F.when(~odd, F.get(nodes_, index + 1)).alias("right"))

            return F.transform(numbers, at)

        return F.struct(
            F.get(F.element_at(built, -1), F.lit(0)).alias("top"),
            F.transform("members", lambda member, i: member.withField("siblings", siblings(i))).alias("nodes"))

    digests = F.array(F.transform("members", lambda member: member["digest"]))
    return runs.select("tree", "height", "run", F.aggregate(numbers, digests, above, linked).alias("built")).select(
        "tree", "height", "run", "built.top", "built.nodes")


@dataclass
class Manifest:
    """A built manifest: leaves with their first siblings, node rows by step and stretch, trees with their subroots.

    ``leaves``: id, tree, place, last, leaf, altered, siblings. ``nodes``: tree, step, stretch, siblings. ``trees``:
    tree, group, leaves, subroot. ``root`` is a digest, None without rows.
    """

    leaves: DataFrame
    nodes: DataFrame
    trees: DataFrame
    root: bytes | None
    stride: int


def _forest(nodes: DataFrame, highest: int, stride: int, scratch: Scratch, label: str) -> list[DataFrame]:
    """The stored runs of each step of all trees in ``nodes``."""
    steps = []
    for step in range(max(1, -(-highest // stride))):
        steps.append(scratch.stage(_runs(nodes, step, stride), f"{label}{step}"))
        nodes = steps[-1].filter(F.col("height") > (step + 1) * stride).select(
            "tree", "height", F.col("run").alias("place"), F.col("top").alias("digest"),
            F.lit(None).cast("bigint").alias("id"), F.lit(None).cast("binary").alias("altered"))
    return steps


def _tops(steps: list[DataFrame], stride: int) -> DataFrame:
    last = [runs.filter((F.col("height") > step * stride if step else F.lit(True))
                        & (F.col("height") <= (step + 1) * stride)).select("tree", "top")
            for step, runs in enumerate(steps)]
    result = last[0]
    for runs in last[1:]:
        result = result.unionByName(runs)
    return result


def build_manifest(
    table: DataFrame, fields: list[str], id: str = "doc_id", group: str = "lang",
    altered: dict[str, Column] | None = None, changed: Column | None = None, stride: int = STRIDE,
) -> Manifest:
    """Digest every row's ``fields``, build a tree per ``group`` and one over the groups.

    Rows of a group ascend by ``id`` (null first), equal ids by digest; groups ascend bytewise, null first. Two
    consecutive nodes become one, a last single one too, while a level has several. For rows that ``changed`` selects a
    second digest is kept, of the row with ``altered`` columns in place of its own. Rows with null id, group or fields
    and repeated rows are leaves like any other; extra columns are not read. An empty table has no leaves and no root.
    """
    scratch = Scratch(table.sparkSession)
    values = {name: F.col(name) for name in fields}
    other = row_digest(list((values | (altered or {})).values()))
    rows = table.select(
        F.col(group).isNotNull().alias("known"), F.coalesce(F.col(group).cast("string"), F.lit("")).alias("name"),
        F.col(id).cast("bigint").alias("id"), row_digest(list(values.values())).alias("digest"),
        F.when(F.lit(False) if changed is None else changed, other).alias("altered"))
    placed = number_rows(rows, ["id", "digest"], ["known", "name"], into="place")
    sizes = scratch.stage(placed.groupBy("known", "name").agg(F.count("*").alias("leaves")), "sizes")
    trees = scratch.stage(number_rows(sizes, ["known", "name"], into="tree").withColumn(
        "height", _height(F.col("leaves"))), "trees")
    n_trees, highest = trees.agg(F.count("*"), F.coalesce(F.max("height"), F.lit(0))).first()

    def stretched(leaves: Column, step: Column) -> Column:
        """All stretches of a tree's leaves, as the climb counts them at ``step``."""
        shift = F.least(step * stride, F.lit(STRETCH))
        return F.sequence(F.lit(0).cast("bigint"), F.call_function("shiftright", leaves - 1, shift))

    # a group may hold most rows: its name is joined by stretches of its leaves too
    named = trees.withColumn("stretch", F.explode(stretched(F.col("leaves"), F.lit(STRETCH))))
    lower = _forest(
        placed.withColumn("stretch", F.shiftright("place", STRETCH)).join(named, ["known", "name", "stretch"]).select(
            "tree", "height", "place", "digest", "id", "altered"), highest, stride, scratch, "lower")
    subroots = scratch.stage(_tops(lower, stride).join(trees, "tree").withColumnRenamed("top", "subroot"), "subroots")
    top_height = (n_trees - 1).bit_length() if n_trees > 1 else 0
    upper = _forest(subroots.select(
        F.lit(TOP).cast("bigint").alias("tree"), F.lit(top_height).alias("height"), F.col("tree").alias("place"),
        F.col("subroot").alias("digest"), F.lit(None).cast("bigint").alias("id"),
        F.lit(None).cast("binary").alias("altered")), top_height, stride, scratch, "upper")
    root = _tops(upper, stride).first()
    top_steps = -(-top_height // stride)

    last = (_steps(F.col("height"), stride) + top_steps).alias("last")
    leaves = lower[0].select("tree", last, F.explode("nodes").alias("n")).select(
        "n.id", "tree", "n.place", "last", F.col("n.digest").alias("leaf"), "n.altered", "n.siblings")
    nodes = []
    for step, runs in enumerate(lower[1:], start=1):
        shift = min(step * stride, STRETCH)
        first = F.shiftright(F.shiftleft(F.col("n.place"), step * stride), shift)
        end = F.shiftright(F.least(F.shiftleft(F.col("n.place") + 1, step * stride), F.col("leaves")) - 1, shift)
        nodes.append(runs.select("tree", F.explode("nodes").alias("n")).join(trees.select("tree", "leaves"), "tree").select(
            "tree", F.lit(step).alias("step"), F.explode(F.sequence(first, end)).alias("stretch"), "n.siblings"))
    for step, runs in enumerate(upper[:top_steps]):
        at = _steps(F.col("height"), stride) + step
        ways = trees.select("tree", at.alias("step"), F.shiftright("tree", step * stride).alias("place"), "leaves").join(
            runs.select(F.explode("nodes").alias("n")).select("n.place", "n.siblings"), "place")
        nodes.append(ways.select(
            "tree", "step", F.explode(stretched(F.col("leaves"), F.col("step"))).alias("stretch"), "siblings"))
    linked = table.sparkSession.createDataFrame(
        [], "tree bigint, step int, stretch bigint, siblings array<struct<left: binary, right: binary>>")
    for rows in nodes:
        linked = linked.unionByName(rows)
    group_ = F.when(F.col("known"), F.col("name")).alias("group")
    return Manifest(leaves, scratch.stage(linked, "nodes"), subroots.select("tree", group_, "leaves", "subroot"),
                    bytes(root.top) if root else None, stride)


def folded_proofs(spark: SparkSession, manifest: Manifest) -> DataFrame:
    """Per leaf of the manifest: id, group, place, leaf, subroot, root, proof, folded_root and verified.

    ``proof`` has the siblings from the leaf to the root, one digest behind another (empty for a lone leaf).
    ``folded_root`` folds the altered digest, else the leaf's own, over them; ``verified`` says if that is the root.
    All digests are lower-case hex. Without leaves the result is empty.
    """
    sql = CLIMB.format(
        fold_leaf=FOLD.format(start="coalesce(n.altered, n.leaf)"), fold_step=FOLD.format(start="a.folded"),
        siblings=SIBLINGS, stride=manifest.stride, stretch=STRETCH)
    climbed = spark.sql(sql, leaves=manifest.leaves, nodes=manifest.nodes)
    ends = manifest.trees.withColumn("stretch", F.explode(
        F.sequence(F.lit(0).cast("bigint"), F.shiftright(F.col("leaves") - 1, STRETCH))))
    root = F.lit(manifest.root.hex() if manifest.root else None).cast("string")
    return climbed.withColumn("stretch", F.shiftright("place", STRETCH)).join(ends, ["tree", "stretch"]).select(
        "id", "group", "place", digest_text(F.col("leaf")).alias("leaf"),
        digest_text(F.col("subroot")).alias("subroot"), root.alias("root"), digest_text(F.col("proof")).alias("proof"),
        digest_text(F.col("folded")).alias("folded_root")).withColumn(
        "verified", F.coalesce(F.col("folded_root") == F.col("root"), F.lit(False)))
