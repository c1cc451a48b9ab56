"""Row numbers and batch numbers without a single-partition window over the data.

Spark rows have no position. A row's number is the sum of the sizes of all blocks before its own (a
block is a file split, or a partition of a range sort) plus its place inside its block. Only the list
of blocks, one row per block, passes through a window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tandem.functions.paths import logical_name, part_number
from tandem.session import Scratch, fixed_splits, stage


# a broadcast list of blocks has at most this many rows of some 100 bytes: 256 TB in splits of 128 MB
BROADCAST_BLOCKS = 2_000_000
CHANGED = "the splits of the files have changed since their lines were counted"


def small_list(blocks: DataFrame, rows: int) -> DataFrame:
    """A list of ``rows`` blocks, to be sent to every task if that is bounded."""
    return F.broadcast(blocks) if rows <= BROADCAST_BLOCKS else blocks


def _starts(blocks: DataFrame, group: list[str], order: list[Column]) -> Column:
    """The number of rows in all blocks of the group before this one."""
    before = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum("_rows").over(before), F.lit(0))


def line_blocks(scan: DataFrame, group: list[str] | None = None) -> DataFrame:
    """The file splits of a scan, counted: group, path, file, block, span, first, start and rows.

    ``start`` is the number of a split's first line in its group (default: the logical file; none: the file itself).
    Files of one group are counted in the order of their names, part files in the order of their numbers. The text is not read into columns;
    one row per split leaves its task.
    """
    fixed_splits(scan.sparkSession)
    group = ["name"] if group is None else [name for name in group if name != "path"]
    path = F.col("path")
    counted = scan.groupBy(*group, "path", "block", "span").agg(
        F.count("*").alias("_rows"), F.min("row").alias("first"))
    order = [logical_name(path), part_number(path), path, F.col("block")]
    return stage(counted.select(
        *group, "path", F.xxhash64("path").alias("file"), "block", "span", "first",
        _starts(counted, group or ["path"], order).alias("start"), F.col("_rows").alias("rows")), "blocks")


def number_lines(
    scan: DataFrame, group: list[str] | None = None, into: str = "line_no", blocks: DataFrame | None = None
) -> DataFrame:
    """Number the lines of a :func:`tandem.sources.lines.scan_lines` result from 0.

    The files are read twice and nothing is written but the list of their splits: one scan counts the lines of each
    split, the other adds a line's place in its split to the split's start. ``group`` and the order are those of
    :func:`line_blocks`, whose result may be given as ``blocks``; then only its splits are numbered, with its starts.
    Splits are held fixed between the scans, and a line that does not fit the counts fails the job.
    """
    chosen = blocks is not None
    blocks = line_blocks(scan, group) if blocks is None else blocks
    known = small_list(blocks.select(
        "file", F.col("block").alias("_block"), F.col("span").alias("_span"), "first", "start", "rows"), blocks.count())
    here = scan.withColumn("_file", F.xxhash64("path"))
    same = (F.col("_file") == F.col("file")) & (F.col("block") == F.col("_block")) & (F.col("span") == F.col("_span"))
    place = F.col("row") - F.col("first")
    number = F.when((place >= 0) & (place < F.col("rows")), place + F.col("start")).otherwise(
        F.raise_error(F.lit(CHANGED)).cast("bigint"))
    return here.join(known, same, "inner" if chosen else "left").withColumn(into, number).drop(
        "_file", "file", "_block", "_span", "first", "start", "rows", "path", "block", "span", "row")


def number_rows(
    df: DataFrame, order_by: list[str], group: list[str] | None = None, into: str = "row_id"
) -> DataFrame:
    """Number table rows from 0 in the order of ``order_by``, restarting for every ``group``.

    ``order_by`` must decide the order fully (end it with a unique key). The data is range-sorted by
    group and order, so one group holding most rows is spread over many tasks. The range sort reads its input
    twice, so the input is stored first and computed once.
    """
    group = group or []
    ordering = [*group, *order_by]
    scratch = Scratch(df.sparkSession)
    located = (
        scratch.stage(df, "unsorted").repartitionByRange(*ordering)
        .sortWithinPartitions(*ordering)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_row", F.monotonically_increasing_id())
    )
    rows = stage(located, "rows")
    scratch.release()
    parts = rows.groupBy(*group, "_part").agg(F.count("*").alias("_rows"), F.min("_row").alias("_first"))
    shift = _starts(parts, group, [F.col("_part")]) - F.col("_first")
    starts = stage(parts.select(*group, "_part", shift.alias("_shift")), "blocks")
    return rows.join(starts, [*group, "_part"]).withColumn(into, F.col("_row") + F.col("_shift")).drop(
        "_shift", "_row", "_part")


def first_of_groups(
    df: DataFrame, order_by: list[str], group: list[str], count: int, into: str = "row_id"
) -> DataFrame:
    """The first ``count`` rows of every group, numbered from 0 as :func:`number_rows` would number them.

    Nothing else is numbered or moved: each task keeps only its own first ``count`` rows of a group, so a group that
    holds most rows sends no more of them than ``count`` per task.
    """
    place = F.row_number().over(Window.partitionBy(*group).orderBy(*order_by))
    return df.withColumn(into, place).filter(F.col(into) <= count).withColumn(into, (F.col(into) - 1).cast("bigint"))


def batch_number(index: Column, batch_size: int) -> Column:
    """Number of the consecutive batch that position ``index`` falls into."""
    if batch_size < 1:
        raise ValueError("batch_size must be at least 1")
    return F.floor(index / F.lit(batch_size)).cast("bigint")


def row_slice(df: DataFrame, start: int, end: int | None = None, index: str = "line_no") -> DataFrame:
    """Rows ``start`` up to, not including, ``end``; a single row by default."""
    end = start + 1 if end is None else end
    return df.filter((F.col(index) >= start) & (F.col(index) < end))


def first_rows(df: DataFrame, count: int | None, index: str = "line_no") -> DataFrame:
    """The first ``count`` rows by position; all rows for ``None`` or 0."""
    return df.filter(F.col(index) < count) if count else df
