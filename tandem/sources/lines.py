"""Text files as lines that know where they came from."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tandem.functions.paths import logical_name
from tandem.functions.text import CHUNK_LENGTH, chunks, is_filled, strip
from tandem.operators.indexing import line_blocks, number_lines, row_slice


def read_manifest(spark: SparkSession, path: str) -> list[str]:
    """Paths listed in a small text file, one per line; blank lines are skipped, none is an error."""
    listed = spark.read.text(path).select(strip(F.col("value")).alias("path")).filter(is_filled(F.col("path")))
    paths = [row.path for row in listed.collect()]
    if not paths:
        raise ValueError(f"no paths listed in {path}")
    return paths


def scan_lines(
    spark: SparkSession, paths: str | list[str], name_prefix: str = "", name_pattern: str = ""
) -> DataFrame:
    """All lines of files and folders, untouched, as (name, path, block, span, row, text).

    ``block`` is the offset of the file split, ``span`` its length, and ``row`` increases by one inside it, so they
    give the reading order of a file without another pass. ``name_prefix`` and ``name_pattern`` (a regular expression) are
    checked against the logical file name, which prunes other files before they are opened. Line breaks are
    LF, CR LF and CR.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    raw = spark.read.option("recursiveFileLookup", "true").text(paths)
    path = F.col("_metadata.file_path")
    if name_prefix:
        raw = raw.filter(logical_name(path).startswith(name_prefix))
    if name_pattern:
        raw = raw.filter(logical_name(path).rlike(name_pattern))
    return raw.select(
        logical_name(path).alias("name"),
        path.alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.col("_metadata.file_block_length").alias("span"),
        F.monotonically_increasing_id().alias("row"),
        F.col("value").alias("text"),
    )


def clean_lines(scan: DataFrame) -> DataFrame:
    """Strip every line and drop those left empty."""
    return scan.withColumn("text", strip(F.col("text"))).filter(is_filled(F.col("text")))


def numbered_lines(spark: SparkSession, paths: str | list[str], stripped: bool = True) -> DataFrame:
    """(name, line_no, text) with blank lines kept, because positions matter."""
    lines = number_lines(scan_lines(spark, paths)).select("name", "line_no", "text")
    return lines.withColumn("text", strip(F.col("text"))) if stripped else lines


LISTED_FILES = 10_000


class LineIndex:
    """Where the lines of files are, to read slices of them again and again.

    Counted once when made. A slice opens only the files whose line numbers it meets, and numbers only the splits of
    them that it meets.
    """

    def __init__(self, spark: SparkSession, paths: str | list[str]):
        self.spark, self.paths = spark, paths
        self.blocks = line_blocks(scan_lines(spark, paths))

    def files(self, start: int, end: int) -> DataFrame:
        """The files, by path, that have lines numbered ``start`` up to, not including, ``end``; with their first number."""
        ranges = self.blocks.groupBy("name", "path").agg(
            F.min("start").alias("begin"), F.sum("rows").alias("lines"))
        return ranges.filter((F.col("begin") < end) & (F.col("begin") + F.col("lines") > start))

    def lines(self, start: int, end: int | None = None, stripped: bool = True) -> DataFrame:
        """(name, line_no, text) of every file's lines ``start`` up to, not including, ``end``; one line by default."""
        end = start + 1 if end is None else end
        wanted = self.files(start, end)
        listed = [row.path for row in wanted.select("path").limit(LISTED_FILES + 1).collect()]
        if not listed:
            return self.spark.createDataFrame([], "name string, line_no bigint, text string")
        if len(listed) <= LISTED_FILES:
            scan, blocks = scan_lines(self.spark, listed), None
        else:  # too many to name: all are opened, and only splits that the slice meets are numbered
            scan, blocks = scan_lines(self.spark, self.paths), self.blocks
        if blocks is None:
            # fewer files are split otherwise, so they are counted by themselves and moved to where they stand
            begins = wanted.select(F.col("path").alias("_path"), "begin")
            blocks = line_blocks(scan, []).join(begins, F.col("path") == F.col("_path")).withColumn(
                "start", F.col("start") + F.col("begin"))
        met = blocks.filter((F.col("start") < end) & (F.col("start") + F.col("rows") > start))
        found = row_slice(number_lines(scan, blocks=met), start, end).select("name", "line_no", "text")
        return found.withColumn("text", strip(F.col("text"))) if stripped else found


def load_monolingual(spark: SparkSession, paths: str | list[str], length: int = CHUNK_LENGTH) -> DataFrame:
    """Clean lines of files and folders cut into chunks; a narrow plan without a shuffle."""
    cleaned = clean_lines(scan_lines(spark, paths))
    return cleaned.select(
        "name", "path", "block", "row",
        F.posexplode(chunks(F.col("text"), length)).alias("chunk_no", "text"),
    )
