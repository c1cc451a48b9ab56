"""Scoring of lines as they arrive, from a text folder to Parquet.

Between source and sink stand the batch operators ``towards`` and ``translate``, which keep no state. Lines can be
numbered on the way: a micro-batch holds whole files, so it numbers the lines of each file over its splits, and keeps
the files' counts. What a logical file of many part files counts through is known when it is read, in whatever order
and batches its parts have come.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tandem.functions.paths import logical_name, part_number
from tandem.operators.indexing import line_blocks, number_lines, small_list
from tandem.session import scratch_scope


def incoming_lines(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    """Stream of (text, path, block, span): lines of files that appear in ``path``, and the file split they stand in."""
    lines = spark.readStream.option("maxFilesPerTrigger", files_per_batch).text(path)
    return lines.select(
        F.col("value").alias("text"), F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block"), F.col("_metadata.file_block_length").alias("span"),
    )


def start_scoring(scored: DataFrame, output: str, checkpoint: str) -> StreamingQuery:
    """Append scored lines to Parquet until the files present now are done.

    Restarting with the same checkpoint resumes after the last finished batch.
    """
    return (
        scored.writeStream.format("parquet")
        .option("path", output)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def start_numbered_scoring(
    lines: DataFrame, score: Callable[[DataFrame], DataFrame], output: str, checkpoint: str
) -> StreamingQuery:
    """Score an :func:`incoming_lines` stream with every line's file and number; :func:`numbered_scores` reads it.

    ``score`` gets (file, file_line, text) of a micro-batch and returns a table that keeps ``file`` and ``file_line``.
    The files of a batch are read twice, to count splits and to number lines; no file is gathered in one task. A batch
    that is run again after a failure replaces its own folders, so that every line stands in the output once.
    """

    def batch(arrived: DataFrame, number: int) -> None:
        with scratch_scope(arrived.sparkSession):
            scan = arrived.withColumn("row", F.monotonically_increasing_id()).withColumn("file", F.col("path"))
            blocks = line_blocks(scan, [])
            numbered = number_lines(scan.withColumnRenamed("file", "_name"), blocks=blocks, into="file_line")
            scored = score(numbered.select(F.col("_name").alias("file"), "file_line", "text"))
            scored.write.mode("overwrite").parquet(f"{output}/lines/batch={number}")
            blocks.groupBy(F.col("path").alias("file")).agg(F.sum("rows").alias("lines")).write.mode(
                "overwrite").parquet(f"{output}/files/batch={number}")

    return lines.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def numbered_scores(spark: SparkSession, output: str) -> DataFrame:
    """Scored lines with ``name`` and ``line_no``: the logical file, and the line's number in it, counted from 0.

    Part files of one logical file count through in the order of their numbers. Lines of a batch whose counts are not
    written yet are left out.
    """
    files = spark.read.parquet(f"{output}/files")
    path = F.col("file")
    name = logical_name(path)
    before = Window.partitionBy("name").orderBy(part_number(path), path).rowsBetween(Window.unboundedPreceding, -1)
    begins = files.select("file", name.alias("name"), "lines").withColumn(
        "_begin", F.coalesce(F.sum("lines").over(before), F.lit(0))).drop("lines")
    return spark.read.parquet(f"{output}/lines").join(small_list(begins, files.count()), "file").withColumn(
        "line_no", F.col("file_line") + F.col("_begin")).drop("_begin", "file", "file_line", "batch")
