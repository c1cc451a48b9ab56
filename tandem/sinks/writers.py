"""Predictions, truth files, evaluation tables and run names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tandem.functions.text import file_safe, flatten_newlines, one_line
from tandem.session import Scratch

# The two forms of a run's time stamp.
RUN_FORMATS = {"compact": "yyyyMMdd-HHmmss", "dashed": "yyyy-MM-dd_HH-mm-ss"}


def run_stamp(moment: Column, form: str = "dashed") -> Column:
    """Run id made from a time stamp."""
    return F.date_format(moment, RUN_FORMATS[form])


def prediction_name(src: Column, tgt: Column) -> Column:
    """``{src}_to_{tgt}.txt`` with blanks as underscores."""
    return file_safe(F.concat(src, F.lit("_to_"), tgt, F.lit(".txt")))


def write_lines(
    df: DataFrame, path: str, name: Column, order_by: list[str], text: str = "text", model: Column | None = None
) -> None:
    """Write one logical text file per ``name``, lines in the order of ``order_by``.

    A logical file is the folder ``name=X`` of part files, which this package reads back as one file. Every
    line break inside a text becomes a blank, so a text is always one line.
    With ``model`` the files of each model go to its own folder ``model=M``, all in one job. The sort is
    range-partitioned on (model, name, order), so a single huge file is written by many tasks. A range
    sort reads its input twice, so the lines are stored first and computed once.
    """
    folders = {"name": name} if model is None else {"model": model, "name": name}
    ordering = [*folders, *order_by]
    lines = df.select(
        *[value.alias(folder) for folder, value in folders.items()], *order_by, one_line(F.col(text)).alias("value")
    )
    scratch = Scratch(df.sparkSession)
    (
        scratch.stage(lines, "unsorted").repartitionByRange(*ordering)
        .sortWithinPartitions(*ordering)
        .select(*folders, "value")
        .write.partitionBy(*folders)
        .text(path)
    )
    scratch.release()


ROWS_PER_FILE = 1_000_000


def flat_predictions(df: DataFrame, newlines: str = "space") -> DataFrame:
    """Predictions with texts on one line and names as file names have them."""
    return df.withColumns({
        "text": flatten_newlines(F.col("text"), newlines),
        "src_lang": file_safe(F.col("src_lang")),
        "tgt_lang": file_safe(F.col("tgt_lang")),
    })


def in_stretches(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows sorted for a partitioned write, the lines of a key cut by ``ROWS_PER_FILE`` and by their bytes.

    A key that holds most rows is written by many tasks: stretches whose lines hold more than
    ``spark.sql.adaptive.advisoryPartitionSizeInBytes`` are dealt over several, small ones share one. The hash shuffle
    computes the rows once, where a range sort would run a model a second time to sample its keys.
    """
    dealt = df.withColumn("_stretch", F.floor(F.col("line_no") / ROWS_PER_FILE)).hint("rebalance", *keys, "_stretch")
    return dealt.sortWithinPartitions(*keys, "line_no").drop("_stretch")


def write_predictions(df: DataFrame, path: str, newlines: str = "space") -> None:
    """Write (run, model, src_lang, tgt_lang, line_no, text) as plain Parquet, one folder per run, model and direction.

    What the folder holds of the written (run, model, src_lang, tgt_lang) is replaced, all else stays, so
    writing a run again does not double its lines. A writer that dies, or two at once, may leave some keys old and some
    new; :class:`tandem.sinks.store.PredictionStore` changes all of them at once.
    """
    partitions = ["run", "model", "src_lang", "tgt_lang"]
    in_stretches(flat_predictions(df, newlines), partitions).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic").partitionBy(*partitions).parquet(path)


def export_predictions(df: DataFrame, path: str, newlines: str = "space") -> None:
    """Text export of predictions: a folder per model, a logical file per direction in it."""
    flat = df.withColumn("text", one_line(F.col("text"), newlines))
    name = prediction_name(F.col("src_lang"), F.col("tgt_lang"))
    write_lines(flat, path, name, ["line_no"], model=F.col("model"))


def export_truth(long: DataFrame, path: str) -> None:
    """Text export of (lang, line_no, text): a logical file ``{language}.txt`` per language."""
    filled = long.withColumn("text", F.coalesce("text", F.lit("")))
    write_lines(filled, path, F.concat(file_safe(F.col("lang")), F.lit(".txt")), ["line_no"])


def write_evaluation(records: DataFrame, path: str) -> None:
    """Evaluation table as one CSV file; it has one row per model and direction.

    The records are stored first, so that only they, and not their computation, pass one task.
    """
    scratch = Scratch(records.sparkSession)
    scratch.stage(records, "evaluation").coalesce(1).write.csv(path, header=True)
    scratch.release()
