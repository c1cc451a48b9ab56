"""Prediction and truth folders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tandem.functions.paths import logical_name, parent_name
from tandem.functions.text import strip
from tandem.operators.indexing import number_lines
from tandem.sources.lines import scan_lines

# Fixed value: how a prediction file is named after its direction.
PREDICTION_NAME = r"^(.+)_to_(.+)\.txt$"
TRUTH_NAME = r"^(.+)\.txt$"


def read_predictions(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(model, src_lang, tgt_lang, line_no, text) of every ``{model}/{src}_to_{tgt}.txt`` at once.

    Lines are stripped and blank ones kept. Files with another name are passed over.
    """
    scan = scan_lines(spark, paths, name_pattern=PREDICTION_NAME).withColumn("model", parent_name(F.col("path")))
    return number_lines(scan, group=["model", "name"]).select(
        "model",
        F.regexp_extract("name", PREDICTION_NAME, 1).alias("src_lang"),
        F.regexp_extract("name", PREDICTION_NAME, 2).alias("tgt_lang"),
        "line_no",
        strip(F.col("text")).alias("text"),
    )


def list_predictions(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(model, src_lang, tgt_lang) of every non-empty prediction file, from the file listing alone."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(paths)
    path = F.col("_metadata.file_path")
    named = files.select(parent_name(path).alias("model"), logical_name(path).alias("name"))
    return named.filter(F.col("name").rlike(PREDICTION_NAME)).select(
        "model",
        F.regexp_extract("name", PREDICTION_NAME, 1).alias("src_lang"),
        F.regexp_extract("name", PREDICTION_NAME, 2).alias("tgt_lang"),
    ).distinct()


def read_truth(spark: SparkSession, path: str) -> DataFrame:
    """(lang, line_no, text) of every ``{language}.txt``; two files of one name are an error that names them."""
    scan = scan_lines(spark, path, name_pattern=TRUTH_NAME)
    places: dict[str, set[str]] = {}
    for file in scan.inputFiles():  # the listing, not the data
        folder, _, name = file.rpartition("/")
        if folder.rpartition("/")[2].startswith("name="):
            folder, _, name = folder.rpartition("/")
        places.setdefault(name.removeprefix("name="), set()).add(folder)
    twice = {name: sorted(folders) for name, folders in places.items() if len(folders) > 1}
    if twice:
        raise ValueError(f"more than one truth file of a name: {twice}")
    return number_lines(scan).select(
        F.regexp_extract("name", TRUTH_NAME, 1).alias("lang"), "line_no", strip(F.col("text")).alias("text")
    )
