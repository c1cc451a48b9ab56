"""Alignment of source, hypothesis and reference lines by position."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tandem.session import stage

KEY = ["model", "src_lang", "tgt_lang"]


def aligned_pairs(predictions: DataFrame, truth: DataFrame) -> DataFrame:
    """Hypothesis and reference of every (model, direction, line); unmatched lines drop out.

    ``predictions`` has model, src_lang, tgt_lang, line_no, text; ``truth`` has lang, line_no, text.
    """
    refs = truth.select(F.col("lang").alias("tgt_lang"), "line_no", F.col("text").alias("ref"))
    joined = predictions.withColumnRenamed("text", "mt").join(refs, ["tgt_lang", "line_no"])
    return joined.select(*KEY, "line_no", "mt", "ref")


def aligned_triples(predictions: DataFrame, truth: DataFrame) -> DataFrame:
    """Source, hypothesis and reference of every line that all three sides have.

    The languages of a truth line are gathered into one map first, so the predictions are joined once
    and not once per side. A line number has one row per language and system, so no key is hot. Two truth
    texts for one line and language fail the job.
    """
    entries = F.collect_list(F.struct("lang", "text"))
    gathered = truth.groupBy("line_no").agg(entries.alias("_entries"))
    complaint = F.concat(F.lit("two truth texts of one language for line "), F.col("line_no").cast("string"))
    twice = F.size(F.array_distinct(F.col("_entries.lang"))) < F.size("_entries")
    texts = gathered.select(
        "line_no", F.when(twice, F.raise_error(complaint).cast("map<string,string>"))
        .otherwise(F.map_from_entries("_entries")).alias("_texts"))
    sides = predictions.join(texts, "line_no").select(
        *KEY, "line_no", F.col("_texts")[F.col("src_lang")].alias("src"), F.col("text").alias("mt"),
        F.col("_texts")[F.col("tgt_lang")].alias("ref"),
    )
    return sides.filter(F.col("src").isNotNull() & F.col("ref").isNotNull())


def alignment_report(predictions: DataFrame, truth: DataFrame) -> DataFrame:
    """Line counts of the three sides for every evaluated direction, to make misalignment visible."""
    lines = truth.groupBy("lang").agg(F.count("*").alias("lines"))
    hyp = predictions.groupBy(*KEY).agg(F.count("*").alias("n_mt"))
    src = lines.select(F.col("lang").alias("src_lang"), F.col("lines").alias("n_src"))
    ref = lines.select(F.col("lang").alias("tgt_lang"), F.col("lines").alias("n_ref"))
    return (
        hyp.join(src, "src_lang", "left").join(ref, "tgt_lang", "left")
        .select(*KEY, F.coalesce("n_src", F.lit(0)).alias("n_src"), "n_mt",
                F.coalesce("n_ref", F.lit(0)).alias("n_ref"))
        .withColumn("aligned", (F.col("n_src") == F.col("n_mt")) & (F.col("n_mt") == F.col("n_ref")))
    )


def require_alignment(predictions: DataFrame, truth: DataFrame, shown: int = 20) -> None:
    """Fail if any side of a direction has a different number of lines.

    The error gives the number of such directions and names the first ``shown``; ``alignment_report`` has all.
    """
    bad = alignment_report(predictions, truth).filter(~F.col("aligned"))
    count = bad.count()
    if count:
        found = bad.orderBy(*KEY).limit(shown).collect()
        raise ValueError(f"{count} misaligned directions: " + "; ".join(
            f"{r.model} {r.src_lang}->{r.tgt_lang} ({r.n_src}/{r.n_mt}/{r.n_ref})" for r in found))


def available(grid: DataFrame, predictions: DataFrame) -> DataFrame:
    """Requested (model, direction) cells that have predictions, or a listed prediction file."""
    return grid.join(predictions.select(*KEY).distinct(), KEY, "left_semi")


def missing(grid: DataFrame, predictions: DataFrame) -> DataFrame:
    """Requested cells without predictions."""
    return grid.join(predictions.select(*KEY).distinct(), KEY, "left_anti")


def availability(grid: DataFrame, predictions: DataFrame) -> DataFrame:
    """Every requested cell with ``available``: whether it has predictions, which are read once, for their keys."""
    keys = stage(predictions.select(*KEY).distinct(), "keys").withColumn("available", F.lit(True))
    return grid.join(keys, KEY, "left").withColumn("available", F.coalesce("available", F.lit(False)))
