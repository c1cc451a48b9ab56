"""Counts and lengths of corpora, and their character inventory."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tandem.functions.text import distinct_characters


def union_corpora(corpora: dict[str, DataFrame]) -> DataFrame:
    """Append corpora, duplicates kept, with the origin in ``source``."""
    tagged = [df.withColumn("source", F.lit(name)) for name, df in corpora.items()]
    return reduce(DataFrame.unionByName, tagged)


def corpus_profile(df: DataFrame, text: str = "text") -> DataFrame:
    """Rows, characters, mean and longest text per ``source``, and one row over all with ``is_total``.

    Texts whose source is NULL have a row of their own, which is not the total.
    The totals are rolled up from the per-source rows, so the data is aggregated once.
    """
    length = F.length(text).cast("bigint")
    per_source = df.groupBy("source").agg(
        F.count("*").alias("rows"), F.sum(length).alias("chars"), F.max(length).alias("longest"),
        F.count(text).alias("filled"),
    )
    return (
        per_source.rollup("source")
        .agg(F.sum("rows").alias("rows"), F.sum("chars").alias("chars"), F.max("longest").alias("longest"),
             F.sum("filled").alias("filled"), (F.grouping_id() == 1).alias("is_total"))
        .withColumn("mean_length", F.col("chars") / F.col("filled"))
        .drop("filled")
    )


def language_profile(df: DataFrame, languages: list[str], dataset: str = "dataset") -> DataFrame:
    """Filled cells, characters, mean per row and longest text for each (dataset, language).

    All languages are aggregated in one pass over the wide rows; only the result is turned to rows.
    """
    def cell(name: str):
        length = F.length(name).cast("bigint")
        return F.struct(
            F.lit(name).alias("lang"),
            F.count(name).alias("filled"),
            F.coalesce(F.sum(length), F.lit(0)).alias("chars"),
            (F.coalesce(F.sum(length), F.lit(0)) / F.count("*")).alias("chars_per_row"),
            F.max(length).alias("longest"),
        )

    return (
        df.groupBy(dataset)
        .agg(F.array(*[cell(name) for name in languages]).alias("_cells"))
        .select(dataset, F.explode("_cells").alias("_cell"))
        .select(dataset, "_cell.*")
    )


def character_counts(df: DataFrame, text: str = "text") -> DataFrame:
    """Each character with the number of texts that contain it; counted before the shuffle."""
    return (
        df.select(F.explode(distinct_characters(F.col(text))).alias("ch"))
        .groupBy("ch")
        .agg(F.count("*").alias("texts"))
    )


def new_characters(df: DataFrame, vocabulary: DataFrame, text: str = "text", token: str = "token") -> DataFrame:
    """Characters of the corpus that are no entry of ``vocabulary``.

    Only single-character entries can match, and Unicode has 1 114 112 code points, so the set of known characters is
    bounded whatever the vocabulary's size. It travels with the plan and is erased from every text, whose other
    characters alone are exploded and counted.
    """
    single = vocabulary.filter(F.length(token) == 1).select(F.col(token).alias("ch")).distinct()
    known = "".join(sorted(row.ch for row in single.collect()))
    unknown = F.translate(F.col(text), known, "") if known else F.col(text)
    return character_counts(df.select(unknown.alias("text")))
