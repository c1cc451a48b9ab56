"""Expansion of multilingual rows into translation examples; every step stays inside its row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def languages_of(wide: DataFrame, keys: list[str]) -> list[str]:
    """The languages of a wide table: all its columns but the keys."""
    return [name for name in wide.columns if name not in keys]


def language_column(wide: DataFrame, language: str, keys: list[str]) -> DataFrame:
    """The texts of one language."""
    return wide.select(*keys, F.col(language).alias("text"))


def ordered_pairs(df: DataFrame, languages: list[str], keys: list[str], keep_nulls: bool = False) -> DataFrame:
    """Every ordered pair of different languages of a wide row, source-major.

    A pair is left out if either text is NULL (an empty text is not NULL). Two explodes in a row keep
    one pair in memory at a time and need no shuffle.
    """
    cells = F.array(*[F.struct(F.lit(name).alias("lang"), F.col(name).alias("text")) for name in languages])
    if not keep_nulls:
        cells = F.filter(cells, lambda cell: cell["text"].isNotNull())
    sources = df.select(*keys, cells.alias("_cells")).select(*keys, "_cells", F.explode("_cells").alias("_src"))
    targets = F.filter("_cells", lambda cell: cell["lang"] != F.col("_src.lang"))
    return sources.select(*keys, "_src", F.explode(targets).alias("_tgt")).select(
        *keys,
        F.col("_src.lang").alias("src_lang"),
        F.col("_tgt.lang").alias("tgt_lang"),
        F.col("_src.text").alias("src_text"),
        F.col("_tgt.text").alias("tgt_text"),
    )


def both_directions(df: DataFrame, left: str, right: str, keys: list[str], keep_nulls: bool = True) -> DataFrame:
    """Each row of a two-language table as (left, right) and (right, left), NULLs kept by default."""
    return ordered_pairs(df, [left, right], keys, keep_nulls=keep_nulls)


def interleave(df: DataFrame, columns: list[str], keys: list[str]) -> DataFrame:
    """The texts of several columns one after another; order by ``keys`` and ``pos``."""
    return df.select(*keys, F.posexplode(F.array(*[F.col(c) for c in columns])).alias("pos", "text"))


def to_long(df: DataFrame, languages: list[str], keys: list[str]) -> DataFrame:
    """One row per (row, language), NULL cells included."""
    return df.unpivot(keys, languages, "lang", "text")


def zip_columns(long: DataFrame, languages: list[str], key: str = "line_no", strict: bool = False) -> DataFrame:
    """Put the texts of all languages with the same position side by side.

    Uneven languages leave NULLs; with ``strict`` they are an error instead. The rows are shuffled before
    the aggregation because it cannot shrink them: a (position, language) occurs once.
    """
    wide = long.repartition(key).groupBy(key).pivot("lang", languages).agg(F.first("text"))
    if not strict:
        return wide
    missing = F.array_compact(F.array(*[F.when(F.col(name).isNull(), F.lit(name)) for name in languages]))
    complaint = F.concat(
        F.lit("line "), F.col(key).cast("string"), F.lit(" is missing for "), F.array_join(missing, ", ")
    )
    # a filter, because a check in a column goes where nobody selects the column
    return wide.filter(F.when(F.size(missing) > 0, F.raise_error(complaint).cast("boolean")).otherwise(True))
