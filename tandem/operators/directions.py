"""Translation directions around a pivot language."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tandem.functions.languages import PIVOT


def without_pivot(languages: list[str], pivot: str = PIVOT) -> list[str]:
    """All languages but the pivot, order kept."""
    return [name for name in languages if name != pivot]


def direction(lang: Column, from_pivot: Column, pivot: str = PIVOT) -> Column:
    """Source and target for one language: out of the pivot if ``from_pivot``, else into it."""
    hub = F.lit(pivot)
    return F.struct(
        F.when(from_pivot, hub).otherwise(lang).alias("src_lang"),
        F.when(from_pivot, lang).otherwise(hub).alias("tgt_lang"),
    )


def with_default_sides(df: DataFrame, pivot: str = PIVOT) -> DataFrame:
    """A side that is not given is the pivot."""
    return df.withColumns({side: F.coalesce(F.col(side), F.lit(pivot)) for side in ("src_lang", "tgt_lang")})


def direction_error(src: Column, tgt: Column, pivot: str = PIVOT) -> Column:
    """NULL for a direction with exactly one pivot side, else the reason it is refused."""
    return (
        F.when((src != pivot) & (tgt != pivot), F.lit(f"either side must be {pivot}"))
        .when((src == pivot) & (tgt == pivot), F.lit(f"both sides are {pivot}"))
    )


def valid_directions(df: DataFrame, pivot: str = PIVOT) -> DataFrame:
    """Rows with a valid direction; any other row fails the job."""
    error = direction_error(F.col("src_lang"), F.col("tgt_lang"), pivot)
    checked = F.when(error.isNotNull(), F.raise_error(error).cast("boolean")).otherwise(True)
    return with_default_sides(df, pivot).filter(checked)


def split_directions(df: DataFrame, pivot: str = PIVOT) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected); rejected rows carry the reason in ``error``."""
    checked = with_default_sides(df, pivot).withColumn(
        "error", direction_error(F.col("src_lang"), F.col("tgt_lang"), pivot)
    )
    return checked.filter(F.col("error").isNull()).drop("error"), checked.filter(F.col("error").isNotNull())


def pivot_grid(languages: list[str], pivot: str = PIVOT) -> list[tuple[str, str]]:
    """All directions out of the pivot, then all into it."""
    others = without_pivot(languages, pivot)
    return [(pivot, name) for name in others] + [(name, pivot) for name in others]


def with_grid(systems: DataFrame, languages: list[str], pivot: str = PIVOT) -> DataFrame:
    """Each row of ``systems`` once per direction of the grid; row-local."""
    cells = [
        F.struct(F.lit(src).alias("src_lang"), F.lit(tgt).alias("tgt_lang"))
        for src, tgt in pivot_grid(languages, pivot)
    ]
    return systems.select("*", F.explode(F.array(*cells)).alias("_direction")).select(
        *systems.columns, "_direction.src_lang", "_direction.tgt_lang"
    )


def in_all_directions(long: DataFrame, languages: list[str], pivot: str = PIVOT) -> DataFrame:
    """Every (row, lang, text) towards each of its targets: the pivot, or all others for pivot texts."""
    others = F.array(*[F.lit(name) for name in without_pivot(languages, pivot)])
    targets = F.when(F.col("lang") == pivot, others).otherwise(F.array(F.lit(pivot)))
    return long.select("*", F.explode(targets).alias("tgt_lang")).withColumnRenamed("lang", "src_lang")
