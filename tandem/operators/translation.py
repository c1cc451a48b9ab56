"""Batch translation of texts by a caller's model."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tandem.functions.languages import PIVOT
from tandem.functions.prompts import chat
from tandem.operators.directions import direction, valid_directions
from tandem.operators.scoring import BatchFunction, score_batches

INPUTS = ["src_lang", "tgt_lang", "text", "messages"]


def towards(df: DataFrame, lang: str, from_pivot: bool, pivot: str = PIVOT) -> DataFrame:
    """Give every text the same direction: out of the pivot into ``lang``, or the other way."""
    if lang == pivot:
        raise ValueError(f"both sides are {pivot}")
    chosen = direction(F.lit(lang), F.lit(from_pivot), pivot)
    return df.withColumn("src_lang", chosen["src_lang"]).withColumn("tgt_lang", chosen["tgt_lang"])


def translate(
    df: DataFrame, make_scorer: Callable[[], BatchFunction], batch_size: int = 2, pivot: str = PIVOT,
    partitions: int | None = None, spread_by: list[str] | None = None,
) -> DataFrame:
    """Add chat ``messages`` and the model's ``result`` to rows with src_lang, tgt_lang and text.

    A side left NULL is the pivot; a row without exactly one pivot side fails the job. The scorer sees
    ``src_lang, tgt_lang, text, messages`` and returns ``result``.
    """
    asked = valid_directions(df, pivot).withColumn(
        "messages", chat(F.col("src_lang"), F.col("tgt_lang"), F.col("text"))
    )
    return score_batches(asked, make_scorer, INPUTS, "result string", batch_size, partitions, spread_by)
