"""Corpus BLEU from counts per segment.

Clipped n-gram matches of a segment need nothing but that segment, so they are counted where its row is, many
segments at once and without a shuffle. Only sums per key are aggregated.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tandem.functions.text import eval_tokens
from tandem.operators.scoring import pieces

MAX_ORDER = 4
CORRECT = [f"correct_{n}" for n in range(1, MAX_ORDER + 1)]
STATISTICS = ["sys_len", "ref_len", *CORRECT, *[f"total_{n}" for n in range(1, MAX_ORDER + 1)]]


def clipped_matches(hyp: pa.Array, ref: pa.Array) -> list[pa.Array]:
    """Clipped n-gram matches of two columns of token lists, row by row, for orders 1 to 4; NULL where a side is NULL.

    A gram is numbered by the gram before its last token and that token, a token by its row and its text, so equal
    numbers are equal grams of one row. Grams that one side lacks are left out of the next order, which they cannot match.
    """
    rows = len(hyp)
    lengths = np.concatenate([pc.fill_null(pc.list_value_length(side), 0).to_numpy(zero_copy_only=False) for side in (hyp, ref)])
    texts = pa.concat_arrays([hyp.flatten(), ref.flatten()]).dictionary_encode()
    tokens = texts.indices.to_numpy().astype(np.int64)
    row = np.repeat(np.tile(np.arange(rows), 2), lengths)
    following = np.repeat(np.cumsum(lengths), lengths) - np.arange(len(tokens))
    of_ref = np.arange(len(tokens)) >= lengths[:rows].sum()
    starts, before, found = np.arange(len(tokens)), row, []
    for order in range(MAX_ORDER):
        grams, distinct = pd.factorize(before * len(texts.dictionary) + tokens[starts + order])
        in_ref = of_ref[starts]
        clipped = np.minimum(np.bincount(grams[in_ref], minlength=len(distinct)),
                             np.bincount(grams[~in_ref], minlength=len(distinct)))
        row_of = np.zeros(len(distinct), np.int64)
        row_of[grams] = row[starts]
        found.append(np.bincount(row_of, weights=clipped, minlength=rows).astype(np.int64))
        longer = (clipped[grams] > 0) & (following[starts] > order + 1)
        starts, before = starts[longer], grams[longer]
    absent = pc.or_(hyp.is_null(), ref.is_null()).to_numpy(zero_copy_only=False)
    return [pa.array(counts, mask=absent) for counts in found]


def _with_matches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches with counts of matches for their last two columns, the token lists; in pieces of bounded bytes."""
    for batch in batches:
        *kept, hyp, ref = batch.schema.names
        for piece in pieces(batch, [hyp, ref], 1):
            matches = clipped_matches(piece[hyp], piece[ref])
            yield pa.RecordBatch.from_arrays([*piece.columns[:-2], *matches], names=[*kept, *CORRECT])


def segment_statistics(df: DataFrame, keys: list[str], hyp: str = "mt", ref: str = "ref",
                       tokenize: str = "zh") -> DataFrame:
    """Per row: token counts of both sides and clipped matches for orders 1 to 4."""
    tokens = df.select(
        *keys, eval_tokens(F.col(hyp), tokenize).alias("_hyp"), eval_tokens(F.col(ref), tokenize).alias("_ref"))
    totals = [
        F.greatest(F.size("_hyp") - (order - 1), F.lit(0)).cast("bigint").alias(f"total_{order}")
        for order in range(1, MAX_ORDER + 1)
    ]
    sized = tokens.select(
        *keys, F.size("_hyp").cast("bigint").alias("sys_len"), F.size("_ref").cast("bigint").alias("ref_len"), *totals,
        "_hyp", "_ref",
    )
    schema = T.StructType([*sized.schema.fields[:-2], *[T.StructField(name, T.LongType()) for name in CORRECT]])
    return sized.mapInArrow(_with_matches, schema).select(*keys, *STATISTICS)


def bleu_from_statistics(sums: DataFrame, keys: list[str]) -> DataFrame:
    """Score, brevity penalty and precisions (exponential smoothing) from summed statistics."""
    orders = range(1, MAX_ORDER + 1)
    correct = [F.col(f"correct_{n}") for n in orders]
    total = [F.col(f"total_{n}") for n in orders]
    any_match = sum(correct[1:], correct[0]) > 0
    reached = [F.lit(True)]
    for count in total:
        reached.append(reached[-1] & (count > 0))
    misses = [F.lit(0)]
    for match in correct:
        misses.append(misses[-1] + (match == 0).cast("int"))
    precision = [
        F.when(any_match & reached[n], F.when(correct[n - 1] == 0, 100 / (F.pow(F.lit(2.0), misses[n]) * total[n - 1]))
               .otherwise(100.0 * correct[n - 1] / total[n - 1])).otherwise(0.0)
        for n in orders
    ]
    penalty = (
        F.when(F.col("sys_len") >= F.col("ref_len"), 1.0)
        .when(F.col("sys_len") == 0, 0.0)
        .otherwise(F.exp(1 - F.col("ref_len") / F.col("sys_len")))
    )
    logs = [F.log(F.get("precision", F.lit(n - 1))) for n in orders]
    complete = F.forall("precision", lambda p: p > 0)
    score = F.when(complete, F.col("bp") * F.exp(sum(logs[1:], logs[0]) / MAX_ORDER)).otherwise(0.0)
    return (
        sums.select(
            *keys, penalty.alias("bp"), "sys_len", "ref_len", F.array(*correct).alias("correct"),
            F.array(*total).alias("total"), F.array(*precision).alias("precision"),
        )
        .withColumn("bleu", score)
        .select(*keys, "bleu", "bp", "sys_len", "ref_len", "correct", "total", "precision")
    )


def corpus_bleu(df: DataFrame, keys: list[str], hyp: str = "mt", ref: str = "ref",
                tokenize: str = "zh") -> DataFrame:
    """One corpus-level score per key, from one pass and a shuffle of one row per key and task."""
    statistics = segment_statistics(df, keys, hyp, ref, tokenize)
    counts = [c for c in statistics.columns if c not in keys]
    sums = statistics.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in counts])
    return bleu_from_statistics(sums, keys)
