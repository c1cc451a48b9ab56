"""Evaluation records, comparisons and leaderboards. All inputs but predictions are one row per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tandem.operators.bleu import STATISTICS, bleu_from_statistics

KEY = ["model", "src_lang", "tgt_lang"]
# The names of a record's metrics.
METRICS = ["bleu_score", "bert_precision", "bert_recall", "bert_f1", "comet_score"]


def rounded(value: Column, places: int = 2) -> Column:
    """Metric as printed: half up, two places."""
    return F.round(value, places)


def segment_means(scores: DataFrame, columns: list[str], keys: list[str] | None = None) -> DataFrame:
    """Mean of each segment score per key, every column averaged on its own."""
    return scores.groupBy(*(keys or KEY)).agg(*[F.avg(c).alias(c) for c in columns])


def evaluation_records(bleu: DataFrame, means: DataFrame | None = None) -> DataFrame:
    """One row per (model, direction): rounded metrics, the learned system score as it is, raw values beside.

    ``means`` has p, r, f1 and score, each already averaged per key; without it they stand in ``bleu``.
    """
    if means is None:
        joined = bleu.withColumnsRenamed({"bleu": "bleu_raw", "p": "p_raw", "r": "r_raw", "f1": "f1_raw",
                                          "score": "comet_score"})
    else:
        joined = bleu.select(*KEY, F.col("bleu").alias("bleu_raw")).join(
            means.select(*KEY, *[F.col(c).alias(f"{c}_raw") for c in ("p", "r", "f1")],
                         F.col("score").alias("comet_score")), KEY)
    return joined.select(
        *KEY,
        rounded(F.col("bleu_raw")).alias("bleu_score"),
        rounded(F.col("p_raw")).alias("bert_precision"),
        rounded(F.col("r_raw")).alias("bert_recall"),
        rounded(F.col("f1_raw")).alias("bert_f1"),
        "comet_score",
        "bleu_raw", "p_raw", "r_raw", "f1_raw",
    )


MEANS = ["p", "r", "f1", "score"]


def records_of_segments(segments: DataFrame) -> DataFrame:
    """Evaluation records rolled up from a table of segments: what :func:`evaluation_records` gives, from one shuffle.

    ``segments`` has model, src_lang, tgt_lang, the counts of :func:`tandem.operators.bleu.segment_statistics`, p, r, f1
    and score. Sums of its rows are all that a record needs, so tables of different lines, systems or runs may be stored
    apart and appended.
    """
    sums = segments.groupBy(*KEY).agg(
        *[F.sum(name).alias(name) for name in STATISTICS], *[F.avg(name).alias(name) for name in MEANS])
    return evaluation_records(bleu_from_statistics(sums, [*KEY, *MEANS]))


def side_by_side(predictions: DataFrame, models: list[str]) -> DataFrame:
    """Outputs of several models for the same line in one row, with a flag whether all agree.

    A model without the line does not agree with those that have it.
    """
    line = ["src_lang", "tgt_lang", "line_no"]
    chosen = predictions.filter(F.col("model").isin(models))
    wide = chosen.repartition(*line).groupBy(*line).pivot("model", models).agg(F.first("text"))
    texts = F.array(*[F.col(name) for name in models])
    return wide.withColumn("same", F.size(F.array_distinct(texts)) == 1)


def against_baseline(records: DataFrame, base: str, metrics: list[str] | None = None) -> DataFrame:
    """Every other model's metrics minus those of ``base`` for the same direction, NULL where base has none."""
    metrics = metrics or METRICS
    baseline = records.filter(F.col("model") == base).select(
        "src_lang", "tgt_lang", *[F.col(m).alias(f"base_{m}") for m in metrics]
    )
    joined = records.filter(F.col("model") != base).join(baseline, ["src_lang", "tgt_lang"], "left")
    return joined.select(
        *KEY, *metrics, *[f"base_{m}" for m in metrics],
        *[(F.col(m) - F.col(f"base_{m}")).alias(f"delta_{m}") for m in metrics],
    )


def leaderboard(records: DataFrame, metrics: list[str] | None = None) -> DataFrame:
    """Long form: one row per (direction, metric, model) with its rank and whether it is a best value.

    All tied best values count as best, but none does where every system ties. ``best_model`` marks the
    model named best for the direction, which follows the first metric.
    """
    metrics = metrics or METRICS
    long = records.unpivot(KEY, metrics, "metric", "value")
    cell = Window.partitionBy("src_lang", "tgt_lang", "metric")
    ranked = long.withColumns({
        "rank": F.rank().over(cell.orderBy(F.desc("value"))),
        "_low": F.min("value").over(cell),
        "_high": F.max("value").over(cell),
    })
    best = (F.col("rank") == 1) & (F.col("_low") < F.col("_high"))
    pair = Window.partitionBy("src_lang", "tgt_lang", "model")
    leads = F.max(F.when(F.col("metric") == metrics[0], F.col("best"))).over(pair)
    return ranked.withColumn("best", best).withColumn("best_model", leads).drop("_low", "_high")


def score_table(records: DataFrame, models: list[str], metric: str = "bleu_score") -> DataFrame:
    """One row per direction, one column per model."""
    return records.groupBy("src_lang", "tgt_lang").pivot("model", models).agg(F.first(metric))
