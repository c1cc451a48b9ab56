"""The four whole jobs: monolingual corpus, training examples, translation runs, evaluation."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tandem.functions.languages import PIVOT, metric_language
from tandem.functions.prompts import prompt
from tandem.functions.text import CHUNK_LENGTH, file_safe, with_markers
from tandem.operators.alignment import aligned_triples, availability, require_alignment
from tandem.operators.bleu import segment_statistics
from tandem.operators.directions import in_all_directions
from tandem.operators.indexing import first_rows
from tandem.operators.pairs import languages_of, ordered_pairs, to_long
from tandem.operators.report import KEY, MEANS, records_of_segments
from tandem.operators.sampling import shuffled
from tandem.operators.scoring import BatchFunction, score_batches, together
from tandem.operators.translation import towards, translate
from tandem.session import stage
from tandem.sources.lines import load_monolingual, numbered_lines
from tandem.sources.parallel import load_numbered_dictionaries


def monolingual_corpus(
    spark: SparkSession, paths: list[str], length: int = CHUNK_LENGTH, markers: bool = False
) -> DataFrame:
    """Chunks of clean lines, optionally between document markers."""
    corpus = load_monolingual(spark, paths, length)
    return corpus.withColumn("text", with_markers(F.col("text"))) if markers else corpus


def training_examples(
    wide: DataFrame, keys: list[str], languages: list[str] | None = None,
    formatting: str | Callable[[DataFrame], DataFrame] = "sft",
) -> DataFrame:
    """Every ordered language pair of every row as a prompt; row-local from wide table to prompt.

    ``formatting`` is a template name, or the caller's own function from the table of pairs to prompts.
    """
    languages = languages or languages_of(wide, keys)
    pairs = ordered_pairs(wide, languages, keys)
    if callable(formatting):
        return pairs.transform(formatting)
    return pairs.withColumn("prompt", prompt(formatting))


def dictionary_examples(
    spark: SparkSession, paths: list[str], seed: int = 42,
    formatting: str | Callable[[DataFrame], DataFrame] = "sft", *, multi_line: bool,
) -> DataFrame:
    """CSV dictionaries to shuffled training prompts.

    Rows are shuffled by a digest of their place in the dictionaries, so copies of one row are dealt
    out evenly over order and partitions. The range sort of the shuffle reads its input twice, so the rows are stored
    first and their files are cut and parsed once.
    """
    keys = ["source_no", "line_no"]
    wide = stage(load_numbered_dictionaries(spark, paths, multi_line=multi_line), "wide")
    languages = languages_of(wide, keys)
    return training_examples(shuffled(wide, keys, seed), keys, languages, formatting)


def translation_run(
    wide: DataFrame, languages: list[str], make_scorer: Callable[[], BatchFunction], run: str, model: str,
    batch_size: int = 8, sample_size: int | None = None, pivot: str = PIVOT, partitions: int | None = None,
) -> DataFrame:
    """Translate every row between the pivot and each other language, both ways, in one job.

    The result is one prediction row per line and direction; see
    :func:`tandem.operators.translation.translate` for the scorer.
    """
    lines = first_rows(wide, sample_size)
    long = to_long(lines, languages, ["line_no"]).filter(F.col("text").isNotNull())
    asked = in_all_directions(long, languages, pivot)
    scored = translate(asked, make_scorer, batch_size, pivot, partitions, ["src_lang", "tgt_lang", "line_no"])
    return _predictions(scored, run, model)


def translate_file(
    spark: SparkSession, path: str, lang: str, from_pivot: bool, make_scorer: Callable[[], BatchFunction],
    run: str, model: str, batch_size: int = 8, sample_size: int | None = None, pivot: str = PIVOT,
    partitions: int | None = None,
) -> DataFrame:
    """Translate the lines of one file, as they are, in one direction."""
    lines = first_rows(numbered_lines(spark, path, stripped=False), sample_size)
    scored = translate(towards(lines, lang, from_pivot, pivot), make_scorer, batch_size, pivot, partitions, ["line_no"])
    return _predictions(scored, run, model)


def _predictions(scored: DataFrame, run: str, model: str) -> DataFrame:
    return scored.select(
        F.lit(run).alias("run"), F.lit(model).alias("model"), "src_lang", "tgt_lang", "line_no",
        F.col("result").alias("text"),
    )


def segment_table(
    triples: DataFrame, make_match: Callable[[], BatchFunction], make_system: Callable[[], BatchFunction],
    partitions: int | None = None,
) -> DataFrame:
    """Per aligned line its BLEU counts, p, r, f1 and score: all that records need, in one pass over the texts.

    ``triples`` has model, src_lang, tgt_lang, line_no, src, mt and ref. The table has no texts and one row a line; store
    it, append those of other lines or systems, and roll any report up from it with
    :func:`tandem.operators.report.records_of_segments`. Lines are dealt by key over ``partitions`` tasks (default: those
    of any shuffle), since models and BLEU cost far more than that.
    """
    partitions = partitions or int(triples.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    scored = score_batches(
        triples.withColumn("lang", metric_language(F.col("tgt_lang"))), together(make_match, make_system),
        ["src", "mt", "ref", "lang"], "p double, r double, f1 double, score double", batch_size=8, partitions=partitions,
        spread_by=[*KEY, "line_no"])
    return segment_statistics(scored, [*KEY, "line_no", *MEANS])


def evaluate(
    predictions: DataFrame, truth: DataFrame, make_match: Callable[[], BatchFunction],
    make_system: Callable[[], BatchFunction], strict: bool = False, grid: DataFrame | None = None,
    partitions: int | None = None,
) -> DataFrame | tuple[DataFrame, DataFrame]:
    """Evaluation record of every (model, direction): BLEU, match means, learned system score.

    The matching scorer returns p, r and f1 and sees which metric language applies in ``lang``; the
    system scorer returns score. Lines without a partner drop out, unless ``strict`` makes them an error.
    BLEU and both scorers see the aligned lines in one pass, dealt out as :func:`segment_table` does. With a ``grid`` of requested (model, src_lang, tgt_lang) the result is a pair:
    the records of its cells, and the cells that have no predictions.
    """
    if grid is not None:
        asked = grid.withColumns({side: file_safe(F.col(side)) for side in ("src_lang", "tgt_lang")})
        cells = stage(availability(asked, predictions.withColumns({
            side: file_safe(F.col(side)) for side in ("src_lang", "tgt_lang")})), "cells")
        wanted = cells.filter("available").drop("available")
        chosen = predictions.withColumns({side: file_safe(F.col(side)) for side in ("src_lang", "tgt_lang")}).join(
            wanted, KEY, "left_semi")
        return (evaluate(chosen, truth, make_match, make_system, strict, partitions=partitions),
                cells.filter("NOT available").drop("available"))
    if strict:
        require_alignment(predictions, truth)
    safe = {side: file_safe(F.col(side)) for side in ("src_lang", "tgt_lang")}
    triples = aligned_triples(
        predictions.withColumns(safe), truth.withColumn("lang", file_safe(F.col("lang")))
    )
    return records_of_segments(segment_table(triples, make_match, make_system, partitions))
