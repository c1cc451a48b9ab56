"""From raw documents to a training mix: language, quality, near-duplicates, benchmark passages, weights of sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tandem.llm.decontaminate import decontaminated
from tandem.llm.language import identified, language_parser
from tandem.llm.mixing import mixed
from tandem.llm.near_dups import deduplicated
from tandem.llm.quality import good_documents, quality_weights
from tandem.llm.queries import held_out, table
from tandem.session import Scratch

SHINGLE_WORDS = 5
SIMILARITY_PERCENT = 80


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the learnt languages; null texts and texts without a letter go."""
    return identified(docs, language_parser(docs.filter(~held_out())))


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learnt from ``labels``, finds good."""
    weights = quality_weights(docs, table(spark, sf_dir, "labels").filter(~held_out()))
    return good_documents(docs, weights)


def near_duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the smallest id."""
    return deduplicated(docs, shingle=SHINGLE_WORDS, percent=SIMILARITY_PERCENT)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of ``benchmark``; what consists of them alone goes."""
    return decontaminated(docs, table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents in the mix: doc_id, source, size, source_size, target and taken (words, repeats counted)."""
    return mixed(docs)["documents"].filter("taken > 0").select(
        "doc_id", "source", "size", "source_size", "target", "taken")


STAGES = [
    ("language_id", language_stage),
    ("quality", quality_stage),
    ("near_duplicates", near_duplicates_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
]
# a trained classifier and a learnt parser are not SQL; tests compare with a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stage's rows written as Parquet and read again by the next."""
    scratch = Scratch(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = scratch.stage(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
