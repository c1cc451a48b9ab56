"""Pairs, prompts, chat messages, directions, training examples."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tandem.catalog import tables as t
from tandem.catalog.corpora import dictionary_files
from tandem.catalog.registry import query
from tandem.functions.prompts import chat_both_ways, prompt
from tandem.operators.directions import direction_error, split_directions, with_default_sides
from tandem.operators.pairs import both_directions, interleave, ordered_pairs
from tandem.operators.sampling import rows_at, shuffled_positions
from tandem.plans.jobs import dictionary_examples, training_examples

# The prompt templates as SQL, with columns between their parts.
PAIR_TEMPLATES = ["inference", "sft", "sft_one_line", "eval"]
SQL_PROMPTS = {
    "inference": "'<|im_start|> system Translate the given ' || src_lang || ' words to ' || tgt_lang || "
    "'. <|im_end|> <|im_start|> user ' || src_text || ' <|im_end|>'",
    "sft": "'<|im_start|>system' || chr(10) || 'Translate the given ' || src_lang || ' words into ' || tgt_lang || "
    "'.<|im_end|>' || chr(10) || '<|im_start|>user' || chr(10) || src_text || '<|im_end|>' || chr(10) || "
    "'<|im_start|>assistant' || chr(10) || tgt_text || '<|im_end|>' || chr(10)",
    "sft_one_line": "'<|im_start|>system Translate the given ' || src_lang || ' words into ' || tgt_lang || "
    "'. <|im_end|><|im_start|>user ' || src_text || ' <|im_end|><|im_start|>assistant ' || tgt_text || ' <|im_end|>'",
    "eval": "'<|im_start|> system' || chr(10) || '    Translate the given ' || src_lang || ' words to ' || tgt_lang || "
    "'.<|im_end|>' || chr(10) || '    <|im_start|> user' || chr(10) || '    ' || src_text || '<|im_end|>' || chr(10) || "
    "'    <|im_start|> assistant' || chr(10) || '    '",
}


@query("q09_interleave", t.with_(t.SQL_BITEXT) + """
SELECT seg, 0::BIGINT AS pos, src AS text FROM bitext UNION ALL SELECT seg, 1::BIGINT, tgt FROM bitext
""")
def q09_interleave(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = interleave(t.bitext(spark, sf_dir), ["src", "tgt"], ["seg"])
    return rows.withColumn("pos", F.col("pos").cast("bigint"))


@query("q10_ordered_pairs", t.with_(t.SQL_WIDE, t.SQL_CELLS, t.SQL_PAIRS) + """
SELECT row_id, src_lang, tgt_lang, src_text, tgt_text FROM pairs
""")
def q10_ordered_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ordered_pairs(t.wide(spark, sf_dir), t.LANGS, ["row_id"])


@query("q10_both_directions", t.with_(t.SQL_WIDE) + """
SELECT row_id, 'de' AS src_lang, 'en' AS tgt_lang, de AS src_text, en AS tgt_text FROM wide
WHERE de IS NOT NULL OR en IS NOT NULL
UNION ALL SELECT row_id, 'en', 'de', en, de FROM wide WHERE de IS NOT NULL OR en IS NOT NULL
""")
def q10_both_directions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return both_directions(t.wide(spark, sf_dir, ["de", "en"]), "de", "en", ["row_id"])


@query("q11_sft_prompts", t.with_(t.SQL_WIDE, t.SQL_CELLS, t.SQL_PAIRS) + " UNION ALL ".join(
    f"SELECT row_id, src_lang, tgt_lang, '{name}' AS template, {SQL_PROMPTS[name]} AS prompt FROM pairs"
    for name in PAIR_TEMPLATES
))
def q11_sft_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = ordered_pairs(t.wide(spark, sf_dir), t.LANGS, ["row_id"])
    texts = [F.struct(F.lit(name).alias("template"), prompt(name).alias("prompt")) for name in PAIR_TEMPLATES]
    return pairs.select("row_id", "src_lang", "tgt_lang", F.inline(F.array(*texts)))


@query("q11_selected_prompts", f"""
SELECT doc_id, prompt FROM (
  SELECT doc_id, lang AS src_lang, 'English' AS tgt_lang, text AS src_text, {SQL_PROMPTS['inference']} AS prompt
  FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1))
""")
def q11_selected_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen = t.table(spark, sf_dir, "labels").filter("quality = 1")
    rows = rows_at(t.table(spark, sf_dir, "documents"), chosen, "doc_id")
    asked = prompt("inference", src_lang=F.col("lang"), tgt_lang=F.lit("English"), src_text=F.col("text"))
    return rows.select("doc_id", asked.alias("prompt"))


SQL_SYSTEM = "'Translate the given {} words to {}.'"


@query("q12_chat_messages", t.with_(t.SQL_BITEXT) + " UNION ALL ".join(
    f"SELECT seg, {number}::BIGINT AS conversation, {pos}::BIGINT AS pos, '{role}' AS role, {content} AS content FROM bitext"
    for number, (src, tgt, column) in enumerate([("English", "Cantonese", "src"), ("Cantonese", "English", "tgt")])
    for pos, (role, content) in enumerate([("system", SQL_SYSTEM.format(src, tgt)), ("user", column)])
))
def q12_chat_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = chat_both_ways(F.lit("English"), F.lit("Cantonese"), F.col("src"), F.col("tgt"))
    return (
        t.bitext(spark, sf_dir)
        .select("seg", F.posexplode(asked).alias("conversation", "messages"))
        .select("seg", F.col("conversation").cast("bigint").alias("conversation"),
                F.posexplode("messages").alias("pos", "message"))
        .select("seg", "conversation", F.col("pos").cast("bigint").alias("pos"), "message.role", "message.content")
    )


SQL_DIRECTIONS = """
asked AS (
  SELECT doc_id, coalesce(lang, 'en') AS src_lang, coalesce(tgt, 'en') AS tgt_lang
  FROM documents, (VALUES ('de'), ('en'), ('es'), ('fr'), (NULL)) targets(tgt)),
checked AS (
  SELECT doc_id, src_lang, tgt_lang,
         CASE WHEN src_lang <> 'en' AND tgt_lang <> 'en' THEN 'either side must be en'
              WHEN src_lang = 'en' AND tgt_lang = 'en' THEN 'both sides are en' END AS error
  FROM asked)
"""


def asked_directions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document towards each language, and once with the target left out."""
    targets = F.array(*[F.lit(name) for name in t.LANGS], F.lit(None).cast("string"))
    return t.table(spark, sf_dir, "documents").select(
        "doc_id", F.col("lang").alias("src_lang"), F.explode(targets).alias("tgt_lang")
    )


@query("q13_direction_check", t.with_(SQL_DIRECTIONS) + """
SELECT src_lang, tgt_lang, error, count(*) AS asked FROM checked GROUP BY src_lang, tgt_lang, error
""")
def q13_direction_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = with_default_sides(asked_directions(spark, sf_dir), "en").withColumn(
        "error", direction_error(F.col("src_lang"), F.col("tgt_lang"), "en")
    )
    return checked.groupBy("src_lang", "tgt_lang", "error").agg(F.count("*").alias("asked"))


@query("q13_accepted_directions", t.with_(SQL_DIRECTIONS) + """
SELECT doc_id, src_lang, tgt_lang FROM checked WHERE error IS NULL
""")
def q13_accepted_directions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_directions(asked_directions(spark, sf_dir), "en")[0]


SQL_EXAMPLES = (t.SQL_WIDE, """
keyed AS (
  SELECT en, fr, CAST(NULL AS VARCHAR) AS de, CAST(NULL AS VARCHAR) AS es FROM wide
  UNION ALL SELECT en, NULL, de, es FROM wide),
listed AS (
  SELECT 'de' AS lang, de AS text, en, fr, de, es FROM keyed UNION ALL SELECT 'en', en, en, fr, de, es FROM keyed
  UNION ALL SELECT 'es', es, en, fr, de, es FROM keyed UNION ALL SELECT 'fr', fr, en, fr, de, es FROM keyed),
pairs AS (
  SELECT s.lang AS src_lang, o.lang AS tgt_lang, s.text AS src_text,
         CASE o.lang WHEN 'de' THEN s.de WHEN 'en' THEN s.en WHEN 'es' THEN s.es ELSE s.fr END AS tgt_text
  FROM listed s, (VALUES ('de'), ('en'), ('es'), ('fr')) o(lang) WHERE s.lang <> o.lang AND s.text IS NOT NULL)""")


@query("q30_training_examples", t.with_(*SQL_EXAMPLES) + f"""
SELECT src_lang, tgt_lang, {SQL_PROMPTS['sft']} AS prompt FROM pairs WHERE tgt_text IS NOT NULL
""")
def q30_training_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = dictionary_examples(spark, dictionary_files(spark, sf_dir), multi_line=True)
    return found.select("src_lang", "tgt_lang", "prompt")


@query("q30_shuffled_positions", t.with_(t.SQL_WIDE) + """
SELECT row_id, row_number() OVER (ORDER BY md5('42:' || row_id), row_id) - 1 AS position FROM wide
""")
def q30_shuffled_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The place of each wide row in the order that its training examples are dealt out in."""
    return shuffled_positions(t.wide(spark, sf_dir), ["row_id"]).select("row_id", "position")


@query("q30_own_format", t.with_(t.SQL_WIDE, t.SQL_CELLS, t.SQL_PAIRS) + """
SELECT row_id, src_lang || '>' || tgt_lang || ': ' || src_text || chr(10) || tgt_text AS prompt FROM pairs
""")
def q30_own_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    def own(pairs: DataFrame) -> DataFrame:
        return pairs.select("row_id", F.concat(
            "src_lang", F.lit(">"), "tgt_lang", F.lit(": "), "src_text", F.lit("\n"), "tgt_text").alias("prompt"))

    return training_examples(t.wide(spark, sf_dir), ["row_id"], t.LANGS, own)
