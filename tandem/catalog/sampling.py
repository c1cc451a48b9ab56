"""Seeded shuffles, splits, samples, completion pairs, distinct prompts, run names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tandem.catalog import tables as t
from tandem.catalog.registry import query
from tandem.functions.languages import mapped
from tandem.functions.prompts import prompt
from tandem.functions.text import is_usable_example
from tandem.operators import sampling
from tandem.sinks.writers import prediction_name, run_stamp


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t.table(spark, sf_dir, "documents").select("doc_id", "lang")


# The completion prompt as SQL.
@query("q14_completion_split", t.with_(t.SQL_LINES, f"""
padded AS (
  SELECT * FROM lines UNION ALL SELECT doc_id, lang, source, -1, ' ' || chr(9) FROM documents
  UNION ALL SELECT doc_id, lang, source, -2, 'x' FROM documents UNION ALL SELECT doc_id, lang, source, -3, 'xy' FROM documents),
usable AS (
  SELECT doc_id, pos, text, length(text) AS n,
         ('0x' || substr(md5('42:' || doc_id || ':' || pos), 1, 15))::BIGINT AS drawn,
         floor(0.3::DOUBLE * length(text))::BIGINT AS low, floor(0.7::DOUBLE * length(text))::BIGINT AS high
  FROM padded WHERE length({t.sql_strip('text')}) > 0 AND length(text) > 1),
cut AS (
  SELECT doc_id, pos, text, greatest(least(low + drawn % greatest(high - low, 1), n - 1), 1) AS point FROM usable)
""") + """
SELECT doc_id, pos, '<|im_start|> user' || chr(10) || '        Complete the following text: ' || substring(text, 1, point)
       || ' <|im_end|> ' || chr(10) || '        <|im_start|> assistant' || chr(10) || '        '
       || substring(text, point + 1) || ' <|im_end|>' AS prompt
FROM cut
""")
def q14_completion_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    short = F.array(*[
        F.struct(F.lit(pos).cast("bigint").alias("pos"), F.lit(text).alias("text"))
        for pos, text in ((-1, " \t"), (-2, "x"), (-3, "xy"))])
    padding = t.table(spark, sf_dir, "documents").select("doc_id", "lang", "source", F.inline(short))
    usable = t.lines(spark, sf_dir).unionByName(padding).filter(is_usable_example(F.col("text")))
    cut = sampling.completion_pairs(usable, "text", ["doc_id", "pos"])
    return cut.select("doc_id", "pos", prompt("completion").alias("prompt"))


@query("q16_seeded_shuffle", """
SELECT doc_id, row_number() OVER (ORDER BY md5('42:' || doc_id), doc_id) - 1 AS position FROM documents
""")
def q16_seeded_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.shuffled_positions(documents(spark, sf_dir), ["doc_id"]).select("doc_id", "position")


@query("q16_seeded_sample", """
SELECT doc_id, lang FROM documents ORDER BY md5('10:' || doc_id), doc_id LIMIT 20
""")
def q16_seeded_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.sample_rows(documents(spark, sf_dir), ["doc_id"], 20)


@query("q16_hash_split", """
SELECT doc_id, CASE WHEN ('0x' || substr(md5('42:' || doc_id), 1, 15))::BIGINT < 115292150460684704
                    THEN 'test' ELSE 'train' END AS split
FROM documents
""")
def q16_hash_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.with_split(documents(spark, sf_dir), ["doc_id"]).select("doc_id", "split")


@query("q16_exact_split", """
SELECT doc_id, CASE WHEN row_number() OVER (ORDER BY md5('42:' || doc_id), doc_id)
                         <= ceil(0.1 * (SELECT count(*) FROM documents)) THEN 'test' ELSE 'train' END AS split
FROM documents
""")
def q16_exact_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.with_exact_split(documents(spark, sf_dir), ["doc_id"]).select("doc_id", "split")


SQL_NAMES = "CASE lang WHEN 'de' THEN 'German' WHEN 'en' THEN 'English' WHEN 'es' THEN 'Spanish' ELSE 'French' END"


@query("q16_distinct_prompts", f"""
SELECT DISTINCT '<|im_start|> system Translate the given ' || {SQL_NAMES} || ' words to English. <|im_end|> <|im_start|> user '
       || text || ' <|im_end|>' AS prompt
FROM documents
""")
def q16_distinct_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = dict(zip(t.LANGS, t.NAMES))
    asked = t.table(spark, sf_dir, "documents").select(prompt(
        "inference", src_lang=mapped(F.col("lang"), names), tgt_lang=F.lit("English"), src_text=F.col("text")
    ).alias("prompt"))
    return sampling.distinct_texts(asked, "prompt")


@query("q25_run_names", """
SELECT event_id, strftime(ts, '%Y%m%d-%H%M%S') AS compact,
       'results/' || strftime(ts, '%Y-%m-%d_%H-%M-%S') || '/Cantonese_to_Simplified_Chinese.txt' AS path
FROM events
""")
def q25_run_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t.table(spark, sf_dir, "events").select(
        "event_id",
        run_stamp(F.col("ts"), "compact").alias("compact"),
        F.concat(F.lit("results/"), run_stamp(F.col("ts")), F.lit("/"),
                 prediction_name(F.lit("Cantonese"), F.lit("Simplified Chinese"))).alias("path"),
    )
