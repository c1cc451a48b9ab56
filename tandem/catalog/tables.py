"""Tables that several queries start from, in Spark and as common table expressions in SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tandem.functions.text import CJK_RANGES, DIGIT_RULES, WHITESPACE
from tandem.operators.indexing import number_rows
from tandem.operators.pairs import zip_columns

LANGS = ["de", "en", "es", "fr"]
CODES = {"deu_Latn": "German", "eng_Latn": "English", "spa_Latn": "Spanish", "fra_Latn": "French"}
CODE_OF = {"de": "deu_Latn", "en": "eng_Latn", "es": "spa_Latn", "fr": "fra_Latn"}
NAMES = list(CODES.values())
MODELS = ["identity", "copy", "sparse"]
DIRECTIONS = [("Cantonese", "English"), ("English", "Cantonese")]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Rows dealt over all tasks by key, ahead of column work that costs far more than their shuffle."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line of every document: doc_id, lang, source, pos, text."""
    documents = spread(table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "text"), "doc_id")
    return documents.select(
        "doc_id", "lang", "source", F.posexplode(F.split("text", "\n")).alias("pos", "text")
    ).withColumn("pos", F.col("pos").cast("bigint"))


def raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines with white space around them and a blank line after each document."""
    padded = F.concat(F.lit(" \t"), F.col("text"), F.lit("　 "))
    return spread(table(spark, sf_dir, "documents").select("doc_id", "source", "text"), "doc_id").select(
        "doc_id", "source", F.posexplode(F.split(F.concat("text", F.lit("\n")), "\n")).alias("pos", "text")
    ).withColumn("text", padded)


def bitext(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User turns with the assistant turn that answers them: seg, src, tgt."""
    turns = table(spark, sf_dir, "conversations")
    user = turns.filter("role = 'user'").select("conv_id", "turn", F.col("text").alias("src"))
    answer = turns.filter("role = 'assistant'").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("tgt")
    )
    return user.join(answer, ["conv_id", "turn"]).select(
        (F.col("conv_id") * 100 + F.col("turn")).alias("seg"), "src", "tgt"
    )


def wide(spark: SparkSession, sf_dir: str, languages: list[str] = LANGS) -> DataFrame:
    """Documents of the languages side by side by their ordinal: row_id, de, en, es, fr."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    if languages != LANGS:
        documents = documents.filter(F.col("lang").isin(languages))
    return zip_columns(number_rows(documents, ["doc_id"], ["lang"]), languages, key="row_id")


def systems_of(pairs: DataFrame, line: str) -> DataFrame:
    """Three made-up systems in both directions: model, src_lang, tgt_lang, line_no, src, mt, ref."""
    (left, right), _ = DIRECTIONS
    sides = F.array(
        F.struct(F.lit(left).alias("src_lang"), F.lit(right).alias("tgt_lang"),
                 F.col("src").alias("src"), F.col("tgt").alias("ref")),
        F.struct(F.lit(right).alias("src_lang"), F.lit(left).alias("tgt_lang"),
                 F.col("tgt").alias("src"), F.col("src").alias("ref")),
    )
    both = pairs.select(F.col(line).alias("line_no"), F.explode(sides).alias("_s")).select("line_no", "_s.*")
    outputs = F.array(
        F.struct(F.lit("identity").alias("model"), F.col("ref").alias("mt")),
        F.struct(F.lit("copy").alias("model"), F.col("src").alias("mt")),
        F.struct(F.lit("sparse").alias("model"), F.array_join(
            F.filter(F.split("ref", " "), lambda word, i: i % 3 != 2), " ").alias("mt")),
    )
    return both.select("*", F.explode(outputs).alias("_o")).select(
        "_o.model", "src_lang", "tgt_lang", "line_no", "src", "_o.mt", "ref"
    )


def systems(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The systems over all of ``bitext``."""
    return systems_of(spread(bitext(spark, sf_dir), "seg"), "seg")


def with_returns(text: Column) -> Column:
    """The text with carriage returns for some blanks and breaks, which a text file must not keep."""
    return F.replace(F.replace(text, F.lit("\n"), F.lit("\r\n")), F.lit(". "), F.lit(".\r"))


def with_(*parts: str) -> str:
    return "WITH " + ",\n".join(part.strip() for part in parts) + "\n"


SQL_LINES = """
lines AS (
  SELECT doc_id, lang, source, unnest(range(len(parts))) AS pos, unnest(parts) AS text
  FROM (SELECT doc_id, lang, source, string_split(text, chr(10)) AS parts FROM documents))
"""
SQL_RAW_LINES = """
raw_lines AS (
  SELECT doc_id, source, pos, ' ' || chr(9) || line || chr(12288) || ' ' AS text
  FROM (SELECT doc_id, source, unnest(range(len(parts))) AS pos, unnest(parts) AS line
        FROM (SELECT doc_id, source, string_split(text || chr(10), chr(10)) AS parts FROM documents)))
"""
SQL_BITEXT = """
bitext AS (
  SELECT u.conv_id * 100 + u.turn AS seg, u.text AS src, a.text AS tgt
  FROM conversations u JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1
  WHERE u.role = 'user' AND a.role = 'assistant')
"""
SQL_WIDE = """
wide AS (
  SELECT row_id, max(text) FILTER (lang = 'de') AS de, max(text) FILTER (lang = 'en') AS en,
         max(text) FILTER (lang = 'es') AS es, max(text) FILTER (lang = 'fr') AS fr
  FROM (SELECT lang, text, row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS row_id FROM documents)
  GROUP BY row_id)
"""
SQL_CELLS = """
cells AS (
  SELECT row_id, 'de' AS lang, de AS text FROM wide UNION ALL SELECT row_id, 'en', en FROM wide
  UNION ALL SELECT row_id, 'es', es FROM wide UNION ALL SELECT row_id, 'fr', fr FROM wide)
"""
SQL_PAIRS = """
pairs AS (
  SELECT s.row_id, s.lang AS src_lang, t.lang AS tgt_lang, s.text AS src_text, t.text AS tgt_text
  FROM cells s JOIN cells t ON s.row_id = t.row_id AND s.lang <> t.lang
  WHERE s.text IS NOT NULL AND t.text IS NOT NULL)
"""


def sql_systems(line: str = "seg") -> str:
    """The systems, with ``line`` (an expression over bitext) as line number."""
    return f"""
both_ways AS (
  SELECT {line} AS line_no, 'Cantonese' AS src_lang, 'English' AS tgt_lang, src, tgt AS ref FROM bitext
  UNION ALL SELECT {line}, 'English', 'Cantonese', tgt, src FROM bitext),
systems AS (
  SELECT model, src_lang, tgt_lang, line_no, src,
         CASE model WHEN 'identity' THEN ref WHEN 'copy' THEN src
           ELSE array_to_string(list_filter(string_split(ref, ' '), lambda word, i: i % 3 <> 0), ' ') END AS mt, ref
  FROM both_ways, (VALUES ('identity'), ('copy'), ('sparse')) m(model))
"""


SQL_PUNCTUATION = r"([\{-\~\[-\` -\&\(-\+\:-\@\/])"
SQL_LINE_NO = "row_number() OVER (ORDER BY seg) - 1"


def sql_strip(column: str) -> str:
    return f"regexp_replace({column}, '^{WHITESPACE}+|{WHITESPACE}+$', '', 'g')"


def sql_tokens(column: str) -> str:
    """The evaluation tokenizer as a DuckDB expression."""
    text = f"regexp_replace({sql_strip(column)}, '([{CJK_RANGES}])', ' \\1 ', 'g')"
    for pattern, replacement in ((SQL_PUNCTUATION, " $1 "), *DIGIT_RULES):
        text = f"regexp_replace({text}, '{pattern}', '{replacement.replace('$', chr(92))}', 'g')"
    return f"list_filter(string_split_regex({text}, '{WHITESPACE}+'), lambda t: t <> '')"
