"""Lines, profiles, chunks, aligned files, dictionaries, character inventory."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tandem.catalog import tables as t
from tandem.catalog.registry import query
from tandem.functions.text import chunks, eval_tokens, is_filled
from tandem.operators import profile
from tandem.operators.indexing import first_of_groups, first_rows, number_rows
from tandem.operators.pairs import language_column, to_long, zip_columns
from tandem.plans.jobs import monolingual_corpus
from tandem.session import scratch_path, stage
from tandem.sinks.writers import export_truth, write_lines
from tandem.sources.evaluation import read_truth
from tandem.sources.lines import LineIndex, clean_lines, numbered_lines, scan_lines
from tandem.sources.parallel import load_aligned, load_dictionaries, load_dictionary_manifest


def raw_files(spark: SparkSession, sf_dir: str) -> str:
    """A folder with one text file per document source."""
    path = scratch_path(spark, "raw")
    write_lines(t.raw_lines(spark, sf_dir), path, F.concat("source", F.lit(".txt")), ["doc_id", "pos"])
    return path


SQL_NUMBERED = """
numbered AS (
  SELECT source || '.txt' AS name,
         row_number() OVER (PARTITION BY source ORDER BY doc_id, pos) - 1 AS line_no, text
  FROM raw_lines)
"""


@query("q01_clean_lines", t.with_(t.SQL_RAW_LINES) + f"""
SELECT source || '.txt' AS name, {t.sql_strip('text')} AS text FROM raw_lines
WHERE length({t.sql_strip('text')}) > 0
""")
def q01_clean_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_lines(scan_lines(spark, raw_files(spark, sf_dir))).select("name", "text")


@query("q01_raw_lines", t.with_(t.SQL_RAW_LINES, SQL_NUMBERED) + "SELECT name, line_no, text FROM numbered")
def q01_raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return numbered_lines(spark, raw_files(spark, sf_dir), stripped=False)


@query("q02_corpus_profile", """
WITH corpus AS (
  SELECT 'documents' AS source, text FROM documents UNION ALL SELECT 'conversations', text FROM conversations)
SELECT source, count(*) AS rows, sum(length(text))::BIGINT AS chars, max(length(text))::BIGINT AS longest,
       round(avg(length(text)), 6) AS mean_length, grouping(source) = 1 AS is_total
FROM corpus GROUP BY ROLLUP (source)
""")
def q02_corpus_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    corpora = {name: t.table(spark, sf_dir, name).select("text") for name in ("documents", "conversations")}
    found = profile.corpus_profile(profile.union_corpora(corpora))
    return found.withColumn("mean_length", F.round("mean_length", 6))


@query("q02_source_profile", """
SELECT source, count(*) AS rows, sum(length(text))::BIGINT AS chars, max(length(text))::BIGINT AS longest,
       round(avg(length(text)), 6) AS mean_length, grouping(source) = 1 AS is_total
FROM documents GROUP BY ROLLUP (source)
""")
def q02_source_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = profile.corpus_profile(t.table(spark, sf_dir, "documents"))
    return found.withColumn("mean_length", F.round("mean_length", 6))


@query("q02_language_profile", t.with_(t.SQL_WIDE, t.SQL_CELLS) + """
SELECT 'documents' AS dataset, lang, count(text) AS filled, coalesce(sum(length(text)), 0)::BIGINT AS chars,
       round(coalesce(sum(length(text)), 0) / count(*), 6) AS chars_per_row, max(length(text))::BIGINT AS longest
FROM cells GROUP BY lang
""")
def q02_language_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = t.wide(spark, sf_dir).withColumn("dataset", F.lit("documents"))
    return profile.language_profile(wide, t.LANGS).withColumn("chars_per_row", F.round("chars_per_row", 6))


SQL_CHUNKS = """
chunked AS (
  SELECT doc_id, source, pos, unnest(range((length(text) + 499) // 500)) AS chunk_no, text FROM lines),
chunks AS (
  SELECT doc_id, source, pos, chunk_no, substring(text, chunk_no * 500 + 1, 500) AS text FROM chunked)
"""


@query("q03_chunk_500", t.with_(t.SQL_LINES, SQL_CHUNKS) + "SELECT doc_id, pos, chunk_no, text FROM chunks")
def q03_chunk_500(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = t.lines(spark, sf_dir).filter(is_filled(F.col("text")))
    return lines.select("doc_id", "pos", F.posexplode(chunks(F.col("text"))).alias("chunk_no", "text")).withColumn(
        "chunk_no", F.col("chunk_no").cast("bigint")
    )


@query("q04_wrap_markers", t.with_(t.SQL_LINES, SQL_CHUNKS) + """
SELECT source || '.txt' AS name, chunk_no, '<|startoftext|>' || text || '<|endoftext|>' AS text FROM chunks
""")
def q04_wrap_markers(spark: SparkSession, sf_dir: str) -> DataFrame:
    corpus = monolingual_corpus(spark, [raw_files(spark, sf_dir)], markers=True)
    return corpus.select("name", F.col("chunk_no").cast("bigint").alias("chunk_no"), "text")


def aligned_files(spark: SparkSession, sf_dir: str) -> str:
    """Line-aligned files per language: even documents in dev, odd ones in devtest, one line each."""
    path = scratch_path(spark, "aligned")
    code = F.create_map(*[F.lit(x) for pair in t.CODE_OF.items() for x in pair])[F.col("lang")]
    split = F.when(F.col("doc_id") % 2 == 0, "dev").otherwise("devtest")
    documents = t.table(spark, sf_dir, "documents").withColumn("text", t.with_returns(F.col("text")))
    notes = documents.withColumns({"split": F.lit("notes"), "text": F.lit("no line of a split")})
    files = documents.withColumn("split", split).unionByName(notes)  # the notes belong to no split
    write_lines(files, path, F.concat("split", F.lit("."), code), ["doc_id"])
    return path


SQL_ALIGNED = f"""
ordered AS (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY doc_id % 2, doc_id) - 1 AS line_no,
         {t.sql_strip("replace(text, chr(10), ' ')")} AS text
  FROM documents),
aligned AS (
  SELECT line_no, max(text) FILTER (lang = 'de') AS "German", max(text) FILTER (lang = 'en') AS "English",
         max(text) FILTER (lang = 'es') AS "Spanish", max(text) FILTER (lang = 'fr') AS "French"
  FROM ordered GROUP BY line_no)
"""


@query("q05_aligned_load", t.with_(SQL_ALIGNED) + 'SELECT line_no, "German", "English", "Spanish", "French" FROM aligned')
def q05_aligned_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_aligned(spark, aligned_files(spark, sf_dir), t.CODES)


@query("q06_truth_export", t.with_(SQL_ALIGNED) + """
SELECT lang, line_no, text FROM (
  SELECT 'German' AS lang, line_no, coalesce("German", '') AS text FROM aligned
  UNION ALL SELECT 'English', line_no, coalesce("English", '') FROM aligned
  UNION ALL SELECT 'Spanish', line_no, coalesce("Spanish", '') FROM aligned
  UNION ALL SELECT 'French', line_no, coalesce("French", '') FROM aligned)
""")
def q06_truth_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "truth")
    export_truth(to_long(load_aligned(spark, aligned_files(spark, sf_dir), t.CODES), t.NAMES, ["line_no"]), path)
    return read_truth(spark, path)


def dictionary_files(spark: SparkSession, sf_dir: str) -> list[str]:
    """Two CSV dictionaries whose columns overlap; the part files of the second have two orders of columns."""
    wide = stage(t.wide(spark, sf_dir), "wide")
    paths = [scratch_path(spark, "dictionary") for _ in range(2)]
    parts = [(paths[0], ["en", "fr"], wide), (paths[1], ["en", "de", "es"], wide.filter("length(en) > 1000")),
             (paths[1], ["es", "en", "de"], wide.filter("NOT coalesce(length(en) > 1000, false)"))]
    for path, columns, rows in parts:
        (rows.select(*columns).write.mode("append").option("escape", '"').option("ignoreLeadingWhiteSpace", False)
         .option("ignoreTrailingWhiteSpace", False).csv(path, header=True))
    return paths


SQL_DICTIONARIES = """
merged AS (
  SELECT en, fr, CAST(NULL AS VARCHAR) AS de, CAST(NULL AS VARCHAR) AS es FROM wide
  UNION ALL SELECT en, NULL, de, es FROM wide)
"""


@query("q07_schema_union", t.with_(t.SQL_WIDE, SQL_DICTIONARIES) + "SELECT en, fr, de, es FROM merged")
def q07_schema_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_dictionaries(spark, dictionary_files(spark, sf_dir), multi_line=True)


@query("q07_manifest", t.with_(t.SQL_WIDE, SQL_DICTIONARIES) + "SELECT en, fr, de, es FROM merged")
def q07_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = scratch_path(spark, "manifest")
    listed = spark.createDataFrame([(f"  {path}\n",) for path in dictionary_files(spark, sf_dir)], "value string")
    listed.coalesce(1).write.text(manifest)
    return load_dictionary_manifest(spark, manifest, multi_line=True)


@query("q08_row_slice", t.with_(t.SQL_RAW_LINES, SQL_NUMBERED) + f"""
SELECT name, line_no, {t.sql_strip('text')} AS text FROM numbered WHERE line_no >= 100 AND line_no < 400
""")
def q08_row_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return LineIndex(spark, raw_files(spark, sf_dir)).lines(100, 400)


@query("q08_first_rows", t.with_(t.SQL_WIDE) + "SELECT row_id, de AS text FROM wide WHERE row_id < 50")
def q08_first_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = t.table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    wide = zip_columns(first_of_groups(documents, ["doc_id"], ["lang"], 50), t.LANGS, key="row_id")
    return first_rows(language_column(wide, "de", ["row_id"]), 50, index="row_id")


@query("q08_row_index", "SELECT doc_id, row_number() OVER (ORDER BY lang, doc_id) - 1 AS row_id FROM documents")
def q08_row_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = t.table(spark, sf_dir, "documents").select("doc_id", "lang")
    return number_rows(documents, ["lang", "doc_id"]).select("doc_id", "row_id")


@query("q17_eval_tokens", t.with_(t.SQL_BITEXT) + f"""
SELECT token, count(*) AS uses FROM (
  SELECT unnest({t.sql_tokens('src')}) AS token FROM bitext UNION ALL SELECT unnest({t.sql_tokens('tgt')}) FROM bitext)
GROUP BY token
""")
def q17_eval_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    sides = t.bitext(spark, sf_dir).select(F.explode(F.array("src", "tgt")).alias("text"))
    tokens = sides.select(F.explode(eval_tokens(F.col("text"))).alias("token"))
    return tokens.groupBy("token").agg(F.count("*").alias("uses"))


@query("q19_new_characters", """
WITH chars AS (
  SELECT unnest(list_distinct(string_split(text, ''))) AS ch FROM documents),
known AS (SELECT DISTINCT unnest(string_split(text, '')) AS ch FROM benchmark)
SELECT ch, count(*) AS texts FROM chars WHERE ch NOT IN (SELECT ch FROM known) GROUP BY ch
""")
def q19_new_characters(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = t.table(spark, sf_dir, "benchmark")
    vocabulary = benchmark.select(F.explode(F.split("text", "")).alias("token"))
    return profile.new_characters(t.table(spark, sf_dir, "documents"), vocabulary)


@query("q19_character_vocabulary", """
SELECT ch, count(*) AS texts FROM (SELECT unnest(list_distinct(string_split(text, ''))) AS ch FROM documents) GROUP BY ch
""")
def q19_character_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.character_counts(t.table(spark, sf_dir, "documents"))
