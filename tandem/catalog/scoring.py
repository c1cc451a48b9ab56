"""Batch scoring with stand-in models, token budgets, predictions, streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tandem.catalog import tables as t
from tandem.catalog.corpora import SQL_ALIGNED, SQL_NUMBERED, aligned_files, raw_files
from tandem.catalog.registry import query
from tandem.functions import text as tx
from tandem.operators.indexing import batch_number, number_rows
from tandem.operators.matching import greedy_match
from tandem.operators.report import segment_means
from tandem.operators.scoring import score_batches, tokenize_columns
from tandem.operators.translation import towards, translate
from tandem.plans.jobs import translate_file, translation_run
from tandem.session import scratch_path
from tandem.sinks.store import PredictionStore
from tandem.sinks.writers import write_lines, write_predictions
from tandem.sources.parallel import load_aligned
from tandem.streaming.incoming import incoming_lines, numbered_scores, start_numbered_scoring, start_scoring


def reversing_scorer():
    """Stand-in model: the text backwards."""
    return lambda batch: {"result": [text[::-1] for text in batch["text"]]}


def labelled_scorer():
    """Stand-in model: the target language, then the text of the user message backwards."""
    return lambda batch: {"result": [
        f"{lang}:\n{messages[1]['content'][::-1]}" for lang, messages in zip(batch["tgt_lang"], batch["messages"])
    ]}


def code_point_tokenizer():
    """Stand-in tokenizer: one id per character."""
    return lambda texts: [[ord(ch) for ch in text] for text in texts]


@query("q15_truncate_and_slice", t.with_(t.SQL_BITEXT, """
ids AS (
  SELECT seg, list_transform(string_split(src, ''), lambda c: unicode(c)) AS prompt,
         list_transform(string_split(tgt, ''), lambda c: unicode(c)) AS answer FROM bitext)""") + """
SELECT seg, (len(prompt) + len(answer))::BIGINT AS tokens, len(prompt) + len(answer) > 512 AS truncated,
       array_to_string((prompt || answer)[1:512], ' ') AS kept,
       array_to_string(list_filter(answer, lambda i: i <> 10), ' ') AS response
FROM ids
""")
def q15_truncate_and_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = t.bitext(spark, sf_dir)
    both = tokenize_columns(turns, code_point_tokenizer, {"src": "prompt_ids", "tgt": "answer_ids"}).withColumn(
        "output_ids", F.concat("prompt_ids", "answer_ids")
    )
    return both.select(
        "seg",
        F.size("output_ids").cast("bigint").alias("tokens"),
        tx.exceeds_budget(F.col("output_ids")).alias("truncated"),
        F.array_join(tx.budgeted(F.col("output_ids")), " ").alias("kept"),
        F.array_join(tx.response_ids(F.col("output_ids"), F.size("prompt_ids"), special=[10]), " ").alias("response"),
    )


@query("q24_write_predictions", t.with_(t.SQL_BITEXT, t.sql_systems()) + """
SELECT 'run-1' AS run, model, src_lang, tgt_lang, line_no, replace(mt, chr(10), ' ') AS text FROM systems
""")
def q24_write_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "predictions")
    predictions = t.systems(spark, sf_dir).select(
        F.lit("run-1").alias("run"), "model", "src_lang", "tgt_lang", "line_no", F.col("mt").alias("text")
    )
    write_predictions(predictions.withColumn("text", F.lit("an earlier run")), path)
    write_predictions(predictions.filter("model = 'copy'"), path)  # a run written again replaces its own lines alone
    write_predictions(predictions.filter("model <> 'copy'"), path)
    return spark.read.schema(predictions.schema).parquet(path)


@query("q24_prediction_store", t.with_(t.SQL_BITEXT, t.sql_systems()) + """
SELECT 'run-1' AS run, model, src_lang, tgt_lang, line_no,
       CASE WHEN model = 'sparse' THEN 'an earlier run' ELSE replace(mt, chr(10), ' ') END AS text
FROM systems
""")
def q24_prediction_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two of the three systems are written again; a write that is never committed is not seen."""
    store = PredictionStore(spark, scratch_path(spark, "store"))
    predictions = t.systems(spark, sf_dir).select(
        F.lit("run-1").alias("run"), "model", "src_lang", "tgt_lang", "line_no", F.col("mt").alias("text"))
    earlier = predictions.withColumn("text", F.lit("an earlier run"))
    store.write(earlier)
    store.write(predictions.filter("model <> 'sparse'"))
    store.stage(predictions.filter("model = 'sparse'"))
    return store.read()


@query("q28_batch_score", t.with_(t.SQL_BITEXT) + f"""
SELECT seg, floor(({t.SQL_LINE_NO}) / 8)::BIGINT AS batch, reverse(src) AS src_result, reverse(tgt) AS tgt_result FROM bitext
""")
def q28_batch_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    def both_sides():
        return lambda batch: {f"{side}_result": [text[::-1] for text in batch[side]] for side in ("src", "tgt")}

    numbered = number_rows(t.bitext(spark, sf_dir), ["seg"])
    scored = score_batches(numbered, both_sides, ["src", "tgt"], "src_result string, tgt_result string", batch_size=8)
    return scored.select("seg", batch_number(F.col("row_id"), 8).alias("batch"), "src_result", "tgt_result")


SQL_MATCH = ("""
tokens AS (
  SELECT vec_id // 16 AS seg, CASE WHEN vec_id % 2 = 0 OR vec_id // 16 % 7 = 3 THEN 0 ELSE 1 END AS side, vec_id,
         embedding::DOUBLE[] AS vec FROM embeddings),
met AS (
  SELECT m.seg, m.vec_id AS mt, r.vec_id AS ref, list_cosine_similarity(m.vec, r.vec) AS cosine
  FROM tokens m JOIN tokens r ON m.seg = r.seg AND m.side = 0 AND r.side = 1)
""", """
precise AS (SELECT seg, avg(best) AS p FROM (SELECT seg, mt, max(cosine) AS best FROM met GROUP BY seg, mt) GROUP BY seg),
recalled AS (SELECT seg, avg(best) AS r FROM (SELECT seg, ref, max(cosine) AS best FROM met GROUP BY seg, ref) GROUP BY seg),
matched AS (
  SELECT seg, coalesce(p, 0) AS p, coalesce(r, 0) AS r, coalesce(2 * p * r / (p + r), 0) AS f1
  FROM (SELECT DISTINCT seg FROM tokens) LEFT JOIN precise USING (seg) LEFT JOIN recalled USING (seg))
""")


def embedding_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors as tokens of segments; some segments have tokens on one side only."""
    return greedy_match(t.table(spark, sf_dir, "embeddings").select(
        F.floor(F.col("vec_id") / 16).alias("seg"),
        F.when(F.expr("vec_id % 2 = 0 OR vec_id div 16 % 7 = 3"), "mt").otherwise("ref").alias("side"),
        (F.col("vec_id") % 16).alias("pos"),
        F.col("embedding").alias("vec"),
    ), ["seg"])


@query("q29_greedy_match", t.with_(*SQL_MATCH) + """
SELECT seg, round(p, 6) AS p, round(r, 6) AS r, round(f1, 6) AS f1 FROM matched
""")
def q29_greedy_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_match(spark, sf_dir).select("seg", *[F.round(c, 6).alias(c) for c in ("p", "r", "f1")])


@query("q29_match_means", t.with_(*SQL_MATCH) + """
SELECT 'vectors' AS model, 'even' AS src_lang, 'odd' AS tgt_lang, round(avg(p), 6) AS p, round(avg(r), 6) AS r,
       round(avg(f1), 6) AS f1
FROM matched
""")
def q29_match_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The match of every segment as a system's scores."""
    scores = embedding_match(spark, sf_dir).withColumns(
        {"model": F.lit("vectors"), "src_lang": F.lit("even"), "tgt_lang": F.lit("odd")})
    means = segment_means(scores, ["p", "r", "f1"])
    return means.withColumns({c: F.round(c, 6) for c in ("p", "r", "f1")})


@query("q31_translation_run", t.with_(SQL_ALIGNED, """
long AS (
  SELECT line_no, 'German' AS lang, "German" AS text FROM aligned UNION ALL SELECT line_no, 'English', "English" FROM aligned
  UNION ALL SELECT line_no, 'Spanish', "Spanish" FROM aligned UNION ALL SELECT line_no, 'French', "French" FROM aligned),
asked AS (
  SELECT line_no, lang AS src_lang, tgt_lang, text FROM long, (VALUES ('German'), ('English'), ('Spanish'), ('French')) x(tgt_lang)
  WHERE text IS NOT NULL AND (lang = 'English') <> (tgt_lang = 'English'))""") + """
SELECT 'run-1' AS run, 'stub' AS model, src_lang, tgt_lang, line_no, tgt_lang || ': ' || reverse(text) AS text FROM asked
""")
def q31_translation_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = load_aligned(spark, aligned_files(spark, sf_dir), t.CODES)
    predictions = translation_run(wide, t.NAMES, labelled_scorer, "run-1", "stub", pivot="English")
    store = PredictionStore(spark, scratch_path(spark, "run"))
    store.write(predictions)
    return store.read()


@query("q33_translate_file", t.with_(t.SQL_BITEXT) + f"""
SELECT 'run-1' AS run, 'stub' AS model, 'Cantonese' AS src_lang, 'Traditional Chinese' AS tgt_lang, {t.SQL_LINE_NO} AS line_no,
       'Traditional Chinese:' || chr(10) || reverse(replace(src, chr(10), ' ')) AS text
FROM bitext
""")
def q33_translate_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "sentences")
    turns = t.bitext(spark, sf_dir).withColumn("text", tx.flatten_newlines(F.col("src")))
    write_lines(turns, path, F.lit("sentences.txt"), ["seg"])
    return translate_file(spark, path, "Traditional Chinese", True, labelled_scorer, "run-1", "stub")


@query("q40_stream_score", t.with_(t.SQL_RAW_LINES) + """
SELECT 'Cantonese' AS src_lang, 'English' AS tgt_lang, text, 'Translate the given Cantonese words into English.' AS system,
       reverse(text) AS result
FROM raw_lines
""")
def q40_stream_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = incoming_lines(spark, f"{raw_files(spark, sf_dir)}/*", files_per_batch=8)
    scored = translate(towards(lines, "English", True), reversing_scorer, batch_size=16).select(
        "src_lang", "tgt_lang", "text", F.col("messages")[0]["content"].alias("system"), "result"
    )
    output = scratch_path(spark, "scored")
    stream = start_scoring(scored, output, scratch_path(spark, "progress"))
    stream.awaitTermination()
    return spark.read.schema(scored.schema).parquet(output)


@query("q40_stream_numbered", t.with_(t.SQL_RAW_LINES, SQL_NUMBERED) + """
SELECT name, line_no, 'Cantonese' AS src_lang, 'English' AS tgt_lang, text, reverse(text) AS result FROM numbered
""")
def q40_stream_numbered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scored lines know their place in their files; the stream is started again when it has ended."""
    def score(batch: DataFrame) -> DataFrame:
        return translate(towards(batch, "English", True), reversing_scorer, batch_size=16).drop("messages")

    lines = incoming_lines(spark, f"{raw_files(spark, sf_dir)}/*", files_per_batch=50)
    output, progress = scratch_path(spark, "scored"), scratch_path(spark, "progress")
    for _ in range(2):
        start_numbered_scoring(lines, score, output, progress).awaitTermination()
    return numbered_scores(spark, output).select("name", "line_no", "src_lang", "tgt_lang", "text", "result")
