"""BLEU, segment means, evaluation records, alignment, grids, comparisons."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tandem.catalog import tables as t
from tandem.catalog.registry import query
from tandem.functions.languages import metric_language
from tandem.operators import alignment, report
from tandem.operators.bleu import corpus_bleu
from tandem.operators.directions import with_grid
from tandem.operators.indexing import number_rows
from tandem.operators.scoring import score_segments, together
from tandem.plans.jobs import evaluate, segment_table
from tandem.session import scratch_path, stage
from tandem.sinks.writers import export_predictions, export_truth, write_evaluation, write_lines
from tandem.sources.evaluation import list_predictions, read_predictions, read_truth

KEY = alignment.KEY
SQL_KEY = "model, src_lang, tgt_lang"
GRID_LANGUAGES = ["Simplified Chinese", "Traditional Chinese", "English", "Cantonese"]


def overlap_scorer():
    """Stand-in matching metric: shares of common distinct characters."""

    def score(batch):
        rows = []
        for mt, ref in zip(batch["mt"], batch["ref"]):
            left, right = set(mt), set(ref)
            common = len(left & right)
            p = common / len(left) if left else 0.0
            r = common / len(right) if right else 0.0
            rows.append((p, r, 2 * p * r / (p + r) if p + r else 0.0))
        return dict(zip(("p", "r", "f1"), map(list, zip(*rows))))

    return score


def jaccard_scorer():
    """Stand-in system metric: mean Jaccard similarity of the hypothesis with source and reference."""

    def similarity(a: set, b: set) -> float:
        return len(a & b) / len(a | b) if a | b else 0.0

    return lambda batch: {"score": [
        (similarity(set(mt), set(ref)) + similarity(set(mt), set(src))) / 2
        for src, mt, ref in zip(batch["src"], batch["mt"], batch["ref"])
    ]}


def sql_bleu(source: str = "systems") -> str:
    """BLEU per key over a relation with mt and ref."""
    orders = range(1, 5)
    any_match = "c1 + c2 + c3 + c4 > 0"
    misses = {n: " + ".join(f"(c{k} = 0)::INT" for k in range(1, n + 1)) for n in orders}
    reached = {n: " AND ".join(f"t{k} > 0" for k in range(1, n + 1)) for n in orders}
    precisions = ",\n         ".join(
        f"CASE WHEN NOT ({any_match} AND {reached[n]}) THEN 0.0::DOUBLE "
        f"WHEN c{n} = 0 THEN 100 / (pow(2.0::DOUBLE, {misses[n]}) * t{n}) ELSE 100.0::DOUBLE * c{n} / t{n} END AS p{n}"
        for n in orders
    )
    sums = ", ".join(
        f"coalesce(max(c) FILTER (n = {n}), 0)::BIGINT AS c{n}, coalesce(max(t) FILTER (n = {n}), 0)::BIGINT AS t{n}"
        for n in orders
    )
    return f"""
tokenized AS (SELECT {SQL_KEY}, line_no, {t.sql_tokens('mt')} AS h, {t.sql_tokens('ref')} AS r FROM {source}),
lengths AS (SELECT {SQL_KEY}, sum(len(h))::BIGINT AS sys_len, sum(len(r))::BIGINT AS ref_len FROM tokenized GROUP BY {SQL_KEY}),
sided AS (
  SELECT {SQL_KEY}, line_no, 'h' AS side, h AS k, unnest([1, 2, 3, 4]) AS n FROM tokenized
  UNION ALL SELECT {SQL_KEY}, line_no, 'r', r, unnest([1, 2, 3, 4]) FROM tokenized),
grams AS (
  SELECT {SQL_KEY}, line_no, side, n,
         unnest(list_transform(range(1, len(k) - n + 2), lambda i: k[i:i + n - 1])) AS gram
  FROM sided WHERE len(k) >= n),
counted AS (
  SELECT {SQL_KEY}, line_no, n, gram, count(*) FILTER (side = 'h') AS ch, count(*) FILTER (side = 'r') AS cr
  FROM grams GROUP BY {SQL_KEY}, line_no, n, gram),
per_order AS (SELECT {SQL_KEY}, n, sum(least(ch, cr)) AS c, sum(ch) AS t FROM counted GROUP BY {SQL_KEY}, n),
statistics AS (SELECT {SQL_KEY}, {sums} FROM per_order GROUP BY {SQL_KEY}),
precisions AS (
  SELECT *, CASE WHEN sys_len >= ref_len THEN 1.0::DOUBLE WHEN sys_len = 0 THEN 0.0::DOUBLE
                 ELSE exp(1 - ref_len::DOUBLE / sys_len) END AS bp,
         {precisions}
  FROM lengths JOIN statistics USING ({SQL_KEY})),
bleu AS (
  SELECT *, CASE WHEN least(p1, p2, p3, p4) > 0 THEN bp * exp((ln(p1) + ln(p2) + ln(p3) + ln(p4)) / 4) ELSE 0.0::DOUBLE END AS bleu
  FROM precisions)
"""


def sql_means(source: str = "systems") -> str:
    """Means of the stand-in metrics per key."""
    return f"""
letters AS (
  SELECT {SQL_KEY}, list_distinct(string_split(src, '')) AS s, list_distinct(string_split(mt, '')) AS m,
         list_distinct(string_split(ref, '')) AS r FROM {source}),
sizes AS (
  SELECT {SQL_KEY}, len(s)::DOUBLE AS s, len(m)::DOUBLE AS m, len(r)::DOUBLE AS r,
         len(list_intersect(m, r))::DOUBLE AS mr, len(list_intersect(m, s))::DOUBLE AS ms FROM letters),
shares AS (SELECT *, mr / m AS p, mr / r AS q FROM sizes),
means AS (
  SELECT {SQL_KEY}, avg(p) AS p, avg(q) AS r, avg(CASE WHEN p + q > 0 THEN 2 * p * q / (p + q) ELSE 0 END) AS f1,
         avg((mr / (m + r - mr) + ms / (m + s - ms)) / 2) AS score
  FROM shares GROUP BY {SQL_KEY})
"""


SQL_RECORDS = f"""
records AS (
  SELECT {SQL_KEY}, round(bleu, 2) AS bleu_score, round(p, 2) AS bert_precision, round(r, 2) AS bert_recall,
         round(f1, 2) AS bert_f1, round(score, 6) AS comet_score
  FROM bleu JOIN means USING ({SQL_KEY}))
"""
SQL_FLAT = """
flat AS (
  SELECT model, src_lang, tgt_lang, line_no, replace(src, chr(10), ' ') AS src,
         replace(mt, chr(10), ' ') AS mt, replace(ref, chr(10), ' ') AS ref FROM systems)
"""
SQL_STRIPPED = f"""
stripped AS (
  SELECT model, src_lang, tgt_lang, line_no, {t.sql_strip('src')} AS src, {t.sql_strip('mt')} AS mt,
         {t.sql_strip('ref')} AS ref
  FROM flat WHERE model <> 'sparse' OR line_no < (SELECT count(*) - 1 FROM bitext))
"""


@query("q18_corpus_bleu", t.with_(t.SQL_BITEXT, t.sql_systems(), sql_bleu()) + f"""
SELECT {SQL_KEY}, round(bleu, 6) AS bleu, round(bp, 6) AS bp, sys_len, ref_len,
       c1 AS correct_1, c2 AS correct_2, c3 AS correct_3, c4 AS correct_4,
       t1 AS total_1, t2 AS total_2, t3 AS total_3, t4 AS total_4,
       round(p1, 6) AS precision_1, round(p2, 6) AS precision_2, round(p3, 6) AS precision_3, round(p4, 6) AS precision_4
FROM bleu
""")
def q18_corpus_bleu(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = corpus_bleu(t.systems(spark, sf_dir), KEY)
    return found.select(
        *KEY, F.round("bleu", 6).alias("bleu"), F.round("bp", 6).alias("bp"), "sys_len", "ref_len",
        *[F.col("correct")[n].alias(f"correct_{n + 1}") for n in range(4)],
        *[F.col("total")[n].alias(f"total_{n + 1}") for n in range(4)],
        *[F.round(F.col("precision")[n], 6).alias(f"precision_{n + 1}") for n in range(4)],
    )


def evaluation_files(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """Truth folder, and a folder of prediction folders, one per model; texts with carriage returns.

    The files of one model lack the last line, and a file beside them is no prediction.
    """
    pairs = stage(number_rows(t.bitext(spark, sf_dir), ["seg"], into="line_no").select("line_no", "src", "tgt"), "pairs")
    (left, right), _ = t.DIRECTIONS
    truth = scratch_path(spark, "truth")
    sides = F.array(F.struct(F.lit(left).alias("lang"), F.col("src").alias("text")),
                    F.struct(F.lit(right).alias("lang"), F.col("tgt").alias("text")))
    long = pairs.select("line_no", F.inline(sides)).withColumn("text", t.with_returns(F.col("text")))
    export_truth(long, truth)
    results = scratch_path(spark, "results")
    complete = (F.col("model") != "sparse") | (F.col("line_no") < pairs.count() - 1)
    predictions = t.systems_of(pairs, "line_no").filter(complete).withColumn("text", t.with_returns(F.col("mt")))
    export_predictions(predictions, results)
    write_lines(long, f"{results}/model=notes", F.lit("notes.txt"), ["line_no"])
    return truth, results


SQL_FILE_SYSTEMS = (t.SQL_BITEXT, """
numbered AS (SELECT row_number() OVER (ORDER BY seg) - 1 AS seg, src, tgt FROM bitext)
""", t.sql_systems().replace("FROM bitext", "FROM numbered"), SQL_FLAT, SQL_STRIPPED)


@query("q20_aligned_triples", t.with_(*SQL_FILE_SYSTEMS) + f"SELECT {SQL_KEY}, line_no, src, mt, ref FROM stripped")
def q20_aligned_triples(spark: SparkSession, sf_dir: str) -> DataFrame:
    truth, results = evaluation_files(spark, sf_dir)
    return alignment.aligned_triples(read_predictions(spark, results), read_truth(spark, truth))


@query("q20_aligned_pairs", t.with_(*SQL_FILE_SYSTEMS) + f"SELECT {SQL_KEY}, line_no, mt, ref FROM stripped")
def q20_aligned_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    truth, results = evaluation_files(spark, sf_dir)
    return alignment.aligned_pairs(read_predictions(spark, results), read_truth(spark, truth))


@query("q20_alignment_report", t.with_(*SQL_FILE_SYSTEMS) + f"""
SELECT {SQL_KEY}, n_lines AS n_src, count(*) AS n_mt, n_lines AS n_ref, count(*) = n_lines AS aligned
FROM stripped, (SELECT count(*) AS n_lines FROM bitext) GROUP BY {SQL_KEY}, n_lines
""")
def q20_alignment_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    truth, results = evaluation_files(spark, sf_dir)
    return alignment.alignment_report(read_predictions(spark, results), read_truth(spark, truth))


SQL_GRID = """
names AS (SELECT * FROM (VALUES ('Simplified Chinese'), ('Traditional Chinese'), ('English')) n(lang)),
grid AS (
  SELECT model, src_lang, tgt_lang FROM (SELECT DISTINCT model FROM systems),
    (SELECT 'Cantonese' AS src_lang, lang AS tgt_lang FROM names UNION ALL SELECT lang, 'Cantonese' FROM names))
"""


@query("q21_direction_grid", t.with_(t.SQL_BITEXT, t.sql_systems(), SQL_GRID) + f"""
SELECT {SQL_KEY}, ({SQL_KEY}) IN (SELECT ({SQL_KEY}) FROM systems) AS available FROM grid
""")
def q21_direction_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    predictions = t.systems(spark, sf_dir)
    keys = stage(predictions.select(*KEY).distinct(), "keys")
    grid = with_grid(keys.select("model").distinct(), GRID_LANGUAGES)
    return alignment.availability(grid, keys).select(*KEY, "available")


@query("q21_predictions_found", t.with_(t.SQL_BITEXT, t.sql_systems(), SQL_GRID) + f"""
SELECT {SQL_KEY.replace('src_lang, tgt_lang', "replace(src_lang, ' ', '_') AS src_lang, replace(tgt_lang, ' ', '_') AS tgt_lang")},
       ({SQL_KEY}) IN (SELECT ({SQL_KEY}) FROM systems) AS available
FROM grid
""")
def q21_predictions_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, results = evaluation_files(spark, sf_dir)
    files = list_predictions(spark, results)
    grid = with_grid(files.select("model").distinct(), [name.replace(" ", "_") for name in GRID_LANGUAGES])
    return alignment.availability(grid, files).select(*KEY, "available")


@query("q22_segment_means", t.with_(t.SQL_BITEXT, t.sql_systems(), sql_means()) + f"""
SELECT {SQL_KEY}, CASE WHEN tgt_lang = 'English' THEN 'en' ELSE 'zh' END AS lang,
       round(p, 6) AS p, round(r, 6) AS r, round(f1, 6) AS f1, round(score, 6) AS score
FROM means
""")
def q22_segment_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    triples = t.systems(spark, sf_dir)
    scored = score_segments(
        triples, together(overlap_scorer, jaccard_scorer), "p double, r double, f1 double, score double", batch_size=8)
    means = report.segment_means(scored, ["p", "r", "f1", "score"])
    return means.select(*KEY, metric_language(F.col("tgt_lang")).alias("lang"),
                        *[F.round(c, 6).alias(c) for c in ("p", "r", "f1", "score")])


def segments_of(triples: DataFrame) -> DataFrame:
    return segment_table(triples, overlap_scorer, jaccard_scorer)


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Evaluation records of the three systems."""
    found = report.records_of_segments(segments_of(t.systems(spark, sf_dir)))
    return found.withColumn("comet_score", F.round("comet_score", 6)).select(*KEY, *report.METRICS)


SQL_TABLE_RECORDS = (t.SQL_BITEXT, t.sql_systems(), sql_bleu(), sql_means(), SQL_RECORDS)
SQL_SELECT_RECORDS = f"SELECT {SQL_KEY}, {', '.join(report.METRICS)} FROM records"


@query("q23_eval_records", t.with_(*SQL_TABLE_RECORDS) + SQL_SELECT_RECORDS)
def q23_eval_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = records(spark, sf_dir)
    path = scratch_path(spark, "evaluation")
    write_evaluation(found, path)
    return spark.read.schema(found.schema).csv(path, header=True)


@query("q23_merged_segments", t.with_(*SQL_TABLE_RECORDS) + SQL_SELECT_RECORDS)
def q23_merged_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segments of some lines are stored, later those of the others beside them; records roll up from the store."""
    path = scratch_path(spark, "segments")
    odd = F.col("line_no") % 2 == 1
    for lines in (odd, ~odd):
        segments_of(t.systems(spark, sf_dir).filter(lines)).write.mode("append").parquet(path)
    found = report.records_of_segments(spark.read.parquet(path))
    return found.withColumn("comet_score", F.round("comet_score", 6)).select(*KEY, *report.METRICS)


@query("q26_side_by_side", t.with_(t.SQL_BITEXT, t.sql_systems()) + """
SELECT src_lang, tgt_lang, line_no, max(mt) FILTER (model = 'identity') AS identity,
       max(mt) FILTER (model = 'copy') AS "copy", max(mt) FILTER (model = 'sparse') AS sparse,
       count(DISTINCT mt) = 1 AND count(*) = 3 AS same
FROM systems WHERE model <> 'sparse' OR line_no > (SELECT min(seg) FROM bitext) GROUP BY src_lang, tgt_lang, line_no
""")
def q26_side_by_side(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = t.bitext(spark, sf_dir).agg(F.min("seg")).first()[0]
    # one of them lacks the first line
    systems = t.systems(spark, sf_dir).filter((F.col("model") != "sparse") | (F.col("line_no") > F.lit(first)))
    return report.side_by_side(systems.withColumnRenamed("mt", "text"), t.MODELS)


SQL_LONG = "long AS (\n  " + "\n  UNION ALL ".join(
    f"SELECT {SQL_KEY}, '{metric}' AS metric, {metric} AS value FROM records" for metric in report.METRICS
) + ")"


@query("q27_leaderboard", t.with_(*SQL_TABLE_RECORDS, SQL_LONG, """
ranked AS (
  SELECT *, rank() OVER (PARTITION BY src_lang, tgt_lang, metric ORDER BY value DESC) AS rank,
         min(value) OVER (PARTITION BY src_lang, tgt_lang, metric) < max(value) OVER (PARTITION BY src_lang, tgt_lang, metric) AS differs
  FROM long)""") + f"""
SELECT {SQL_KEY}, metric, value, rank, rank = 1 AND differs AS best,
       bool_or(metric = 'bleu_score' AND rank = 1 AND differs) OVER (PARTITION BY {SQL_KEY}) AS best_model
FROM ranked
""")
def q27_leaderboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    board = report.leaderboard(stage(records(spark, sf_dir), "records"))
    return board.withColumn("rank", F.col("rank").cast("bigint"))


@query("q27_score_table", t.with_(*SQL_TABLE_RECORDS, SQL_LONG) + """
SELECT src_lang, tgt_lang, metric, max(value) FILTER (model = 'identity') AS identity,
       max(value) FILTER (model = 'copy') AS "copy", max(value) FILTER (model = 'sparse') AS sparse
FROM long GROUP BY src_lang, tgt_lang, metric
""")
def q27_score_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = stage(records(spark, sf_dir), "records")
    tables = [report.score_table(found, t.MODELS, metric).withColumn("metric", F.lit(metric)) for metric in report.METRICS]
    return reduce(DataFrame.unionByName, tables)


SQL_BASE = f"""
based AS (SELECT * FROM records WHERE model <> 'copy' OR src_lang = 'English')
"""


@query("q27_against_baseline", t.with_(*SQL_TABLE_RECORDS, SQL_BASE) + f"""
SELECT r.model, r.src_lang, r.tgt_lang, {', '.join(f'r.{m}, b.{m} AS base_{m}, round(r.{m} - b.{m}, 6) AS delta_{m}' for m in report.METRICS)}
FROM based r LEFT JOIN based b ON b.model = 'copy' AND r.src_lang = b.src_lang AND r.tgt_lang = b.tgt_lang
WHERE r.model <> 'copy'
""")
def q27_against_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The baseline never ran one of the directions."""
    based = stage(records(spark, sf_dir), "records").filter("model <> 'copy' OR src_lang = 'English'")
    found = report.against_baseline(based, "copy")
    return found.withColumns({f"delta_{m}": F.round(f"delta_{m}", 6) for m in report.METRICS})


@query("q32_evaluate_files", t.with_(*SQL_FILE_SYSTEMS, sql_bleu("stripped"), sql_means("stripped"), SQL_RECORDS)
       + SQL_SELECT_RECORDS)
def q32_evaluate_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    truth, results = evaluation_files(spark, sf_dir)
    found = evaluate(read_predictions(spark, results), read_truth(spark, truth), overlap_scorer, jaccard_scorer)
    return found.withColumn("comet_score", F.round("comet_score", 6)).select(*KEY, *report.METRICS)


SQL_ASKED = """
asked AS (
  SELECT m.model, g.src_lang, g.tgt_lang FROM (VALUES ('identity'), ('copy'), ('unseen')) m(model),
    (VALUES ('Cantonese', 'English'), ('Cantonese', 'French')) g(src_lang, tgt_lang))
"""


@query("q32_requested_grid", t.with_(*SQL_FILE_SYSTEMS, sql_bleu("stripped"), sql_means("stripped"), SQL_RECORDS, SQL_ASKED)
       + f"SELECT {SQL_KEY}, {', '.join(report.METRICS)} FROM asked LEFT JOIN records USING ({SQL_KEY})")
def q32_requested_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of the cells asked for, and the cells without predictions with NULL metrics."""
    truth, results = evaluation_files(spark, sf_dir)
    models = spark.createDataFrame([("identity",), ("copy",), ("unseen",)], "model string")
    cells = F.array(*[F.struct(F.lit("Cantonese").alias("src_lang"), F.lit(tgt).alias("tgt_lang"))
                      for tgt in ("English", "French")])
    found, absent = evaluate(read_predictions(spark, results), read_truth(spark, truth), overlap_scorer, jaccard_scorer,
                             grid=models.select("model", F.inline(cells)))
    found = found.withColumn("comet_score", F.round("comet_score", 6)).select(*KEY, *report.METRICS)
    return found.unionByName(absent, allowMissingColumns=True)
