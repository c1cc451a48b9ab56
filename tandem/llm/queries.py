"""The registered queries of this subpackage: each operator over its whole table, and SQL where SQL can say it."""

from __future__ import annotations

from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tandem.catalog.registry import Query
from tandem.llm.decontaminate import contamination
from tandem.llm.impacts import exact_top
from tandem.llm.language import language_parser, languages_of
from tandem.llm.licenses import license_spans
from tandem.llm.merkle import build_manifest, folded_proofs
from tandem.llm.mixing import BLOCK, BUCKETS, MOST_REPEATS, ROUNDS, SALT, SEED, STEPS, mixed
from tandem.llm.near_dups import near_duplicates
from tandem.llm.neighbours import nearest
from tandem.llm.quality import quality_scores, quality_weights
from tandem.llm.rendering import visible_text
from tandem.llm.spelling import variant_groups, word_counts
from tandem.llm.tokens import token_counts
from tandem.llm.warc import read_archives, write_archives
from tandem.session import scratch_path

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query under ``name`` with the SQL that must give the same rows."""

    def register(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql.strip()
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(id: str = "doc_id"):
    """Rows that no model learns from; a null id is one of them."""
    return F.coalesce(F.crc32(F.col(id).cast("string")) % 3 == 1, F.lit(True))


@query("op1_token_counts")
def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    specification = Path(public_tokenizers.path("byte_bpe_50k.json")).read_text()
    return token_counts(table(spark, sf_dir, "documents"), specification)


@query("op5_near_duplicates")
def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), shingle=3, percent=85)


SQL_PLAIN_WORDS = "regexp_extract_all(translate(text, '{}', '{}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')".format(
    "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@query("op8_decontamination", f"""
WITH doc_words AS (SELECT doc_id, unnest(range(len(w))) AS pos, unnest(w) AS word
  FROM (SELECT doc_id, {SQL_PLAIN_WORDS} AS w FROM documents)),
items AS (SELECT item_id, {SQL_PLAIN_WORDS} AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, list_slice(w, s + 1, s + least(len(w), 10)) AS v
  FROM (SELECT item_id, w, unnest(range(len(w) - least(len(w), 10) + 1)) AS s FROM items WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT len(v) AS k FROM windows),
texts AS (SELECT doc_id, {SQL_PLAIN_WORDS} AS w FROM documents),
places AS (
  SELECT doc_id, s, k, list_slice(w, s + 1, s + k) AS v
  FROM (SELECT doc_id, w, k, unnest(range(len(w) - k + 1)) AS s FROM texts, sizes WHERE len(w) >= k)),
found AS (SELECT p.doc_id, p.s, p.k, x.item_id FROM places p JOIN windows x ON p.v = x.v),
hits AS (SELECT doc_id, count(DISTINCT word) AS n_hit
  FROM (SELECT doc_id, unnest(range(s, s + k)) AS word FROM found) GROUP BY doc_id),
named AS (SELECT doc_id, count(DISTINCT item_id) AS n_items,
    string_agg(name, ',' ORDER BY name) AS names
  FROM (SELECT DISTINCT doc_id, item_id, CAST(item_id AS VARCHAR) AS name FROM found) GROUP BY doc_id)
SELECT t.doc_id, CAST(coalesce(len(t.w), 0) AS BIGINT) AS n_words, CAST(coalesce(h.n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n.n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(n.names, '')) AS items_sha256,
  coalesce(h.n_hit, 0) > 0 AS contaminated
FROM texts t LEFT JOIN hits h ON t.doc_id = h.doc_id LEFT JOIN named n ON t.doc_id = n.doc_id
""")
def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda total, span: total + span["end"] - span["start"])
    return found.select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", F.array_sort("items")), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"))


@query("op9_license_scan")
def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = license_spans(table(spark, sf_dir, "documents"))

    def joined(found):
        labels = F.transform(found, lambda span: span["label"])
        return F.concat_ws(",", F.array_sort(F.array_distinct(labels)))

    base = F.filter("spans", lambda span: span["exact"])
    starts = F.transform(base, lambda span: span["first_word"])
    return spans.select(
        "doc_id", "n_words", F.size(base).cast("bigint").alias("n_base"),
        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        joined(base).alias("base_labels"), joined(F.col("spans")).alias("labels"),
        F.coalesce(F.array_max(F.transform("spans", lambda span: span["coverage"])), F.lit(0.0)).alias("score"))


@query("op6_quality")
def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    weights = quality_weights(documents, table(spark, sf_dir, "labels").filter(~held_out()))
    return quality_scores(documents, weights).select("doc_id", held_out().alias("held_out"), "score", "predicted")


@query("op7_language")
def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    parser = language_parser(documents.filter(~held_out()))
    return languages_of(documents, parser).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def sql_scrambled(value: str, salt: str) -> str:
    for factor, prime in STEPS:
        value = f"(((({value}) % {prime} + {prime}) % {prime} * {factor} + ({salt}) * {SALT} + {factor}) % {prime})"
    return value


def sql_permuted(index: str, size: str, key: str) -> str:
    partner = f"((({sql_scrambled(key, 'r * 2 + 1')} - x) % {size} + {size}) % {size})"
    coin = sql_scrambled(f"greatest(x, {partner}) + ({key}) * 7", "r * 2 + 2")
    swap = f"CASE WHEN ({coin} >> 9) % 2 = 1 THEN {partner} ELSE x END"
    return f"list_reduce(list_prepend({index}, range({ROUNDS})), lambda x, r: {swap})"


@query("op2_mixing", f"""
WITH sized AS (
  SELECT doc_id, source, CAST(len(coalesce(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+'), [])) AS BIGINT) AS size,
    coalesce({sql_scrambled('doc_id', str(SEED))} % {BUCKETS}, 0) AS bucket
  FROM documents),
sources AS (
  SELECT source, source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS source_no
  FROM (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source)),
weighted AS (
  SELECT *, 1.0::DOUBLE * (source_no % 3 + 1) AS weight, source_size * {MOST_REPEATS} AS "limit",
    source_size * {MOST_REPEATS} / (1.0::DOUBLE * (source_no % 3 + 1)) AS fill FROM sources),
levels AS (
  SELECT *, ((sum(source_size) OVER ()) - coalesce(sum("limit") OVER before, 0))::DOUBLE
    / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS level
  FROM weighted
  WINDOW before AS (ORDER BY fill, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
shared AS (SELECT arg_min(level, struct_pack(a := fill, b := level)) AS level FROM levels WHERE level <= fill),
targets AS (
  SELECT w.*, CASE WHEN s.level IS NULL OR w.fill < s.level THEN CAST("limit" AS DOUBLE)
    ELSE s.level * weight END AS target
  FROM weighted w, shared s),
need AS (
  SELECT source_no, source_size, source_size // {BLOCK} AS whole, words // source_size AS passes,
    words % source_size AS rest
  FROM (SELECT *, CAST(floor(target) AS BIGINT) AS words FROM targets) WHERE words > 0),
positions AS (
  SELECT d.doc_id, d.size, t.source_no, t.source_size, t.target,
    CAST(sum(d.size) OVER (PARTITION BY t.source_no ORDER BY d.bucket, d.doc_id ROWS UNBOUNDED PRECEDING) AS BIGINT)
      - d.size AS start
  FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source),
pieces AS (
  SELECT source_no, doc_id, b, greatest(0, start - b * {BLOCK}) AS low,
    least({BLOCK}, start + size - b * {BLOCK}) AS high
  FROM (SELECT *, unnest(range(start // {BLOCK}, (start + size - 1) // {BLOCK} + 1)) AS b FROM positions WHERE size > 0)),
turns AS (
  SELECT *, unnest(range(rest // {BLOCK} + CASE WHEN rest % {BLOCK} > 0 THEN 1 ELSE 0 END)) AS turn FROM need),
last_pass AS (
  SELECT source_no, CASE WHEN turn < whole THEN
      {sql_permuted('turn', 'greatest(whole, 1)', f'source_no * 1009 + passes * 31 + {SEED}')} ELSE turn END AS b,
    least({BLOCK}, rest - turn * {BLOCK}) AS words
  FROM turns),
more AS (
  SELECT p.source_no, p.doc_id, sum(greatest(0, least(p.high, l.words) - p.low)) AS taken
  FROM pieces p JOIN last_pass l ON p.source_no = l.source_no AND p.b = l.b GROUP BY ALL)
SELECT p.doc_id, p.size, p.source_size, p.target,
  CAST(coalesce(n.passes, 0) * p.size + coalesce(m.taken, 0) AS BIGINT) AS taken
FROM positions p LEFT JOIN need n ON p.source_no = n.source_no
LEFT JOIN more m ON p.source_no = m.source_no AND p.doc_id = m.doc_id
""")
def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed(table(spark, sf_dir, "documents"))["documents"].select(
        "doc_id", "size", "source_size", "target", "taken")


@query("op4_warc", """
WITH payloads AS (
  SELECT page_id, coalesce(html, '') AS html, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes FROM pages),
lasts AS (SELECT *, max(page_id) OVER (PARTITION BY html) AS last_id FROM payloads)
SELECT page_id, payload_bytes, sha1(html) AS payload_digest,
  CASE WHEN payload_bytes >= 1000 AND page_id < last_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 1000 AND page_id < last_id THEN last_id END AS refers_to
FROM lasts
""")
def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    write_archives(table(spark, sf_dir, "pages"), path)
    return read_archives(spark, path, payload=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op3_nearest")
def op3_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


@query("op10_visible_text")
def op10_visible_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return visible_text(table(spark, sf_dir, "pages"))


@query("op12_exact_top", """
WITH vectors AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM vectors q JOIN vectors c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 50 = 0),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
""")
def op12_exact_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_top(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0).select(
        "query_id", "rank", "vec_id", "score")


SQL_CRC_TABLE = "list_transform(range(256), lambda b: list_reduce(list_prepend(b, range(8)), lambda c, i: {}))".format(
    "CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END")


def sql_crc32(text: str) -> str:
    """The unsigned CRC-32 of a text's UTF-8 bytes; ``crc.steps`` must be in scope."""
    byte = "CAST('0x' || substr(hex(encode({0})), 2 * CAST(i AS INTEGER) + 1, 2) AS BIGINT)".format(text)
    step = "xor(c // 256, crc.steps[CAST(xor(c % 256, b) AS INTEGER) + 1])"
    codes = f"list_prepend(4294967295, list_transform(range(strlen({text})), lambda i: {byte}))"
    return f"xor(list_reduce({codes}, lambda c, b: {step}), 4294967295)"


@query("op11_spelling_variants", f"""
WITH RECURSIVE crc AS (SELECT {SQL_CRC_TABLE} AS steps),
runs AS (
  SELECT doc_id, run, count(*) AS times
  FROM (SELECT doc_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[A-Za-z\\x{{C0}}-\\x{{FF}}]{{7,}}')) AS run FROM documents) GROUP BY ALL),
hashed AS (SELECT run, times, {sql_crc32("(CAST(doc_id AS VARCHAR) || ':' || run)")} AS h FROM runs, crc),
words AS (
  SELECT word, CAST(sum(times) AS BIGINT) AS n
  FROM (SELECT times, CASE WHEN h % 31 = 0
    THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word FROM hashed)
  WHERE length(word) >= 7 GROUP BY word HAVING sum(times) >= 2),
cuts AS (
  SELECT word, i, substr(word, 1, i) || substr(word, i + 2) AS rest
  FROM (SELECT word, unnest(range(length(word))) AS i FROM words)),
shorter AS (SELECT DISTINCT c.word AS a, w.word AS b FROM cuts c JOIN words w ON c.rest = w.word),
near AS (
  SELECT a, b FROM shorter UNION ALL SELECT b, a FROM shorter
  UNION ALL SELECT x.word, y.word FROM cuts x JOIN cuts y ON x.i = y.i AND x.rest = y.rest AND x.word <> y.word),
best AS (
  SELECT w.word, count(*) AS n_near, max(o.n) AS most, min(-o.n) AS least,
    arg_min(o.word, struct_pack(n := -o.n, word := o.word)) AS form
  FROM words w JOIN near p ON p.a = w.word JOIN words o ON o.word = p.b GROUP BY w.word),
formed AS (
  SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.most >= 10 * w.n THEN b.form END AS form,
    CASE WHEN b.most >= 10 * w.n THEN b.most END AS form_n
  FROM words w LEFT JOIN best b ON w.word = b.word),
chains AS (
  SELECT word, word AS root, form AS next FROM formed
  UNION ALL SELECT c.word, f.word, f.form FROM chains c JOIN formed f ON c.next = f.word)
SELECT f.word, f.form, c.root, f.n, f.n_near, f.form_n FROM formed f JOIN chains c ON f.word = c.word
WHERE c.next IS NULL
""")
def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variant_groups(word_counts(table(spark, sf_dir, "documents"), garbled=31))


def sql_field(value: str) -> str:
    return f"coalesce(strlen(CAST({value} AS VARCHAR)) || ':' || CAST({value} AS VARCHAR), '-')"


@query("op13_merkle_manifest", f"""
WITH RECURSIVE crc AS (SELECT {SQL_CRC_TABLE} AS steps),
keyed AS (
  SELECT d.*, coalesce({sql_crc32('CAST(doc_id AS VARCHAR)')} % 7 = 0, false) AS changed FROM documents d, crc),
leaves AS (
  SELECT doc_id, lang, sha256({sql_field('doc_id')} || {sql_field('source')} || {sql_field('lang')}
    || {sql_field('n_chars')} || {sql_field('text')}) AS leaf,
    sha256({sql_field('doc_id')} || {sql_field('source')} || {sql_field('lang')}
    || {sql_field('(n_chars + CASE WHEN changed THEN 1 ELSE 0 END)')} || {sql_field('text')}) AS other
  FROM keyed),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place FROM leaves),
lower AS (
  SELECT lang, 0 AS level, list(leaf ORDER BY place) AS nodes FROM placed GROUP BY lang
  UNION ALL
  SELECT lang, level + 1, list_transform(range((len(nodes) + 1) // 2),
    lambda i: sha256(nodes[2 * i + 1] || coalesce(nodes[2 * i + 2], ''))) FROM lower WHERE len(nodes) > 1),
subroots AS (
  SELECT lang, level AS height, nodes[1] AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS rank
  FROM lower WHERE len(nodes) = 1),
upper AS (
  SELECT 0 AS level, list(subroot ORDER BY rank) AS nodes FROM subroots
  UNION ALL
  SELECT level + 1, list_transform(range((len(nodes) + 1) // 2),
    lambda i: sha256(nodes[2 * i + 1] || coalesce(nodes[2 * i + 2], ''))) FROM upper WHERE len(nodes) > 1),
tops AS (SELECT level AS top_height, nodes[1] AS root FROM upper WHERE len(nodes) = 1),
levels AS (
  SELECT lang, level, nodes FROM lower WHERE len(nodes) > 1
  UNION ALL SELECT s.lang, s.height + u.level, u.nodes FROM subroots s, upper u WHERE len(u.nodes) > 1),
paths AS (
  SELECT p.doc_id, p.lang, p.place, p.other, l.level, l.nodes,
    CASE WHEN l.level < s.height THEN p.place >> l.level ELSE s.rank >> (l.level - s.height) END AS i
  FROM placed p JOIN subroots s ON p.lang IS NOT DISTINCT FROM s.lang
  JOIN levels l ON p.lang IS NOT DISTINCT FROM l.lang),
sides AS (
  SELECT doc_id, lang, place,
    list({{'l': CASE WHEN i % 2 = 1 THEN nodes[i] ELSE '' END,
      'r': CASE WHEN i % 2 = 0 THEN coalesce(nodes[i + 2], '') ELSE '' END}} ORDER BY level) AS way
  FROM paths GROUP BY ALL),
proved AS (
  SELECT p.doc_id, p.leaf, s.subroot, t.root,
    sha256(coalesce(array_to_string(list_transform(w.way, lambda x: x.l || x.r), ''), '')) AS proof_sha256,
    list_reduce(list_prepend({{'l': p.other, 'r': ''}}, coalesce(w.way, [])),
      lambda h, x: {{'l': sha256(x.l || h.l || x.r), 'r': ''}}).l AS folded_root
  FROM placed p JOIN subroots s ON p.lang IS NOT DISTINCT FROM s.lang CROSS JOIN tops t
  LEFT JOIN sides w ON p.lang IS NOT DISTINCT FROM w.lang AND p.place = w.place)
SELECT doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root AS verified FROM proved
""")
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    more = (F.col("n_chars").cast("decimal(38,0)") + 1)
    manifest = build_manifest(
        table(spark, sf_dir, "documents"), ["doc_id", "source", "lang", "n_chars", "text"],
        altered={"n_chars": more}, changed=F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, F.lit(False)))
    return folded_proofs(spark, manifest).select(
        F.col("id").alias("doc_id"), "leaf", "subroot", "root", F.sha2("proof", 256).alias("proof_sha256"),
        "folded_root", "verified")
