"""Named queries ``opN_<name>`` over whole tables, with their SQL where it exists."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tilldeck.llm.decontaminate import benchmark_matches
from tilldeck.llm.embeddings import near_duplicate_vectors
from tilldeck.llm.flat_tokens import document_token_counts, write_flat_tokens
from tilldeck.llm.html_text import extract_main_text
from tilldeck.llm.language import fit as fit_language
from tilldeck.llm.language import language
from tilldeck.llm.negatives import hard_negatives
from tilldeck.llm.ngram_join import near_duplicate_classes
from tilldeck.llm.packing import pack_documents
from tilldeck.llm.periodic import periodic_runs
from tilldeck.llm.substring import remove_repeats
from tilldeck.llm.token_files import read_token_files, write_token_files
from tilldeck.llm.toxicity import THRESHOLD, fit, toxicity
from tilldeck.llm.urls import url_verdicts
from tilldeck.session import scratch_dir


def _read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def op1_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    out = remove_repeats(_read(spark, folder, "documents"))
    return out.select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256")
    )


def op2_html_text(spark: SparkSession, folder: str) -> DataFrame:
    out = extract_main_text(_read(spark, folder, "pages"))
    return out.withColumn("n_chars", F.length("text").cast("long"))


def op3_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return url_verdicts(_read(spark, folder, "pages")).drop("trust", "distrust")


def op4_embedding_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicate_vectors(_read(spark, folder, "embeddings"))


def op5_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicate_classes(_read(spark, folder, "documents"))


def held_out(id_column: str = "doc_id") -> Column:
    """Rows kept for testing: crc32 of the id as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def op6_token_files(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_dir(spark, "token-files")
    write_token_files(_read(spark, folder, "documents"), path)
    return read_token_files(spark, path)


def op7_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_dir(spark, "flat-tokens")
    write_flat_tokens(_read(spark, folder, "documents"), path)
    return document_token_counts(spark, path)


def op8_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = _read(spark, folder, "documents")
    model = fit(docs, _read(spark, folder, "labels").where(~held_out()))
    return toxicity(docs, model).select(
        "doc_id",
        held_out().alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
        "hits",
    )


def op9_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    out = benchmark_matches(_read(spark, folder, "documents"), _read(spark, folder, "benchmark"))
    return out.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op10_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack_documents(_read(spark, folder, "documents"))


def op11_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = _read(spark, folder, "embeddings").select("vec_id", "embedding", label.alias("label"))
    return hard_negatives(vectors, F.col("vec_id") % 100 == 0)


def op12_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = _read(spark, folder, "documents")
    crc = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    held = F.coalesce(crc % 4 == 2, F.lit(False))
    model = fit_language(docs.where(~held))
    return language(docs, model).select("doc_id", held.alias("held_out"), "lang_pred", "score")


def planted_runs(docs: DataFrame) -> DataFrame:
    """``docs`` with a periodic end for ids whose crc32 is divisible by 10: words from
    place ``a`` on become those from ``a`` with period ``p``. Other texts are unchanged,
    as are those without id or words."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    split = F.filter(F.split(F.col("text"), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    parts = docs.select("doc_id", "text", F.floor(h / 10).alias("g"), F.when(h % 10 == 0, split).alias("w"))
    parts = parts.withColumn("n", F.size("w")).withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    parts = parts.withColumn("p", F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)) + 1)
    again = F.expr("flatten(array_repeat(slice(w, int(a + 1), int(p)), int(ceil((n - a) / p))))")
    words = F.concat(F.expr("slice(w, 1, int(a))"), F.slice(again, F.lit(1), (F.col("n") - F.col("a")).cast("int")))
    return parts.select("doc_id", F.when(F.col("n") > 0, F.array_join(words, " ")).otherwise(F.col("text")).alias("text"))


def op13_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    out = periodic_runs(planted_runs(_read(spark, folder, "documents")))
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"], -r["start"], -r["period"])))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    found = out.withColumn("best", best)
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.col2")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.col3")).alias("period"),
        F.floor(1000 * F.col("best.length") / -F.col("best.col3")).alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed_text").cast("binary"), 256).alias("collapsed_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_html_text": op2_html_text,
    "op3_url_filter": op3_url_filter,
    "op4_embedding_dedup": op4_embedding_dedup,
    "op5_ngram_jaccard": op5_ngram_jaccard,
    "op6_token_files": op6_token_files,
    "op7_token_counts": op7_token_counts,
    "op8_toxicity": op8_toxicity,
    "op9_decontaminate": op9_decontaminate,
    "op10_packing": op10_packing,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_language_id": op12_language_id,
    "op13_periodic_runs": op13_periodic_runs,
}

_WORDS_1 = r"""
words AS (
  SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS p
  FROM (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
        FROM documents))"""

ORACLE: dict[str, str] = {
    "op1_substring_dedup": rf"""
WITH {_WORDS_1},
keyed AS (
  SELECT doc_id, p, w, list(w) OVER ahead AS k, count(*) OVER ahead AS n FROM words
  WINDOW ahead AS (PARTITION BY doc_id ORDER BY p ROWS BETWEEN CURRENT ROW AND 19 FOLLOWING)),
first_seen AS (
  SELECT k, min(doc_id::HUGEINT * 1000000000 + p) AS lowest FROM keyed WHERE n = 20 GROUP BY k),
marked AS (
  SELECT doc_id, p, w, coalesce(lowest < doc_id::HUGEINT * 1000000000 + p, false) AS late
  FROM keyed LEFT JOIN first_seen ON keyed.k = first_seen.k AND keyed.n = 20),
covered AS (
  SELECT doc_id, p, w, bool_or(late) OVER (
    PARTITION BY doc_id ORDER BY p ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS gone
  FROM marked),
per_doc AS (
  SELECT doc_id, count(*) AS n_words, count(*) FILTER (gone) AS n_removed,
         string_agg(w, ' ' ORDER BY p) FILTER (NOT gone) AS kept
  FROM covered GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM documents d LEFT JOIN per_doc USING (doc_id)""",
    "op9_decontaminate": r"""
WITH
doc_words AS (
  SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS p
  FROM (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
          'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents)),
item_words AS (
  SELECT item_id, ws, len(ws) AS n
  FROM (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
          'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark)
  WHERE len(ws) > 0),
phrases AS (
  SELECT DISTINCT item_id, least(n, 10) AS size, ws[s:s + least(n, 10) - 1] AS k
  FROM (SELECT *, unnest(range(1, n - least(n, 10) + 2)) AS s FROM item_words)),
sizes AS (SELECT DISTINCT size FROM phrases),
keyed AS (
  SELECT doc_id, p, list(w) OVER (PARTITION BY doc_id ORDER BY p ROWS BETWEEN CURRENT ROW AND 9 FOLLOWING) AS k
  FROM doc_words),
hits AS (
  SELECT doc_id, p, size, item_id FROM
    (SELECT doc_id, p, size, k[1:size] AS k FROM keyed, sizes WHERE len(k) >= size) JOIN phrases USING (size, k)),
covered AS (
  SELECT doc_id, count(*) AS n_hit
  FROM (SELECT DISTINCT doc_id, unnest(range(p, p + size)) AS p FROM hits) GROUP BY doc_id),
named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i COLLATE "binary") AS names
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS i FROM hits) GROUP BY doc_id),
counts AS (SELECT doc_id, count(*) AS n_words FROM doc_words GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM documents d LEFT JOIN counts USING (doc_id) LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)""",
    "op4_embedding_dedup": """
WITH RECURSIVE
unit AS (
  SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM unit a JOIN unit b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.9),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
low AS (SELECT a, min(b) AS b FROM reach GROUP BY a),
counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, coalesce(n, 0) AS n_links, least(e.vec_id, coalesce(low.b, e.vec_id)) AS component_id,
       e.vec_id = least(e.vec_id, coalesce(low.b, e.vec_id)) AS kept
FROM embeddings e LEFT JOIN counts ON e.vec_id = counts.a LEFT JOIN low ON e.vec_id = low.a""",
    "op11_hard_negatives": """
WITH
v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS a, b.vec_id AS b, a.label = b.label AS same, list_inner_product(a.q, b.q)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.q) = len(b.q) WHERE a.vec_id % 100 = 0),
positives AS (
  SELECT * FROM scored WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, b) <= 5)
SELECT p.a AS anchor_id, p.b AS positive_id,
       (row_number() OVER (PARTITION BY p.a, p.b ORDER BY n.score DESC, n.b))::INT AS rank,
       n.b AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positives p JOIN scored n ON p.a = n.a AND NOT n.same
  AND 80 * p.score <= 100 * n.score AND 100 * n.score <= 100 * p.score
QUALIFY row_number() OVER (PARTITION BY p.a, p.b ORDER BY n.score DESC, n.b) <= 5""",
    "op5_ngram_jaccard": r"""
WITH RECURSIVE
split AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
words AS (SELECT doc_id, len(ws) AS n, unnest(ws) AS w, generate_subscripts(ws, 1) AS p FROM split),
grams AS (
  SELECT DISTINCT doc_id, hash(k) AS g FROM (
    SELECT doc_id, n, p, list(w) OVER (PARTITION BY doc_id ORDER BY p ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING) AS k
    FROM words) WHERE len(k) = 5 OR (n < 5 AND p = 1)),
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(a, b) AS (SELECT a, b FROM both_ways UNION SELECT reach.a, l.b FROM reach JOIN both_ways l ON reach.b = l.a),
low AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, least(d.doc_id, coalesce(low.b, d.doc_id)) AS component_id
FROM documents d LEFT JOIN sizes USING (doc_id) LEFT JOIN low ON low.a = d.doc_id""",
    # A run is an island of equal words on one diagonal of 5-word repeats; of those
    # that cover one stretch, the one of the smallest period counts.
    "op13_periodic_runs": r"""
WITH
split AS (
  SELECT doc_id, CAST(doc_id AS VARCHAR) AS s,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
  FROM documents),
hashed AS (
  SELECT *, len(ws) AS n, xor(4294967295::BIGINT, list_reduce(range(8 * len(s)), lambda c, i:
      CASE WHEN (xor(c, CASE WHEN i % 8 = 0 THEN ascii(substr(s, (i // 8 + 1)::INT, 1)) ELSE 0 END) & 1) = 1
        THEN xor(xor(c, CASE WHEN i % 8 = 0 THEN ascii(substr(s, (i // 8 + 1)::INT, 1)) ELSE 0 END) >> 1, 3988292384::BIGINT)
        ELSE xor(c, CASE WHEN i % 8 = 0 THEN ascii(substr(s, (i // 8 + 1)::INT, 1)) ELSE 0 END) >> 1 END,
      4294967295::BIGINT)) AS h
  FROM split),
cut AS (
  SELECT *, CASE WHEN h % 10 = 0 AND n > 0 THEN (h // 10) % n END AS a,
         CASE WHEN h % 10 = 0 AND n > 0 THEN 1 + (n - (h // 10) % n) // (3 + (h // 10) % 8) END AS p FROM hashed),
words AS (
  SELECT doc_id, n, i, ws[(CASE WHEN a IS NULL OR i < a THEN i ELSE a + (i - a) % p END) + 1] AS w
  FROM (SELECT *, unnest(range(n)) AS i FROM cut)),
grams AS (
  SELECT doc_id, n, i, list(w) OVER ahead AS g, count(*) OVER ahead AS m FROM words
  WINDOW ahead AS (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING)),
coded AS (SELECT doc_id, n, i, hash(g) AS g FROM grams WHERE m = 5),
pairs AS (
  SELECT x.doc_id, x.i, y.i - x.i AS q FROM coded x JOIN coded y
  ON x.doc_id = y.doc_id AND x.g = y.g AND y.i > x.i AND 4 * (y.i - x.i) <= x.n),
islands AS (
  SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS k FROM pairs),
stretches AS (
  SELECT doc_id, q, min(i) AS s, count(*) + 4 + q AS l FROM islands GROUP BY doc_id, q, k
  HAVING count(*) + 4 + q >= greatest(6, 4 * q)),
runs AS (
  SELECT * FROM stretches r WHERE NOT EXISTS (
    FROM stretches o WHERE o.doc_id = r.doc_id AND o.q < r.q AND o.s <= r.s AND o.s + o.l >= r.s + r.l)),
listed AS (
  SELECT doc_id, count(*) AS n_runs, string_agg(s || ',' || l || ',' || q || chr(10), '' ORDER BY s, q) AS lines FROM runs GROUP BY doc_id),
best AS (
  SELECT * FROM runs QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY l DESC, s, q) = 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(s + q, s + l)) AS i FROM runs),
kept AS (
  SELECT doc_id, string_agg(w, ' ' ORDER BY i) AS t FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_runs, 0) AS n_runs, b.s AS start, b.l AS length, b.q AS period,
       1000 * b.l // b.q AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(t, '')) AS collapsed_sha256
FROM documents d LEFT JOIN listed USING (doc_id) LEFT JOIN best b USING (doc_id) LEFT JOIN kept USING (doc_id)""",
}
