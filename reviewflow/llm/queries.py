"""The registered queries of this package and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewflow.llm import (bpe, collocation, dedup, lm, mixing, ngram_join, pages, periodic, pii, quality, topk_search,
                            toxicity, urls)
from reviewflow.llm.tables import read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# Hosts with one of these labels make up the list of the URL filter's query.
LISTED_LABELS = ("cheap-pills", "adult-x", "free-bets", "spam-farm")


def query(name: str, sql: str | None = None):
    def register(build):
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql
        return build
    return register


@query("op1_mix_sources")
def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


@query("op2_find_pii")
def op2_find_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_pii(read(spark, sf_dir, "documents"))
    counts = [F.expr(f"cast(size(filter(base, span -> span.kind = {number})) as long)").alias(f"n_{name}")
              for number, name in enumerate(pii.KINDS)]
    return found.select(
        "doc_id", *counts, F.sha2(pii.span_text("base").cast("binary"), 256).alias("base_sha256"), pii.span_text("spans").alias("spans"))


@query("op4_html_article")
def op4_html_article(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.extract_articles(read(spark, sf_dir, "pages"))


@query("op3_toxicity")
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@query("op5_lm_score")
def op5_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_texts(read(spark, sf_dir, "documents"))


@query("op6_quality_rules", r"""
WITH words AS (
  SELECT doc_id, source, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
windows AS (
  SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS gram
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM words WHERE len(w) >= 3)),
repeated AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, gram) AS n FROM windows) WHERE n > 1),
repeat_words AS (
  SELECT doc_id, count(DISTINCT i + k) AS n FROM repeated, (SELECT unnest([0, 1, 2]) AS k) GROUP BY doc_id),
lines AS (
  SELECT doc_id, source, text, line, regexp_extract_all(line, '[^\x20\x09-\x0D]+') AS lw
  FROM (SELECT doc_id, source, text, unnest(string_split(text, chr(10))) AS line FROM words)),
full_lines AS (SELECT * FROM lines WHERE len(lw) > 0),
dup_lines AS (
  SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM full_lines GROUP BY doc_id),
normal AS (
  SELECT doc_id, coalesce('+' || source, '-') AS host, text, lower(array_to_string(lw, ' ')) AS line, len(lw) AS n FROM full_lines),
hosts AS (SELECT coalesce('+' || source, '-') AS host, count(*) AS host_docs FROM words GROUP BY 1),
common AS (
  SELECT host, line FROM (SELECT host, line, count(DISTINCT text) AS n FROM normal GROUP BY 1, 2) JOIN hosts USING (host)
  WHERE n > 50 AND n > 0.01 * host_docs),
removed AS (SELECT doc_id, sum(normal.n) AS n FROM normal JOIN common USING (host, line) GROUP BY doc_id),
measured AS (
  SELECT doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
         coalesce(d.n, 0) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words, coalesce(x.n, 0) AS gone
  FROM words LEFT JOIN dup_lines d USING (doc_id) LEFT JOIN repeat_words r USING (doc_id) LEFT JOIN removed x USING (doc_id)),
judged AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM measured)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT (gone > 0.5 * n_words OR (gone > 0 AND n_words - gone < 50)) AS kept
FROM judged""")
def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(read(spark, sf_dir, "documents")).drop("removed_words")


@query("op7_ngram_join")
def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar_groups(read(spark, sf_dir, "documents"))


_URL_PARTS = r"""
parts AS (
  SELECT page_id, translate(coalesce(regexp_extract(rest, '^[^/?#]*', 0), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                            'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path,
         coalesce(regexp_extract(rest, '^[^?#]*(\?[^#]*)', 1), '') AS query
  FROM (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) END AS rest FROM pages)),
named AS (
  SELECT *, regexp_replace(host, '^(www|m)\.', '') || regexp_replace(path, '/+$', '') || query AS canonical FROM parts)"""


@query("op8_url_filter", "WITH " + _URL_PARTS + """,
listed AS (SELECT DISTINCT canonical FROM named WHERE regexp_matches(host, '(^|\\.)(cheap-pills|adult-x|free-bets|spam-farm)\\.')),
ruled AS (
  SELECT named.*, CASE
    WHEN (host = 'example.net' OR host LIKE '%.example.net') AND path LIKE '/en/%' THEN 'example.net/en/'
    WHEN (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/de/%' THEN 'example.com/de/'
    WHEN (host = 'org' OR host LIKE '%.org') AND path LIKE '/fr/%' THEN 'org/fr/'
    WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/%' THEN 'net/' END AS rule
  FROM named)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('example.net/en/', 'org/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
            WHEN listed.canonical IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict
FROM ruled LEFT JOIN listed USING (canonical)""")
def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    addresses = read(spark, sf_dir, "pages").select("page_id", "url")
    labels = "(^|\\.)(" + "|".join(LISTED_LABELS) + ")\\."
    listed = addresses.where(urls.host_of(F.col("url")).rlike(labels)).select(urls.canonical(F.col("url")).alias("canonical"))
    return urls.judge_pages(addresses, listed).drop("canonical")


@query("op9_byte_bpe")
def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.token_digests(read(spark, sf_dir, "documents"), str(public_tokenizers.path(corpus_pipeline.VOCABULARY)))


@query("op10_exact_dedup", r"""
WITH normal AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents),
ranked AS (
  SELECT doc_id, sha256(norm) AS text_sha256,
         first_value(doc_id) OVER (PARTITION BY norm ORDER BY length(text) DESC, doc_id) AS keep_id,
         count(*) OVER (PARTITION BY norm) AS group_size
  FROM normal)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM ranked""")
def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.exact_groups(read(spark, sf_dir, "documents"))


@query("op11_collocations", r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
f1 AS (SELECT lang, p, count(*) AS f FROM (SELECT lang, unnest(w) AS p FROM words) GROUP BY ALL),
f2 AS (SELECT lang, w[i] AS w1, w[i + 1] AS w2, count(*) AS f
       FROM (SELECT lang, w, unnest(range(1, len(w))) AS i FROM words WHERE len(w) > 1) GROUP BY ALL),
f3 AS (SELECT lang, w[i] AS w1, w[i + 1] AS w2, w[i + 2] AS w3, count(*) AS f
       FROM (SELECT lang, w, unnest(range(1, len(w) - 1)) AS i FROM words WHERE len(w) > 2) GROUP BY ALL HAVING count(*) >= 10),
totals AS (SELECT lang, sum(f) AS n FROM f1 GROUP BY lang),
three AS (
  SELECT f3.lang, f3.w1 || ' ' || f3.w2 || ' ' || f3.w3 AS phrase, f3.f AS a, x.f AS l1, y.f AS r1, v.f AS l2, z.f AS r2,
         1000000 * f3.f::HUGEINT * f3.f // (x.f::HUGEINT * y.f) AS one, 1000000 * f3.f::HUGEINT * f3.f // (v.f::HUGEINT * z.f) AS two
  FROM f3 JOIN f1 x ON x.lang = f3.lang AND x.p = f3.w1 JOIN f2 y ON y.lang = f3.lang AND y.w1 = f3.w2 AND y.w2 = f3.w3
  JOIN f2 v ON v.lang = f3.lang AND v.w1 = f3.w1 AND v.w2 = f3.w2 JOIN f1 z ON z.lang = f3.lang AND z.p = f3.w3),
around AS (
  SELECT lang, a, b, max(f) AS most FROM (
    SELECT lang, w1 AS a, w2 AS b, f FROM f3 UNION ALL SELECT lang, w2, w3, f FROM f3) GROUP BY ALL),
scored AS (
  SELECT lang, phrase, a, CASE WHEN one <= two THEN l1 ELSE l2 END AS l, CASE WHEN one <= two THEN r1 ELSE r2 END AS r,
         least(one, two) AS score FROM three
  UNION ALL
  SELECT f2.lang, f2.w1 || ' ' || f2.w2, f2.f, x.f, y.f, 1000000 * f2.f::HUGEINT * f2.f // (x.f::HUGEINT * y.f)
  FROM f2 JOIN f1 x ON x.lang = f2.lang AND x.p = f2.w1 JOIN f1 y ON y.lang = f2.lang AND y.p = f2.w2
  LEFT JOIN around ON around.lang = f2.lang AND around.a = f2.w1 AND around.b = f2.w2
  WHERE f2.f >= 10 AND (most IS NULL OR 100 * most < 50 * f2.f)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM scored)
SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM ranked JOIN totals USING (lang) WHERE rank <= 2000""")
def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocation.collocations(read(spark, sf_dir, "documents")).drop("passage")


def periodic_digests(docs: DataFrame) -> DataFrame:
    """The digest columns of the runs of texts with planted periods."""
    found = periodic.find_runs(periodic.plant_periods(docs.select("doc_id", "text")))
    best = found.withColumn("best", periodic.greatest_run("runs"))
    listed = "array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\\n')), '')"
    return best.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.expr(listed).cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


@query("op12_periodic_runs")
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_digests(read(spark, sf_dir, "documents"))


@query("op13_topk_search", """
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM whole q, whole c WHERE q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place FROM scored)
SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score FROM ranked WHERE place <= 5""")
def op13_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_search.top_products(topk_search.quantized(read(spark, sf_dir, "embeddings")), F.col("vec_id") % 50 == 0, 5)


query("pipeline", corpus_pipeline.ORACLE_SQL)(corpus_pipeline.run)
