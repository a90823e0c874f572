"""Parsing, validation, projection, search, business measures, rankings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewflow.functions.quality import is_invalid, required_fields_present
from reviewflow.functions.reviews import review_id
from reviewflow.functions.search import search_rows
from reviewflow.operators.profile import dlq_alert, dlq_root_cause, null_profile
from reviewflow.operators.ranking import FEED_COLUMNS, FEED_ROWS, feed, latest_row, latest_rows, top_products
from reviewflow.operators.routing import batch_quality, mark_route, parse_reviews, route
from reviewflow.operators.sequence import rolling_mean, with_sequence
from reviewflow.operators.shape import check_columns, safe_rating_rows, select_existing, table_audit
from reviewflow.operators.trace import trace_marked
from reviewflow.plans import measures
from reviewflow.plans.staging import stage_reviews, with_review_date
from workload.inputs import FIELDS, INVALID_SQL, PARSED_SQL, REVIEWS_SQL, messages, reviews, table
from workload.registry import query

KEYS = ["reviewerID", "asin", "overall", "unixReviewTime", "orderID"]
KEYS_SQL = '"reviewerID", asin, overall, "unixReviewTime", "orderID"'
RATED_SQL = f"WITH {REVIEWS_SQL}, rated AS (SELECT * FROM reviews WHERE overall IS NOT NULL)"

CHECKED = ["reviewerID", "asin", "overall"]
SCALARS = [name for name in FIELDS if name != "helpful"]


@query("parse_json", f"""WITH {PARSED_SQL}
SELECT {', '.join(f'"{name}"' for name in SCALARS)}, helpful_0, helpful_1, is_broken FROM parsed""")
def parse_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = parse_reviews(messages(spark, sf_dir))
    return parsed.select(
        *SCALARS, F.col("helpful")[0].alias("helpful_0"), F.col("helpful")[1].alias("helpful_1"),
        F.col("raw_json").startswith("not json").alias("is_broken"))


@query("dq_invalid", f"WITH {REVIEWS_SQL} SELECT {KEYS_SQL} FROM reviews WHERE {INVALID_SQL}")
def dq_invalid(spark, sf_dir):
    return reviews(spark, sf_dir, KEYS).where(is_invalid())


@query("dq_valid", f"WITH {REVIEWS_SQL} SELECT {KEYS_SQL} FROM reviews WHERE NOT {INVALID_SQL}")
def dq_valid(spark, sf_dir):
    return reviews(spark, sf_dir, KEYS).where(~is_invalid())


@query("dq_required", f"""WITH {REVIEWS_SQL} SELECT {KEYS_SQL} FROM reviews
WHERE "reviewerID" IS NOT NULL AND asin IS NOT NULL AND overall IS NOT NULL""")
def dq_required(spark, sf_dir):
    return reviews(spark, sf_dir, KEYS).where(required_fields_present())


@query("route_counts", f"""WITH {PARSED_SQL}
SELECT CASE WHEN {INVALID_SQL} THEN 'dlq' ELSE 'bronze' END AS route, count(*) AS n,
  count(CASE WHEN {INVALID_SQL} THEN 1 END) AS with_raw
FROM parsed GROUP BY 1""")
def route_counts(spark, sf_dir):
    routed = mark_route(parse_reviews(messages(spark, sf_dir), fields=CHECKED))
    return routed.groupBy("route").agg(F.count("*").alias("n"), F.count("raw_json").alias("with_raw"))


@query("review_date", f"""WITH {REVIEWS_SQL}
SELECT "orderID", "unixReviewTime", CAST(CAST(to_timestamp("unixReviewTime") AT TIME ZONE 'UTC' AS DATE) AS VARCHAR)
  AS review_date FROM reviews""")
def review_date(spark, sf_dir):
    return with_review_date(reviews(spark, sf_dir, ["orderID", "unixReviewTime"]))


STAGED_SQL = f"""{REVIEWS_SQL},
stg AS (
  SELECT "orderID" AS order_id, "productName" AS product_name, category, sub_category, brand,
    CAST("unitPrice" AS DECIMAL(10,2)) AS unit_price, quantity,
    CAST("totalAmount" AS DECIMAL(12,2)) AS total_amount,
    "storeID" AS store_id, "storeName" AS store_name, city, region, "storeType" AS store_type,
    "paymentID" AS payment_id, "paymentMethod" AS payment_method, "paymentStatus" AS payment_status,
    "shippingID" AS shipping_id, "shippingMethod" AS shipping_method, "carrierName" AS carrier_name,
    "shippingStatus" AS shipping_status,
    md5(coalesce("reviewerID", '') || coalesce(asin, '') || CAST("unixReviewTime" AS VARCHAR)) AS review_id,
    "reviewerID" AS user_id, "reviewerName" AS user_name, asin AS product_id,
    CAST(to_timestamp("unixReviewTime") AT TIME ZONE 'UTC' AS DATE) AS date_id,
    CAST(overall AS DECIMAL(3,1)) AS rating_score, "reviewText" AS review_text
  FROM reviews
)"""


@query("stg_reviews", f"""WITH {STAGED_SQL}
SELECT * REPLACE (CAST(unit_price AS DOUBLE) AS unit_price, CAST(total_amount AS DOUBLE) AS total_amount,
  CAST(rating_score AS DOUBLE) AS rating_score, CAST(date_id AS VARCHAR) AS date_id) FROM stg""")
def stg_reviews(spark, sf_dir):
    return stage_reviews(reviews(spark, sf_dir))


@query("review_id", f"WITH {STAGED_SQL} SELECT order_id, review_id FROM stg")
def review_id_query(spark, sf_dir):
    rows = reviews(spark, sf_dir, ["orderID", "reviewerID", "asin", "unixReviewTime"])
    return rows.select(F.col("orderID").alias("order_id"), review_id().alias("review_id"))


@query("safe_cast", """SELECT event_id, TRY_CAST(props AS DOUBLE) AS from_text,
  TRY_CAST(substr(props, 7, 2) AS DOUBLE) AS overall
FROM events WHERE TRY_CAST(substr(props, 7, 2) AS DOUBLE) IS NOT NULL""")
def safe_cast(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select(
        "event_id", F.col("props").try_cast("double").alias("from_text"),
        F.substring("props", 7, 2).alias("overall"))
    return safe_rating_rows(rows)


@query("sentiment", f"""{RATED_SQL} SELECT "orderID", overall,
  CASE WHEN overall >= 4 THEN 'positive' WHEN overall = 3 THEN 'neutral' ELSE 'negative' END AS sentiment
FROM rated""")
def sentiment_query(spark, sf_dir):
    return measures.with_sentiment(safe_rating_rows(reviews(spark, sf_dir, ["orderID", "overall"])))


@query("feed_columns", f'WITH {REVIEWS_SQL} SELECT asin AS product, overall, "reviewerName", summary FROM reviews')
def feed_columns(spark, sf_dir):
    rows = reviews(spark, sf_dir, ["asin", "overall", "reviewerName", "summary", "orderID"])
    return select_existing(rows, FEED_COLUMNS, rename={"asin": "product"})


@query("schema_check", """SELECT * REPLACE (CAST(ts AS VARCHAR) AS ts), 'overall' AS missing,
  'event_id,ts,user_id,event_type,value,props' AS present FROM events ORDER BY event_id LIMIT 3""")
def schema_check(spark, sf_dir):
    """Events lack a rating: the missing and present columns next to a peek."""
    missing, present, peek = check_columns(table(spark, sf_dir, "events").orderBy("event_id"), ["overall"])
    return peek.withColumns({"missing": F.lit(",".join(missing)), "present": F.lit(",".join(present))})


@query("search_all_columns", """SELECT event_id, event_type, value, props FROM events
WHERE regexp_matches(event_id || ' ' || ts || ' ' || user_id || ' ' || event_type || ' ' || value || ' ' || props,
  '(?i)(ERROR 1|-0[12] .* 1[0-9]? click)')""")
def search_all_columns(spark, sf_dir):
    found = search_rows(table(spark, sf_dir, "events"), "(ERROR 1|-0[12] .* 1[0-9]? click)")
    return found.select("event_id", "event_type", "value", "props")


@query("search_string_columns", """SELECT doc_id, lang, source, length(text) AS n_text FROM documents
WHERE regexp_matches(coalesce(text, '') || ' ' || coalesce(lang, '') || ' ' || coalesce(source, ''), '(?i)licen[sc]e')""")
def search_string_columns(spark, sf_dir):
    found = search_rows(table(spark, sf_dir, "documents"), "licen[sc]e", string_only=True, null_text="")
    return found.select("doc_id", "lang", "source", F.length("text").cast("bigint").alias("n_text"))


FEED_ORDER_SQL = """"unixReviewTime" DESC, "orderID", asin NULLS LAST, summary, "reviewText", "reviewerName" """
FEED_SQL = 'asin, overall, "reviewerName", summary, "reviewText"'


def _feed_rows(spark, sf_dir):
    return safe_rating_rows(reviews(spark, sf_dir, [*FEED_COLUMNS, "unixReviewTime", "orderID"]))


def _feed_order():
    return [F.desc("unixReviewTime"), F.asc("orderID"), F.asc_nulls_last("asin"), F.asc("summary"),
            F.asc("reviewText"), F.asc("reviewerName")]


@query("feed_negative", f"{RATED_SQL} SELECT {FEED_SQL} FROM rated WHERE overall <= 2")
def feed_negative(spark, sf_dir):
    return feed(_feed_rows(spark, sf_dir), "negative", _feed_order())


@query("feed_positive", f"""{RATED_SQL} SELECT {FEED_SQL} FROM rated WHERE overall >= 4
ORDER BY {FEED_ORDER_SQL} LIMIT {FEED_ROWS}""")
def feed_positive(spark, sf_dir):
    return feed(_feed_rows(spark, sf_dir), "positive", _feed_order())


@query("feed_all", f"{RATED_SQL} SELECT {FEED_SQL} FROM rated ORDER BY {FEED_ORDER_SQL} LIMIT {FEED_ROWS}")
def feed_all(spark, sf_dir):
    return feed(_feed_rows(spark, sf_dir), "all", _feed_order())


@query("record_trace", f"""WITH {PARSED_SQL},
seen AS (
  SELECT unnest(["reviewerID", asin]) AS id, "orderID" AS payload, {INVALID_SQL} AS rejected FROM parsed
),
found AS (
  SELECT id, bool_or(rejected) AS in_dlq, min(payload) AS raw_payload,
    min(CASE WHEN rejected THEN payload END) AS dlq_payload
  FROM seen WHERE id IS NOT NULL GROUP BY id
)
, ids AS (
  SELECT c_name AS id FROM customer UNION SELECT 'nobody ' || c_custkey FROM customer
  UNION SELECT 'B0' || lpad(CAST(p_partkey AS VARCHAR), 12, '0') FROM part
)
SELECT id, in_dlq IS NOT NULL AS in_raw, coalesce(in_dlq, FALSE) AS in_dlq,
  CASE WHEN in_dlq IS NULL THEN 'missing' ELSE 'received' END AS ingestion,
  CASE WHEN in_dlq IS NULL THEN 'waiting' WHEN in_dlq THEN 'rejected' ELSE 'clean' END AS bronze,
  CASE WHEN in_dlq IS NULL THEN 'waiting' WHEN in_dlq THEN 'blocked' ELSE 'stored' END AS silver,
  CASE WHEN in_dlq IS NULL OR in_dlq THEN 'not ready' ELSE 'pending' END AS gold,
  coalesce(dlq_payload, raw_payload) AS payload
FROM ids LEFT JOIN found USING (id)""")
def record_trace(spark, sf_dir):
    """Every customer and product, and as many ids that no message has."""
    customers, parts = table(spark, sf_dir, "customer"), table(spark, sf_dir, "part")
    ids = customers.select(F.col("c_name").alias("id")).union(
        customers.select(F.concat(F.lit("nobody "), F.col("c_custkey").cast("string")))).union(
        parts.select(F.concat(F.lit("B0"), F.lpad(F.col("p_partkey").cast("string"), 12, "0"))))
    parsed = parse_reviews(messages(spark, sf_dir), fields=[*CHECKED, "orderID"])
    return trace_marked(ids, parsed, is_invalid(), payload="orderID")


# --- measures ---------------------------------------------------------------

@query("batch_kpis", f"""WITH {REVIEWS_SQL}
SELECT count(*) AS total_reviews, round(coalesce(avg(overall), 0), 2) AS avg_rating,
  count(CASE WHEN overall >= 4 THEN 1 END) AS positive_count,
  count(CASE WHEN overall <= 2 THEN 1 END) AS negative_count
FROM reviews WHERE NOT {INVALID_SQL}""")
def batch_kpis(spark, sf_dir):
    return measures.batch_kpis(reviews(spark, sf_dir, ["reviewerID", "asin", "overall"]).where(~is_invalid()))


@query("batch_quality", f"""WITH {PARSED_SQL}
SELECT count(*) AS total_received, count(CASE WHEN NOT {INVALID_SQL} THEN 1 END) AS valid_records,
  count(CASE WHEN {INVALID_SQL} THEN 1 END) AS invalid_records,
  round(count(CASE WHEN {INVALID_SQL} THEN 1 END) / count(*) * 100, 2) AS error_rate_percent,
  count(CASE WHEN {INVALID_SQL} THEN 1 END) / count(*) < CAST(0.2 AS DOUBLE) AS is_acceptable
FROM parsed""")
def batch_quality_query(spark, sf_dir):
    return batch_quality(mark_route(parse_reviews(messages(spark, sf_dir), fields=CHECKED)))


@query("ingest_stats", """SELECT source, count(*) AS messages, CAST(sum(strlen(text)) AS BIGINT) AS total_bytes,
  CAST(sum(strlen(text)) AS DOUBLE) / count(text) AS avg_bytes, CAST(max(strlen(text)) AS BIGINT) AS max_bytes
FROM documents GROUP BY source""")
def ingest_stats(spark, sf_dir):
    return measures.ingest_stats(table(spark, sf_dir, "documents"), "text", "source")


@query("business_kpis", f"""{RATED_SQL}
SELECT count(*) AS total_reviews, avg(overall) AS avg_rating,
  count(CASE WHEN overall >= 4 THEN 1 END) / count(*) * 100 AS positive_percent,
  count(CASE WHEN overall <= 2 THEN 1 END) AS negative_count,
  avg(overall) - CAST(3.5 AS DOUBLE) AS delta_to_benchmark
FROM rated""")
def business_kpis(spark, sf_dir):
    return measures.business_kpis(safe_rating_rows(reviews(spark, sf_dir, ["overall"])))


@query("sentiment_share", f"""{RATED_SQL}
SELECT CASE WHEN overall >= 4 THEN 'positive' WHEN overall = 3 THEN 'neutral' ELSE 'negative' END AS sentiment,
  count(*) AS reviews FROM rated GROUP BY 1""")
def sentiment_share(spark, sf_dir):
    return measures.sentiment_share(safe_rating_rows(reviews(spark, sf_dir, ["overall"])))


@query("null_profile", f"""WITH {PARSED_SQL}, dlq AS (SELECT * FROM parsed WHERE {INVALID_SQL}),
counts AS (
  """ + "\n  UNION ALL ".join(
    f"SELECT '{name}' AS column_name, count(*) - count(\"{name if name != 'helpful' else 'helpful_0'}\")"
    f" AS null_count FROM dlq" for name in FIELDS) + """
)
SELECT column_name, null_count FROM counts WHERE null_count > 0""")
def null_profile_query(spark, sf_dir):
    _, rejected = route(parse_reviews(messages(spark, sf_dir)))
    return null_profile(rejected)


DLQ_SQL = f"""WITH {PARSED_SQL}, causes AS (
  SELECT count(*) AS total_rejected, count(*) - count("reviewerID") AS "missing_reviewerID",
    count(*) - count(asin) AS missing_asin, count(*) - count(overall) AS missing_overall
  FROM parsed WHERE {INVALID_SQL}
)"""


@query("dlq_root_cause", f"{DLQ_SQL} SELECT * FROM causes")
def dlq_root_cause_query(spark, sf_dir):
    return dlq_root_cause(route(parse_reviews(messages(spark, sf_dir), fields=CHECKED))[1])


@query("dlq_alert", f"""{DLQ_SQL}
SELECT *, 'reviewerID: ' || "missing_reviewerID" || '; asin: ' || missing_asin || '; overall: ' || missing_overall
    AS causes, 'on-call' AS recipients
FROM causes WHERE total_rejected > 0""")
def dlq_alert_query(spark, sf_dir):
    return dlq_alert(route(parse_reviews(messages(spark, sf_dir), fields=CHECKED))[1], "on-call")


@query("table_audit", """SELECT count(*) AS row_count, 11 AS column_count,
  'l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, '
  'l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz' AS schema_ddl FROM lineitem""")
def table_audit_query(spark, sf_dir):
    return table_audit(table(spark, sf_dir, "lineitem"))


# --- order ------------------------------------------------------------------

@query("row_number", """SELECT event_id, event_type,
  row_number() OVER (ORDER BY ts, event_id) AS seq FROM events""")
def row_number(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_id", "event_type", "ts")
    return with_sequence(rows, ["ts", "event_id"]).drop("ts")


ROLLING_FIELDS = ["unixReviewTime", "orderID", "asin", "storeID", "totalAmount", "overall"]
ROLLING_ORDER_SQL = """"unixReviewTime" NULLS FIRST, "orderID" NULLS FIRST, asin NULLS FIRST,
    "storeID" NULLS FIRST, "totalAmount" NULLS FIRST, overall NULLS FIRST"""


@query("rolling_rating", f"""{RATED_SQL}
SELECT "orderID", asin, "storeID", overall, row_number() OVER w AS seq,
  avg(overall) OVER (w ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS rolling_avg
FROM rated WINDOW w AS (ORDER BY {ROLLING_ORDER_SQL})""")
def rolling_rating(spark, sf_dir):
    rows = safe_rating_rows(reviews(spark, sf_dir, ROLLING_FIELDS))
    rolled = rolling_mean(rows, "overall", ROLLING_FIELDS, n=20)
    return rolled.select("orderID", "asin", "storeID", "overall", "seq", "rolling_avg")


@query("rolling_rating_by_store", f"""{RATED_SQL}
SELECT "orderID", asin, "storeID", overall,
  avg(overall) OVER (PARTITION BY "storeID" ORDER BY {ROLLING_ORDER_SQL}
    ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS rolling_avg
FROM rated""")
def rolling_rating_by_store(spark, sf_dir):
    rows = safe_rating_rows(reviews(spark, sf_dir, ROLLING_FIELDS))
    rolled = rolling_mean(rows, "overall", ROLLING_FIELDS, n=20, by=["storeID"])
    return rolled.select("orderID", "asin", "storeID", "overall", "rolling_avg")


@query("top_products", f"""{RATED_SQL} SELECT asin, count(*) AS mentions FROM rated
GROUP BY asin ORDER BY mentions DESC, asin NULLS FIRST LIMIT 10""")
def top_products_query(spark, sf_dir):
    return top_products(safe_rating_rows(reviews(spark, sf_dir, ["asin", "overall"])))


LATEST = ["unixReviewTime", "orderID", "asin", "storeID", "totalAmount"]
LATEST_SQL = '"unixReviewTime", "orderID", asin, "storeID", "totalAmount"'
LATEST_ORDER_SQL = ", ".join(f'"{name}" DESC NULLS LAST' for name in LATEST)


@query("latest_rows", f"WITH {REVIEWS_SQL} SELECT {LATEST_SQL} FROM reviews ORDER BY {LATEST_ORDER_SQL} LIMIT 1000")
def latest_rows_query(spark, sf_dir):
    return latest_rows(reviews(spark, sf_dir, LATEST), 1000, LATEST)


@query("latest_rows_10000", f"WITH {REVIEWS_SQL} SELECT {LATEST_SQL} FROM reviews ORDER BY {LATEST_ORDER_SQL} LIMIT 10000")
def latest_rows_10000(spark, sf_dir):
    return latest_rows(reviews(spark, sf_dir, LATEST), 10_000, LATEST)


@query("row_number_of_ties", """SELECT l_returnflag, max(seq) - min(seq) + 1 = count(*) AS together, count(DISTINCT seq) AS n,
  min(seq) AS first_seq FROM (SELECT l_returnflag, row_number() OVER (ORDER BY l_returnflag) AS seq FROM lineitem) GROUP BY 1""")
def row_number_of_ties(spark, sf_dir):
    """Three order keys for the whole table; each has its stretch of numbers."""
    numbered = with_sequence(table(spark, sf_dir, "lineitem"), ["l_returnflag"])
    return numbered.groupBy("l_returnflag").agg(
        (F.max("seq") - F.min("seq") + 1 == F.count("*")).alias("together"), F.countDistinct("seq").alias("n"),
        F.min("seq").alias("first_seq"))


@query("latest_row", "SELECT event_id, event_type, value FROM events ORDER BY ts DESC, event_id DESC LIMIT 1")
def latest_row_query(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_id", "event_type", "value", "ts")
    return latest_row(rows, "ts", "event_id").drop("ts")
