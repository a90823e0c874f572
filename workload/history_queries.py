"""Dimensions, history, as-of joins, facts and incremental loads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reviewflow.operators.asof import asof_left_join
from reviewflow.operators.history import empty_history, scd2_snapshot
from reviewflow.operators.merge import incremental_append, late_rows, replace_days, upsert
from reviewflow.operators.rollup import rollup_bronze
from reviewflow.plans import dims, facts, measures
from reviewflow.plans.staging import stage_reviews, with_review_date
from reviewflow.session import let_go, materialize, new_path
from reviewflow.sources.files import demo_products, first_non_empty
from workload.inputs import (
    LOAD_DATES, LOGS_SQL, REVIEWS_SQL, SNAPSHOT_TIMES, Part, bronze_log, passes, reviews, staged_folder, table,
)
from workload.registry import query
from workload.review_queries import STAGED_SQL

PRODUCT_FIELDS = ["asin", "productName", "category", "sub_category", "brand", "unitPrice", "unixReviewTime"]
STORE_FIELDS = ["storeID", "storeName", "city", "region", "storeType", "unixReviewTime"]


def staged(spark: SparkSession, sf_dir: str, fields: list[str] | None = None, part: Part | None = None) -> DataFrame:
    return stage_reviews(reviews(spark, sf_dir, fields, part))


def _history(rows: DataFrame, current, key: str, check: list[str]) -> DataFrame:
    """Snapshots after each load; a load sees all rows up to its day. Each
    snapshot but the last is stored, as it is between two daily runs."""
    states = [current(rows.where(F.col("date_id") <= F.lit(day).cast("date"))) for day in LOAD_DATES]
    history = empty_history(states[0], key, check)
    for state, moment in zip(states, SNAPSHOT_TIMES):
        history = materialize(scd2_snapshot(history, state, key, check, moment), "history")
    return scd2_snapshot(history, current(rows), key, check, SNAPSHOT_TIMES[-1])


def product_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = materialize(staged(spark, sf_dir, PRODUCT_FIELDS), "staged-products")
    return _history(rows, dims.current_products, dims.PRODUCT_KEY, dims.PRODUCT_CHECK)


def store_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = materialize(staged(spark, sf_dir, STORE_FIELDS), "staged-stores")
    return _history(rows, dims.current_stores, dims.STORE_KEY, dims.STORE_CHECK)


def _history_sql(key: str, check: list[str], name: str) -> str:
    """States after each load; a version starts where the state changes."""
    moments = list(zip([*LOAD_DATES, "9999-12-31"], SNAPSHOT_TIMES))
    attributes = ", ".join(check)
    largest = ", ".join(f"max({column}) AS {column}" for column in check)
    states = " UNION ALL ".join(
        f"SELECT {key}, TIMESTAMP '{moment}' AS as_of, {largest} FROM stg "
        f"WHERE {key} IS NOT NULL AND date_id <= DATE '{day}' GROUP BY {key}" for day, moment in moments)
    differs = " OR ".join(f"{column} IS DISTINCT FROM lag({column}) OVER w" for column in check)
    return f"""{name}_states AS ({states}),
{name}_starts AS (
  SELECT *, lag({key}) OVER w IS NULL OR {differs} AS starts
  FROM {name}_states WINDOW w AS (PARTITION BY {key} ORDER BY as_of)
),
{name}_history AS (
  SELECT {key}, {attributes}, md5({key} || '|' || CAST(as_of AS VARCHAR)) AS dbt_scd_id,
    as_of AS dbt_valid_from, lead(as_of) OVER (PARTITION BY {key} ORDER BY as_of) AS dbt_valid_to
  FROM {name}_starts WHERE starts
)"""


PRODUCT_SQL = _history_sql(dims.PRODUCT_KEY, dims.PRODUCT_CHECK, "product")
STORE_SQL = _history_sql(dims.STORE_KEY, dims.STORE_CHECK, "store")
VALID_TEXT = "CAST(dbt_valid_from AS VARCHAR) AS {0}valid_from, CAST(dbt_valid_to AS VARCHAR) AS {0}valid_to"
STATUS = "CASE WHEN dbt_valid_to IS NULL THEN 'Active' ELSE 'Expired' END AS status"


# --- dimensions -------------------------------------------------------------

@query("current_products", f"""WITH {STAGED_SQL}
SELECT product_id, max(product_name) AS product_name, max(category) AS category, max(sub_category) AS sub_category,
  max(brand) AS brand, CAST(max(unit_price) AS DOUBLE) AS unit_price
FROM stg WHERE product_id IS NOT NULL GROUP BY product_id""")
def current_products(spark, sf_dir):
    return dims.current_products(staged(spark, sf_dir, PRODUCT_FIELDS))


@query("current_stores", f"""WITH {STAGED_SQL}
SELECT store_id, max(store_name) AS store_name, max(city) AS city, max(region) AS region,
  max(store_type) AS store_type
FROM stg WHERE store_id IS NOT NULL GROUP BY store_id""")
def current_stores(spark, sf_dir):
    return dims.current_stores(staged(spark, sf_dir, STORE_FIELDS))


@query("dim_users", f"""WITH {STAGED_SQL}
SELECT user_id, max(user_name) AS user_name, count(review_id) AS total_reviews_written,
  CAST(min(date_id) AS VARCHAR) AS first_review_date, CAST(max(date_id) AS VARCHAR) AS last_review_date
FROM stg WHERE user_id IS NOT NULL GROUP BY user_id""")
def dim_users(spark, sf_dir):
    return dims.dim_users(staged(spark, sf_dir, ["reviewerID", "reviewerName", "asin", "unixReviewTime"]))


@query("dim_payments", f"""WITH {STAGED_SQL}
SELECT payment_id, max(payment_method) AS payment_method, max(payment_status) AS payment_status
FROM stg WHERE payment_id IS NOT NULL GROUP BY payment_id""")
def dim_payments(spark, sf_dir):
    return dims.dim_payments(staged(spark, sf_dir, ["paymentID", "paymentMethod", "paymentStatus"]))


@query("dim_date", f"""WITH {STAGED_SQL}
SELECT DISTINCT CAST(date_id AS VARCHAR) AS date_id, CAST(year(date_id) AS INTEGER) AS review_year,
  CAST(month(date_id) AS INTEGER) AS review_month, CAST(day(date_id) AS INTEGER) AS review_day,
  rpad(dayname(date_id), 9, ' ') AS day_of_week
FROM stg WHERE date_id IS NOT NULL""")
def dim_date(spark, sf_dir):
    return dims.dim_date(staged(spark, sf_dir, ["unixReviewTime"]))


@query("inline_products", """SELECT * FROM (VALUES
  (1, 'Laptop Dell XPS 15', 'Electronics', 1500), (2, 'Chuột Logitech G502', 'Accessories', 50),
  (3, 'Bàn phím cơ Keychron K8', 'Accessories', 100), (4, 'Màn hình LG UltraGear', 'Electronics', 350)
) t(product_id, product_name, category, price)
UNION ALL SELECT CAST(p_partkey + 5 AS INTEGER), p_name, p_type, CAST(floor(p_retailprice) AS INTEGER) FROM part""")
def inline_products(spark, sf_dir):
    """The constant rows in front of the products of the part table."""
    catalog = table(spark, sf_dir, "part").selectExpr(
        "CAST(p_partkey + 5 AS INT) AS product_id", "p_name AS product_name", "p_type AS category",
        "CAST(floor(p_retailprice) AS INT) AS price")
    return demo_products(spark).drop("created_at").unionAll(catalog)


# --- history ----------------------------------------------------------------

@query("scd2_products", f"""WITH {STAGED_SQL}, {PRODUCT_SQL}
SELECT product_id, product_name, category, sub_category, brand, CAST(unit_price AS DOUBLE) AS unit_price,
  dbt_scd_id, {VALID_TEXT.format('dbt_')} FROM product_history""")
def scd2_products(spark, sf_dir):
    return product_history(spark, sf_dir)


@query("scd2_stores", f"""WITH {STAGED_SQL}, {STORE_SQL}
SELECT store_id, store_name, city, region, store_type, dbt_scd_id, {VALID_TEXT.format('dbt_')}
FROM store_history""")
def scd2_stores(spark, sf_dir):
    return store_history(spark, sf_dir)


@query("dim_products", f"""WITH {STAGED_SQL}, {PRODUCT_SQL}
SELECT dbt_scd_id AS product_sk, product_id AS original_product_id, product_name, category, sub_category, brand,
  CAST(unit_price AS DOUBLE) AS unit_price, {VALID_TEXT.format('')}, {STATUS} FROM product_history""")
def dim_products(spark, sf_dir):
    return dims.dim_products(product_history(spark, sf_dir))


@query("dim_stores", f"""WITH {STAGED_SQL}, {STORE_SQL}
SELECT dbt_scd_id AS store_sk, store_id AS original_store_id, store_name, city, region, store_type,
  {VALID_TEXT.format('')}, {STATUS} FROM store_history""")
def dim_stores(spark, sf_dir):
    return dims.dim_stores(store_history(spark, sf_dir))


# --- facts ------------------------------------------------------------------

def product_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored product dimension, the table facts are joined to."""
    return spark.read.parquet(staged_folder(
        spark, sf_dir, "dim-products", lambda path: dims.dim_products(product_history(spark, sf_dir)).write.parquet(path)))


def store_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(staged_folder(
        spark, sf_dir, "dim-stores", lambda path: dims.dim_stores(store_history(spark, sf_dir)).write.parquet(path)))


def _asof_sql(name: str, key: str) -> str:
    return f"""LEFT JOIN {name}_history {name} ON stg.{key} = {name}.{key}
    AND stg.date_id >= CAST({name}.dbt_valid_from AS DATE)
    AND (stg.date_id < CAST({name}.dbt_valid_to AS DATE) OR {name}.dbt_valid_to IS NULL)"""


@query("asof_product", f"""WITH {STAGED_SQL}, {PRODUCT_SQL}
SELECT order_id, stg.product_id AS original_product_id, CAST(date_id AS VARCHAR) AS date_id, dbt_scd_id AS product_sk
FROM stg {_asof_sql('product', 'product_id')}""")
def asof_product(spark, sf_dir):
    fact = facts.fact_measures(staged(spark, sf_dir, ["orderID", "asin", "unixReviewTime"]))
    versions = product_versions(spark, sf_dir)
    return facts.asof_product(fact, versions)


@query("asof_store", f"""WITH {STAGED_SQL}, {STORE_SQL}
SELECT order_id, stg.store_id AS original_store_id, CAST(date_id AS VARCHAR) AS date_id, dbt_scd_id AS store_sk
FROM stg {_asof_sql('store', 'store_id')}""")
def asof_store(spark, sf_dir):
    fact = facts.fact_measures(staged(spark, sf_dir, ["orderID", "storeID", "unixReviewTime"]))
    versions = store_versions(spark, sf_dir)
    return facts.asof_store(fact, versions)


FACT_FIELDS = ["orderID", "asin", "storeID", "reviewerID", "paymentID", "shippingID", "unixReviewTime", "quantity",
               "totalAmount", "overall", "reviewText"]
FACT_SQL = f"""{STAGED_SQL}, {PRODUCT_SQL}, {STORE_SQL},
fact AS (
  SELECT order_id, product.dbt_scd_id AS product_sk, stg.product_id AS original_product_id,
    store.dbt_scd_id AS store_sk, stg.store_id AS original_store_id, user_id, payment_id, shipping_id, date_id,
    review_id, quantity, total_amount, rating_score, review_text
  FROM stg {_asof_sql('product', 'product_id')} {_asof_sql('store', 'store_id')}
)"""
FACT_TEXT = """* REPLACE (CAST(date_id AS VARCHAR) AS date_id, CAST(total_amount AS DOUBLE) AS total_amount,
  CAST(rating_score AS DOUBLE) AS rating_score)"""


def fact_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    products = product_versions(spark, sf_dir)
    stores = store_versions(spark, sf_dir)
    return facts.fact_sales(staged(spark, sf_dir, FACT_FIELDS), products, stores)


def stored_fact(spark: SparkSession, sf_dir: str, by_month: bool = False) -> DataFrame:
    """The fact on disk, by month if asked for, made in passes so that its joins do not shuffle all of it at once."""
    products, stores = product_versions(spark, sf_dir), store_versions(spark, sf_dir)
    many, path = facts.crowded(products, stores), new_path(spark, "fact")
    for part in passes(spark, sf_dir):
        rows = facts.fact_sales(staged(spark, sf_dir, FACT_FIELDS, part), products, stores, many)
        if by_month:
            rows = rows.withColumn("month_id", F.trunc("date_id", "month"))
        writer = (rows.hint("rebalance", "month_id") if by_month else rows).write.mode("append").option("compression", "zstd")
        (writer.partitionBy("month_id") if by_month else writer).parquet(path)
        let_go(spark)
    return spark.read.schema(rows.schema).parquet(path)


@query("asof_many_versions", f"""WITH {STAGED_SQL},
days AS (SELECT DISTINCT store_id, date_id FROM stg WHERE store_id IS NOT NULL AND date_id <= DATE '{LOAD_DATES[1]}'),
versions AS (SELECT store_id, date_id AS valid_from, lead(date_id) OVER (PARTITION BY store_id ORDER BY date_id) AS valid_to FROM days)
SELECT order_id, stg.store_id AS original_store_id, CAST(date_id AS VARCHAR) AS date_id,
  versions.store_id || '@' || CAST(valid_from AS VARCHAR) AS version
FROM stg LEFT JOIN versions ON stg.store_id = versions.store_id AND date_id >= valid_from
  AND (valid_to IS NULL OR date_id < valid_to)""")
def asof_many_versions(spark, sf_dir):
    """Each shipping day of a store begins a version: several hundred versions a key."""
    fact = facts.fact_measures(staged(spark, sf_dir, ["orderID", "storeID", "unixReviewTime"]))
    days = fact.where(F.col("original_store_id").isNotNull() & (F.col("date_id") <= F.lit(LOAD_DATES[1]).cast("date")))
    days = days.select("original_store_id", F.col("date_id").alias("valid_from")).distinct()
    following = F.lead("valid_from").over(Window.partitionBy("original_store_id").orderBy("valid_from"))
    versions = days.select(
        "original_store_id", "valid_from", following.alias("valid_to"),
        F.concat("original_store_id", F.lit("@"), F.col("valid_from").cast("string")).alias("version"))
    return asof_left_join(fact, versions, "original_store_id", "date_id", "original_store_id", ["version"])


@query("fact_sales_reviews", f"WITH {FACT_SQL} SELECT {FACT_TEXT} FROM fact")
def fact_sales_reviews(spark, sf_dir):
    """Joined as it is read where one pass takes it all, else stored pass by pass."""
    return fact_table(spark, sf_dir) if len(passes(spark, sf_dir)) == 1 else stored_fact(spark, sf_dir)


@query("fact_sales_incremental", f"""WITH {FACT_SQL},
existing AS (SELECT * FROM fact WHERE date_id <= DATE '{LOAD_DATES[2]}'),
fresh AS (SELECT * FROM fact
  WHERE date_id >= (SELECT coalesce(max(date_id), DATE '1900-01-01') FROM existing)),
merged AS (
  SELECT * FROM existing WHERE order_id NOT IN (SELECT order_id FROM fresh)
  UNION ALL SELECT * FROM fresh
)
SELECT {FACT_TEXT} FROM merged""")
def fact_sales_incremental(spark, sf_dir):
    """The fact as of the third load, brought up to date with all rows."""
    everything = stored_fact(spark, sf_dir)
    existing = everything.where(F.col("date_id") <= F.lit(LOAD_DATES[2]).cast("date"))
    return facts.fact_sales_incremental(existing, everything, len(passes(spark, sf_dir)))


@query("fact_replace_days", f"""WITH {FACT_SQL},
existing AS (SELECT * FROM fact WHERE date_id <= DATE '{LOAD_DATES[2]}'),
keys AS (SELECT DISTINCT order_id FROM fact
  WHERE date_id >= (SELECT coalesce(date_trunc('month', max(date_id)), DATE '1900-01-01') FROM existing)),
merged AS (
  SELECT * FROM existing WHERE order_id NOT IN (SELECT order_id FROM keys)
  UNION ALL SELECT * FROM fact WHERE order_id IN (SELECT order_id FROM keys)
)
SELECT {FACT_TEXT} FROM merged""")
def fact_replace_days(spark, sf_dir):
    """The table on disk, here by month, brought up to date in place, and once more, which changes nothing."""
    everything = stored_fact(spark, sf_dir, by_month=True)
    path = new_path(spark, "fact-months")
    existing = everything.where(F.col("date_id") <= F.lit(LOAD_DATES[2]).cast("date"))
    # Its files have one month each, so they are written as they are, without another shuffle.
    existing.write.option("compression", "zstd").partitionBy("month_id").parquet(path)
    for _ in range(2):
        replace_days(path, everything, "order_id", "month_id", whole_keys=True)
    return spark.read.parquet(path).drop("month_id")


BI_FIELDS = ["storeID", "totalAmount", "overall"]


def bi_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fact columns of the reports; they need no surrogate key."""
    return facts.fact_measures(staged(spark, sf_dir, BI_FIELDS))


@query("fact_with_fallback", f"""WITH {STAGED_SQL}
SELECT store_id AS original_store_id, count(*) AS orders, CAST(sum(total_amount) AS DOUBLE) AS revenue
FROM stg GROUP BY store_id""")
def fact_with_fallback(spark, sf_dir):
    """The incremental fact before its first load is empty, so the full one is read."""
    gold = facts.fact_measures(staged(spark, sf_dir, ["storeID", "totalAmount", "unixReviewTime"]))
    platinum = gold.where(F.col("date_id") < F.lit("1900-01-01").cast("date"))
    return first_non_empty(platinum, gold).groupBy("original_store_id").agg(
        F.count("*").alias("orders"), F.sum("total_amount").alias("revenue"))


@query("fact_before_fallback", f"""WITH {STAGED_SQL}
SELECT store_id AS original_store_id, count(*) AS orders, CAST(sum(total_amount) AS DOUBLE) AS revenue
FROM stg WHERE date_id <= DATE '{LOAD_DATES[0]}' GROUP BY store_id""")
def fact_before_fallback(spark, sf_dir):
    """The incremental fact after its first load is not empty, so it is read and the full one is not."""
    gold = facts.fact_measures(staged(spark, sf_dir, ["storeID", "totalAmount", "unixReviewTime"]))
    platinum = gold.where(F.col("date_id") <= F.lit(LOAD_DATES[0]).cast("date"))
    return first_non_empty(platinum, gold).groupBy("original_store_id").agg(
        F.count("*").alias("orders"), F.sum("total_amount").alias("revenue"))


@query("executive_kpis", f"""WITH {STAGED_SQL}
SELECT CAST(sum(total_amount) AS DOUBLE) AS total_revenue, count(*) AS total_orders,
  avg(CAST(rating_score AS DOUBLE)) AS avg_rating FROM stg""")
def executive_kpis(spark, sf_dir):
    return measures.executive_kpis(bi_fact(spark, sf_dir))


@query("revenue_by_store", f"""WITH {STAGED_SQL}
SELECT store_id AS original_store_id, CAST(sum(total_amount) AS DOUBLE) AS revenue FROM stg GROUP BY store_id""")
def revenue_by_store(spark, sf_dir):
    return measures.revenue_by_store(bi_fact(spark, sf_dir))


@query("rating_distribution", f"""WITH {STAGED_SQL}
SELECT CAST(round(rating_score, 0) AS INTEGER) AS rounded_rating, count(*) AS reviews FROM stg GROUP BY 1""")
def rating_distribution(spark, sf_dir):
    return measures.rating_distribution(bi_fact(spark, sf_dir))


# --- incremental loads ------------------------------------------------------

SILVER_FIELDS = ["orderID", "asin", "storeID", "overall", "unixReviewTime"]


@query("incremental_load", f"""WITH {REVIEWS_SQL} SELECT "orderID", asin, "storeID", overall, "unixReviewTime"
FROM reviews""")
def incremental_load(spark, sf_dir):
    """A target filled up to the third load receives what is newer."""
    silver = with_review_date(reviews(spark, sf_dir, SILVER_FIELDS))
    target = new_path(spark, "warehouse")
    first = silver.where(F.col("review_date") <= F.lit(LOAD_DATES[2]).cast("date"))
    first.drop("review_date").write.parquet(target)
    loaded = spark.read.parquet(target).agg(F.coalesce(F.max("unixReviewTime"), F.lit(0))).first()[0]
    incremental_append(
        silver, loaded, lambda rows: rows.drop("review_date").write.mode("append").parquet(target),
        "unixReviewTime", "review_date")
    return spark.read.parquet(target)


@query("incremental_load_late", f"""WITH {REVIEWS_SQL} SELECT "orderID", asin, "storeID", overall, "unixReviewTime"
FROM reviews""")
def incremental_load_late(spark, sf_dir):
    """Some orders of the last sixty days before the load come after it; the load finds them and what is newer."""
    silver = with_review_date(reviews(spark, sf_dir, SILVER_FIELDS))
    target, last = new_path(spark, "warehouse"), F.lit(LOAD_DATES[2]).cast("date")
    late = (F.col("review_date") > F.date_sub(last, 60)) & F.col("orderID").endswith("7")
    silver.where((F.col("review_date") <= last) & ~late).drop("review_date").write.parquet(target)
    have = spark.read.parquet(target)
    loaded = have.agg(F.coalesce(F.max("unixReviewTime"), F.lit(0))).first()[0]
    missed = materialize(late_rows(silver, have, "unixReviewTime", loaded, 61 * 86_400, SILVER_FIELDS), "late")
    missed.drop("review_date").write.mode("append").parquet(target)
    incremental_append(
        silver, loaded, lambda rows: rows.drop("review_date").write.mode("append").parquet(target),
        "unixReviewTime", "review_date")
    return spark.read.parquet(target)


@query("metrics_upsert", f"""WITH {LOGS_SQL} SELECT CAST("timestamp" AS VARCHAR) AS "timestamp", total_received,
  valid_records, invalid_records, error_rate_percent FROM bronze_metrics""")
def metrics_upsert(spark, sf_dir):
    """Metrics of the first half of the month, then the complete ones over them."""
    log = bronze_log(spark, sf_dir)
    early = rollup_bronze(log.where(F.col("timestamp") < "2024-01-15T10:30:30"))
    return upsert(early, rollup_bronze(log), "timestamp")
