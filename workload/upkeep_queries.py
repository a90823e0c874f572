"""Row-level reconciliation, self-maintained dimensions, lookup of a few records by file index."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewflow.functions.quality import is_invalid
from reviewflow.operators.file_index import candidate_files, read_index, update_index
from reviewflow.operators.routing import parse_reviews
from reviewflow.operators.row_reconcile import differing_cells, fingerprints, merge_fingerprints, reconcile_rows
from reviewflow.operators.text_index import search_files, update_text_index
from reviewflow.operators.trace import trace_marked
from reviewflow.plans.staging import with_review_date
from reviewflow.plans.state import refresh_states
from reviewflow.session import materialize, new_path
from reviewflow.sources.loads import append_load
from workload.flow_queries import KEYS, KEYS_SQL, silver_folder
from workload.inputs import LOAD_DATES, REVIEWS_SQL, message_folder, reviews, staged_folder, table
from workload.registry import ORACLES, query
from workload.review_queries import CHECKED

# --- reconciliation down to rows --------------------------------------------

# What is wrong with the second table: rows lost in one month, changed in another, repeated in a third.
_ORDER = "CAST(substr(`orderID`, 5) AS BIGINT)"
_LOST = f"{_ORDER} % 3 = 0 AND review_date BETWEEN DATE '1995-03-01' AND DATE '1995-03-31'"
_CHANGED = f"{_ORDER} % 5 = 0 AND review_date BETWEEN DATE '1996-07-01' AND DATE '1996-07-31'"
_REPEATED = f"{_ORDER} % 7 = 0 AND review_date BETWEEN DATE '1997-11-01' AND DATE '1997-11-30'"

_TABLES_SQL = f"""WITH {REVIEWS_SQL},
bronze AS (SELECT {KEYS_SQL}, CAST(to_timestamp("unixReviewTime") AT TIME ZONE 'UTC' AS DATE) AS review_date FROM reviews),
changed AS (
  SELECT * REPLACE (CASE WHEN {_CHANGED} THEN NULL ELSE "totalAmount" END AS "totalAmount") FROM bronze WHERE NOT coalesce({_LOST}, FALSE)),
silver AS (SELECT * FROM changed UNION ALL SELECT * FROM changed WHERE {_REPEATED})""".replace("`", '"')


def two_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    bronze = spark.read.parquet(silver_folder(spark, sf_dir)).select(*KEYS, "review_date")
    amount = F.when(~F.coalesce(F.expr(_CHANGED), F.lit(False)), F.col("totalAmount"))
    silver = bronze.where(~F.coalesce(F.expr(_LOST), F.lit(False))).withColumn("totalAmount", amount)
    return bronze, silver.union(silver.where(_REPEATED))


@query("reconcile_rows", f"""{_TABLES_SQL}
SELECT {KEYS_SQL}, CAST(review_date AS VARCHAR) AS review_date, CAST(sum(b) AS BIGINT) AS n_left, CAST(sum(s) AS BIGINT) AS n_right
FROM (SELECT *, 1 AS b, 0 AS s FROM bronze UNION ALL SELECT *, 0, 1 FROM silver) GROUP BY ALL HAVING sum(b) <> sum(s)""")
def reconcile_rows_query(spark, sf_dir):
    """The rows that differ, each with how often both tables have it."""
    return reconcile_rows(*two_tables(spark, sf_dir), KEYS, "review_date")


@query("reconcile_days", f"""{_TABLES_SQL},
counted AS (
  SELECT {KEYS_SQL}, review_date, sum(b) AS b, sum(s) AS s
  FROM (SELECT *, 1 AS b, 0 AS s FROM bronze UNION ALL SELECT *, 0, 1 FROM silver) GROUP BY ALL)
SELECT CAST(review_date AS VARCHAR) AS day, CAST(sum(b) AS BIGINT) AS n_left, CAST(sum(s) AS BIGINT) AS n_right
FROM counted GROUP BY review_date HAVING bool_or(b <> s)""")
def reconcile_days(spark, sf_dir):
    """Days that differ, from fingerprints of the loads added up."""
    bronze, silver = two_tables(spark, sf_dir)
    sums = [merge_fingerprints(*(fingerprints(part, KEYS, "review_date") for part in (
        rows.where(F.col("review_date") <= LOAD_DATES[1]), rows.where(~F.coalesce(F.col("review_date") <= LOAD_DATES[1], F.lit(False))))))
        for rows in (bronze, silver)]
    cells = differing_cells(*sums)
    both = [rows.groupBy("day").agg(F.sum("n").alias(name)) for rows, name in zip(sums, ("n_left", "n_right"))]
    days = cells.select("day").distinct().alias("d")
    for rows, name in zip(both, ("l", "r")):
        days = days.join(rows.alias(name), F.col("d.day").eqNullSafe(F.col(f"{name}.day")), "left")
    return days.select("d.day", F.coalesce("n_left", F.lit(0)).alias("n_left"), F.coalesce("n_right", F.lit(0)).alias("n_right"))


# --- dimensions kept up to date ----------------------------------------------

STATE_FIELDS = [
    "reviewerID", "reviewerName", "asin", "overall", "unixReviewTime", "productName", "category", "sub_category", "brand", "unitPrice",
    "storeID", "storeName", "city", "region", "storeType", "paymentID", "paymentMethod", "paymentStatus"]


def states_after_loads(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Four loads reach silver one after another; the states follow each."""
    silver, root = new_path(spark, "loads"), new_path(spark, "states")
    loaded = F.lit(len(LOAD_DATES))
    for number, day in reversed(list(enumerate(LOAD_DATES))):
        loaded = F.when(F.col("review_date") <= day, number).otherwise(loaded)
    rows = with_review_date(reviews(spark, sf_dir, STATE_FIELDS)).withColumn("month", F.date_format("review_date", "yyyy-MM"))
    # A folder for each load, so that none reads the rows of the others.
    rows = materialize(rows.withColumn("loaded", loaded), "by-load", ["loaded"])
    states = {}
    for number in range(len(LOAD_DATES) + 1):
        part = rows.where(F.col("loaded") == number).drop("loaded")
        append_load(part, silver, f"run-{number}", "month")
        states = refresh_states(spark, silver, root)
    return states


@query("dim_users_incremental", ORACLES["dim_users"])
def dim_users_incremental(spark, sf_dir):
    return states_after_loads(spark, sf_dir)["dim_users"]


@query("current_products_incremental", ORACLES["current_products"])
def current_products_incremental(spark, sf_dir):
    return states_after_loads(spark, sf_dir)["current_products"]


# --- a few records by file index ----------------------------------------------

@query("record_lookup", ORACLES["record_trace"].split(", ids AS (")[0] + """, ids AS (
  SELECT max(c_name) AS id FROM customer UNION SELECT min(c_name) FROM customer UNION SELECT 'nobody'
  UNION SELECT 'B0' || lpad(CAST(max(p_partkey) AS VARCHAR), 12, '0') FROM part
)""" + ORACLES["record_trace"].split(", ids AS (")[1].split("FROM part\n)", 1)[1])
def record_lookup(spark, sf_dir):
    """The first and last customer, the last product and an id that no message has, read from the files that may hold them."""
    customers, parts = table(spark, sf_dir, "customer"), table(spark, sf_dir, "part")
    ids = customers.select(F.explode(F.array(F.max("c_name"), F.min("c_name"), F.lit("nobody"))).alias("id")).union(
        parts.select(F.concat(F.lit("B0"), F.lpad(F.max("p_partkey").cast("string"), 12, "0"))))
    folder, index = message_folder(spark, sf_dir), new_path(spark, "file-index")

    def read(files: list[str]) -> DataFrame:
        return parse_reviews(spark.read.text(files), fields=[*CHECKED, "orderID"])

    update_index(spark, index, folder, read, pattern="*.txt*")
    files = candidate_files(ids, read_index(spark, index))
    # Without any such file the schema alone is needed.
    rows = read(files) if files else parse_reviews(spark.createDataFrame([], "value string"), fields=[*CHECKED, "orderID"])
    return trace_marked(ids, rows, is_invalid(), payload="orderID")


# --- keyword search by text index ---------------------------------------------

@query("search_indexed", """SELECT event_id, event_type, value, props FROM events
WHERE regexp_matches(event_id || ' ' || ts || ' ' || user_id || ' ' || event_type || ' ' || value || ' ' || props,
  '(?i)(2024-01-0[23] .* ERROR 1|2024-01-15 1.*click)')""")
def search_indexed(spark, sf_dir):
    """Errors of two days and clicks of one morning, read from the files that may hold them."""
    events = table(spark, sf_dir, "events")
    folder = staged_folder(spark, sf_dir, "events-by-time", lambda path: events.repartitionByRange("ts").write.parquet(path))
    index = new_path(spark, "text-index")

    def read(files: list[str]) -> DataFrame:
        return spark.read.schema(events.schema).parquet(*files) if files else events.limit(0)

    update_text_index(spark, index, folder, read, pattern="*.parquet")
    found = search_files(spark, index, folder, read, "(2024-01-0[23] .* ERROR 1|2024-01-15 1.*click)", pattern="*.parquet")
    return found.select("event_id", "event_type", "value", "props")
