"""Flow inputs derived from the given tables, in Spark and in SQL.

``reviews`` is one review/order event per ``lineitem`` row. Every expression
exists once per engine; a caller names the fields it needs and only the
tables behind them are joined.
"""

from __future__ import annotations

import hashlib
import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewflow.schema import REVIEW_SCHEMA
from reviewflow.session import let_go, shared_folder
from reviewflow.sources.files import list_files
from reviewflow.sources.folders import delete, exists, publish
from reviewflow.sources.sinks import write_lines

FIELDS = REVIEW_SCHEMA.fieldNames()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Field -> (tables joined to lineitem, Spark SQL expression).
_SPARK_FIELDS = {
    "reviewerID": ("oc", """CASE (l_orderkey * 7 + l_linenumber) % 41
        WHEN 0 THEN NULL WHEN 1 THEN 'None' WHEN 2 THEN '' ELSE c_name END"""),
    "asin": ("", """CASE WHEN (l_orderkey + l_partkey) % 37 = 0 THEN NULL
        ELSE concat('B0', lpad(CAST(l_partkey AS STRING), 12, '0')) END"""),
    "reviewerName": ("oc", "c_name"),
    "helpful": ("", "array(CAST(l_linenumber AS BIGINT), CAST(l_quantity AS BIGINT) + l_linenumber)"),
    "reviewText": ("ps", "concat(p_name, ' of type ', p_type, ' bought from ', s_name)"),
    "overall": ("", """CASE (l_orderkey * 3 + l_suppkey) % 43 WHEN 0 THEN NULL WHEN 1 THEN 0.0D WHEN 2 THEN 6.0D
        ELSE CAST(1 + (l_orderkey + l_partkey * 3) % 5 AS DOUBLE) END"""),
    "summary": ("p", "concat(p_brand, ' ', l_returnflag)"),
    "unixReviewTime": ("", "timestampdiff(SECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', l_shipdate)"),
    "reviewTime": ("", "date_format(l_shipdate, 'MM dd, yyyy')"),
    "day_diff": ("", "CAST(l_linenumber + 4 AS INT)"),
    "helpful_yes": ("", "CAST(l_linenumber AS INT)"),
    "total_vote": ("", "CAST(l_quantity AS INT) + CAST(l_linenumber AS INT)"),
    "productName": ("p", "p_name"),
    "category": ("p", "p_type"),
    "sub_category": ("p", "concat(p_type, ' ', l_returnflag)"),
    "brand": ("p", "p_brand"),
    "unitPrice": ("p", "p_retailprice"),
    "orderID": ("", "concat('ORD-', l_orderkey)"),
    "quantity": ("", "CAST(l_quantity AS INT)"),
    "totalAmount": ("", "l_extendedprice"),
    "storeID": ("", "concat('STR-', l_suppkey)"),
    "storeName": ("s", "s_name"),
    "city": ("sn", "n_name"),
    "region": ("snr", "r_name"),
    "storeType": ("o", "o_orderstatus"),
    "paymentID": ("", "concat('PAY-', l_orderkey)"),
    "paymentMethod": ("o", "o_orderpriority"),
    "paymentStatus": ("", "l_linestatus"),
    "shippingID": ("", "concat('SHP-', l_orderkey)"),
    "shippingMethod": ("", "l_returnflag"),
    "carrierName": ("s", "s_name"),
    "shippingStatus": ("", "l_linestatus"),
}

_JOINS = {
    "o": ("orders", "l_orderkey = o_orderkey"),
    "c": ("customer", "o_custkey = c_custkey"),
    "p": ("part", "l_partkey = p_partkey"),
    "s": ("supplier", "l_suppkey = s_suppkey"),
    "n": ("nation", "s_nationkey = n_nationkey"),
    "r": ("region", "n_regionkey = r_regionkey"),
}


# What hangs on a table is joined to it before the many rows of lineitem meet it, so those are shuffled once for both.
_BEHIND = {"o": "c", "p": "", "s": "nr"}


# Bytes of lineitem that are joined at a time where the rows are stored: what a pass shuffles is let go before the next.
PASS_BYTES = 256 * 1024 * 1024

# Number of a pass and how many there are.
Part = tuple[int, int]


def passes(spark: SparkSession, sf_dir: str, most: int | None = None) -> list[Part]:
    """The parts that the reviews are made in, as many as the size of lineitem needs; together they are all reviews."""
    size = list_files(spark, f"{sf_dir}/lineitem.parquet").agg(F.sum("bytes")).first()[0] or 0
    of = max(1, math.ceil(size / PASS_BYTES))
    of = min(of, most or of)
    return [(number, of) for number in range(of)]


def write_passes(spark: SparkSession, sf_dir: str, path: str, write) -> None:
    """Call ``write(part, folder)`` for each pass and give the folder its name when all of them are in it."""
    staged = f"{path}-passes"
    delete(spark, staged)
    for part in passes(spark, sf_dir):
        write(part, staged)
        let_go(spark)
    publish(spark, staged, path)


def _of_part(rows: DataFrame, key: str, part: Part | None) -> DataFrame:
    """The rows of a part: equal keys, of whatever type, are in the same one, and those that are no number too."""
    if part is None or part[1] == 1:
        return rows
    return rows.where(F.pmod(F.xxhash64(F.col(key).try_cast("bigint")), F.lit(part[1])) == part[0])


def _joined(spark: SparkSession, sf_dir: str, needed: set[str], part: Part | None = None) -> DataFrame:
    def join(rows: DataFrame, letter: str, other: DataFrame) -> DataFrame:
        return rows.join(other, F.expr(_JOINS[letter][1]), "left")

    rows = _of_part(table(spark, sf_dir, "lineitem"), "l_orderkey", part)
    for letter, behind in _BEHIND.items():
        if letter in needed:
            other = table(spark, sf_dir, _JOINS[letter][0])
            if letter == "o":
                other = _of_part(other, "o_orderkey", part)
            for further in behind:
                if further in needed:
                    other = join(other, further, table(spark, sf_dir, _JOINS[further][0]))
            rows = join(rows, letter, other)
    return rows


def _field(name: str):
    return F.expr(_SPARK_FIELDS[name][1]).alias(name)


def reviews(spark: SparkSession, sf_dir: str, fields: list[str] | None = None, part: Part | None = None) -> DataFrame:
    """Review events with the named fields (all 32 by default), all of them or those of one part."""
    fields = fields or FIELDS
    needed = set().union(*(_SPARK_FIELDS[name][0] for name in fields))
    return _joined(spark, sf_dir, needed, part).select(*[_field(name) for name in fields])


REVIEWS_SQL = """reviews AS (
  SELECT
    CASE (l_orderkey * 7 + l_linenumber) % 41
      WHEN 0 THEN NULL WHEN 1 THEN 'None' WHEN 2 THEN '' ELSE c_name END AS "reviewerID",
    CASE WHEN (l_orderkey + l_partkey) % 37 = 0 THEN NULL
      ELSE 'B0' || lpad(CAST(l_partkey AS VARCHAR), 12, '0') END AS asin,
    c_name AS "reviewerName",
    p_name || ' of type ' || p_type || ' bought from ' || s_name AS "reviewText",
    CASE (l_orderkey * 3 + l_suppkey) % 43 WHEN 0 THEN NULL WHEN 1 THEN CAST(0 AS DOUBLE)
      WHEN 2 THEN CAST(6 AS DOUBLE)
      ELSE CAST(1 + (l_orderkey + l_partkey * 3) % 5 AS DOUBLE) END AS overall,
    p_brand || ' ' || l_returnflag AS summary,
    CAST(epoch(l_shipdate) AS BIGINT) AS "unixReviewTime",
    strftime(l_shipdate, '%m %d, %Y') AS "reviewTime",
    CAST(l_linenumber + 4 AS INTEGER) AS day_diff,
    CAST(l_linenumber AS INTEGER) AS helpful_yes,
    CAST(l_quantity AS INTEGER) + CAST(l_linenumber AS INTEGER) AS total_vote,
    p_name AS "productName", p_type AS category, p_type || ' ' || l_returnflag AS sub_category,
    p_brand AS brand, p_retailprice AS "unitPrice",
    'ORD-' || l_orderkey AS "orderID", CAST(l_quantity AS INTEGER) AS quantity,
    l_extendedprice AS "totalAmount",
    'STR-' || l_suppkey AS "storeID", s_name AS "storeName", n_name AS city, r_name AS region,
    o_orderstatus AS "storeType",
    'PAY-' || l_orderkey AS "paymentID", o_orderpriority AS "paymentMethod", l_linestatus AS "paymentStatus",
    'SHP-' || l_orderkey AS "shippingID", l_returnflag AS "shippingMethod", s_name AS "carrierName",
    l_linestatus AS "shippingStatus",
    CAST(l_linenumber AS BIGINT) AS helpful_0, CAST(l_quantity AS BIGINT) + l_linenumber AS helpful_1,
    (l_orderkey + l_suppkey) % 53 = 0 AS is_broken
  FROM lineitem
  LEFT JOIN orders ON l_orderkey = o_orderkey
  LEFT JOIN customer ON o_custkey = c_custkey
  LEFT JOIN part ON l_partkey = p_partkey
  LEFT JOIN supplier ON l_suppkey = s_suppkey
  LEFT JOIN nation ON s_nationkey = n_nationkey
  LEFT JOIN region ON n_regionkey = r_regionkey
)"""

INVALID_SQL = """("reviewerID" IS NULL OR "reviewerID" IN ('None', '') OR asin IS NULL OR asin IN ('None', '')
    OR overall IS NULL OR overall < 1 OR overall > 5)"""

# The last day of history that the first, second and third load have seen.
LOAD_DATES = ["1996-06-30", "1998-06-30", "2000-06-30"]
# Moments of the snapshots taken after those loads and after the full one.
SNAPSHOT_TIMES = [f"{day} 12:00:00" for day in (*LOAD_DATES, "2001-12-31")]


# What parsing those messages gives: unreadable ones have no fields.
PARSED_SQL = REVIEWS_SQL + """,
parsed AS (
  SELECT """ + ", ".join(
    f'CASE WHEN is_broken THEN NULL ELSE "{name}" END AS "{name}"' for name in FIELDS if name != "helpful"
) + """, CASE WHEN is_broken THEN NULL ELSE helpful_0 END AS helpful_0,
    CASE WHEN is_broken THEN NULL ELSE helpful_1 END AS helpful_1, is_broken
  FROM reviews
)"""


def _staged_path(spark: SparkSession, sf_dir: str, label: str) -> str:
    app = spark.sparkContext.applicationId
    of = hashlib.md5(sf_dir.encode()).hexdigest()[:10]
    return f"{shared_folder(spark)}/reviewflow/{app}/input-{of}/{label}"


def staged_folder(spark: SparkSession, sf_dir: str, label: str, write) -> str:
    """Folder with an input that a file source must find on disk.

    Written once per application and shared by the queries that read it. What
    was shuffled to write it is let go.
    """
    path = _staged_path(spark, sf_dir, label)
    if not exists(spark, f"{path}/_SUCCESS"):
        write(path)
        let_go(spark)
    return path


# Messages are some thirty times as large as the Parquet tables they are made of, so their files are compressed.
COMPRESSION = "gzip"


def _message_lines(spark: SparkSession, sf_dir: str, part: Part | None = None) -> DataFrame:
    """The reviews as JSON, some of them unreadable."""
    event = F.to_json(F.struct(*[_field(name) for name in FIELDS]))
    broken = F.expr("(l_orderkey + l_suppkey) % 53 = 0")
    return _joined(spark, sf_dir, set(_JOINS), part).select(
        F.when(broken, F.concat(F.lit("not json "), event)).otherwise(event).alias("value"))


def message_folder(spark: SparkSession, sf_dir: str) -> str:
    """Message lines on disk, for streams and whatever else needs files."""
    def write(part: Part, path: str) -> None:
        write_lines(_message_lines(spark, sf_dir, part), path, "append", COMPRESSION)

    return staged_folder(spark, sf_dir, "messages", lambda path: write_passes(spark, sf_dir, path, write))


def messages(spark: SparkSession, sf_dir: str, part: Part | None = None) -> DataFrame:
    """The message lines as a batch, all of them or those of one part.

    They are three times as large on disk as their tables even compressed, so a batch does not stage them: it reads the files
    if a stream has needed them before, else it makes the same lines as it goes. One of several parts is always made.
    """
    if part is not None and part[1] > 1:
        return _message_lines(spark, sf_dir, part)
    path = _staged_path(spark, sf_dir, "messages")
    if exists(spark, f"{path}/_SUCCESS"):
        return spark.read.text(path)
    let_go(spark)
    return _message_lines(spark, sf_dir)


def bronze_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One batch record per event; errors reject half of their rows."""
    return (
        table(spark, sf_dir, "events")
        .withColumn("rejects", F.when(F.col("event_type") == "error", 2).otherwise(11))
        .selectExpr(
            "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\") AS timestamp",
            "event_id AS batch_id",
            """named_struct(
                'total_received', CAST(floor(value) AS BIGINT),
                'valid_records', CAST(floor(value) AS BIGINT) - CAST(floor(value / rejects) AS BIGINT),
                'invalid_records', CAST(floor(value / rejects) AS BIGINT),
                'error_rate_percent', CAST(0 AS DOUBLE),
                'processing_time_ms', value) AS metrics""",
            "named_struct('is_acceptable', rejects > 5, 'sample_error_data', array(props)) AS data_quality"))


def silver_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One progress record per event; sign-ups lose a row now and then."""
    return (
        table(spark, sf_dir, "events")
        .withColumn("rejects", F.when(F.col("event_type") == "error", 2).otherwise(11))
        .withColumn("lost", F.when(F.col("event_type") == "signup", F.floor(F.col("value") / 100)).otherwise(0))
        .selectExpr(
            "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss.SSS'Z'\") AS timestamp",
            "event_id AS batch_id",
            """named_struct(
                'input_rows_per_second', value,
                'processed_rows_per_second', CASE event_type WHEN 'click' THEN value / 2
                    WHEN 'view' THEN value * 2 ELSE value END,
                'total_input_rows',
                CAST(floor(value) AS BIGINT) - CAST(floor(value / rejects) AS BIGINT) - CAST(lost AS BIGINT),
                'duration_ms', map('addBatch', CAST(floor(value * 400) AS BIGINT))) AS performance""",
            """named_struct(
                'addBatch', CASE WHEN event_type = 'purchase' THEN NULL ELSE CAST(floor(value * 400) AS BIGINT) END,
                'getBatch', CAST(0 AS BIGINT), 'queryPlanning', CAST(0 AS BIGINT),
                'triggerExecution', CAST(floor(value * 400) AS BIGINT)) AS processing_time"""))


LOGS_SQL = """logged AS (
  SELECT *, CASE WHEN event_type = 'error' THEN 2 ELSE 11 END AS rejects,
    CASE WHEN event_type = 'signup' THEN CAST(floor(value / 100) AS BIGINT) ELSE 0 END AS lost
  FROM events
),
bronze_flat AS (
  SELECT date_trunc('second', ts) AS "timestamp", event_id AS batch_id,
    CAST(floor(value) AS DOUBLE) AS total_received,
    CAST(floor(value) - floor(value / rejects) AS DOUBLE) AS valid_records,
    CAST(floor(value / rejects) AS DOUBLE) AS invalid_records
  FROM logged
),
silver_flat AS (
  SELECT date_trunc('second', ts) AS "timestamp", event_id AS batch_id,
    value AS input_rows_per_second,
    CASE event_type WHEN 'click' THEN value / 2 WHEN 'view' THEN value * 2 ELSE value END
      AS processed_rows_per_second,
    CAST(floor(value) - floor(value / rejects) AS BIGINT) - lost AS total_input_rows,
    CAST(floor(value * 400) AS DOUBLE) AS "addBatch_ms"
  FROM logged
),
bronze_metrics AS (
  SELECT date_trunc('minute', "timestamp") AS "timestamp",
    sum(total_received) AS total_received, sum(valid_records) AS valid_records,
    sum(invalid_records) AS invalid_records,
    CASE WHEN sum(total_received) = 0 THEN CAST(0 AS DOUBLE)
      ELSE round(sum(invalid_records) / sum(total_received) * 100, 2) END AS error_rate_percent
  FROM bronze_flat GROUP BY 1
),
silver_metrics AS (
  SELECT date_trunc('minute', "timestamp") AS "timestamp",
    avg(input_rows_per_second) AS input_rows_per_second,
    avg(processed_rows_per_second) AS processed_rows_per_second,
    avg("addBatch_ms") AS "addBatch_ms",
    CAST(sum(total_input_rows) AS BIGINT) AS total_input_rows
  FROM silver_flat GROUP BY 1
)"""
