"""Stream logs, minute metrics, reconciliation and health rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from reviewflow.functions.clock import clock_label, local_time
from reviewflow.operators.ranking import latest_metrics
from reviewflow.operators.reconcile import funnel, reconcile
from reviewflow.operators.rollup import (
    flatten_bronze_log, flatten_silver_log, rollup_bronze, rollup_silver, total_received,
)
from reviewflow.plans import health
from workload.inputs import LOGS_SQL, bronze_log, silver_log, table
from workload.registry import query

TIME_SQL = 'CAST("timestamp" AS VARCHAR) AS "timestamp"'
WITH = f"WITH {LOGS_SQL}"


def bronze_metrics(spark, sf_dir):
    return rollup_bronze(bronze_log(spark, sf_dir))


def silver_metrics(spark, sf_dir):
    return rollup_silver(silver_log(spark, sf_dir))


@query("flatten_logs", f"""{WITH} SELECT {TIME_SQL}, batch_id, total_received, valid_records, invalid_records
FROM bronze_flat""")
def flatten_logs(spark, sf_dir):
    return flatten_bronze_log(bronze_log(spark, sf_dir))


@query("flatten_silver_logs", f"""{WITH} SELECT {TIME_SQL}, batch_id, input_rows_per_second,
  processed_rows_per_second, total_input_rows, "addBatch_ms" FROM silver_flat""")
def flatten_silver_logs(spark, sf_dir):
    return flatten_silver_log(silver_log(spark, sf_dir))


@query("local_time", """SELECT event_id, CAST(ts + INTERVAL 7 HOUR AS VARCHAR) AS local_ts,
  strftime(ts + INTERVAL 7 HOUR, '%H:%M:%S') AS time_label FROM events""")
def local_time_query(spark, sf_dir):
    local = local_time("ts")
    return table(spark, sf_dir, "events").select(
        "event_id", local.alias("local_ts"), clock_label(local).alias("time_label"))


@query("minute_error_rate", f"""{WITH} SELECT {TIME_SQL}, total_received, valid_records, invalid_records,
  error_rate_percent FROM bronze_metrics""")
def minute_error_rate(spark, sf_dir):
    return bronze_metrics(spark, sf_dir)


@query("hour_error_rate", f"""{WITH} SELECT CAST(date_trunc('hour', "timestamp") AS VARCHAR) AS "timestamp",
  sum(total_received) AS total_received, sum(valid_records) AS valid_records, sum(invalid_records) AS invalid_records,
  round(coalesce(sum(invalid_records) / nullif(sum(total_received), 0) * 100, 0), 2) AS error_rate_percent
FROM bronze_flat GROUP BY 1""")
def hour_error_rate(spark, sf_dir):
    return rollup_bronze(bronze_log(spark, sf_dir), every="1 hour")


@query("minute_throughput", f"""{WITH} SELECT {TIME_SQL}, round(input_rows_per_second, 6) AS input_rows_per_second,
  round(processed_rows_per_second, 6) AS processed_rows_per_second, round("addBatch_ms", 6) AS "addBatch_ms",
  total_input_rows FROM silver_metrics""")
def minute_throughput(spark, sf_dir):
    rates = ["input_rows_per_second", "processed_rows_per_second", "addBatch_ms"]
    return silver_metrics(spark, sf_dir).withColumns({name: F.round(name, 6) for name in rates})


@query("total_received", f"{WITH} SELECT coalesce(sum(total_received), 0) AS total_received FROM bronze_metrics")
def total_received_query(spark, sf_dir):
    return total_received(bronze_metrics(spark, sf_dir))


RECONCILE_SQL = f"""{WITH}, books AS (
  SELECT b.rows_in, b.rows_rejected, b.rows_in - b.rows_rejected AS rows_expected, s.rows_processed,
    b.rows_in - b.rows_rejected - s.rows_processed AS discrepancy
  FROM (SELECT sum(total_received) AS rows_in, sum(invalid_records) AS rows_rejected FROM bronze_metrics) b,
    (SELECT CAST(sum(total_input_rows) AS DOUBLE) AS rows_processed FROM silver_metrics) s
)"""


def books(spark, sf_dir):
    return reconcile(bronze_metrics(spark, sf_dir), silver_metrics(spark, sf_dir))


@query("reconcile", f"{RECONCILE_SQL} SELECT * FROM books")
def reconcile_query(spark, sf_dir):
    return books(spark, sf_dir)


@query("funnel", f"""{RECONCILE_SQL}, stages AS (
  SELECT 1 AS step, 'bronze_in' AS stage, rows_in AS value, rows_in FROM books
  UNION ALL SELECT 2, 'dlq', rows_rejected, rows_in FROM books
  UNION ALL SELECT 3, 'expected_silver', rows_expected, rows_in FROM books
  UNION ALL SELECT 4, 'silver_out', rows_processed, rows_in FROM books
)
SELECT step, stage, value, value / rows_in * 100 AS percent_of_first FROM stages""")
def funnel_query(spark, sf_dir):
    return funnel(books(spark, sf_dir))


@query("latest_metrics", f"""{WITH}, shown AS (
  SELECT *, "timestamp" + INTERVAL 7 HOUR AS timestamp_tz,
    strftime("timestamp" + INTERVAL 7 HOUR, '%H:%M:%S') AS time_label FROM bronze_metrics
)
SELECT {TIME_SQL}, total_received, valid_records, invalid_records, error_rate_percent,
  CAST(timestamp_tz AS VARCHAR) AS timestamp_tz, time_label
FROM shown
WHERE regexp_matches(CAST("timestamp" AS VARCHAR) || ' ' || total_received || ' ' || valid_records || ' ' ||
  invalid_records || ' ' || error_rate_percent || ' ' || CAST(timestamp_tz AS VARCHAR) || ' ' || time_label,
  '(?i)01-2[0-9] 0')
ORDER BY shown."timestamp" DESC LIMIT 60""")
def latest_metrics_query(spark, sf_dir):
    return latest_metrics(bronze_metrics(spark, sf_dir), 60, "01-2[0-9] 0")


@query("latest_metrics_newest_first", f"""{WITH}, latest AS (SELECT * FROM bronze_metrics ORDER BY "timestamp" DESC LIMIT 50)
SELECT {TIME_SQL}, total_received, row_number() OVER (ORDER BY latest."timestamp" DESC) - 1 AS place FROM latest""")
def latest_metrics_newest_first(spark, sf_dir):
    shown = latest_metrics(bronze_metrics(spark, sf_dir), 50, ascending=False)
    # The rows are in one task, numbered in their order.
    return shown.select("timestamp", "total_received", F.monotonically_increasing_id().alias("place"))


@query("heartbeat", f"""{WITH} SELECT CAST(max("timestamp") AS VARCHAR) AS last_seen,
  date_diff('second', max("timestamp"), TIMESTAMP '2024-02-01 00:00:00') AS silent_seconds,
  CASE WHEN date_diff('second', max("timestamp"), TIMESTAMP '2024-02-01 00:00:00') > 30 THEN 'error' ELSE 'ok' END
    AS level
FROM bronze_flat""")
def heartbeat(spark, sf_dir):
    now = F.lit("2024-02-01 00:00:00").cast("timestamp_ntz")
    return health.heartbeat(flatten_bronze_log(bronze_log(spark, sf_dir)), now)


@query("error_level", f"""{WITH} SELECT {TIME_SQL}, error_rate_percent, CASE WHEN error_rate_percent > 30 THEN 'error'
  WHEN error_rate_percent > 10 THEN 'warning' ELSE 'ok' END AS level FROM bronze_metrics""")
def error_level(spark, sf_dir):
    return health.error_level(bronze_metrics(spark, sf_dir))


@query("latency_level", f"""{WITH} SELECT {TIME_SQL}, "addBatch_ms",
  CASE WHEN "addBatch_ms" > 75000 THEN 'error' ELSE 'ok' END AS level,
  CASE WHEN "addBatch_ms" < 1500 THEN 'green' WHEN "addBatch_ms" < 3000 THEN 'yellow'
    WHEN "addBatch_ms" <= 5000 THEN 'red' ELSE 'beyond' END AS band,
  "addBatch_ms" >= 4000 AS over_mark
FROM silver_metrics""")
def latency_level(spark, sf_dir):
    return health.latency_level(silver_metrics(spark, sf_dir))


@query("backpressure", f"""{WITH} SELECT {TIME_SQL}, round(input_rows_per_second, 6) AS input_rows_per_second,
  round(processed_rows_per_second, 6) AS processed_rows_per_second,
  input_rows_per_second > processed_rows_per_second * CAST(1.5 AS DOUBLE) AND input_rows_per_second > 10
    AS is_congested
FROM silver_metrics""")
def backpressure(spark, sf_dir):
    rates = ["input_rows_per_second", "processed_rows_per_second"]
    return health.backpressure(silver_metrics(spark, sf_dir)).withColumns(
        {name: F.round(name, 6) for name in rates})


@query("freshness", f"""{RECONCILE_SQL}, latest AS (
  SELECT "addBatch_ms" / 1000 AS seconds FROM silver_metrics ORDER BY "timestamp" DESC LIMIT 1
)
SELECT seconds AS latency_seconds, CASE WHEN seconds < 10 THEN 'fresh' WHEN seconds < 30 THEN 'normal'
    WHEN seconds <= 60 THEN 'danger' ELSE 'beyond' END AS band,
  discrepancy, discrepancy = 0 AS is_balanced
FROM latest, books""")
def freshness(spark, sf_dir):
    return health.freshness(silver_metrics(spark, sf_dir), books(spark, sf_dir))


@query("ledger", f"""{WITH}, latest AS (SELECT * FROM silver_metrics ORDER BY "timestamp" DESC LIMIT 20)
SELECT strftime("timestamp" + INTERVAL 7 HOUR, '%H:%M:%S') AS time_label,
  round(input_rows_per_second, 6) AS input, round(processed_rows_per_second, 6) AS processed,
  CASE WHEN input_rows_per_second = 0 AND processed_rows_per_second = 0 THEN 'idle'
    WHEN input_rows_per_second <= processed_rows_per_second THEN 'matched' ELSE 'congested' END AS state
FROM latest""")
def ledger(spark, sf_dir):
    return health.ledger(silver_metrics(spark, sf_dir)).withColumns(
        {name: F.round(name, 6) for name in ("input", "processed")})


@query("ledger_of_rows", f"""{RECONCILE_SQL.rsplit(", books AS", 1)[0]}, both_sides AS (
  SELECT "timestamp", valid_records AS input, CAST(total_input_rows AS DOUBLE) AS processed
  FROM bronze_metrics JOIN silver_metrics USING ("timestamp")
), latest AS (SELECT * FROM both_sides ORDER BY "timestamp" DESC LIMIT 20)
SELECT strftime("timestamp" + INTERVAL 7 HOUR, '%H:%M:%S') AS time_label, input, processed,
  CASE WHEN input = 0 AND processed = 0 THEN 'idle' WHEN input <= processed THEN 'matched' ELSE 'congested' END AS state
FROM latest""")
def ledger_of_rows(spark, sf_dir):
    """The same from counted rows instead of rates."""
    rows = bronze_metrics(spark, sf_dir).select("timestamp", F.col("valid_records").alias("input_rows")).join(
        silver_metrics(spark, sf_dir).select("timestamp", F.col("total_input_rows").cast("double").alias("processed_rows")), "timestamp")
    return health.ledger(rows)
