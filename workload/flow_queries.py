"""Streams, file sources and sinks, maintenance jobs.

Streams read a staged copy of their input, run until it is used up, and hand
back what they wrote as a batch frame.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewflow.operators.maintain import (
    archive_session, clear_dlq, compact_dlq, compact_table, compact_text, expired_files, live_files, merge_loads, read_session,
)
from reviewflow.operators.rollup import flatten_bronze_log, rollup_bronze
from reviewflow.operators.routing import BRONZE, DLQ, parse_reviews, route
from reviewflow.plans.staging import with_review_date
from reviewflow.schema import BRONZE_LOG_SCHEMA, REVIEW_SCHEMA
from reviewflow.session import let_go, new_path
from reviewflow.sources.files import list_files, read_dlq, read_json_stream, read_ndjson_union, read_table
from reviewflow.sources.folders import delete
from reviewflow.sources.messages import read_messages
from reviewflow.sources.sinks import export_sample, gather, setting, write_json, write_lines
from reviewflow.streaming.metrics import finish, read_latest, start_metric_upserts
from reviewflow.streaming.once import first_deliveries, with_arrival
from reviewflow.streaming.progress import ProgressLog, read_progress
from reviewflow.streaming.router import Landing, read_batch_log, read_speed_layer, route_batch, start_router
from reviewflow.streaming.silence import silences
from reviewflow.streaming.silver import read_silver, start_silver
from workload.inputs import (
    COMPRESSION, INVALID_SQL, LOGS_SQL, PARSED_SQL, REVIEWS_SQL, Part, bronze_log, message_folder, messages, passes, reviews,
    staged_folder, table, write_passes,
)
from workload.registry import query

ONCE = {"availableNow": True}
KEYS = ["reviewerID", "asin", "overall", "unixReviewTime", "orderID", "storeID", "quantity", "totalAmount"]
KEYS_SQL = ", ".join(f'"{name}"' for name in KEYS)
ROUTE_SQL = f"CASE WHEN {INVALID_SQL} THEN 'dlq' ELSE 'bronze' END"


def routed_folder(spark: SparkSession, sf_dir: str, kind: str) -> str:
    """Bronze or dead-letter JSON of the whole message stream."""

    def write(part: Part, path: str) -> None:
        valid, rejected = route(parse_reviews(messages(spark, sf_dir, part)))
        write_json({BRONZE: valid, DLQ: rejected}[kind], path, compression=COMPRESSION)

    return staged_folder(spark, sf_dir, kind, lambda path: write_passes(spark, sf_dir, path, write))


# Input of a task that writes the silver table.
TASK_BYTES = 16 * 1024 * 1024


def tasks_for(spark: SparkSession, source: str) -> int:
    """A task for each core, and more of them where each would get more than ``TASK_BYTES`` of the source."""
    size = list_files(spark, source).agg(F.sum("bytes")).first()[0] or 0
    return max(spark.sparkContext.defaultParallelism, math.ceil(size / TASK_BYTES))


def silver_folder(spark: SparkSession, sf_dir: str) -> str:
    """Silver table with one folder per review date."""

    def write(path: str) -> None:
        rows = with_review_date(reviews(spark, sf_dir, KEYS))
        gather(rows, "review_date", tasks_for(spark, f"{sf_dir}/lineitem.parquet"), 1).write.partitionBy("review_date").parquet(path)

    return staged_folder(spark, sf_dir, "silver", write)


def fragmented_folder(spark: SparkSession, sf_dir: str) -> str:
    """The same rows by rating, as several tasks left them."""

    def write(path: str) -> None:
        rows = reviews(spark, sf_dir, KEYS)
        rows.repartition(tasks_for(spark, f"{sf_dir}/lineitem.parquet")).write.partitionBy("overall").parquet(path)

    return staged_folder(spark, sf_dir, "fragmented", write)


# --- batch sources and sinks ------------------------------------------------

@query("silver_scan", f"""WITH {REVIEWS_SQL}
SELECT CAST(CAST(to_timestamp("unixReviewTime") AT TIME ZONE 'UTC' AS DATE) AS VARCHAR) AS review_date,
  count(*) AS n, count(overall) AS rated FROM reviews GROUP BY 1""")
def silver_scan(spark, sf_dir):
    silver = read_table(spark, silver_folder(spark, sf_dir))
    return silver.groupBy("review_date").agg(F.count("*").alias("n"), F.count("overall").alias("rated"))


@query("bronze_roundtrip", f"WITH {PARSED_SQL} SELECT {KEYS_SQL} FROM parsed WHERE NOT {INVALID_SQL}")
def bronze_roundtrip(spark, sf_dir):
    path = new_path(spark, "bronze")
    valid, _ = route(parse_reviews(messages(spark, sf_dir)))
    write_json(valid, path, batch_id=0, compression=COMPRESSION)
    return spark.read.schema(REVIEW_SCHEMA).json(path).select(KEYS)


@query("ndjson_union", """SELECT doc_id, lang, source, n_chars, CAST(NULL AS BIGINT) AS conv_id,
  CAST(NULL AS BIGINT) AS turn, CAST(NULL AS VARCHAR) AS role, length(text) AS n_text FROM documents
UNION ALL SELECT NULL, NULL, NULL, NULL, conv_id, turn, role, length(text) FROM conversations""")
def ndjson_union(spark, sf_dir):
    """A compacted file and part files with other columns; broken lines between."""

    def lines(name: str) -> DataFrame:
        rows = table(spark, sf_dir, name)
        good = F.to_json(F.struct("*"))
        return rows.select(F.explode(F.array(good, F.concat(F.lit("{broken "), F.col("text")))).alias("value"))

    paths = [staged_folder(spark, sf_dir, f"lines-{name}", lines(name).write.text)
             for name in ("documents", "conversations")]
    united = read_ndjson_union(spark, paths)
    return united.select("doc_id", "lang", "source", "n_chars", "conv_id", "turn", "role",
                         F.length("text").cast("bigint").alias("n_text"))


SAMPLE_ORDER = ["unixReviewTime", "orderID", "storeID", "reviewerID", "asin", "overall", "quantity", "totalAmount"]
SAMPLE_ORDER_SQL = ", ".join(f'"{name}" NULLS FIRST' for name in SAMPLE_ORDER)


@query("sample_rows", f"WITH {REVIEWS_SQL} SELECT {KEYS_SQL} FROM reviews ORDER BY {SAMPLE_ORDER_SQL} LIMIT 5")
def sample_rows(spark, sf_dir):
    rows = reviews(spark, sf_dir, KEYS)
    path = new_path(spark, "sample")
    return export_sample(rows.orderBy(*SAMPLE_ORDER), path)


# --- streams ----------------------------------------------------------------

@query("stream_json_source", f"WITH {PARSED_SQL} SELECT {KEYS_SQL} FROM parsed WHERE NOT {INVALID_SQL}")
def stream_json_source(spark, sf_dir):
    out = new_path(spark, "json-stream")
    rows = read_json_stream(spark, routed_folder(spark, sf_dir, BRONZE), REVIEW_SCHEMA).select(KEYS)
    writer = rows.writeStream.format("parquet").option("checkpointLocation", f"{out}/checkpoint")
    writer.trigger(**ONCE).start(f"{out}/data").awaitTermination()
    return spark.read.schema(rows.schema).parquet(f"{out}/data")


def _routed(spark: SparkSession, sf_dir: str, parts: list[Part] | None = None) -> Landing:
    """The message stream routed, as one batch or, with several parts, as their messages arrive; routed ones are deleted then."""
    out = new_path(spark, "routed")
    landing = Landing(f"{out}/landing", f"{out}/log", f"{out}/speed", COMPRESSION)

    def run(folder: str) -> None:
        stream = read_messages(spark, folder, fmt="text")
        start_router(stream, landing, f"{out}/checkpoint", ONCE).awaitTermination()

    if parts is None or len(parts) == 1:
        run(message_folder(spark, sf_dir))
        return landing
    for part in parts:
        write_lines(messages(spark, sf_dir, part), f"{out}/in", "append", COMPRESSION)
        let_go(spark)
        run(f"{out}/in")
        delete(spark, f"{out}/in")
    return landing


@query("stream_route", f"""WITH {PARSED_SQL}
SELECT {KEYS_SQL}, {ROUTE_SQL} AS route, {INVALID_SQL} AS has_raw FROM parsed""")
def stream_route(spark, sf_dir):
    landing = _routed(spark, sf_dir, passes(spark, sf_dir))
    valid = spark.read.schema(REVIEW_SCHEMA).json(landing.bronze)
    rejected = read_dlq(spark, landing.dlq)
    return valid.select(*KEYS, F.lit(BRONZE).alias("route"), F.lit(False).alias("has_raw")).unionAll(
        rejected.select(*KEYS, F.lit(DLQ).alias("route"), F.col("raw_json").isNotNull().alias("has_raw")))


@query("stream_batch_log", f"""WITH {PARSED_SQL}
SELECT count(*) AS total_received, count(CASE WHEN NOT {INVALID_SQL} THEN 1 END) AS valid_records,
  count(CASE WHEN {INVALID_SQL} THEN 1 END) AS invalid_records, TRUE AS has_samples FROM parsed""")
def stream_batch_log(spark, sf_dir):
    log = read_batch_log(spark, _routed(spark, sf_dir, passes(spark, sf_dir)).log)
    samples = F.max(F.size("data_quality.sample_error_data")).between(1, 5)
    return log.agg(
        *[F.sum(f"metrics.{name}").alias(name) for name in ("total_received", "valid_records", "invalid_records")],
        samples.alias("has_samples"))


@query("speed_layer_metrics", f"""WITH {PARSED_SQL}
SELECT count(*) AS total_reviews, round(avg(overall), 2) AS avg_rating,
  count(CASE WHEN overall >= 4 THEN 1 END) AS positive_count,
  count(CASE WHEN overall <= 2 THEN 1 END) AS negative_count
FROM parsed WHERE NOT {INVALID_SQL}""")
def speed_layer_metrics(spark, sf_dir):
    """One batch, as the means of several would be rounded before they are added up."""
    items = read_speed_layer(spark, _routed(spark, sf_dir).speed_layer)
    weighted = F.sum(F.col("avg_rating").cast("double") * F.col("total_reviews")) / F.sum("total_reviews")
    return items.agg(
        F.sum("total_reviews").alias("total_reviews"), F.round(weighted, 2).alias("avg_rating"),
        F.sum("positive_count").alias("positive_count"), F.sum("negative_count").alias("negative_count"))


@query("stream_silver", f"""WITH {PARSED_SQL}
SELECT {KEYS_SQL}, CAST(CAST(to_timestamp("unixReviewTime") AT TIME ZONE 'UTC' AS DATE) AS VARCHAR) AS review_date
FROM parsed WHERE NOT {INVALID_SQL}""")
def stream_silver(spark, sf_dir):
    """The bronze files of a large input arrive part by part and are deleted once the stream has taken them."""
    out, parts = new_path(spark, "silver-stream"), passes(spark, sf_dir)

    def run(bronze: str) -> None:
        start_silver(spark, bronze, f"{out}/silver", f"{out}/checkpoint", ONCE, shards=2).awaitTermination()
        let_go(spark)

    if len(parts) == 1:
        run(routed_folder(spark, sf_dir, BRONZE))
    else:
        for part in parts:
            valid, _ = route(parse_reviews(messages(spark, sf_dir, part)))
            write_json(valid, f"{out}/bronze", compression=COMPRESSION)
            let_go(spark)
            run(f"{out}/bronze")
            delete(spark, f"{out}/bronze")
    return read_silver(spark, f"{out}/silver").select(*KEYS, "review_date")


# Loads that the files of the bronze folder are taken to silver in.
LOADS = 8


@query("silver_optimize", f"""WITH {REVIEWS_SQL}, monthly AS (
  SELECT * REPLACE (CAST(epoch(date_trunc('month', to_timestamp("unixReviewTime") AT TIME ZONE 'UTC')) AS BIGINT)
    AS "unixReviewTime") FROM reviews)
SELECT {KEYS_SQL}, CAST(CAST(to_timestamp("unixReviewTime") AT TIME ZONE 'UTC' AS DATE) AS VARCHAR) AS review_date
FROM monthly WHERE NOT {INVALID_SQL}""")
def silver_optimize(spark, sf_dir):
    """Batches routed, one of them twice, taken to silver in several loads, compacted, appended to, compacted again.

    All reviews, dated on the first of their month.
    """
    out = new_path(spark, "optimize")
    month = F.trunc(F.date_from_unix_date(F.floor(F.col("unixReviewTime") / 86_400).cast("int")), "month")
    rows = reviews(spark, sf_dir, KEYS).withColumn("unixReviewTime", F.unix_date(month).cast("long") * 86_400)
    write_lines(rows.select(F.to_json(F.struct("*")).alias("value")), f"{out}/messages", compression=COMPRESSION)
    lines = spark.read.text(f"{out}/messages")
    landing, half = Landing(f"{out}/landing", compression=COMPRESSION), F.pmod(F.xxhash64("value"), F.lit(3))

    def add(number: int) -> None:
        route_batch(lines.where(half == number), number, landing)

    def to_silver() -> None:
        # About as many loads, whatever the number of files: each load and its merge costs the same time again.
        at_a_time = max(2, math.ceil(list_files(spark, landing.bronze, "part-*").count() / LOADS))
        start_silver(spark, landing.bronze, f"{out}/silver", f"{out}/checkpoint", ONCE, max_files=at_a_time, shards=2).awaitTermination()

    add(0)
    add(1)
    to_silver()
    add(1)
    to_silver()
    merge_loads(spark, f"{out}/silver", "review_date")
    add(2)
    to_silver()
    merge_loads(spark, f"{out}/silver", "review_date")
    return read_silver(spark, f"{out}/silver").select(*KEYS, "review_date")


@query("stream_progress", "SELECT CAST(0 AS BIGINT) AS first_batch, CAST(count(*) AS BIGINT) AS total_input_rows FROM lineitem")
def stream_progress(spark, sf_dir):
    """Progress records of a stream over the message files."""
    out = new_path(spark, "progress")
    listener = ProgressLog(spark, f"{out}/log", query="progress-log")
    spark.streams.addListener(listener)
    stream = read_messages(spark, message_folder(spark, sf_dir), fmt="text")
    running = (
        stream.writeStream.queryName("progress-log").format("noop")
        .option("checkpointLocation", f"{out}/checkpoint").trigger(**ONCE).start())
    running.awaitTermination()
    listener.wait(len(running.recentProgress))
    spark.streams.removeListener(listener)
    log = read_progress(spark, f"{out}/log")
    return log.agg(F.min("batch_id").alias("first_batch"), F.sum("performance.total_input_rows").alias("total_input_rows"))


@query("stream_minute_error_rate", f"""WITH {LOGS_SQL} SELECT CAST("timestamp" AS VARCHAR) AS "timestamp",
  total_received, valid_records, invalid_records, error_rate_percent FROM bronze_metrics""")
def stream_minute_error_rate(spark, sf_dir):
    """The whole log as one batch, as files that were written at a time have no order that a lateness could count on."""
    out = new_path(spark, "minutes")
    folder = staged_folder(spark, sf_dir, "bronze-log", lambda path: write_json(bronze_log(spark, sf_dir).repartitionByRange("timestamp"), path))
    metrics = rollup_bronze(read_json_stream(spark, folder, BRONZE_LOG_SCHEMA, max_files=None), lateness="1 hour")
    finish(start_metric_upserts(metrics, f"{out}/data", f"{out}/checkpoint", ONCE))
    return read_latest(spark, f"{out}/data")


# Stretches of four days, each second one before the one it follows.
OUT_OF_ORDER = [1, 0, 3, 2, 5, 4, 7, 6]


@query("stream_late_files", f"""WITH {LOGS_SQL} SELECT CAST("timestamp" AS VARCHAR) AS "timestamp",
  total_received, valid_records, invalid_records, error_rate_percent FROM bronze_metrics""")
def stream_late_files(spark, sf_dir):
    """Files of four days each, as many as their size needs, taken out of order by up to eight days.

    A batch takes an eighth of the files, so there are about as many batches as stretches, whatever the number of files.
    """
    out = new_path(spark, "late")

    def write(path: str) -> None:
        log = bronze_log(spark, sf_dir)
        stretch = F.floor((F.dayofmonth(F.to_date(F.substring("timestamp", 1, 10))) - 1) / 4)
        for number in OUT_OF_ORDER:
            write_json(log.where(stretch == number).repartitionByRange("timestamp"), path)

    folder = staged_folder(spark, sf_dir, "late-log", write)
    at_a_time = max(1, math.ceil(list_files(spark, folder, "part-*").count() / len(OUT_OF_ORDER)))
    metrics = rollup_bronze(read_json_stream(spark, folder, BRONZE_LOG_SCHEMA, max_files=at_a_time), lateness="9 days")
    finish(start_metric_upserts(metrics, f"{out}/data", f"{out}/checkpoint", ONCE))
    return read_latest(spark, f"{out}/data")


@query("stream_silences", """WITH log AS (SELECT event_type <> 'error' AS is_acceptable, date_trunc('second', ts) AS t FROM events WHERE ts IS NOT NULL),
marked AS (
  SELECT *, CASE WHEN t - lag(t) OVER w <= INTERVAL 30 SECOND THEN 0 ELSE 1 END AS starts
  FROM log WINDOW w AS (PARTITION BY is_acceptable ORDER BY t)),
numbered AS (SELECT *, sum(starts) OVER (PARTITION BY is_acceptable ORDER BY t ROWS UNBOUNDED PRECEDING) AS n FROM marked)
SELECT is_acceptable, CAST(min(t) AS VARCHAR) AS active_since, CAST(max(t) AS VARCHAR) AS silent_since,
  CAST(max(t) + INTERVAL 30 SECOND AS VARCHAR) AS noticed_at, count(*) AS events
FROM numbered GROUP BY is_acceptable, n
HAVING max(t) + INTERVAL 30 SECOND <= (SELECT max(t) - INTERVAL 1 HOUR FROM log)""")
def stream_silences(spark, sf_dir):
    """When no good batch, or no bad one, was logged for more than 30 seconds; the log ends an hour before its last entry."""
    out = new_path(spark, "silences")
    folder = staged_folder(spark, sf_dir, "bronze-log", lambda path: write_json(bronze_log(spark, sf_dir).repartitionByRange("timestamp"), path))
    log = read_json_stream(spark, folder, BRONZE_LOG_SCHEMA, max_files=None)
    flat = flatten_bronze_log(log, "data_quality.is_acceptable")
    found = silences(flat, "is_acceptable", lateness="1 hour")
    found.writeStream.option("checkpointLocation", f"{out}/checkpoint").trigger(**ONCE).start(f"{out}/data").awaitTermination()
    return spark.read.schema(found.schema).parquet(f"{out}/data")


# Parts that a stream with a state takes its input in: it reads the state again for each.
RESTARTS = 8


@query("stream_repeated_messages", f"""WITH {REVIEWS_SQL}
SELECT {KEYS_SQL} FROM (SELECT DISTINCT * FROM reviews) WHERE NOT is_broken""")
def stream_repeated_messages(spark, sf_dir):
    """Every message delivered again after a restart of the stream, as a producer does that missed its receipt.

    Messages are parsed before they meet, so the stream shuffles and keeps the fields asked for and the digest of the whole text.
    Those of a large input arrive part by part; what the stream has taken is deleted, and its state is written as changes only.
    """
    out = new_path(spark, "repeated")
    parts = passes(spark, sf_dir, RESTARTS)

    def deliver(part: Part) -> DataFrame:
        write_lines(messages(spark, sf_dir, part), f"{out}/in", "append", COMPRESSION)
        let_go(spark)
        arrivals = with_arrival(spark.readStream.text(f"{out}/in")).withColumn("digest", F.unhex(F.sha2("value", 256)))
        readable = (~F.startswith("value", F.lit("not json "))).alias("readable")
        parsed = parse_reviews(arrivals, fields=KEYS, keep=("arrived", "digest", readable))
        first = first_deliveries(parsed, ["digest"], "arrived", "1 day").select(*KEYS, "readable")
        first.writeStream.option("checkpointLocation", f"{out}/checkpoint").trigger(**ONCE).start(f"{out}/data").awaitTermination()
        delete(spark, f"{out}/in")
        let_go(spark)
        return first

    # Snapshots would hold the whole state once more, several times over.
    with setting(spark, "spark.sql.streaming.stateStore.minDeltasForSnapshot", 8 * RESTARTS):
        for part in parts * 2:
            first = deliver(part)
    return spark.read.schema(first.schema).parquet(f"{out}/data").where("readable").select(KEYS)


# --- maintenance ------------------------------------------------------------

@query("dlq_compaction", f"""WITH {PARSED_SQL} SELECT {KEYS_SQL}, TRUE AS has_raw FROM parsed WHERE {INVALID_SQL}""")
def dlq_compaction(spark, sf_dir):
    target = new_path(spark, "dlq-compacted")
    compact_text(spark, routed_folder(spark, sf_dir, DLQ), target, pattern="*.json*", compression=COMPRESSION)
    return read_dlq(spark, target).select(*KEYS, F.col("raw_json").isNotNull().alias("has_raw"))


@query("dlq_compaction_live", f"""WITH {PARSED_SQL}, rejects AS (SELECT {KEYS_SQL} FROM parsed WHERE {INVALID_SQL})
SELECT * FROM rejects UNION ALL SELECT * FROM rejects""")
def dlq_compaction_live(spark, sf_dir):
    """Batches compacted, their ids used again by another run, and a compaction that died before it wrote anything.

    One batch, or one for each part of a large input. Nothing reads the valid rows here, so those of a batch are deleted when it
    is routed.
    """
    out = new_path(spark, "dlq-live")
    landing, target = Landing(f"{out}/landing", compression=COMPRESSION), f"{out}/compacted"

    def put(run: str) -> None:
        for part in passes(spark, sf_dir):
            route_batch(messages(spark, sf_dir, part), part[0], landing, run)
            delete(spark, f"{landing.bronze}/run={run}/batch_id={part[0]}")
            let_go(spark)

    put("first")
    compact_dlq(spark, landing.dlq, target, compression=COMPRESSION)
    put("second")
    list_files(spark, landing.dlq, "*.json*").select("path").coalesce(1).write.text(f"{target}.sources/run=2")
    compact_dlq(spark, landing.dlq, target, compression=COMPRESSION)
    compact_dlq(spark, landing.dlq, target, compression=COMPRESSION)
    return read_dlq(spark, target, landing.dlq).select(KEYS)


@query("dlq_cleared", f"WITH {PARSED_SQL} SELECT {KEYS_SQL} FROM parsed WHERE {INVALID_SQL}")
def dlq_cleared(spark, sf_dir):
    """Rejects removed, and the same ones written again."""
    path = new_path(spark, "dlq-cleared")
    _, rejected = route(parse_reviews(messages(spark, sf_dir)))
    write_json(rejected, path, compression=COMPRESSION)
    clear_dlq(spark, path)
    let_go(spark)
    write_json(rejected, path, compression=COMPRESSION)
    return read_dlq(spark, path).select(KEYS)


@query("table_compaction", f"WITH {REVIEWS_SQL} SELECT {KEYS_SQL} FROM reviews")
def table_compaction(spark, sf_dir):
    target = new_path(spark, "compacted")
    compact_table(spark, fragmented_folder(spark, sf_dir), target, "overall")
    return read_table(spark, target).select(KEYS)


@query("expired_files", f"""WITH {REVIEWS_SQL}
SELECT DISTINCT coalesce(CAST(overall AS VARCHAR), '__HIVE_DEFAULT_PARTITION__') AS overall, TRUE AS expired, FALSE AS live FROM reviews""")
def expired_files_query(spark, sf_dir):
    """Files of the fragmented table once it has been compacted: none is live."""
    source, target = fragmented_folder(spark, sf_dir), new_path(spark, "compacted")
    compact_table(spark, source, target, "overall")
    later = F.current_timestamp() + F.expr("INTERVAL 8 DAYS")
    files = list_files(spark, source, "*.parquet").select("path")
    gone = expired_files(spark, source, live_files(read_table(spark, target)), later).select("path", F.lit(True).alias("gone"))
    kept = expired_files(spark, source, live_files(read_table(spark, source)), later).select("path", F.lit(True).alias("kept"))
    # Against the new table every old file is expired, against the old one none.
    return files.join(gone, "path", "left").join(kept, "path", "left").groupBy(
        F.regexp_extract("path", "overall=([^/]+)", 1).alias("overall")).agg(
        F.every(F.coalesce("gone", F.lit(False))).alias("expired"), F.some(F.coalesce("kept", F.lit(False))).alias("live"))


@query("session_archive", f"""WITH {LOGS_SQL} SELECT CAST("timestamp" AS VARCHAR) AS "timestamp", total_received,
  valid_records, invalid_records, error_rate_percent, CAST(2 AS INTEGER) AS session_id FROM bronze_metrics""")
def session_archive(spark, sf_dir):
    """Two sessions of the minute metrics; the second is read back."""
    root = new_path(spark, "sessions")
    metrics = rollup_bronze(bronze_log(spark, sf_dir))
    archive_session(metrics, root)
    return read_session(spark, root, archive_session(metrics, root))
