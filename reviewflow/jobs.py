"""Command line for the jobs: ``python -m reviewflow.jobs <job> --help``.

Run it through spark-submit on a cluster; the session settings come from there.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from reviewflow.operators import maintain
from reviewflow.operators.merge import incremental_append, late_rows, upsert
from reviewflow.operators.profile import dlq_alert
from reviewflow.operators.rollup import rollup_bronze, rollup_silver
from reviewflow.operators.shape import table_audit
from reviewflow.plans.daily import KEEP_VERSIONS, run_daily
from reviewflow.schema import BRONZE_LOG_SCHEMA, SILVER_LOG_SCHEMA
from reviewflow.sources import jdbc
from reviewflow.session import materialize
from reviewflow.sources.files import MAX_FILES_PER_TRIGGER, read_dlq
from reviewflow.sources.folders import read_current, write_version
from reviewflow.sources.messages import read_messages
from reviewflow.sources.sinks import export_sample
from reviewflow.streaming.progress import ProgressLog
from reviewflow.streaming.router import Landing, start_router
from reviewflow.streaming.silver import read_silver, start_silver

# What tells a review from any other.
REVIEW_KEYS = ["reviewerID", "asin", "orderID", "unixReviewTime"]


def bronze(spark: SparkSession, args) -> None:
    stream = read_messages(spark, args.source, args.format, args.servers)
    trigger = {"availableNow": True} if args.once else None
    start_router(stream, Landing(args.landing, args.log, args.speed_layer), args.checkpoint, trigger).awaitTermination()


def silver(spark: SparkSession, args) -> None:
    if args.log:
        spark.streams.addListener(ProgressLog(spark, args.log))
    trigger = {"availableNow": True} if args.once else None
    files = MAX_FILES_PER_TRIGGER if args.max_files is None else args.max_files
    start_silver(spark, args.bronze, args.silver, args.checkpoint, trigger, files, args.max_bytes, args.shards).awaitTermination()


def optimize(spark: SparkSession, args) -> None:
    print(maintain.merge_loads(spark, args.silver, "review_date"), "loads merged")


def load(spark: SparkSession, args) -> None:
    credentials = {"user": args.user, "password": args.password, "driver": args.driver}
    credentials = {name: value for name, value in credentials.items() if value}
    loaded = jdbc.loaded_maximum(spark, args.url, args.table, "unixReviewTime", **credentials)
    rows = read_silver(spark, args.silver)

    def write(new: DataFrame) -> None:
        jdbc.write_jdbc(new, args.url, args.table, connections=args.connections, **credentials)

    if args.lateness and loaded:
        # Rows that reached silver after newer ones were loaded. They are found before the newer ones are appended.
        names = ", ".join(f'"{name}"' for name in REVIEW_KEYS)
        recent = jdbc.read_jdbc_query(
            spark, args.url, f'SELECT {names} FROM {args.table} WHERE "unixReviewTime" >= {loaded - args.lateness}', **credentials)
        write(materialize(late_rows(rows, recent, "unixReviewTime", loaded, args.lateness, REVIEW_KEYS), "late"))
    print(incremental_append(rows, loaded, write, "unixReviewTime", "review_date"), "rows loaded")


def daily(spark: SparkSession, args) -> None:
    run_daily(spark, args.silver, args.warehouse, args.as_of, full_fact=not args.incremental_only)


def metrics(spark: SparkSession, args) -> None:
    """Roll both logs up by minute into the metric tables."""

    def refresh(name: str, minutes: DataFrame) -> None:
        table = f"{args.metrics}/{name}"
        existing = read_current(spark, table)
        write_version(minutes if existing is None else upsert(existing, minutes, "timestamp"), table, keep=KEEP_VERSIONS)

    refresh("bronze_metrics", rollup_bronze(spark.read.schema(BRONZE_LOG_SCHEMA).json(args.bronze_log)))
    silver_rows = spark.read.schema(SILVER_LOG_SCHEMA).option("recursiveFileLookup", True).json(args.silver_log)
    refresh("silver_metrics", rollup_silver(silver_rows))


def alert(spark: SparkSession, args) -> None:
    dlq_alert(read_dlq(spark, args.dlq), args.recipients).show(truncate=False)


def audit(spark: SparkSession, args) -> None:
    table = read_silver(spark, args.silver)
    table.printSchema()
    table_audit(table).select("row_count", "column_count").show()
    export_sample(table, args.sample).show(truncate=False)


def compact_dlq(spark: SparkSession, args) -> None:
    print(maintain.compact_dlq(spark, args.dlq, args.target), "files compacted")


def clear_dlq(spark: SparkSession, args) -> None:
    print(maintain.clear_dlq(spark, args.dlq), "files removed")


def archive(spark: SparkSession, args) -> None:
    """Store the metric tables as the next session and start them anew."""
    for name in ("bronze_metrics", "silver_metrics"):
        live = read_current(spark, f"{args.metrics}/{name}")
        if live is not None:
            print(name, "session", maintain.archive_session(live, f"{args.sessions}/{name}"))
            write_version(live.limit(0), f"{args.metrics}/{name}", keep=KEEP_VERSIONS)


def expired(spark: SparkSession, args) -> None:
    """Print every expired file, oldest first; they are files, not rows, and come partition by partition."""
    found = maintain.expired_files(spark, args.table, maintain.live_files(read_silver(spark, args.live)))
    for row in found.orderBy("modified", "path").toLocalIterator():
        print(row.path, row.modified, row.age_hours, sep="\t")


JOBS = {
    "bronze": (bronze, ["source", "landing", "checkpoint"], ["servers", "log", "speed-layer"]),
    "silver": (silver, ["bronze", "silver", "checkpoint"], ["log"]),
    "optimize": (optimize, ["silver"], []),
    "load": (load, ["silver", "url"], ["user", "password", "driver"]),
    "daily": (daily, ["silver", "warehouse", "as-of"], []),
    "metrics": (metrics, ["bronze-log", "silver-log", "metrics"], []),
    "alert": (alert, ["dlq"], []),
    "archive": (archive, ["metrics", "sessions"], []),
    "clear-dlq": (clear_dlq, ["dlq"], []),
    "audit": (audit, ["silver", "sample"], []),
    "compact-dlq": (compact_dlq, ["dlq", "target"], []),
    "expired": (expired, ["table", "live"], []),
}


def parser() -> argparse.ArgumentParser:
    root = argparse.ArgumentParser(prog="reviewflow.jobs")
    commands = root.add_subparsers(dest="job", required=True)
    for name, (_, required, optional) in JOBS.items():
        command = commands.add_parser(name)
        for option in required:
            command.add_argument(f"--{option}", required=True)
        for option in optional:
            command.add_argument(f"--{option}")
        if name in ("bronze", "silver"):
            command.add_argument("--once", action="store_true", help="stop when the input is used up")
        if name == "bronze":
            command.add_argument("--format", default="kafka")
        if name == "silver":
            command.add_argument("--shards", type=int, help="files a batch leaves per day, at most")
            command.add_argument("--max-files", type=int, help="files a batch takes, at most")
            command.add_argument("--max-bytes", help="instead of a number of files, about their size, as 8g")
        if name == "load":
            command.add_argument("--table", default="raw_ecommerce_reviews")
            command.add_argument("--connections", type=int, default=jdbc.CONNECTIONS)
            command.add_argument("--lateness", type=int, default=0, help="seconds that rows may come after newer ones were loaded")
        if name == "alert":
            command.add_argument("--recipients", default="on-call")
        if name == "daily":
            command.add_argument("--incremental-only", action="store_true")
    return root


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    args = parser().parse_args(argv)
    JOBS[args.job][0](spark or SparkSession.builder.appName(f"reviewflow-{args.job}").getOrCreate(), args)


if __name__ == "__main__":
    main()
