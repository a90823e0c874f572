import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from reviewflow.functions import levels
from reviewflow.operators.ranking import feed, latest_metrics, latest_row, latest_rows, top_products
from reviewflow.operators.reconcile import funnel, reconcile
from reviewflow.operators.rollup import flatten_silver_log, rollup_bronze, rollup_silver, total_received
from reviewflow.operators.sequence import rolling_mean, with_sequence
from reviewflow.operators.trace import trace_records
from reviewflow.plans import health, measures
from reviewflow.schema import BRONZE_LOG_SCHEMA, SILVER_LOG_SCHEMA


def _skewed(rows=3000):
    rng = random.Random(3)
    # a third of all rows share one order value, and one key holds half of them
    return [(7 if i % 3 == 0 else rng.randrange(1000), i, "hot" if i % 2 else f"k{i % 7}", float(rng.randrange(1, 6)))
            for i in range(rows)]


def test_sequence_is_dense_and_ordered(spark):
    rows = _skewed()
    df = spark.createDataFrame(rows, "t int, id int, k string, v double").repartition(5)
    got = {r.id: r.seq for r in with_sequence(df, ["t", "id"]).collect()}
    assert got == {row[1]: n for n, row in enumerate(sorted(rows), start=1)}


@pytest.mark.parametrize("by", [None, ["k"]])
@pytest.mark.parametrize("chunk", [20, 333, 100_000])
def test_rolling_mean_against_brute_force(spark, by, chunk):
    rows = _skewed()
    df = spark.createDataFrame(rows, "t int, id int, k string, v double").repartition(5)
    got = {r.id: r.rolling_avg for r in rolling_mean(df, "v", ["t", "id"], 20, by, chunk_rows=chunk).collect()}
    seen, expected = {}, {}
    for t, i, k, v in sorted(rows):
        window = seen.setdefault(k if by else None, [])
        window.append(v)
        expected[i] = sum(window[-20:]) / len(window[-20:])
    assert got.keys() == expected.keys()
    assert all(abs(got[i] - expected[i]) < 1e-9 for i in expected)


def test_rolling_mean_refuses_tiny_chunks(spark):
    with pytest.raises(ValueError):
        rolling_mean(spark.range(3), "id", ["id"], n=20, chunk_rows=5)


def test_latest_and_top(spark):
    df = spark.createDataFrame([(i, f"p{i % 3}" if i else None) for i in range(10)], "t int, asin string")
    assert [r.t for r in latest_rows(df, 3, ["t"]).collect()] == [9, 8, 7]
    assert latest_row(df, "t").collect() == [(9, "p0")]
    assert latest_row(df.limit(0), "t").collect() == []
    assert [tuple(r) for r in top_products(df, 2).collect()] == [("p0", 3), ("p1", 3)]
    reviews = spark.createDataFrame([("a", float(i % 5 + 1), i) for i in range(100)], "asin string, overall double, t int")
    assert feed(reviews, "negative", ["t"]).count() == 40
    assert feed(reviews, "positive", ["t"], 7).count() == 7
    assert feed(reviews, "all", ["t"]).columns == ["asin", "overall"]


@pytest.mark.parametrize("n", [1, 100, 5_000])
def test_latest_rows_for_any_number(spark, n):
    df = spark.createDataFrame(_skewed(), "t int, id int, k string, v double").repartition(8)
    found = latest_rows(df, n, ["t", "id"])
    assert [(r.t, r.id) for r in found.collect()] == sorted(((r[0], r[1]) for r in _skewed()), reverse=True)[:n]
    # Ties in the order: the same rows whatever the partitions.
    assert latest_rows(df, n, ["k"]).collect() == latest_rows(df.repartition(3), n, ["k"]).collect()


def _bronze_log(spark, rows):
    return spark.createDataFrame(
        [(stamp, n, (total, total - bad, bad, 0.0, 1.0), (True, [])) for n, (stamp, total, bad) in enumerate(rows)],
        BRONZE_LOG_SCHEMA)


def _silver_log(spark, rows):
    return spark.createDataFrame(
        [(stamp, n, (i, o, total, {"addBatch": 7}), (ms, 0, 0, 0)) for n, (stamp, i, o, total, ms) in enumerate(rows)],
        SILVER_LOG_SCHEMA)


BRONZE = [("2024-01-01T00:00:01.5", 10, 1), ("2024-01-01T00:00:59", 20, 9), ("2024-01-01T00:05:00.123456", 0, 0),
          ("broken", 5, 5)]
SILVER = [("2024-01-01T00:00:01.000Z", 1.0, 3.0, 10, 100), ("2024-01-01T00:00:30.000Z", 3.0, 1.0, 10, None)]


def test_minute_rollups(spark):
    rows = [(str(r.timestamp), r.total_received, r.invalid_records, r.error_rate_percent)
            for r in rollup_bronze(_bronze_log(spark, BRONZE)).orderBy("timestamp").collect()]
    assert rows == [("2024-01-01 00:00:00", 30.0, 10.0, 33.33), ("2024-01-01 00:05:00", 0.0, 0.0, 0.0)]
    flat = flatten_silver_log(_silver_log(spark, SILVER)).orderBy("batch_id").collect()
    assert [r.addBatch_ms for r in flat] == [100.0, 7.0]
    row = rollup_silver(_silver_log(spark, SILVER)).first()
    assert (row.input_rows_per_second, row.processed_rows_per_second, row.addBatch_ms, row.total_input_rows) == (
        2.0, 2.0, 53.5, 20)


def test_reconcile_and_funnel(spark):
    bronze, silver = rollup_bronze(_bronze_log(spark, BRONZE)), rollup_silver(_silver_log(spark, SILVER))
    books = reconcile(bronze, silver)
    assert tuple(books.first()) == (30.0, 10.0, 20.0, 20.0, 0.0)
    assert [(r.stage, r.value, round(r.percent_of_first, 1)) for r in funnel(books).orderBy("step").collect()] == [
        ("bronze_in", 30.0, 100.0), ("dlq", 10.0, 33.3), ("expected_silver", 20.0, 66.7), ("silver_out", 20.0, 66.7)]
    assert tuple(reconcile(bronze.limit(0), silver.limit(0)).first()) == (0.0, 0.0, 0.0, 0.0, 0.0)
    assert total_received(bronze).first()[0] == 30.0 and total_received(bronze.limit(0)).first()[0] == 0.0
    fresh = health.freshness(silver, books).first()
    assert (fresh.latency_seconds, fresh.band, fresh.is_balanced) == (0.0535, "fresh", True)


def test_latest_metrics_search_and_local_time(spark):
    metrics = rollup_bronze(_bronze_log(spark, BRONZE))
    rows = latest_metrics(metrics, 30).collect()
    assert [r.time_label for r in rows] == ["07:00:00", "07:05:00"]
    assert [r.time_label for r in latest_metrics(metrics, 30, "33.33").collect()] == ["07:00:00"]
    assert [r.time_label for r in latest_metrics(metrics, 1, ascending=False).collect()] == ["07:05:00"]


def test_levels(spark):
    def ask(rule, *values):
        df = spark.createDataFrame([(float(v),) for v in values], "x double")
        return [r[0] for r in df.select(rule(F.col("x"))).collect()]

    assert ask(levels.heartbeat_level, 30, 31) == ["ok", "error"]
    assert ask(levels.error_level, 10, 10.5, 30, 30.1) == ["ok", "warning", "warning", "error"]
    assert ask(levels.latency_level, 75_000, 75_001) == ["ok", "error"]
    assert ask(levels.gauge_band, 1499, 1500, 3000, 5000, 5001) == ["green", "yellow", "red", "red", "beyond"]
    assert ask(levels.over_gauge_mark, 3999, 4000) == [False, True]
    assert ask(levels.freshness_band, 9, 10, 30, 60, 61) == ["fresh", "normal", "danger", "danger", "beyond"]
    pairs = spark.createDataFrame([(16.0, 10.0), (15.0, 10.0), (9.0, 1.0), (0.0, 0.0)], "i double, o double")
    assert [tuple(r) for r in pairs.select(
        levels.backpressure(F.col("i"), F.col("o")), levels.ledger_state(F.col("i"), F.col("o"))).collect()] == [
        (True, "congested"), (False, "congested"), (False, "congested"), (False, "idle")]


def test_heartbeat_and_ledger(spark):
    metrics = rollup_silver(_silver_log(spark, SILVER))
    now = F.lit("2024-01-01 00:00:31").cast("timestamp_ntz")
    row = health.heartbeat(metrics, now).first()
    assert (row.silent_seconds, row.level) == (31, "error")
    assert health.heartbeat(metrics.limit(0), now).count() == 0
    assert tuple(health.ledger(metrics).first()) == ("07:00:00", 2.0, 2.0, "matched")
    counted = metrics.withColumns({"input_rows": F.lit(9), "processed_rows": F.lit(3)})
    assert tuple(health.ledger(counted).first()) == ("07:00:00", 9, 3, "congested")


def test_kpis_of_nothing_and_something(spark):
    empty = spark.createDataFrame([], "overall double")
    assert tuple(measures.batch_kpis(empty).first()) == (0, 0.0, 0, 0)
    assert tuple(measures.business_kpis(empty).first()) == (0, None, 0.0, 0, None)
    some = spark.createDataFrame([(5.0,), (4.0,), (2.0,), (3.0,)], "overall double")
    assert tuple(measures.business_kpis(some).first()) == (4, 3.5, 50.0, 1, 0.0)


def test_trace_of_all_and_of_wanted_ids(spark):
    raw = spark.createDataFrame([("u1", "p1", "r1"), ("u2", "p2", "r2"), (None, "p2", "r3")],
                                "reviewerID string, asin string, raw_json string")
    dlq = raw.where("reviewerID is null")
    rows = {r.id: r for r in trace_records(None, raw, dlq).collect()}
    assert set(rows) == {"u1", "u2", "p1", "p2"}
    assert (rows["u1"].bronze, rows["u1"].silver, rows["u1"].gold) == ("clean", "stored", "pending")
    assert (rows["p2"].bronze, rows["p2"].silver, rows["p2"].gold, rows["p2"].payload) == (
        "rejected", "blocked", "not ready", "r3")
    wanted = spark.createDataFrame([("u1",), ("nobody",)], "id string")
    rows = {r.id: r for r in trace_records(wanted, raw, dlq).collect()}
    assert (rows["nobody"].ingestion, rows["nobody"].bronze, rows["nobody"].gold, rows["nobody"].payload) == (
        "missing", "waiting", "not ready", None)
    assert len(rows) == 2


def test_ingest_sizes_are_bytes(spark):
    df = spark.createDataFrame([("é", "s"), ("ab", "s")], "text string, source string")
    assert tuple(measures.ingest_stats(df, "text", "source").first()) == ("s", 2, 4, 2.0, 2)
    log = measures.ingest_log(spark.createDataFrame([('{"asin": "é"}',)], "value string"), "value").first()
    assert (log.metadata.size_bytes, log.data_content.asin, log.metadata.status) == (14, "é", "ingested")
    assert dt.datetime.fromisoformat(log.timestamp)
