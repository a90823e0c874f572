import json
import time
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from reviewflow import session
from reviewflow.operators import maintain
from reviewflow.operators.maintain import (
    archive_session, clear_dlq, compact_dlq, compact_fragmented, compact_table, compact_text, expired_files, file_plan,
    file_ranges, list_sessions, live_files, merge_loads, read_session,
)
from reviewflow.operators.rollup import flatten_bronze_log, rollup_bronze
from reviewflow.operators.routing import parse_reviews, route
from reviewflow.schema import BRONZE_LOG_SCHEMA, REVIEW_SCHEMA
from reviewflow.sources import folders, jdbc, loads, sinks
from reviewflow.sources.files import (
    demo_products, first_non_empty, list_files, read_dlq, read_json_stream, read_ndjson_union, read_table,
)
from reviewflow.sources.messages import read_messages
from reviewflow.sources.sinks import export_sample, write_json
from reviewflow.streaming.metrics import finish, read_latest, start_metric_upserts
from reviewflow.streaming.once import first_deliveries, with_arrival
from reviewflow.streaming.progress import ProgressLog, read_progress
from reviewflow.streaming import router
from reviewflow.streaming.router import Landing, read_batch_log, read_speed_layer, route_batch, start_router
from reviewflow.streaming.silence import silences
from reviewflow.streaming.silver import read_silver, start_silver
from workload import flow_queries, inputs

ONCE = {"availableNow": True}


def _messages(first, count):
    for i in range(first, first + count):
        if i % 7 == 0:
            yield "not json"
        else:
            yield json.dumps({"reviewerID": f"u{i}", "asin": f"p{i % 5}", "overall": float(i % 5 + 1),
                              "unixReviewTime": 86400 * (i % 3), "orderID": f"o{i}"})


def _put(spark, path, first, count):
    spark.createDataFrame([(m,) for m in _messages(first, count)], "value string").coalesce(1) \
        .write.mode("append").text(path)


def test_messages_to_silver_and_restart(spark, folder):
    source, landing = f"{folder}/in", Landing(f"{folder}/landing", f"{folder}/log", f"{folder}/speed")
    _put(spark, source, 0, 50)

    def run():
        start_router(read_messages(spark, source, "text"), landing, f"{folder}/c1", ONCE).awaitTermination()
        start_silver(spark, landing.bronze, f"{folder}/silver", f"{folder}/c2", ONCE, shards=2).awaitTermination()
        return read_silver(spark, f"{folder}/silver").count(), read_dlq(spark, landing.dlq).count()

    assert run() == (42, 8)
    assert run() == (42, 8)  # nothing new: nothing added
    _put(spark, source, 50, 50)
    assert run() == (85, 15)

    # the stream gives what the batch operators give
    valid, rejected = route(parse_reviews(spark.read.text(source)))
    silver = read_silver(spark, f"{folder}/silver")
    assert sorted(r.orderID for r in silver.collect()) == sorted(r.orderID for r in valid.collect())
    assert {str(r.review_date) for r in silver.select("review_date").distinct().collect()} == {
        "1970-01-01", "1970-01-02", "1970-01-03"}
    assert read_dlq(spark, landing.dlq).where("raw_json = 'not json'").count() == rejected.count()

    log = read_batch_log(spark, landing.log).orderBy("timestamp").collect()
    assert [tuple(r.metrics)[:3] for r in log] == [(50, 42, 8), (50, 43, 7)]
    assert [r.data_quality.is_acceptable for r in log] == [True, True]
    assert all(len(r.data_quality.sample_error_data) == 5 for r in log)
    items = {r.batch_id: r for r in read_speed_layer(spark, landing.speed_layer).collect()}
    assert [items[i].total_reviews for i in ("0", "1")] == [42, 43]
    ratings = [r.overall for r in valid.collect()]
    assert sum(items[i].positive_count for i in "01") == sum(v >= 4 for v in ratings)
    assert sum(items[i].negative_count for i in "01") == sum(v <= 2 for v in ratings)


def test_repeated_batch_replaces_itself(spark, folder):
    landing = Landing(f"{folder}/landing", f"{folder}/log", f"{folder}/speed")
    batch = spark.createDataFrame([(m,) for m in _messages(0, 20)], "value string")
    assert route_batch(batch, 3, landing)["total_received"] == 20
    route_batch(batch, 3, landing)
    route_batch(batch, 4, landing)
    assert spark.read.schema(REVIEW_SCHEMA).json(landing.bronze).count() == 34
    assert read_batch_log(spark, landing.log).count() == 2
    assert read_speed_layer(spark, landing.speed_layer).count() == 2


def test_repeated_batch_is_once_in_silver(spark, folder):
    """A batch redone after its rows were published, and one whose id comes again under a new checkpoint."""
    landing = Landing(f"{folder}/landing", f"{folder}/log")
    batch = spark.createDataFrame([(m,) for m in _messages(0, 35)], "value string").repartition(3)

    def silver():
        start_silver(spark, landing.bronze, f"{folder}/silver", f"{folder}/c", ONCE, max_files=1).awaitTermination()
        return read_silver(spark, f"{folder}/silver").count()

    route_batch(batch, 0, landing, "a")
    assert silver() == 30
    files = list_files(spark, landing.bronze, "*.json").select("path").collect()
    route_batch(batch, 0, landing, "a")
    assert sorted(list_files(spark, landing.bronze, "*.json").select("path").collect()) == sorted(files)
    assert silver() == 30
    route_batch(batch, 0, landing, "b")
    assert silver() == 60


def test_loads_merge_while_the_stream_goes_on(spark, folder):
    root = f"{folder}/t"

    def load(run, number):
        df = spark.range(number * 100, number * 100 + 100).selectExpr("id", "concat('d ', id % 3) AS day")
        return loads.append_load(df.repartition(4), root, f"{run}-{number}", "day")

    def content():
        rows = loads.read_loads(spark, root).collect()
        assert all(r.day == f"d {r.id % 3}" for r in rows)
        return sorted(r.id for r in rows)

    assert [load("s", n) for n in (0, 1, 1, 2)] == [True, True, False, True]
    assert content() == list(range(300))
    assert merge_loads(spark, root, "day") == 2  # the newest batch may still be repeated
    assert content() == list(range(300)) and len(loads.live_loads(spark, root)) == 2
    assert load("s", 2) is False
    assert list_files(spark, f"{root}/load={loads.live_loads(spark, root)[0]}", "*.parquet").count() == 3
    # A job that died after it published its load, before it deleted what it replaced.
    load("s", 3)
    staged = f"{root}/_staged/x"
    loads.read_loads(spark, root, ["s-2"]).write.partitionBy("day").parquet(staged)
    spark.createDataFrame([('["s-2"]',)], "value string").coalesce(1).write.text(f"{root}/_replaced/load=merged-x")
    assert content() == list(range(400))
    folders.publish(spark, staged, f"{root}/load=merged-x")
    assert content() == list(range(400))
    load("s", 4)
    merge_loads(spark, root, "day")
    assert content() == list(range(500)) and not folders.exists(spark, f"{root}/load=s-2")


def test_empty_batch_leaves_no_log(spark, folder):
    landing = Landing(f"{folder}/landing", f"{folder}/log")
    assert route_batch(spark.createDataFrame([], "value string"), 0, landing)["total_received"] == 0
    assert not folders.exists(spark, landing.log)


def test_kafka_needs_servers(spark):
    with pytest.raises(ValueError):
        read_messages(spark, "topic")


def test_stream_windows_equal_batch_windows(spark, folder):
    log = spark.createDataFrame(
        [(f"2024-01-01T00:{i % 9:02d}:{i % 60:02d}.5", i, (i, i - i % 3, i % 3, 0.0, 1.0), (True, []))
         for i in range(200)], BRONZE_LOG_SCHEMA)
    log.repartition(5).write.json(f"{folder}/log")
    stream = rollup_bronze(read_json_stream(spark, f"{folder}/log", BRONZE_LOG_SCHEMA, max_files=2), lateness="1 day")
    start_metric_upserts(stream, f"{folder}/out", f"{folder}/c", ONCE).awaitTermination()
    key = lambda df: sorted(map(str, df.select(sorted(df.columns)).collect()))
    assert key(read_latest(spark, f"{folder}/out")) == key(rollup_bronze(log))
    assert len(folders.subfolders(spark, f"{folder}/out")) > 1


def test_rows_that_come_too_late_are_noticed(spark, folder):
    for day in (3, 5, 1):
        rows = [(f"2024-01-0{day}T00:{i:02d}:00.0", i, (10, 9, 1, 0.0, 1.0), (True, [])) for i in range(5)]
        write_json(spark.createDataFrame(rows, BRONZE_LOG_SCHEMA).coalesce(1), f"{folder}/log")
    def run(lateness):
        stream = rollup_bronze(read_json_stream(spark, f"{folder}/log", BRONZE_LOG_SCHEMA, max_files=1), lateness=lateness)
        finish(start_metric_upserts(stream, f"{folder}/{lateness}", f"{folder}/c {lateness}", ONCE))
        return read_latest(spark, f"{folder}/{lateness}").count()

    assert run("10 days") == 15
    with pytest.raises(RuntimeError, match="later than"):
        run("1 hour")


def test_rows_dropped_in_a_forgotten_batch_are_noticed(spark, folder):
    for day in (3, 5, 1, 6, 7, 8):
        rows = [(f"2024-01-0{day}T00:{i:02d}:00.0", i, (10, 9, 1, 0.0, 1.0), (True, [])) for i in range(5)]
        write_json(spark.createDataFrame(rows, BRONZE_LOG_SCHEMA).coalesce(1), f"{folder}/log")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "1")
    try:
        stream = rollup_bronze(read_json_stream(spark, f"{folder}/log", BRONZE_LOG_SCHEMA, max_files=1), lateness="1 hour")
        query = start_metric_upserts(stream, f"{folder}/out", f"{folder}/c", ONCE)
        with pytest.raises(RuntimeError, match="5 rows came later"):
            finish(query)
        assert len(query.recentProgress) <= 1
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")


def test_silences_are_told_once_on_a_stream_as_in_a_table(spark, folder):
    def log(minutes, seconds):
        return spark.createDataFrame(
            [(f"2024-01-01T00:{minutes:02d}:{s:02d}.7", s, (1, 1, 0, 0.0, 1.0), (good, [])) for s in seconds for good in (True, None)]
            + [(None, 0, (1, 1, 0, 0.0, 1.0), (True, []))], BRONZE_LOG_SCHEMA)

    key, out = "data_quality.is_acceptable", []
    # 30 seconds are no silence, 31 are.
    for minutes, seconds in [(0, [0, 30]), (1, [0, 31]), (5, [0])]:
        write_json(log(minutes, seconds).coalesce(1), f"{folder}/log")
        stream = read_json_stream(spark, f"{folder}/log", BRONZE_LOG_SCHEMA, max_files=1)
        found = silences(flatten_bronze_log(stream, key), "is_acceptable", lateness="0 seconds")
        found.writeStream.option("checkpointLocation", f"{folder}/c").trigger(**ONCE).start(f"{folder}/out").awaitTermination()
        out.append(spark.read.schema(found.schema).parquet(f"{folder}/out").count())
    rows = spark.read.schema(found.schema).parquet(f"{folder}/out")
    assert out == [0, 2, 4] and rows.dtypes[1:4] == [(name, "timestamp_ntz") for name in ("active_since", "silent_since", "noticed_at")]
    table = silences(flatten_bronze_log(spark.read.schema(BRONZE_LOG_SCHEMA).json(f"{folder}/log"), key), "is_acceptable")
    told, every = set(map(str, rows.collect())), set(map(str, table.collect()))
    assert told < every and len(every) == 6
    first = rows.where("is_acceptable").orderBy("active_since").first()
    assert (first.active_since.second, first.silent_since.minute, first.noticed_at.second, first.events) == (0, 1, 30, 3)


def test_messages_delivered_again_count_once(spark, folder):
    def run():
        lines = with_arrival(spark.readStream.option("maxFilesPerTrigger", 1).text(f"{folder}/in"))
        first_deliveries(lines, ["value"], "arrived", "1 hour").select("value").writeStream.option(
            "checkpointLocation", f"{folder}/c").trigger(**ONCE).start(f"{folder}/out").awaitTermination()
        return sorted(r.value for r in spark.read.parquet(f"{folder}/out").collect())

    for _ in range(2):
        _put(spark, f"{folder}/in", 1, 6)
    once = sorted(_messages(1, 6))
    assert run() == once
    _put(spark, f"{folder}/in", 1, 6)
    assert run() == once
    _put(spark, f"{folder}/in", 4, 6)
    assert run() == sorted({*_messages(1, 6), *_messages(4, 6)})


def test_progress_log(spark, folder):
    _put(spark, f"{folder}/in", 0, 30)
    listener = ProgressLog(spark, f"{folder}/log", query="watched")
    spark.streams.addListener(listener)
    try:
        read_messages(spark, f"{folder}/in", "text").writeStream.queryName("watched").format("noop").option(
            "checkpointLocation", f"{folder}/c").trigger(**ONCE).start().awaitTermination()
        assert listener.wait(1)
    finally:
        spark.streams.removeListener(listener)
    row = read_progress(spark, f"{folder}/log").orderBy(F.desc("performance.total_input_rows")).first()
    assert row.performance.total_input_rows == 30 and row.processing_time.triggerExecution > 0


def test_ndjson_union_skips_bad_lines_and_takes_newest(spark, folder):
    spark.createDataFrame([('{"a": 1, "b": "x"}',), ("{bad",), ('{"a": 2}',)], "value string").coalesce(1) \
        .write.text(f"{folder}/one")
    spark.createDataFrame([('{"b": "y", "c": 3.5}',)], "value string").write.text(f"{folder}/two")
    both = read_ndjson_union(spark, [f"{folder}/one", f"{folder}/two"])
    assert sorted((tuple(r) for r in both.select("a", "b", "c").collect()), key=str) == [
        (1, "x", None), (2, None, None), (None, "y", 3.5)]
    time.sleep(1.1)
    spark.createDataFrame([('{"a": 9}',)], "value string").coalesce(1).write.mode("append").text(f"{folder}/one")
    newest = read_ndjson_union(spark, [f"{folder}/one"], newest_files=1)
    assert [r.a for r in newest.collect()] == [9]
    spark.createDataFrame([], "value string").write.text(f"{folder}/none")
    assert read_ndjson_union(spark, [f"{folder}/none"], REVIEW_SCHEMA, newest_files=0).count() == 0


def test_json_sink_omits_nulls(spark, folder):
    df = spark.createDataFrame([("a", None), (None, 1)], "x string, y int")
    write_json(df, f"{folder}/t", batch_id=1)
    write_json(df, f"{folder}/t", batch_id=1)
    write_json(df, f"{folder}/t", batch_id=2)
    lines = [r.value for r in spark.read.option("recursiveFileLookup", True).text(f"{folder}/t").collect()]
    assert sorted(lines) == ['{"x":"a"}'] * 2 + ['{"y":1}'] * 2


def test_text_compaction_keeps_every_line(spark, folder):
    rows = [(f'{{"a": {i % 10}}}',) for i in range(500)] + [("  ",), ("",)]
    spark.createDataFrame(rows, "value string").repartition(20).write.text(f"{folder}/small")
    assert compact_text(spark, f"{folder}/small", f"{folder}/big", target_bytes=2000) == 3
    kept = sorted(r.value for r in spark.read.text(f"{folder}/big").collect())
    assert kept == sorted(r[0] for r in rows if r[0].strip())
    assert list_files(spark, f"{folder}/big", "*.txt").count() <= 3


@pytest.mark.parametrize("compression", [None, "gzip"])
def test_text_compaction_shuffles_nothing(spark, folder, monkeypatch, compression):
    plans = []

    def write(lines, *args):
        plans.append(lines._jdf.queryExecution().executedPlan().toString())
        sinks.write_lines(lines, *args)

    monkeypatch.setattr(maintain, "write_lines", write)
    rows = [(f"line {i % 50}",) for i in range(400)]
    sinks.write_lines(spark.createDataFrame(rows, "value string").repartition(12), f"{folder}/small", compression=compression)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    files = compact_text(spark, f"{folder}/small", f"{folder}/big", 2000, compression=compression)
    assert len(plans) == 1 and "Exchange" not in plans[0]
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before
    assert sorted(r.value for r in spark.read.text(f"{folder}/big").collect()) == sorted(r[0] for r in rows)
    assert 1 < list_files(spark, f"{folder}/big", "*.txt*").count() <= files


def _tables(spark, path):
    tables = {
        "region": [(0, "here")], "nation": [(0, "land", 0), (1, "nowhere", None)], "supplier": [(1, "s1", 0), (2, "s2", 1)],
        "customer": [(1, "c\n1"), (2, None)], "part": [(1, "thing", "BIG", "B1", 2.5), (2, "other \"one\"", "SMALL", "B2", None)],
        "orders": [(i, i % 3, "O", "1-URGENT") for i in range(1, 60)],
        "lineitem": [(i, i % 4, i % 3, j, 3.0, 10.5, "R", "F", f"2001-02-{i % 28 + 1:02} 00:00:00") for i in range(1, 60) for j in (1, 2)]}
    columns = {
        "region": "r_regionkey long, r_name string", "nation": "n_nationkey long, n_name string, n_regionkey long",
        "supplier": "s_suppkey long, s_name string, s_nationkey long", "customer": "c_custkey long, c_name string",
        "part": "p_partkey long, p_name string, p_type string, p_brand string, p_retailprice double",
        "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_orderpriority string",
        "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
                    "l_returnflag string, l_linestatus string, l_shipdate string"}
    for name, rows in tables.items():
        df = spark.createDataFrame(rows, columns[name])
        if name == "lineitem":
            df = df.withColumn("l_shipdate", F.expr("CAST(l_shipdate AS TIMESTAMP_NTZ)"))
        df.coalesce(1).write.parquet(f"{path}/{name}.parquet")


def test_batches_of_messages_are_not_staged(spark, folder):
    """The lines of a batch are those of the files, before a stream has needed files and after."""
    _tables(spark, folder)
    staged = inputs._staged_path(spark, folder, "messages")
    lines, parsed = inputs.messages(spark, folder), flow_queries.dlq_cleared(spark, folder).collect()
    first = sorted(r.value for r in lines.collect())
    assert not folders.exists(spark, staged)
    assert sorted(r.value for r in spark.read.text(inputs.message_folder(spark, folder)).collect()) == first
    assert len(first) == 118 and any(line.startswith("not json ") for line in first)
    assert folders.exists(spark, staged) and inputs.messages(spark, folder).inputFiles()
    assert sorted(r.value for r in inputs.messages(spark, folder).collect()) == first
    assert sorted(map(str, flow_queries.dlq_cleared(spark, folder).collect())) == sorted(map(str, parsed))


def test_batches_are_routed_without_a_sort(spark, folder, monkeypatch):
    writers = []
    publish = router.publish

    @contextmanager
    def unsorted_writes(session):
        with sinks.unsorted_writes(session):
            yield
            writers.append(int(session.conf.get("spark.sql.maxConcurrentOutputFileWriters")))

    monkeypatch.setattr(router, "unsorted_writes", unsorted_writes)
    monkeypatch.setattr(router, "publish", lambda *args: writers.append("published") or publish(*args))
    batch = spark.createDataFrame([(m,) for m in _messages(0, 35)], "value string").coalesce(1)
    landing = Landing(f"{folder}/landing", compression="gzip")
    assert route_batch(batch, 0, landing)["valid_records"] == 30
    assert writers[0] >= 2 and "published" in writers and spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"
    assert spark.read.schema(REVIEW_SCHEMA).json(landing.bronze).count() == 30 and read_dlq(spark, landing.dlq).count() == 5


def test_dlq_compaction_moves_batches_once(spark, folder):
    dlq, target = f"{folder}/dlq", f"{folder}/all"
    _, rejected = route(parse_reviews(spark.createDataFrame([("x",), ("y",), ("z",)], "value string")))

    def texts():
        return sorted(r.raw_json for r in read_dlq(spark, dlq, target).collect())

    def note(run):
        list_files(spark, dlq, "*.json").select("path").coalesce(1).write.text(f"{target}.sources/run={run}")

    rejected = rejected.coalesce(1)
    write_json(rejected, dlq, batch_id=0)
    write_json(rejected, dlq, batch_id=1)
    assert compact_dlq(spark, dlq, target) == 2 and texts() == sorted("xyz" * 2)
    assert compact_dlq(spark, dlq, target) == 0
    # Batch ids used again hold new rejects: nothing of an earlier run touches them.
    write_json(rejected, dlq, batch_id=0)
    assert compact_dlq(spark, dlq, target) == 1 and texts() == sorted("xyz" * 3)
    # A run that died before its folder was complete: its files are taken again.
    write_json(rejected, dlq, batch_id=1)
    note(3)
    assert compact_dlq(spark, dlq, target) == 1 and texts() == sorted("xyz" * 4)
    # A run that died before it deleted its files: they go, and what came since is taken.
    write_json(rejected, dlq, batch_id=2)
    note(4)
    compact_text(spark, dlq, f"{target}/run=4", pattern="*.json")
    write_json(rejected, dlq, batch_id=3)
    assert compact_dlq(spark, dlq, target) == 1 and texts() == sorted("xyz" * 6)
    assert folders.subfolders(spark, f"{target}.sources") == []


def _fragmented(spark, path):
    df = spark.range(3000).selectExpr(
        "id", "CASE WHEN id % 3 = 0 THEN 'a b/c' WHEN id % 7 = 0 THEN NULL ELSE concat('k', id % 4) END AS k",
        "repeat('copy', 5) AS text")
    df.repartition(8).write.partitionBy("k").parquet(path)
    return df


def _content(df):
    return sorted((r.id, str(r.k), r.text) for r in df.collect())


def test_table_compaction_keeps_rows_and_sizes_files(spark, folder):
    df = _fragmented(spark, f"{folder}/t")
    before = list_files(spark, f"{folder}/t", "*.parquet").count()
    plan = compact_table(spark, f"{folder}/t", f"{folder}/u", "k", target_bytes=5_000)
    assert _content(spark.read.parquet(f"{folder}/u")) == _content(df)
    after = list_files(spark, f"{folder}/u", "*.parquet").count()
    assert after <= plan.agg(F.sum("wanted")).first()[0] < before
    hot = file_plan(spark, f"{folder}/u", "k").where("folder = 'a b/c'").first()
    assert hot.files > 1  # the value with a third of the rows is spread


def test_in_place_compaction_touches_fragmented_values_only(spark, folder):
    df = _fragmented(spark, f"{folder}/t")
    df.where("k = 'k1'").coalesce(1).selectExpr("id", "'fine' AS k", "text") \
        .write.mode("append").partitionBy("k").parquet(f"{folder}/t")
    fine = list_files(spark, f"{folder}/t").where("path LIKE '%k=fine%'").select("path").collect()
    expected = _content(spark.read.parquet(f"{folder}/t"))
    assert compact_fragmented(spark, f"{folder}/t", "k") == 6
    assert _content(spark.read.parquet(f"{folder}/t")) == expected
    assert list_files(spark, f"{folder}/t", "*.parquet").count() == 7
    assert list_files(spark, f"{folder}/t").where("path LIKE '%k=fine%'").select("path").collect() == fine
    assert compact_fragmented(spark, f"{folder}/t", "k") == 0


def test_expired_files(spark, folder):
    spark.range(10).repartition(4).write.parquet(f"{folder}/t")
    files = list_files(spark, f"{folder}/t", "*.parquet")
    live = files.limit(1)
    assert expired_files(spark, f"{folder}/t", live).count() == 0
    later = F.current_timestamp() + F.expr("INTERVAL 200 HOURS")
    old = expired_files(spark, f"{folder}/t", live, later).where("path LIKE '%.parquet'")
    assert old.count() == files.count() - 1


def test_live_files_with_odd_names_do_not_expire(spark, folder):
    df = spark.createDataFrame([(k, v) for k, v in enumerate(["a b", "c/d:e", "50%", "x+y=z", "ü ß", None])], "n int, k string")
    df.write.partitionBy("k").parquet(f"{folder}/t")
    later = F.current_timestamp() + F.expr("INTERVAL 200 HOURS")
    live = live_files(spark.read.parquet(f"{folder}/t"))
    assert expired_files(spark, f"{folder}/t", live, later).where("path LIKE '%.parquet'").count() == 0
    some = live_files(spark.read.parquet(f"{folder}/t").where("n <> 1"))
    gone = expired_files(spark, f"{folder}/t", some, later).where("path LIKE '%.parquet'").collect()
    assert len(gone) == 1 and "c%2Fd" in gone[0].path


def test_clear_dlq(spark, folder):
    _, rejected = route(parse_reviews(spark.createDataFrame([("x",), ("y",)], "value string")))
    assert clear_dlq(spark, f"{folder}/dlq") == 0
    write_json(rejected.repartition(2), f"{folder}/dlq")
    assert clear_dlq(spark, f"{folder}/dlq") == 2
    assert read_dlq(spark, f"{folder}/dlq").count() == 0


def test_sessions(spark, folder):
    assert list_sessions(spark, f"{folder}/s") == []
    assert archive_session(spark.range(3), f"{folder}/s") == 1
    assert archive_session(spark.range(5), f"{folder}/s") == 2
    assert list_sessions(spark, f"{folder}/s") == [1, 2]
    assert read_session(spark, f"{folder}/s", 2).count() == 5


def test_versions_switch_only_when_complete(spark, folder):
    root = f"{folder}/dim"
    assert folders.read_current(spark, root) is None
    folders.write_version(spark.range(2), root)
    folders.write_version(folders.read_current(spark, root).union(spark.range(1)), root)
    assert folders.read_current(spark, root).count() == 3
    folders.delete(spark, f"{root}/v=2/_SUCCESS")
    assert folders.read_current(spark, root).count() == 2
    for n in range(4):
        folders.write_version(spark.range(n), root, keep=2)
    assert folders.versions(spark, root) == [4, 5] and folders.read_current(spark, root).count() == 3


def test_small_sources(spark, folder):
    assert demo_products(spark).columns == ["product_id", "product_name", "category", "price", "created_at"]
    assert demo_products(spark).count() == 4
    full = spark.range(2)
    assert first_non_empty(full.limit(0), full).count() == 2
    assert first_non_empty(full, full.limit(0)).count() == 2
    export_sample(spark.createDataFrame([(1, [1, 2])], "a int, b array<int>"), f"{folder}/csv")
    assert [tuple(r) for r in spark.read.csv(f"{folder}/csv", header=True).collect()] == [("1", "[1, 2]")]


def test_jdbc_options():
    assert jdbc.max_query("raw", "unixReviewTime") == 'SELECT MAX("unixReviewTime") AS max_loaded FROM raw'
    assert jdbc.query_options("jdbc:x", "SELECT 1", user="u") == {
        "url": "jdbc:x", "dbtable": "(SELECT 1) t", "user": "u"}
    assert jdbc.write_options("jdbc:x", "raw") == {
        "url": "jdbc:x", "dbtable": "raw", "batchsize": "10000", "numPartitions": "4"}
    assert jdbc._is_missing_table(RuntimeError("ERROR 42X05: Table does not exist"))
    assert not jdbc._is_missing_table(RuntimeError("password authentication failed"))


def test_settings_scale_with_the_input():
    small, large = session.session_settings(8), session.session_settings(8000, 100 * 10**12)
    assert small["spark.sql.shuffle.partitions"] == "16"
    assert int(large["spark.sql.shuffle.partitions"]) > 300_000


def test_shared_folder_is_the_configured_one(spark):
    assert session.new_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_compressed_lines_end_after_a_number_of_rows(spark, folder, monkeypatch):
    monkeypatch.setattr(sinks, "ROWS_PER_FILE", 10)
    lines = spark.createDataFrame([(m,) for m in _messages(0, 35)], "value string").coalesce(1)
    sinks.write_lines(lines, f"{folder}/lines", compression="gzip")
    write_json(lines, f"{folder}/json", compression="gzip")
    for name in ("lines", "json"):
        files = [r.path for r in list_files(spark, f"{folder}/{name}").collect()]
        assert sorted(spark.read.text(path).count() for path in files if path.endswith(".gz")) == [5, 10, 10, 10]
    assert sorted(r.value for r in spark.read.text(f"{folder}/lines").collect()) == sorted(_messages(0, 35))


def test_compressed_landing_reaches_silver_and_compacted_rejects(spark, folder):
    plain, packed = Landing(f"{folder}/plain"), Landing(f"{folder}/packed", compression="gzip")
    batch = spark.createDataFrame([(m,) for m in _messages(0, 35)], "value string").repartition(3)
    for landing in (plain, packed):
        route_batch(batch, 0, landing)
    assert list_files(spark, packed.root, "*.json").count() == 0 < list_files(spark, packed.root, "*.json.gz").count()
    rows = [sorted(spark.read.schema(REVIEW_SCHEMA).json(l.bronze).collect(), key=str) for l in (plain, packed)]
    assert rows[0] == rows[1]
    rejects = sorted(r.raw_json for r in read_dlq(spark, plain.dlq).collect())
    assert compact_dlq(spark, packed.dlq, f"{folder}/all", compression="gzip") > 0
    assert sorted(r.raw_json for r in read_dlq(spark, packed.dlq, f"{folder}/all").collect()) == rejects
    assert list_files(spark, packed.dlq, "*.json*").count() == 0


def test_small_values_share_compacting_tasks_by_size(spark):
    rows = [(f"v{i:03}", 60 if i % 2 else 1, 1, 1) for i in range(40)] + [("big", 350, 9, 4)]
    plan = spark.createDataFrame(rows, "folder string, bytes bigint, files int, wanted int")
    ranges, tasks = file_ranges(plan, 2, target_bytes=100)
    first = {r.folder: r._from for r in ranges.collect()}
    assert first["big"] == 0 and min(v for k, v in first.items() if k != "big") >= 4 and max(first.values()) < tasks
    loads_of = {}
    for name, size, _, wanted in rows:
        if wanted == 1:
            loads_of[first[name]] = loads_of.get(first[name], 0) + size
    assert max(loads_of.values()) <= 50 + 60


def test_large_sources_get_more_tasks(spark, folder, monkeypatch):
    spark.range(2000).coalesce(1).write.parquet(f"{folder}/t")
    assert flow_queries.tasks_for(spark, f"{folder}/t") == spark.sparkContext.defaultParallelism
    monkeypatch.setattr(flow_queries, "TASK_BYTES", 100)
    size = sum(r.bytes for r in list_files(spark, f"{folder}/t").collect())
    assert flow_queries.tasks_for(spark, f"{folder}/t") == -(-size // 100) > spark.sparkContext.defaultParallelism


def test_columns_kept_beside_parsed_fields(spark):
    lines = spark.createDataFrame([(1, '{"asin": "a", "overall": 2}'), (2, "not json {}")], "n int, value string")
    rows = parse_reviews(lines, fields=["asin"], keep=("n", F.length("value").alias("size")))
    assert rows.columns == ["asin", "raw_json", "n", "size"]
    assert sorted((r.n, r.asin, r.size) for r in rows.collect()) == [(1, "a", 27), (2, None, 11)]


def test_loads_of_silver_do_not_grow_with_the_files(spark, folder, monkeypatch):
    """Forty bronze files are taken in about as few loads as eight."""
    taken = []
    monkeypatch.setattr(flow_queries, "start_silver", lambda *args, **options: taken.append(options["max_files"]) or start_silver(*args, **options))
    monkeypatch.setattr(flow_queries, "reviews", lambda spark, sf_dir, fields: spark.range(0, 4000, 1, 40).selectExpr(
        "'u' || id AS reviewerID", "'a' AS asin", "3.0D AS overall", "id * 86400 AS unixReviewTime", "'o' || id AS orderID", "'s' AS storeID",
        "1 AS quantity", "1.5D AS totalAmount"))
    monkeypatch.setattr(flow_queries, "route_batch", lambda lines, *args: route_batch(lines.repartition(24), *args))
    assert flow_queries.silver_optimize(spark, folder).count() == 4000
    assert [-(-files // most) <= 8 for files, most in zip((48, 48, 72), taken)] == [True] * 3


def test_passes_are_all_reviews(spark, folder, monkeypatch):
    """The parts together are all rows, with keys that are NULL, repeat or have another type in the joined table."""
    _tables(spark, folder)
    assert inputs.passes(spark, folder) == [(0, 1)]
    extra = spark.read.parquet(f"{folder}/lineitem.parquet").where("l_orderkey = 7").withColumn("l_orderkey", F.expr("CAST(NULL AS BIGINT)"))
    extra.union(spark.read.parquet(f"{folder}/lineitem.parquet").where("l_orderkey = 8")).write.mode("append").parquet(f"{folder}/lineitem.parquet")
    orders = spark.read.parquet(f"{folder}/orders.parquet").withColumn("o_orderkey", F.col("o_orderkey").cast("int"))
    session.materialize(orders, "orders").write.mode("overwrite").parquet(f"{folder}/orders.parquet")
    size = list_files(spark, f"{folder}/lineitem.parquet").agg(F.sum("bytes")).first()[0]
    monkeypatch.setattr(inputs, "PASS_BYTES", -(-size // 3))
    parts = inputs.passes(spark, folder)
    assert parts == [(0, 3), (1, 3), (2, 3)]
    made = [[str(row) for row in inputs.reviews(spark, folder, None, part).collect()] for part in parts]
    everything = [str(row) for row in inputs.reviews(spark, folder).collect()]
    assert sorted(row for rows in made for row in rows) == sorted(everything) and len(everything) == 122
    assert all(0 < len(rows) < 122 for rows in made)


@pytest.fixture
def in_passes(spark, folder, monkeypatch):
    """Tables that take three passes, and the folder of every query's own files."""
    _tables(spark, folder)
    size = list_files(spark, f"{folder}/lineitem.parquet").agg(F.sum("bytes")).first()[0]
    monkeypatch.setattr(inputs, "PASS_BYTES", -(-size // 3))
    made = []
    monkeypatch.setattr(flow_queries, "new_path", lambda spark, label: made.append(session.new_path(spark, label)) or made[-1])
    return folder, made


def _plain_rows(df):
    return sorted(map(str, df.collect()))


def _expected(spark, folder):
    return route(parse_reviews(inputs.messages(spark, folder)))


def test_route_in_passes(spark, in_passes):
    """Each part of the messages is a batch, and no message file is left."""
    folder, made = in_passes
    valid, rejected = _expected(spark, folder)
    got = flow_queries.stream_route(spark, folder)
    assert _plain_rows(got.where("route = 'bronze'").select(flow_queries.KEYS)) == _plain_rows(valid.select(flow_queries.KEYS))
    assert _plain_rows(got.where("route = 'dlq' AND has_raw").select(flow_queries.KEYS)) == _plain_rows(rejected.select(flow_queries.KEYS))
    assert got.count() == 118 and read_batch_log(spark, f"{made[0]}/log").count() == 3
    assert not folders.exists(spark, f"{made[0]}/in") and not folders.exists(spark, inputs._staged_path(spark, folder, "messages"))


def test_batch_log_in_passes(spark, in_passes):
    valid, rejected = (rows.count() for rows in _expected(spark, in_passes[0]))
    assert tuple(flow_queries.stream_batch_log(spark, in_passes[0]).first()) == (118, valid, rejected, True)


def test_silver_in_passes(spark, in_passes):
    """A load for each part; bronze files are gone once taken."""
    folder, made = in_passes
    got = flow_queries.stream_silver(spark, folder)
    assert _plain_rows(got.select(flow_queries.KEYS)) == _plain_rows(_expected(spark, folder)[0].select(flow_queries.KEYS))
    assert len([name for name in folders.subfolders(spark, f"{made[0]}/silver") if name.startswith("load=")]) == 3
    assert not folders.exists(spark, f"{made[0]}/bronze")


def test_rejects_compacted_in_passes(spark, in_passes):
    """The rejects of all batches, twice; the valid rows, which nothing reads, are gone."""
    folder, made = in_passes
    rejected = _expected(spark, folder)[1].select(flow_queries.KEYS)
    assert _plain_rows(flow_queries.dlq_compaction_live(spark, folder)) == _plain_rows(rejected.unionAll(rejected))
    left = list_files(spark, f"{made[0]}/landing/route=bronze").count() if folders.exists(spark, f"{made[0]}/landing/route=bronze") else 0
    assert left == 0


def test_repeated_messages_in_passes(spark, in_passes):
    """Each message once although all parts come again; no snapshot beside the changes of the state, no message file left."""
    folder, made = in_passes
    lines = inputs.messages(spark, folder).distinct().where("NOT startswith(value, 'not json ')")
    want = parse_reviews(lines).select(flow_queries.KEYS)
    assert _plain_rows(flow_queries.stream_repeated_messages(spark, folder)) == _plain_rows(want)
    assert not folders.exists(spark, f"{made[0]}/in")
    names = [row.path for row in list_files(spark, f"{made[0]}/checkpoint/state").collect()]
    assert names and not [name for name in names if name.endswith(".snapshot")]


def test_staged_files_in_passes(spark, in_passes):
    """Messages and routed files are the same lines, and have their name only when all passes are done."""
    folder, _ = in_passes
    lines = _plain_rows(inputs._message_lines(spark, folder))
    assert _plain_rows(spark.read.text(inputs.message_folder(spark, folder))) == lines
    rejected = read_dlq(spark, flow_queries.routed_folder(spark, folder, "dlq"))
    assert _plain_rows(rejected.select(flow_queries.KEYS)) == _plain_rows(_expected(spark, folder)[1].select(flow_queries.KEYS))

    def fails(part, path):
        inputs.write_lines(inputs._message_lines(spark, folder, part), path, "append")
        if part[0] == 1:
            raise RuntimeError("died")

    with pytest.raises(RuntimeError):
        inputs.write_passes(spark, folder, f"{folder}/half", fails)
    assert not folders.exists(spark, f"{folder}/half")
    inputs.write_passes(spark, folder, f"{folder}/half", lambda part, path: inputs.write_lines(
        inputs._message_lines(spark, folder, part), path, "append"))
    assert _plain_rows(spark.read.text(f"{folder}/half")) == lines
