import json

from pyspark.sql import functions as F

from reviewflow import jobs
from reviewflow.plans import measures
from reviewflow.sources.files import read_dlq


def _event(n, day, store="Old name", price=10.0):
    return json.dumps({
        "reviewerID": f"u{n % 4}", "asin": f"p{n % 3}", "overall": float(n % 5 + 1), "unixReviewTime": day * 86400 + n,
        "orderID": f"o{n}", "storeID": "s1", "storeName": store, "productName": "thing", "unitPrice": price,
        "quantity": 2, "totalAmount": 2 * price, "paymentID": f"pay{n}", "paymentMethod": "cash",
        "paymentStatus": "done", "reviewerName": "name"})


def test_two_days_from_messages_to_reports(spark, folder, capsys):
    source, landing, silver, house = (f"{folder}/{n}" for n in ("in", "landing", "silver", "house"))

    def day(events, as_of):
        spark.createDataFrame([(e,) for e in events], "value string").repartition(3).write.mode("append").text(source)
        jobs.main(["bronze", "--source", source, "--format", "text", "--landing", landing, "--checkpoint",
                   f"{folder}/c1", "--log", f"{folder}/log", "--speed-layer", f"{folder}/speed", "--once"], spark)
        jobs.main(["silver", "--bronze", f"{landing}/route=bronze", "--silver", silver, "--checkpoint",
                   f"{folder}/c2", "--log", f"{folder}/progress", "--max-files", "1", "--once"], spark)
        jobs.main(["optimize", "--silver", silver], spark)
        jobs.main(["daily", "--silver", silver, "--warehouse", house, "--as-of", as_of], spark)

    def read(name):
        path = f"{house}/{name}"
        if name == "fact_sales_incremental":
            return spark.read.parquet(path)
        from reviewflow.sources.folders import read_current
        return read_current(spark, path)

    day([_event(n, 1) for n in range(20)] + ["broken"], "1970-01-02 00:00:00")
    assert read("dim_stores").count() == 1 and read("dim_products").count() == 3
    assert read("fact_sales_reviews").where("store_sk IS NOT NULL").count() == 20
    assert read("fact_sales_incremental").count() == 20

    # The store is renamed (to a name that sorts after the old one) and prices rise.
    day([_event(n, 5, "Renamed", 12.0) for n in range(20, 30)], "1970-01-06 00:00:00")
    stores = {r.store_name: r for r in read("dim_stores").collect()}
    assert (stores["Old name"].status, stores["Renamed"].status) == ("Expired", "Active")
    assert str(stores["Old name"].valid_to) == str(stores["Renamed"].valid_from) == "1970-01-06 00:00:00"
    fact = read("fact_sales_reviews")
    assert fact.count() == 30 == fact.select("order_id").distinct().count()
    sks = {r.original_store_id + str(r.date_id): r.store_sk for r in fact.collect()}
    assert sks["s11970-01-02"] == stores["Old name"].store_sk
    assert sks["s11970-01-06"] == stores["Renamed"].store_sk
    key = lambda df: sorted(map(str, df.select(sorted(df.columns)).collect()))
    assert key(read("fact_sales_incremental")) == key(fact)
    assert float(measures.executive_kpis(fact).first().total_revenue) == 20 * 20 + 10 * 24
    assert read("dim_users").agg(F.sum("total_reviews_written")).first()[0] == 30
    assert [r.day_of_week for r in read("dim_date").orderBy("date_id").collect()] == ["Friday   ", "Tuesday  "]

    # An order with rows on two days keeps both in a run and in a repeated one.
    day([_event(29, 6, "Renamed", 12.0), _event(30, 6, "Renamed", 12.0)], "1970-01-07 00:00:00")
    assert sorted(str(r.date_id) for r in read("fact_sales_incremental").where("order_id = 'o29'").collect()) == [
        "1970-01-06", "1970-01-07"]
    assert key(read("fact_sales_incremental")) == key(read("fact_sales_reviews"))

    # A repeated run changes nothing.
    before = {n: key(read(n)) for n in ("dim_stores", "dim_products", "fact_sales_reviews", "fact_sales_incremental")}
    jobs.main(["daily", "--silver", silver, "--warehouse", house, "--as-of", "1970-01-08 00:00:00"], spark)
    assert before == {n: key(read(n)) for n in before}

    jobs.main(["metrics", "--bronze-log", f"{folder}/log", "--silver-log", f"{folder}/progress",
               "--metrics", f"{folder}/metrics"], spark)
    jobs.main(["metrics", "--bronze-log", f"{folder}/log", "--silver-log", f"{folder}/progress",
               "--metrics", f"{folder}/metrics"], spark)
    total = spark.read.parquet(f"{folder}/metrics/bronze_metrics/v=2").agg(F.sum("total_received")).first()[0]
    assert total == 33
    jobs.main(["compact-dlq", "--dlq", f"{landing}/route=dlq", "--target", f"{folder}/dlq"], spark)
    assert read_dlq(spark, f"{folder}/dlq").count() == 1
    jobs.main(["alert", "--dlq", f"{folder}/dlq", "--recipients", "team"], spark)
    jobs.main(["clear-dlq", "--dlq", f"{folder}/dlq"], spark)
    assert read_dlq(spark, f"{folder}/dlq").count() == 0
    for _ in range(2):
        jobs.main(["archive", "--metrics", f"{folder}/metrics", "--sessions", f"{folder}/sessions"], spark)
    assert spark.read.parquet(f"{folder}/sessions/bronze_metrics/session_id=1").agg(F.sum("total_received")).first()[0] == 33
    assert spark.read.parquet(f"{folder}/sessions/bronze_metrics/session_id=2").count() == 0
    jobs.main(["audit", "--silver", silver, "--sample", f"{folder}/sample"], spark)
    jobs.main(["expired", "--table", silver, "--live", silver], spark)
    assert "reviewerID: 1; asin: 1; overall: 1" in capsys.readouterr().out
