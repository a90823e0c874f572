import hashlib
import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from reviewflow.functions.quality import error_percent, is_acceptable, is_invalid, required_fields_present
from reviewflow.functions.reviews import review_id, sentiment, utc_date
from reviewflow.functions.search import search_rows
from reviewflow.operators.profile import dlq_alert, dlq_root_cause, null_profile
from reviewflow.operators.routing import batch_quality, mark_route, parse_reviews, reject_samples, route
from reviewflow.operators.shape import check_columns, safe_rating_rows, select_existing, union_by_name
from reviewflow.schema import REVIEW_SCHEMA

GOOD = {"reviewerID": "A", "asin": "B", "overall": 4.0, "unixReviewTime": 0}


def _message(**changes):
    return json.dumps({**GOOD, **changes})


EDGES = [
    (_message(), True),
    ("not json", False),
    (None, False),
    ('{"reviewerID": "A", "asin": "B", "overall": NaN}', False),
    (_message(overall="NaN"), False),
    (_message(overall="4"), False),
    (_message(overall=0), False),
    (_message(overall=6), False),
    (_message(overall=1), True),
    (_message(overall=5), True),
    (_message(overall=5.01), False),
    (_message(overall=None), False),
    (_message(reviewerID="None"), False),
    (_message(reviewerID=""), False),
    (_message(reviewerID=" "), True),
    (_message(reviewerID=5), True),
    (_message(asin=None), False),
    (_message(asin="None"), False),
    (_message(quantity=1.5), True),
    ("[]", False),
]


@pytest.mark.parametrize("as_bytes", [False, True])
def test_edge_messages_go_where_they_belong(spark, as_bytes):
    kind = "binary" if as_bytes else "string"
    texts = [(None if t is None else t.encode() if as_bytes else t,) for t, _ in EDGES]
    parsed = parse_reviews(spark.createDataFrame(texts, f"value {kind}"))
    assert parsed.columns == [*REVIEW_SCHEMA.fieldNames(), "raw_json"]
    rows = parsed.select("raw_json", (~is_invalid()).alias("valid")).collect()
    assert sorted((str(r.raw_json), r.valid) for r in rows) == sorted((str(t), v) for t, v in EDGES)


def test_partial_parse_equals_full_parse(spark):
    texts = spark.createDataFrame([(t,) for t, _ in EDGES], "value string")
    some = ["overall", "asin"]
    full = parse_reviews(texts).select(*some, "raw_json")
    part = parse_reviews(texts, fields=some)
    assert sorted(map(str, full.collect())) == sorted(map(str, part.collect()))


def test_messages_are_parsed_once_per_row(spark):
    texts = spark.createDataFrame([(t,) for t, _ in EDGES], "value string")
    valid, _ = route(parse_reviews(texts))
    plan = valid._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_route_splits_without_loss(spark):
    parsed = parse_reviews(spark.createDataFrame([(t,) for t, _ in EDGES], "value string"))
    valid, rejected = route(parsed)
    assert valid.count() == sum(v for _, v in EDGES)
    assert rejected.count() == sum(not v for _, v in EDGES)
    assert "raw_json" not in valid.columns and "raw_json" in rejected.columns
    marked = mark_route(parsed)
    assert marked.where("route = 'bronze' AND raw_json IS NOT NULL").count() == 0
    assert reject_samples(rejected).count() == 5


ids = st.one_of(st.none(), st.sampled_from(["", "None", " ", "x"]), st.text(max_size=3))
ratings = st.one_of(st.none(), st.floats(allow_infinity=True, allow_nan=True))


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(ids, ids, ratings), max_size=30))
def test_valid_and_invalid_are_complements(spark, rows):
    df = spark.createDataFrame(rows, "reviewerID string, asin string, overall double")
    flags = [r[0] for r in df.select(is_invalid()).collect()]
    assert None not in flags
    expected = [
        u in (None, "", "None") or p in (None, "", "None") or o is None or not 1 <= o <= 5 for u, p, o in rows]
    assert flags == expected


def test_required_fields(spark):
    df = spark.createDataFrame([("a", "b", 9.0), (None, "b", 1.0), ("a", "", None)],
                               "reviewerID string, asin string, overall double")
    assert [r[0] for r in df.select(required_fields_present()).collect()] == [True, False, False]


def test_batch_quality_of_empty_and_mixed(spark):
    empty = spark.createDataFrame([], "route string")
    assert batch_quality(empty).first().asDict() == {
        "total_received": 0, "valid_records": 0, "invalid_records": 0, "error_rate_percent": 0.0,
        "is_acceptable": True}
    mixed = spark.createDataFrame([("bronze",)] * 4 + [("dlq",)], "route string")
    row = batch_quality(mixed).first()
    assert (row.error_rate_percent, row.is_acceptable) == (20.0, False)


def test_percent_and_verdict_round_half_up(spark):
    row = spark.range(1).select(
        error_percent(F.lit(1), F.lit(3)).alias("p"), error_percent(F.lit(0), F.lit(0)).alias("z"),
        is_acceptable(F.lit(0), F.lit(0)).alias("a")).first()
    assert (row.p, row.z, row.a) == (33.33, 0.0, True)


def test_review_expressions(spark):
    df = spark.createDataFrame(
        [("a", "b", 86399), (None, None, -1), ("a", "b", None)],
        "reviewerID string, asin string, unixReviewTime bigint")
    rows = df.select(review_id().alias("id"), utc_date("unixReviewTime").cast("string").alias("d")).collect()
    assert [r.d for r in rows] == ["1970-01-01", "1969-12-31", None]
    assert rows[0].id == hashlib.md5(b"ab86399").hexdigest() and rows[1].id == hashlib.md5(b"-1").hexdigest()
    assert rows[2].id is None
    marks = spark.createDataFrame([(v,) for v in (5.0, 4.0, 3.5, 3.0, 2.5, 1.0)], "overall double")
    assert [r[0] for r in marks.select(sentiment("overall")).collect()] == [
        "positive", "positive", "negative", "neutral", "negative", "negative"]


def test_safe_rating_drops_what_is_no_number(spark):
    df = spark.createDataFrame([("4",), ("x",), (None,), ("2.5",)], "overall string")
    assert sorted(r.overall for r in safe_rating_rows(df).collect()) == [2.5, 4.0]


def test_search_and_nulls(spark):
    df = spark.createDataFrame([("Foo", 1, None), ("foo", 2, "x"), ("bar", 3, "FOO")], "a string, n int, b string")
    assert [r.n for r in search_rows(df, "foo").orderBy("n").collect()] == [2, 3]
    assert [r.n for r in search_rows(df, "foo", string_only=True, null_text="").orderBy("n").collect()] == [1, 2, 3]
    assert [r.n for r in search_rows(df, "^bar 3 f").collect()] == [3]
    assert search_rows(df, "").count() == 3


def test_null_profile_and_root_cause(spark):
    df = spark.createDataFrame([(None, "a", 1.0, "r"), (None, None, None, "r")],
                               "reviewerID string, asin string, overall double, raw_json string")
    assert {r.column_name: r.null_count for r in null_profile(df).collect()} == {
        "reviewerID": 2, "asin": 1, "overall": 1}
    assert dlq_root_cause(df).first().asDict() == {
        "total_rejected": 2, "missing_reviewerID": 2, "missing_asin": 1, "missing_overall": 1}
    assert dlq_root_cause(df.drop("asin")).columns == ["total_rejected", "missing_reviewerID", "missing_overall"]
    assert dlq_alert(df, "team").first().causes == "reviewerID: 2; asin: 1; overall: 1"
    assert dlq_alert(df.limit(0), "team").count() == 0


def test_shape_helpers(spark):
    left = spark.createDataFrame([(1, "x")], "a int, b string")
    right = spark.createDataFrame([("y", 2.0)], "b string, c double")
    assert sorted(map(tuple, union_by_name(left, right).collect()), key=str) == [(1, "x", None), (None, "y", 2.0)]
    assert select_existing(left, ["b", "zz", "a"], {"a": "A"}, drop=["zz"]).columns == ["b", "A"]
    missing, present, peek = check_columns(left, ["a", "q"])
    assert (missing, present, peek.count()) == (["q"], ["a", "b"], 1)
    assert check_columns(left, ["a"])[2] is None
