"""Row-level reconciliation, states of dimensions, file index."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from reviewflow.functions.search import search_rows
from reviewflow.operators import file_index, text_index
from reviewflow.operators.maintain import merge_loads
from reviewflow.operators.row_reconcile import differing_cells, fingerprints, merge_fingerprints, reconcile_rows, rows_of_cells
from reviewflow.operators.trace import trace_records
from reviewflow.plans import dims, state
from reviewflow.plans.staging import stage_reviews, with_review_date
from reviewflow.schema import REVIEW_SCHEMA
from reviewflow.sources.loads import append_load, live_loads, read_loads

COLUMNS = ["a", "b", "c"]
SCHEMA = "a long, b string, c double, day date"


def _rows(rng, n):
    days = [None, "2024-01-01", "2024-01-02", "2024-02-01"]
    return [(rng.choice([None, 1, 2, 3]), rng.choice([None, "", "x", "y"]), rng.choice([None, 0.5, 2.0]), rng.choice(days)) for _ in range(n)]


def _frame(spark, rows):
    return spark.createDataFrame(rows, "a long, b string, c double, day string").withColumn("day", F.col("day").cast("date")).repartition(3)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_rows_that_differ_are_listed(spark, seed):
    rng = random.Random(seed)
    left = _rows(rng, 400)
    right = list(left)
    for _ in range(6):
        right.pop(rng.randrange(len(right)))
    right += _rows(rng, 5) + [(None, "x", 0.5, "2030-01-01")] + [left[7]] * 2
    found = reconcile_rows(_frame(spark, left), _frame(spark, right), COLUMNS, "day", buckets=8)
    one, two = Counter(left), Counter(right)
    want = {row: (one[row], two[row]) for row in one.keys() | two.keys() if one[row] != two[row]}
    assert {(r.a, r.b, r.c, r.day and str(r.day)): (r.n_left, r.n_right) for r in found.collect()} == want


def test_nulls_in_other_places_differ(spark):
    left, right = _frame(spark, [(None, "x", 2.0, None)]), _frame(spark, [(1, None, 2.0, None)])
    assert reconcile_rows(left, right, COLUMNS, "day").count() == 2
    assert reconcile_rows(left, left, COLUMNS, "day").count() == 0
    empty = _frame(spark, [])
    assert reconcile_rows(empty, empty, COLUMNS, "day").count() == 0
    assert [(r.n_left, r.n_right) for r in reconcile_rows(empty, left, COLUMNS, "day").collect()] == [(0, 1)]


def test_fingerprints_of_parts_add_up(spark):
    rows = _rows(random.Random(5), 300)
    whole = fingerprints(_frame(spark, rows), COLUMNS, "day", 16)
    parts = merge_fingerprints(*(fingerprints(_frame(spark, rows[k::3]), COLUMNS, "day", 16) for k in range(3)))
    assert differing_cells(whole, parts).count() == 0 and whole.agg(F.sum("n")).first()[0] == 300


def test_only_files_of_differing_days_are_read(spark, folder):
    days = [f"2024-01-{k:02}" for k in range(1, 21)]
    _frame(spark, [(k, "x", 1.0, day) for k in range(30) for day in days]).write.partitionBy("day").parquet(folder + "/t")
    table = spark.read.parquet(folder + "/t")
    other = table.where("NOT (a = 3 AND day = DATE '2024-01-07')")
    cells = differing_cells(fingerprints(table, COLUMNS, "day"), fingerprints(other, COLUMNS, "day"))
    assert cells.count() == 1
    read = rows_of_cells(table.withColumn("file", F.input_file_name()), cells, COLUMNS, "day")
    assert 0 < read.count() < 30 and all("day=2024-01-07" in row.file for row in read.select("file").distinct().collect())
    # The day prunes the files themselves, not only the rows.
    plan = rows_of_cells(table, cells, COLUMNS, "day")._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^]]*day#\d+ = 2024-01-07|PartitionFilters: \[[^]]*day#\d+ IN \(2024-01-07\)", plan)


# --- states ------------------------------------------------------------------

def _load(spark, silver, number, seed, n=60):
    rng = random.Random(seed)
    rows = [{"reviewerID": rng.choice([None, *"abcdef"]), "reviewerName": rng.choice(["x", "y", None]), "asin": rng.choice("pqrs"),
             "overall": 3.0, "unixReviewTime": rng.randrange(40) * 86400, "productName": rng.choice("mn"), "unitPrice": rng.choice([1.0, 2.5]),
             "storeID": rng.choice("st"), "storeName": rng.choice("gh"), "paymentID": f"pay{rng.randrange(20)}",
             "paymentMethod": rng.choice(["cash", "card"])} for _ in range(n)]
    frame = with_review_date(spark.createDataFrame(rows, REVIEW_SCHEMA))
    append_load(frame, silver, f"run-{number}", "review_date")


def _same(found, spark, silver):
    staged = stage_reviews(read_loads(spark, silver))
    key = lambda df: sorted(map(str, df.select(sorted(df.columns)).collect()))
    for table, (build, _) in state.STATES.items():
        assert key(found[table]) == key(build(staged)), table


def test_states_read_new_loads_only(spark, folder, monkeypatch):
    silver, root = f"{folder}/silver", f"{folder}/states"
    read = []
    original = state.read_loads
    monkeypatch.setattr(state, "read_loads", lambda s, path, names: read.append(list(names)) or original(s, path, names))
    assert state.refresh_states(spark, silver, root) == {}
    _load(spark, silver, 0, 1)
    _load(spark, silver, 1, 2)
    _same(state.refresh_states(spark, silver, root), spark, silver)
    _load(spark, silver, 2, 3)
    _same(state.refresh_states(spark, silver, root), spark, silver)
    state.refresh_states(spark, silver, root)
    assert read == [["run-0", "run-1"], ["run-2"]]

    # A run that dies before its version has a name changes nothing, and its repetition reads the same load.
    _load(spark, silver, 3, 4)
    with monkeypatch.context() as broken:
        broken.setattr(state, "publish", lambda *args: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            state.refresh_states(spark, silver, root)
    _same(state.refresh_states(spark, silver, root), spark, silver)
    assert read[2:] == [["run-3"], ["run-3"]]

    # Loads merged from known ones are known, also when they are merged again; a mixture is built anew.
    merge_loads(spark, silver, "review_date")
    assert state.new_loads(spark, silver, root) == ([], True)
    _load(spark, silver, 4, 5, n=400)
    _same(state.refresh_states(spark, silver, root), spark, silver)
    assert read[4:] == [["run-4"]]
    _load(spark, silver, 5, 6, n=400)
    _load(spark, silver, 6, 7, n=400)
    merge_loads(spark, silver, "review_date")
    live = live_loads(spark, silver)
    _same(state.refresh_states(spark, silver, root), spark, silver)
    assert read[5] == live and len(state.known_loads(spark, root)) == 7


# --- file index ----------------------------------------------------------------

def _files(spark, folder, numbers):
    for number in numbers:
        rows = [(f"u{number}-{k}", f"p{number}-{k % 5}" if k % 4 else None, f"raw {number} {k}") for k in range(200)]
        spark.createDataFrame(rows, "reviewerID string, asin string, raw_json string").coalesce(1).write.mode("append").parquet(folder)


def test_few_files_are_read_for_few_ids(spark, folder):
    # Names that are written otherwise as addresses.
    data, index = f"{folder}/a b+c%20d/day=x%3Ay", f"{folder}/index"
    _files(spark, data, range(12))

    def read(files):
        return spark.read.parquet(*files)

    assert len(file_index.update_index(spark, index, data, read, pattern="*.parquet")) == 12
    assert file_index.update_index(spark, index, data, read, pattern="*.parquet") == []
    ids = spark.createDataFrame([("u3-7",), ("p9-2",), ("nobody",), (None,)], "wanted string")
    files = file_index.candidate_files(ids, file_index.read_index(spark, index))
    assert 2 <= len(files) <= 3
    everything, none = spark.read.parquet(data), spark.createDataFrame([], "reviewerID string, asin string, raw_json string")
    rows = lambda raw: sorted(map(str, trace_records(ids, raw, none).collect()))
    assert rows(read(files)) == rows(everything)

    _files(spark, data, [12])
    assert len(file_index.update_index(spark, index, data, read, pattern="*.parquet")) == 1
    late = spark.createDataFrame([("u12-1",)], "wanted string")
    assert len(file_index.candidate_files(late, file_index.read_index(spark, index))) == 1


def test_no_id_is_missed(spark, folder):
    data = f"{folder}/data"
    _files(spark, data, range(5))
    rows = spark.read.parquet(data)
    # Filters as small as can be let much through, but never hide a file.
    index = file_index.file_filters(rows, blocks=2).cache()
    for number in range(5):
        ids = spark.createDataFrame([(f"u{number}-{k}",) for k in range(0, 200, 50)], "id string")
        own = {r.f for r in rows.where(f"reviewerID = 'u{number}-0'").select(file_index.own_path().alias("f")).collect()}
        assert own <= set(file_index.candidate_files(ids, index, blocks=2))
    assert file_index.candidate_files(spark.createDataFrame([], "id string"), index, blocks=2) == []


# --- text index ----------------------------------------------------------------

@pytest.mark.parametrize("keyword, needed", [
    ("error", [["error"]]), ("Err(or|ing) now", [["err", "or", " now"], ["err", "ing", " now"]]),
    ("a|bcd", None), ("abcd|wxyz", [["abcd"], ["wxyz"]]), ("abcd*e", [["abc"]]), ("abc+def", [["abc", "def"]]),
    ("(abc)?def", [["def"]]), ("(abc)+", [["abc"]]), ("ab{2}c", None), ("x{0}yzw", [["yzw"]]), ("1\\.50", [["1.50"]]),
    ("(?:abc)", None), ("\\Qabc\\E", None), ("[abc]def", [["def"]]), ("[a[bc]]def", None), ("", None), ("abc)", None), ("(abc", None)])
def test_required_texts(keyword, needed):
    found = text_index.required_texts(keyword)
    plain = lambda branches: branches and [[t for t in b if len(t) > 2] for b in branches]
    assert plain(found) == plain(needed)


def test_every_match_contains_the_required_texts():
    rng = random.Random(11)
    pieces = ["ab", "b", "C", "abc", ".", "[ab]", "[^c]", "(ab|bc)", "(abc|a(b|ca)b)", "(c)", "a*", "b+", "c?", "(ab)*", "(bca)+?", "a{2}", "b{0,2}", "|", "\\.", "^", "$"]
    seen = restricted = 0
    for _ in range(4000):
        keyword = "".join(rng.choices(pieces, k=rng.randint(1, 7)))
        branches = text_index.required_texts(keyword)
        restricted += branches is not None
        for _ in range(40):
            text = "".join(rng.choices("abcABC.", k=rng.randint(0, 14)))
            if branches is not None and re.search(keyword, text, re.I):
                seen += 1
                assert any(all(part in text.lower() for part in branch) for branch in branches), (keyword, text)
    assert seen > 200 and restricted > 400


def test_text_index_reads_few_files_and_finds_all(spark, folder):
    data, index = f"{folder}/data", f"{folder}/index"
    words = ["alpha", "bravo", "Charlie", "delta É", "echo 😀 x", "foxtrot"]

    def put(number):
        rows = [(f"{words[number]} {k}", None if k == 3 else f"row{number}") for k in range(20)] + [("", ""), (None, "lost")]
        spark.createDataFrame(rows, "a string, b string").coalesce(1).write.mode("append").parquet(data)

    def read(files):
        return spark.read.schema("a string, b string").parquet(*files) if files else spark.createDataFrame([], "a string, b string")

    for number in range(5):
        put(number)
    assert len(text_index.update_text_index(spark, index, data, read, pattern="*.parquet")) == 5
    assert text_index.update_text_index(spark, index, data, read, pattern="*.parquet") == []
    for keyword, at_most in [("CHARLIE", 1), ("a É 1", 1), ("😀 x 7", 1), ("alpha 1|bravo 2", 2), ("nothing", 0), ("o", 5), ("", 5), ("row[0-4]", 5), ("(?:alpha)", 5)]:
        files = text_index.matching_files(text_index.read_index(spark, index), keyword)
        assert len(files) <= at_most
        found = text_index.search_files(spark, index, data, read, keyword, pattern="*.parquet")
        assert sorted(map(str, found.collect())) == sorted(map(str, search_rows(spark.read.parquet(data), keyword).collect()))
    # A file that is not indexed yet is read.
    put(5)
    assert text_index.search_files(spark, index, data, read, "foxtrot 1", pattern="*.parquet").count() == 11
    # The smallest filters let more through, but hide nothing.
    tiny = text_index.text_filters(spark.read.parquet(data), blocks=2)
    assert len(text_index.matching_files(tiny, "bravo 2", blocks=2)) >= 1


def test_trigrams_of_short_and_long_texts(spark, monkeypatch):
    texts = [None, "", "ab", "abc", "aBcD", "x" * 3 + "\U0001f600yz", "".join(chr(97 + (i * i) % 26) for i in range(700))]
    frame = spark.createDataFrame(list(enumerate(texts)), "n int, text string")
    for piece in (text_index.PIECE, 2):
        monkeypatch.setattr(text_index, "PIECE", piece)
        found = {n: set() for n in range(len(texts))}
        for row in text_index.trigrams(frame).collect():
            found[row.n].add(row.id)
        for n, text in enumerate(texts):
            lower = (text or "").lower()
            assert found[n] == ({lower[i:i + 3] for i in range(len(lower) - 2)} or {None})


def test_the_path_is_made_once_a_row(spark, folder):
    spark.range(10).selectExpr("cast(id AS string) AS reviewerID", "'x' AS asin").write.parquet(folder + "/t")
    rows = spark.read.parquet(folder + "/t")
    for made in (file_index.file_filters(rows), text_index.text_filters(rows)):
        plan = made._jdf.queryExecution().optimizedPlan().toString()
        # Below the lowest explode, so not repeated for each of its rows.
        assert plan.rindex("Generate explode") < plan.index("input_file_name") and plan.count("input_file_name") == 1


def test_users_with_several_names(spark):
    rows = [("u", None, "r", "2024-01-02"), ("u", "b", None, "2024-01-01"), ("u", "a", "r", None), ("v", None, None, None), (None, "x", "r", "2024-01-01")]
    frame = spark.createDataFrame(rows, "user_id string, user_name string, review_id string, date_id string")
    found = dims.dim_users(frame.withColumn("date_id", F.col("date_id").cast("date"))).withColumns({
        name: F.col(name).cast("string") for name in ("first_review_date", "last_review_date")})
    assert sorted(map(tuple, found.collect())) == [("u", "b", 2, "2024-01-01", "2024-01-02"), ("v", None, 0, None, None)]
    # The largest of text is taken of rows that were made few without a sort.
    plan = found._jdf.queryExecution().sparkPlan().toString()
    assert "HashAggregate" in plan[plan.rindex("SortAggregate"):]
