from datetime import date

import pytest
from pyspark.sql import functions as F

from gapmend.functions import file_name
from gapmend.operators import (
    dedup,
    duplicate_files,
    duplicate_keys,
    duplicate_occurrences,
    number_rows,
)
from gapmend.operators import duplicates as steps
from gapmend.operators.duplicates import find_duplicates, rows_of
from gapmend.operators.joins import row_filter
from gapmend.shared import fresh_path, session_conf
from gapmend.sinks import append_dynamic, create_table, rewrite_duplicates
from tests.tables import contents, day_table, ids

ROWS = [
    (1, "a", "2024-01-01"),
    (1, "b", "2024-01-02"),
    (1, "c", "2024-01-02"),
    (2, "d", "2024-01-02"),
    (3, "e", "2024-01-01"),
    (3, "f", "2024-01-01"),
    (4, "g", "2024-01-03"),
    (2, "h", "2024-01-04"),
    (None, "i", "2024-01-04"),
    (None, "i", "2024-01-05"),
]
KEPT = sorted(
    [
        (1, "a", "2024-01-01"),
        (2, "d", "2024-01-02"),
        (3, "e", "2024-01-01"),
        (4, "g", "2024-01-03"),
        (None, "i", "2024-01-04"),
        (None, "i", "2024-01-05"),
    ],
    key=str,
)


def frame(spark, rows=ROWS):
    return spark.createDataFrame(rows, "id bigint, v string, day string")


def listed(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_null_keys_are_no_duplicates(spark):
    assert listed(duplicate_keys(frame(spark), "id")) == [(1, 3), (2, 2), (3, 2)]


def test_occurrences_are_numbered_by_day(spark):
    found = duplicate_occurrences(frame(spark), "id")
    assert listed(found) == [
        (1, "2024-01-02", 2, 3, 2),
        (2, "2024-01-04", 2, 2, 1),
        (3, "2024-01-01", 2, 2, 1),
    ]


def test_undated_copies_come_first(spark):
    df = frame(spark, [(1, "a", None), (1, "b", "2024-01-01")])
    assert listed(duplicate_occurrences(df, "id")) == [(1, "2024-01-01", 2, 2, 1)]
    assert listed(dedup(df, "id", ["day", "v"])) == [(1, "a", None)]


def test_dedup_breaks_ties(spark):
    assert listed(dedup(frame(spark), "id", ["day", "v"])) == KEPT


def test_dedup_when_the_keys_are_too_many_to_broadcast(spark):
    with session_conf(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        assert listed(dedup(frame(spark), "id", ["day", "v"])) == KEPT


def test_dedup_of_keys_alone(spark):
    assert listed(dedup(ids(spark, [1, 1, 2]), "id", [])) == [(1,), (2,)]


def test_files_with_duplicates(spark):
    path = fresh_path(spark, "files")
    for rows in ([(1, "x"), (2, "x")], [(1, "x"), (1, "x"), (2, "y"), (5, "y")], [(5, "z")]):
        df = spark.createDataFrame(rows, "id bigint, day string")
        df.coalesce(1).write.mode("append").parquet(path)
    df = file_name(spark.read.parquet(path))
    found = duplicate_files(df, "id", source=ids(spark, [1, 2]))
    extra = {}
    for row in found.collect():
        extra[row.id, row.day] = extra.get((row.id, row.day), 0) + row.extra_rows
        assert row.filename.endswith(".parquet")
    assert extra == {(1, "x"): 2, (2, "y"): 1}


def test_same_day_in_two_files_counts_once_as_the_first(spark):
    rows = [(1, None, "f1"), (1, None, "f2"), (1, None, "f2"), (2, "d", "f1")]
    df = spark.createDataFrame(rows, "id bigint, day string, filename string")
    assert listed(duplicate_files(df, "id")) == [(1, None, "f2", 2)]


def test_rewrite_touches_only_days_that_lose_rows(spark):
    name, path = day_table(spark, ROWS)
    before = {r.f for r in file_name(spark.read.parquet(path), "f").select("f").collect()}
    report = rewrite_duplicates(spark, name, "id", ["v"])
    assert contents(spark, name) == KEPT
    assert report.removed_rows == 4
    assert set(report.rewritten) == {"2024-01-01", "2024-01-02", "2024-01-04"}
    after = {r.f for r in file_name(spark.read.parquet(path), "f").select("f").collect()}
    same = {f for f in before & after}
    assert any("2024-01-03" in f for f in same) and any("2024-01-05" in f for f in same)
    assert not any("2024-01-01" in f for f in same)
    assert rewrite_duplicates(spark, name, "id", ["v"]).removed_rows == 0


def test_rewrite_without_broadcast(spark):
    name, _ = day_table(spark, ROWS)
    with session_conf(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        rewrite_duplicates(spark, name, "id", ["v"])
    assert contents(spark, name) == KEPT


def test_day_left_without_rows_is_dropped(spark):
    rows = [(1, "a", "2024-01-01"), (1, "b", "2024-01-31"), (2, "c", "2024-01-02")]
    name, path = day_table(spark, rows)
    report = rewrite_duplicates(spark, name, "id", ["v"])
    assert report.dropped == ("2024-01-31",) and report.rewritten == ()
    listed_days = [r.partition for r in spark.sql(f"SHOW PARTITIONS {name}").collect()]
    assert listed_days == ["day=2024-01-01", "day=2024-01-02"]
    spark.sql(f"MSCK REPAIR TABLE {name}")
    assert contents(spark, name) == [(1, "a", "2024-01-01"), (2, "c", "2024-01-02")]


def test_undated_partition_is_rewritten(spark):
    rows = [(1, "a", None), (1, "b", None), (2, "c", "2024-01-02"), (1, "d", "2024-01-02")]
    name, _ = day_table(spark, rows)
    report = rewrite_duplicates(spark, name, "id", ["v"])
    assert report.removed_rows == 2
    assert contents(spark, name) == [(1, "a", None), (2, "c", "2024-01-02")]


def test_days_that_are_dates(spark):
    rows = spark.createDataFrame(
        [(1, "a", "2024-01-01"), (1, "b", "2024-01-31"), (2, "c", "2024-01-02"), (2, "d", "2024-01-02")],
        "id bigint, v string, day string",
    ).withColumn("day", F.col("day").cast("date"))
    path = fresh_path(spark, "dated")
    name = f"t_{path[-32:]}"
    create_table(spark, name, rows.schema, path, partition_type="date")
    append_dynamic(rows, name)
    report = rewrite_duplicates(spark, name, "id", ["v"])
    assert report.dropped == (date(2024, 1, 31),) and report.rewritten == (date(2024, 1, 2),)
    assert contents(spark, name) == [(1, "a", date(2024, 1, 1)), (2, "c", date(2024, 1, 2))]


@pytest.mark.parametrize("threshold", ["10MB", "-1"])
def test_identical_copies(spark, threshold):
    rows = [(1, "a", "2024-01-01")] * 40 + [(2, "b", "2024-01-01"), (1, "a", "2024-01-02")]
    name, _ = day_table(spark, rows)
    with session_conf(spark, {"spark.sql.autoBroadcastJoinThreshold": threshold}):
        assert listed(dedup(frame(spark, rows), "ID", ["day"])) == [
            (1, "a", "2024-01-01"),
            (2, "b", "2024-01-01"),
        ]
        report = rewrite_duplicates(spark, name, "ID", [])
    assert (report.removed_rows, report.dropped) == (40, ("2024-01-02",))
    assert contents(spark, name) == [(1, "a", "2024-01-01"), (2, "b", "2024-01-01")]


@pytest.mark.parametrize("limit", [1, 3, 1_000])
def test_numbers_of_rows(spark, monkeypatch, limit):
    """Every copy but one has its own number, days in order, hot days in parts."""
    monkeypatch.setattr("gapmend.operators.duplicates.HOT_COPIES", limit)
    rows = [(1, f"2024-01-0{i % 3 + 1}", i) for i in range(12)] + [(2, None, 1), (2, "2024-01-01", 2), (3, None, 3), (None, None, 4), (None, None, 5)]
    df = spark.createDataFrame(rows, "id bigint, day string, v int")
    found = sorted(((r.id, r.rno, r.day or "", r.v) for r in number_rows(df, "id", ["v"]).collect()))
    assert [r[:2] for r in found] == [*[(1, n) for n in range(2, 13)], (2, 2)]
    assert [r[2] for r in found] == sorted(r[2] for r in found if r[0] == 1) + ["2024-01-01"]
    if limit == 1_000:
        assert [r[3] for r in found[:3]] == [3, 6, 9]


@pytest.mark.parametrize("limit", [1, 3, 1_000])
def test_numbers_follow_the_order_at_every_limit(spark, monkeypatch, limit):
    """The same rows have the same numbers, also where hot days are dealt to tasks."""
    monkeypatch.setattr("gapmend.operators.duplicates.HOT_COPIES", limit)
    values = [(i * 37) % 41 for i in range(41)]
    rows = [(k, day, v, f"t{v}") for k in (1, 2) for day in ("2024-01-01", None) for v in values] + [(3, None, 3, "a"), (3, None, 3, "b")]
    df = spark.createDataFrame(rows, "id bigint, day string, v int, w string").repartition(5)
    with session_conf(spark, {"spark.sql.shuffle.partitions": "7"}):
        found = {(r.id, r.rno): (r.day, r.v, r.w) for r in number_rows(df, "id", ["v"]).collect()}
    wanted = {}
    for k in (1, 2, 3):
        own = sorted((r[1:] for r in rows if r[0] == k), key=lambda r: (r[0] or "", r[1:]))
        wanted |= {(k, n + 1): r for n, r in enumerate(own) if n}
    assert found == wanted


def test_rows_of_duplicated_keys_are_sent_once(spark):
    """Keys too many to broadcast: others are filtered where they are read, whole
    keys at once, and the result does not depend on the way."""
    path = fresh_path(spark, "many-keys")
    rows = spark.range(4000).selectExpr("id % 60 AS a", "id % 61 AS b", "CAST(id % 3 AS STRING) AS day", "CONCAT('f', id % 2) AS filename")
    rows.write.parquet(path)
    df = spark.read.parquet(path)
    want = listed(duplicate_files(df, ["a", "b"]))
    assert len(want) > 100
    with session_conf(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        assert listed(duplicate_files(df, ["a", "b"])) == want
        found = find_duplicates(df, ["a", "b"])
        with row_filter(found):
            kept = rows_of(df, ["a", "b"], found)
            plan = kept._jdf.queryExecution().optimizedPlan().toString()
            assert plan.count("might_contain(") == 1
            assert kept.count() == 2 * found.rows


@pytest.mark.parametrize("hot", [1, 1_000_000])
def test_losers_do_not_depend_on_hot_keys(spark, monkeypatch, hot):
    monkeypatch.setattr(steps, "HOT_ROWS", hot)
    path = fresh_path(spark, "losers")
    spark.range(3000).selectExpr("id % 700 AS k", "id % 7 AS v", "CAST(id % 3 AS STRING) AS day").write.parquet(path)
    df = spark.read.parquet(path)
    found = find_duplicates(df, "k")
    gone = steps.losers(df, ["k"], ["day", "v"], found)
    kept = steps.without_losers(df, gone)
    assert listed(kept) == listed(dedup(df, "k", ["day", "v"])) and kept.count() == 700
