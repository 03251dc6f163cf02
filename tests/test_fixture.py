"""Known figures for orders against a target with gaps and second copies."""

import pytest
from pyspark.sql import functions as F

from gapmend.operators import (
    coverage,
    dedup,
    duplicate_keys,
    duplicate_occurrences,
    in_range,
    key_range,
    missing_rows,
    rows_in_missing_range,
    source_keys_duplicated,
)
from gapmend.sinks import append_dynamic, create_table, rewrite_duplicates
from gapmend.plans import repair
from gapmend.shared import fresh_path

KEY = "o_orderkey"


def landed(df, key, ts):
    """Rows without every seventh key, and some of them again a day later."""
    rows = df.where(F.col(key) % 7 != 3)
    day = F.col(ts).cast("date")
    again = rows.where(F.col(key) % 50 == 0)
    return rows.withColumn("day", day.cast("string")).unionByName(
        again.withColumn("day", F.date_add(day, 1).cast("string"))
    )


@pytest.mark.parametrize(
    "sf, last, source_rows, target_rows, matched, missing, span, high, twice, shared",
    [
        ("0.001", 1499, 500, 1312, 438, 71, 491, 1494, 26, 9),
        ("0.01", 14999, 4000, 13114, 3498, 571, 3991, 4994, 257, 69),
        ("0.1", 149999, 4000, 131142, 3498, 571, 3991, 4994, 2571, 69),
    ],
)
def test_figures(
    spark, sf, last, source_rows, target_rows, matched, missing, span, high, twice, shared
):
    orders = spark.read.parquet(f"/root/testdata/sf{sf}/orders.parquet")
    source, target = in_range(orders, KEY, 1000, 4999), landed(orders, KEY, "o_orderdate")
    assert tuple(key_range(orders, KEY).first()) == (0, last)
    assert target.count() == target_rows
    row = coverage(source, target, KEY).first()
    assert (row.source_rows, row.matched_rows, row.status) == (source_rows, matched, "missing")
    assert (row.missing_rows, row.missing_keys) == (missing, missing)
    assert (row.min_missing, row.max_missing) == (1004, high)
    assert missing_rows(source, target, KEY).count() == missing
    assert rows_in_missing_range(source, target, KEY).count() == span
    assert duplicate_keys(target, KEY).count() == twice
    assert source_keys_duplicated(source, target, KEY).count() == shared


@pytest.mark.parametrize(
    "sf, twice, pairs, rows",
    [("0.001", 1161, 4599, 6000), ("0.01", 11785, 45832, 60000), ("0.1", 118144, 456861, 600000)],
)
def test_repeated_line_numbers(spark, sf, twice, pairs, rows):
    lines = spark.read.parquet(f"/root/testdata/sf{sf}/lineitem.parquet")
    keys = ["l_orderkey", "l_linenumber"]
    assert lines.count() == rows
    assert duplicate_keys(lines, keys).count() == twice
    assert dedup(lines, keys, ["l_shipdate"]).count() == pairs


def test_events_end_complete_and_unique(spark):
    events = spark.read.parquet("/root/testdata/sf0.01/events.parquet")
    target = landed(events, "event_id", "ts")
    name = f"t_{fresh_path(spark, 'e')[-32:]}"
    create_table(spark, name, events.schema, fresh_path(spark, "events"))
    append_dynamic(target, name, rebalance=True)
    table = spark.table(name)
    extra = duplicate_occurrences(table, "event_id")
    assert extra.agg(F.sum("extra_rows")).first()[0] == 171
    assert extra.select("day").distinct().count() == 30

    report = repair(events, name, "event_id", day="2024-02-01")
    assert report.appended_rows == report.missing_rows > 0
    removed = rewrite_duplicates(spark, name, "event_id", ["ts"])
    assert removed.removed_rows == 171 and removed.dropped == ("2024-01-31",)
    table = spark.table(name)
    assert table.count() == table.select("event_id").distinct().count() == 10_000
