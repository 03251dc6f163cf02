"""Runs that fail, are killed, or are repeated."""

import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from gapmend.operators import dedup, duplicates
from gapmend.operators.duplicates import find_duplicates, has_places, losers
from gapmend.plans import history, repair
from gapmend.shared import (
    Written,
    beside,
    delete_path,
    file_names,
    fresh_path,
    move_path,
    path_exists,
    scratch_tables,
    write_shared,
)
from gapmend.sinks import append_once, files, partition_states, replace_files, rewrite_duplicates, sync_partitions, tables
from gapmend.sources import newest_file, newest_schema
from tests.tables import contents, day_table, ids, source_rows

DAY = "2024-02-01"


def rows_at(spark, path):
    return sorted(r[0] for r in spark.read.parquet(path).collect())


def test_a_failing_source_leaves_the_old_history(spark):
    path = fresh_path(spark, "history")
    history(ids(spark, [1, 2]), path, "parquet")
    bad = spark.range(0, 1000, 1, 8).select(F.expr("IF(id = 900, CAST(concat('x', id) AS INT), id)").alias("id"))
    with pytest.raises(Exception, match="x900"):
        history(bad, path, "parquet")
    assert rows_at(spark, path) == [1, 2] and beside(spark, path) == []
    history(ids(spark, [3]), path, "parquet")
    assert rows_at(spark, path) == [3] and beside(spark, path) == []


@pytest.mark.parametrize("killed_at", [1, 2, 3])
def test_a_killed_history_is_put_back(spark, monkeypatch, killed_at):
    """Killed before the first rename, between the two, and before the clean-up."""
    path = fresh_path(spark, "history")
    replace_files(ids(spark, [1, 2]), path, "parquet")
    keep = f"{path}.of-mine"
    ids(spark, [9]).write.parquet(keep)

    class Killed(BaseException):
        pass

    calls = []

    def step(original):
        def run(*arguments):
            calls.append(1)
            if len(calls) >= killed_at:
                raise Killed
            return original(*arguments)
        return run

    monkeypatch.setattr(files, "move_path", step(move_path))
    monkeypatch.setattr(files, "delete_path", step(delete_path))
    with pytest.raises(Killed):
        replace_files(ids(spark, [3]), path, "parquet")
    monkeypatch.undo()
    files.put_back(spark, path)
    assert rows_at(spark, path) == ([3] if killed_at == 3 else [1, 2])
    replace_files(ids(spark, [4]), path, "parquet")
    assert rows_at(spark, path) == [4]
    assert [p.rsplit(".", 1)[1] for p in beside(spark, path)] == ["of-mine"]


def test_an_append_that_stops_half_way_is_completed(spark, monkeypatch):
    name, path = day_table(spark, [(1, "old", DAY), (2, "old", "2024-01-01")])
    staged = f"{fresh_path(spark, 'staged')}/run-1"
    source = source_rows(spark, range(10, 14))

    def half(df, *arguments):
        original(df.where("id < 12"), *arguments)
        raise RuntimeError("lost")

    original = tables.append_static
    monkeypatch.setattr(tables, "append_static", half)
    with pytest.raises(RuntimeError):
        append_once(source, name, DAY, staged, fmt="parquet")
    assert len(contents(spark, name)) == 4
    monkeypatch.undo()
    # The source has changed; what was staged is what lands.
    assert append_once(source_rows(spark, [77]), name, DAY, staged, fmt="parquet") == 4
    assert append_once(source, name, DAY, staged, fmt="parquet") == 0
    assert [r[0] for r in contents(spark, name)] == [1, 10, 11, 12, 13, 2]
    assert file_names(spark, f"{path}/nowhere") == []


def test_a_full_repair_of_one_name_appends_once(spark):
    name, _ = day_table(spark, [(1, "old", "2024-01-01")])
    staged = fresh_path(spark, "staged")
    options = dict(mode="full", day="it's a day", staging_path=staged, staging_format="parquet")
    source = source_rows(spark, [1, 2, None])
    assert [repair(source, name, "id", run_id="a", **options).appended_rows for _ in range(2)] == [3, 0]
    assert repair(source, name, "id", run_id="b", **options).appended_rows == 3
    assert spark.table(name).count() == 7
    with pytest.raises(ValueError):
        repair(source, name, "id", run_id="a", day=DAY)


def test_a_source_parsed_once(spark):
    import bench

    path = fresh_path(spark, "text")
    source_rows(spark, range(1, 50)).write.csv(path, header=True)
    name, _ = day_table(spark, [(v, "old", "2024-01-01") for v in range(1, 40)])
    source = spark.read.csv(path, header=True)
    store = spark._jsparkSession.sharedState().statusStore()
    before = store.executionsCount()
    report = repair(source, name, "id", day=DAY, key_range=(30, 45), parse_once=True)
    assert (report.source_rows, report.appended_rows) == (16, 6)
    runs = store.executionsList(before, 100)
    plans = [runs.apply(i).physicalPlanDescription() for i in range(runs.length())]
    assert sum(bench.scanned(p).count(path) for p in plans) == 1


def test_states_of_days(spark):
    name, path = day_table(spark, [(1, "a", "2024-01-01"), (2, "b", "2024-01-02"), (3, "c", None)])
    delete_path(spark, f"{path}/day=2024-01-02")
    rows = spark.createDataFrame([(4, "d", "a/b=c:d"), (5, "e", "it's"), (6, "f", "2024-01-04")], "id bigint, v string, day string")
    rows.write.mode("append").partitionBy("day").parquet(path)
    ids(spark, [1]).write.parquet(f"{path}/other=1")
    states = {r.partition: r.state for r in partition_states(spark, name).collect()}
    assert sorted(states.values()) == ["gone", "new", "new", "new", "registered", "registered"]
    assert states["day=2024-01-02"] == "gone"
    listed = {r[0] for r in sync_partitions(spark, name).collect()}
    assert listed == set(states) and contents(spark, name) == [
        (1, "a", "2024-01-01"), (3, "c", None), (4, "d", "a/b=c:d"), (5, "e", "it's"), (6, "f", "2024-01-04"),
    ]
    assert partition_states(spark, name).where("state = 'new'").isEmpty()


def test_a_null_day_that_others_landed(spark):
    name, path = day_table(spark, [])
    rows = spark.createDataFrame([(4, "d", None)], "id bigint, v string, day string")
    rows.write.mode("append").partitionBy("day").parquet(path)
    sync_partitions(spark, name)
    assert contents(spark, name) == [(4, "d", None)]


def test_newest_file_of_some_days(spark):
    path = fresh_path(spark, "landing")
    for day in ("03", "01"):
        ids(spark, [int(day)], f"id{day} bigint").coalesce(1).write.parquet(f"{path}/day=2024-01-{day}")
    assert "day=2024-01-01" in newest_file(spark, path, ending=".parquet")
    assert newest_schema(spark, path, fmt="parquet").names == ["id01"]
    assert newest_schema(spark, path, fmt="parquet", days=1).names == ["id03"]


@pytest.fixture
def never_broadcast(monkeypatch):
    monkeypatch.setattr(Written, "fits_broadcast", lambda self: False)


def wide_rows(spark):
    """Copies in many files, a hot key, keys without a value, equal orders."""
    path = fresh_path(spark, "wide")
    key = F.expr("CASE WHEN id % 3 = 0 THEN 7 WHEN id % 10 = 1 THEN NULL ELSE id % 2000 END")
    rows = spark.range(0, 9000, 1, 6).select(
        key.alias("k"), (F.col("id") * 7 % 100).alias("o"), F.concat(F.lit("2024-01-0"), F.col("id") % 4 + 1).alias("day"),
        F.array("id").alias("wide"), "id",
    )
    rows.write.parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize("batches", [1, 3])
def test_losers_by_place(spark, monkeypatch, never_broadcast, batches):
    df = wide_rows(spark)
    monkeypatch.setattr(duplicates, "batches_of", lambda gone: batches)
    out = dedup(df, "k", ["day", "o", "id"])
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "wide" in plan and "Aggregate" not in plan and plan.count("Relation [") == 2 * batches
    physical = out._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in physical and "Exchange rangepartitioning" not in physical
    want = {}
    for r in df.collect():
        if r.k is not None:
            want[r.k] = min(want.get(r.k, (r.day, r.o, r.id)), (r.day, r.o, r.id))
    found = out.collect()
    assert {(r.day, r.o, r.id) for r in found if r.k is not None} == set(want.values())
    assert len([r for r in found if r.k is not None]) == len(want)
    assert len([r for r in found if r.k is None]) == df.where("k IS NULL").count()


def test_places_are_known_for_plain_rows_alone(spark):
    df = wide_rows(spark)
    assert has_places(df.where("o > 3").select("k", "o"))
    assert not has_places(df.join(df.select("k").distinct(), "k"))
    assert not has_places(df.withColumn("x", F.explode("wide")))
    assert not has_places(ids(spark, [1]))


def test_too_many_bits_fall_back(spark, monkeypatch, never_broadcast):
    df = wide_rows(spark).drop("wide")
    monkeypatch.setattr(duplicates, "MOST_BATCHES", 0)
    assert dedup(df, "k", ["day", "o", "id"]).count() == df.where("k IS NULL").count() + df.where("k IS NOT NULL").select("k").distinct().count()


def test_rewrite_by_place(spark, never_broadcast):
    name, _ = day_table(spark, [(i % 40, f"v{i}", f"2024-01-0{i % 3 + 1}") for i in range(100)] + [(None, "n", "2024-01-01")])
    report = rewrite_duplicates(spark, name, "id", ["v"])
    first = {}
    for i in range(100):
        first[i % 40] = min(first.get(i % 40, ("x",)), (f"2024-01-0{i % 3 + 1}", f"v{i}"))
    assert report.removed_rows == 60
    assert contents(spark, name) == sorted([(k, v, d) for k, (d, v) in first.items()] + [(None, "n", "2024-01-01")], key=str)


def test_bits_name_the_right_rows(spark):
    df = wide_rows(spark)
    gone = losers(df, ["k"], ["id"], find_duplicates(df, "k"))
    bits = gone.frame.selectExpr("aggregate(words, 0L, (a, w) -> a + bit_count(w)) AS n").agg(F.sum("n")).first()[0]
    keyed = df.where("k IS NOT NULL")
    assert bits == keyed.count() - keyed.select("k").distinct().count()


def test_base_queries_without_the_libraries_of_others():
    """Where tiktoken is missing, the other queries are still there."""
    code = (
        "import sys, warnings; sys.modules['tiktoken'] = None; warnings.simplefilter('ignore');"
        "import __spark_entry__ as e; print(len(e.queries()), 'missing_rows' in e.queries(), any(q.startswith('op') for q in e.queries()))"
    )
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=120)
    assert out.stdout.split()[1:] == ["True", "False"], out.stderr


def test_scratch_tables_go(spark):
    with scratch_tables(spark) as keep:
        first = write_shared(spark.range(3), "first")
        with pytest.raises(ZeroDivisionError), scratch_tables(spark) as spare:
            second, third = (write_shared(spark.range(3), label) for label in ("second", "third"))
            spare(second.path)
            1 / 0
        assert [path_exists(spark, t.path) for t in (first, second, third)] == [True, True, False]
        keep(first.path)
    assert [path_exists(spark, t.path) for t in (first, second)] == [True, False]
    assert first.frame.count() == 3
    first.drop()
    outside = write_shared(spark.range(3), "outside")
    with scratch_tables(spark):
        pass
    assert path_exists(spark, outside.path)
