"""The plans that the operators must get, on tables with a hot key."""

import re

import pytest
from pyspark.sql import functions as F

import bench
from gapmend.functions import change_envelope, partition_stamp, widen_decimals
from gapmend.operators import (
    coverage,
    dedup,
    duplicate_files,
    duplicate_occurrences,
    in_range,
    key_coverage,
    matched_copies,
    matched_rows,
    missing_keys,
    missing_preview,
    missing_rows,
    present_key_days,
)
from gapmend.operators.duplicates import copies_by, find_duplicates
from gapmend.operators.joins import hot_keys, join_unique
from gapmend.plans import repair, validate
from gapmend.shared import fresh_path, session_conf, write_shared
from gapmend.sinks import append_dynamic, null_partition_rows, rewrite_duplicates
from tests.tables import day_table, ids

ROWS = 120_000
NO_BROADCAST = {"spark.sql.autoBroadcastJoinThreshold": "-1"}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def run(df):
    """Run ``df`` and return its final plan."""
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    final = plan(df)
    return final[: final.index("== Initial Plan ==")]


@pytest.fixture(scope="module")
def tables(spark):
    """A source, and a target where one key has a third of all rows."""
    path = fresh_path(spark, "hot")
    n = F.col("id")
    spark.range(0, ROWS // 2, 1, 4).select(
        n.alias("k"), F.concat(F.lit("s"), n).alias("v"), F.lit("x").alias("w")
    ).write.parquet(f"{path}/source")
    key = F.when(n % 3 == 0, 7).when(n % 10 == 1, n - 1).otherwise(n)
    spark.range(0, ROWS, 1, 8).select(
        key.alias("k"), n.alias("v"), F.concat(F.lit("2024-01-0"), n % 5 + 1).alias("day")
    ).write.parquet(f"{path}/target")
    return spark.read.parquet(f"{path}/source"), spark.read.parquet(f"{path}/target")


def exchanges(text):
    """The kinds of shuffle in a plan."""
    return re.findall(r"(?<!Broadcast)Exchange (\w+)", text)


def shuffled_rows(spark, df):
    """Rows that each shuffle of ``df`` really carried."""
    df.collect()
    explain = spark._jvm.org.apache.spark.sql.api.python.PythonSQLUtils.explainString
    text = explain(df._jdf.queryExecution(), "formatted")
    final = text[: text.index("Initial Plan")]
    stages = re.findall(r"ShuffleQueryStage.*rowCount=([\d.E+]+)\)", final)
    return [int(float(n)) for n in stages]


def test_coverage_shuffles_keys_once(spark, tables):
    text = plan(coverage(*tables, "k"))
    assert exchanges(text) == ["SinglePartition", "hashpartitioning"]
    assert "Join" not in text and "Sort" not in text
    assert set(re.findall(r"ReadSchema: (\S+)", text)) == {"struct<k:bigint>"}


def test_hot_key_is_reduced_before_the_shuffle(spark, tables):
    source, target = tables
    hot = target.where("k = 7").count()
    others = target.where("k <> 7").count()
    assert hot > ROWS / 3
    sent = shuffled_rows(spark, key_coverage(*tables, "k"))
    tasks = target.rdd.getNumPartitions()
    assert len(sent) == 1 and sent[0] <= source.count() + others + tasks


def test_missing_rows_are_not_shuffled(spark, tables):
    text = plan(missing_rows(*tables, "k"))
    assert "BroadcastHashJoin" in text and exchanges(text) == []


def test_many_missing_keys_are_not_broadcast(spark, tables):
    with session_conf(spark, NO_BROADCAST):
        found = missing_rows(*tables, "k")
        assert "SortMergeJoin" in plan(found)
        assert found.count() == missing_rows(*tables, "k").count() > 10_000


def test_range_reaches_the_scan(spark, tables):
    text = plan(in_range(tables[0], "k", 5, 9))
    assert "GreaterThanOrEqual(k,5), LessThanOrEqual(k,9)" in text


def test_stamp_keeps_the_scan_narrow(spark, tables):
    text = plan(partition_stamp(tables[0], "2024-01-01").select("day", "k"))
    assert "ReadSchema: struct<k:bigint>" in text


def test_semi_join_moves_below_the_count_only_when_broadcast(spark, tables):
    _, target = tables
    found = find_duplicates(target, "k")
    text = plan(copies_by(target, ["k"], ["day"], found))
    assert text.index("partial_count") < text.index("BroadcastHashJoin")
    with session_conf(spark, NO_BROADCAST):
        text = plan(copies_by(target, ["k"], ["day"], found))
        assert text.index("SortMergeJoin") < text.index("partial_count")


def test_hot_key_is_written_out_by_many_tasks(spark, tables):
    source, target = tables
    copies = matched_copies(source, target, "k", per_part=500)
    hot = target.where("k = 7").count()
    per_task = (
        copies.where("k = 7").groupBy(F.spark_partition_id()).count().toPandas()["count"]
    )
    assert per_task.sum() == hot
    assert len(per_task) >= 6 and per_task.max() < hot / 3
    assert copies.count() == coverage(source, target, "k").first().matched_rows


@pytest.mark.parametrize("part", [1, 2, 3, 4, 7, 8])
def test_copies_do_not_depend_on_the_part_size(spark, part):
    source, target = ids(spark, [1, 1, 2, 3]), ids(spark, [1] * 7 + [2])
    found = matched_copies(source, target, "id", per_part=part)
    assert sorted(r.id for r in found.collect()) == [1] * 14 + [2]


def results(spark, source, target):
    return {
        "matched": matched_rows(source, target, "k").agg(F.sum("target_rows")).first()[0],
        "copies": matched_copies(source, target, "k").count(),
        "days": sorted(present_key_days(source, target, "k").collect()),
        "occurrences": sorted(duplicate_occurrences(target, "k").collect()),
        "files": sorted(
            duplicate_files(target.withColumn("filename", F.lit("f")), "k", source).collect()
        ),
        "dedup": sorted(dedup(target, "k", ["day", "v"]).collect()),
    }


def test_same_results_with_and_without_broadcast(spark, tables):
    small = results(spark, *tables)
    with session_conf(spark, NO_BROADCAST):
        large = results(spark, *tables)
    assert small == large
    assert small["matched"] == small["copies"]


def test_hot_key_never_meets_a_window_whole(spark, tables):
    _, target = tables
    sent = shuffled_rows(spark, duplicate_occurrences(target, "k"))
    assert len(sent) == 2
    assert sent[1] <= 5 * find_duplicates(target, "k").frame.count()
    assert "Window" not in plan(dedup(target, "k", ["day", "v"]))


@pytest.mark.parametrize("form", ["parquet", "csv"])
@pytest.mark.parametrize("ranged", [True, False])
def test_validated_repair_reads_keys_once_and_rows_once(spark, form, ranged):
    """Two scans of the source, one of the target, with and without a range."""
    found = bench.scans(spark, "/root/testdata/sf0.001", form, ranged)
    assert found == {"source": 2, "target": 1}


def test_small_source_narrows_the_target(spark, tables):
    """No more target keys are shuffled than the source holds."""
    source, target = tables
    few = spark.createDataFrame([(3, "x"), (7, "y"), (None, "z")], "k bigint, v string")
    few = write_shared(few.coalesce(1), "few").frame
    text = plan(missing_keys(few, target, "k"))
    scan = text[text.index("FileScan"):]
    assert "LeftSemi" in text and "GreaterThanOrEqual(k,3)" in scan and "LessThanOrEqual(k,7)" in scan
    pairs = few.withColumn("w", F.col("v"))
    wide = target.withColumn("w", F.lit("x"))
    text = plan(missing_keys(pairs, wide, ["k", "w"]))
    assert "LeftSemi" in text and "GreaterThanOrEqual(k,3)" in text
    assert "LeftSemi" not in plan(missing_keys(source, target, "k"))


@pytest.mark.parametrize("missing", [900, 5_000])
@pytest.mark.parametrize("lookup", [0, 1_000, 10_000])
@pytest.mark.parametrize("kind, mode", [("string", "exact"), ("string", "range"), ("float", "exact")])
def test_repair_of_a_cast_key_drops_nothing(spark, monkeypatch, kind, mode, lookup, missing):
    """Text keys have another order, floating point makes large keys equal."""
    monkeypatch.setattr("gapmend.plans.jobs.LOOKUP_KEYS", lookup)
    start = 2**24 - 100 if kind == "float" else 5
    name, _ = day_table(spark, [], f"id {kind}, v string, day string")
    source = spark.range(start, start + missing + 10).selectExpr("id", "'new' AS v")
    append_dynamic(
        source.where(f"id >= {start + missing}").selectExpr(f"CAST(id AS {kind}) AS id", "v", "'d' AS day"), name
    )
    report = repair(source, name, "id", mode, day="2024-02-01")
    if mode == "exact":
        assert report.appended_rows == report.missing_rows
    spark.catalog.refreshTable(name)
    keys = source.selectExpr(f"CAST(id AS {kind}) AS id")
    assert keys.join(spark.table(name), "id", "left_anti").isEmpty()


@pytest.fixture
def hot_source(spark):
    """Keys 3 and 4 hold most of the source, partly as identical copies."""
    rows = spark.range(0, 4000, 1, 4).selectExpr(
        "CASE WHEN id % 2 = 0 THEN 3 WHEN id % 5 = 0 THEN 4 WHEN id % 101 = 1 THEN NULL "
        "ELSE id END AS k",
        "CASE WHEN id % 4 = 0 THEN 'same' ELSE CAST(id AS string) END AS v",
    )
    target = ids(spark, [*range(0, 4000, 3), *[4] * 50, None]).withColumnRenamed("id", "k")
    return rows, target


@pytest.mark.parametrize("how", ["inner", "left_semi", "left_anti"])
@pytest.mark.parametrize("most", [10_000, 1])
def test_hot_source_keys_are_joined_apart(spark, hot_source, monkeypatch, how, most):
    source, target = hot_source
    right = target.dropna().groupBy("k").count()
    wanted = sorted(source.join(right, "k", how).collect(), key=str)
    monkeypatch.setattr("gapmend.operators.joins.HOT_ROWS", 300)
    monkeypatch.setattr("gapmend.operators.joins.MAX_HOT_KEYS", most)
    with hot_keys(source, ["k"]) as hot:
        assert sorted(r.k for r in hot.collect()) == ([3, 4] if most == 10_000 else [])
    with session_conf(spark, NO_BROADCAST):
        found = join_unique(source, write_shared(right, "right"), ["k"], how)
        assert sorted(found.collect(), key=str) == wanted
        if most == 1:
            return
        text = plan(found)
        assert "Union" in text and "SortMergeJoin" in text
        assert text.count("BroadcastHashJoin") >= 3


def test_no_hot_key_no_split(spark, hot_source):
    with hot_keys(hot_source[0], ["k"]) as hot:
        assert hot is None
    assert "Union" not in plan(matched_rows(*hot_source, "k"))


def test_hot_source_keys_in_the_operators(spark, hot_source, monkeypatch):
    source, target = hot_source

    def found():
        return [
            sorted(op(source, target, "k").collect(), key=str)
            for op in (missing_rows, matched_rows, matched_copies)
        ]

    wanted = found()
    monkeypatch.setattr("gapmend.operators.joins.HOT_ROWS", 300)
    with session_conf(spark, NO_BROADCAST):
        assert found() == wanted


def test_preview_is_a_top_n(spark, tables):
    assert "TakeOrderedAndProject" in plan(missing_preview(*tables, "k"))


def test_undated_rows_come_from_one_partition(spark):
    name, _ = day_table(spark, [(1, "a", None), (2, "b", "2024-01-01")])
    text = plan(null_partition_rows(spark.table(name)))
    assert "PartitionFilters: [isnull(day" in text


def test_cleaning_reads_whole_rows_of_touched_days_only(spark, monkeypatch):
    rows = [(1, "a", "d1"), (1, "b", "d2"), (2, "c", "d3"), (3, "d", "d2")]
    name, _ = day_table(spark, rows)
    seen = {}

    def spy(df, label, **options):
        seen[label] = plan(df)
        return write_shared(df, label, **options)

    monkeypatch.setattr("gapmend.sinks.rewrite.write_shared", spy)
    rewrite_duplicates(spark, name, "id", ["v"])
    scans = re.findall(r"FileScan parquet [^\n]*ReadSchema: struct<id:bigint,v:string>", seen["cleaned-days"])
    assert len(scans) == 2
    filters = [re.search(r"PartitionFilters: \[([^\]]*)", s).group(1) for s in scans]
    assert all("d2" in f and "d3" not in f for f in filters)
    assert "v:string" not in seen["copies-by-day"]


def test_history_is_one_stage(spark, tables):
    rows = change_envelope(tables[0].selectExpr("CAST(k AS decimal(9,0)) AS k", "v"), "s.t")
    assert exchanges(plan(widen_decimals(rows))) == []


def test_rows_without_a_gap_are_dropped_before_the_shuffle(spark, tables, monkeypatch):
    source, _ = tables
    rows = [(k, str(k), "x", "d") for k in range(0, ROWS // 2, 3)]
    name, _ = day_table(spark, rows, "k bigint, v string, w string, day string")
    monkeypatch.setattr("gapmend.plans.jobs.LOOKUP_KEYS", 0)
    scan = "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold"
    store = spark._jsparkSession.sharedState().statusStore()
    before = store.executionsCount()
    with session_conf(spark, {**NO_BROADCAST, scan: "1"}):
        report = repair(source, name, "k", day="2024-02-01", key_range=(0, ROWS))
    ran = store.executionsList(before, 100)
    plans = [ran.apply(i).physicalPlanDescription() for i in range(ran.length())]
    written = [p for p in plans if "InsertIntoHadoopFs" in p and "SortMergeJoin" in p]
    assert any("might_contain" in p for p in written)
    assert report.appended_rows == ROWS // 2 - len(rows)
    assert spark.table(name).select("k").distinct().count() == ROWS // 2
