import pytest

from gapmend.functions import (
    SchemaMismatch,
    change_envelope,
    conform,
    conform_with_rejects,
    rejects,
)
from gapmend.operators.joins import hot_keys
from gapmend.plans import history, repair
from gapmend.plans.jobs import _Source
from gapmend.shared import delete_path, fresh_path, session_conf
from tests.tables import contents, day_table, ids, source_rows

DAY = "2024-02-01"
OLD = "2024-01-01"


def landed(spark, values):
    return day_table(spark, [(v, f"old {v}", OLD) for v in values])


def days(spark, name):
    return sorted(r.id for r in spark.table(name).where(f"day = '{DAY}'").collect())


def test_exact_repair_and_again(spark):
    name, _ = landed(spark, [1, 2, 5, 5])
    source = source_rows(spark, range(1, 8))
    report = repair(source, name, "id", day=DAY)
    assert (report.status, report.missing_rows, report.appended_rows) == ("missing", 4, 4)
    assert (report.min_missing, report.max_missing) == (3, 7)
    assert days(spark, name) == [3, 4, 6, 7]
    again = repair(source, name, "id", day=DAY)
    assert (again.status, again.missing_rows, again.appended_rows) == ("duplicated", 0, 0)
    assert days(spark, name) == [3, 4, 6, 7]


def test_range_repair_appends_the_whole_span(spark):
    name, _ = landed(spark, [1, 2, 4, 6])
    report = repair(source_rows(spark, range(1, 7)), name, "id", "range", day=DAY)
    assert (report.min_missing, report.max_missing, report.appended_rows) == (3, 5, 3)
    assert days(spark, name) == [3, 4, 5]


def test_full_repair_does_not_look(spark):
    name, _ = landed(spark, [1])
    report = repair(source_rows(spark, [1, 2, None]), name, "id", "full", day=DAY)
    assert (report.status, report.appended_rows) == ("full", 3)
    assert spark.table(name).count() == 4


def test_given_range_limits_both_sides(spark):
    name, _ = landed(spark, [1, 2])
    source = source_rows(spark, range(1, 10))
    report = repair(source, name, "id", day=DAY, key_range=(2, 4))
    assert (report.source_rows, report.missing_rows) == (3, 2)
    assert days(spark, name) == [3, 4]
    assert repair(source, name, "id", "full", DAY, key_range=(8, 9)).appended_rows == 2


@pytest.mark.parametrize("mode", ["exact", "range", "full"])
def test_staged_repair(spark, mode):
    name, _ = landed(spark, [1])
    path = fresh_path(spark, "staged")
    source = source_rows(spark, [1, 2, 3])
    report = repair(
        source, name, "id", mode, DAY, staging_path=path, staging_format="parquet"
    )
    assert spark.read.parquet(path).count() == report.appended_rows == len(days(spark, name))


def test_null_keys_are_reported_not_appended(spark):
    name, _ = landed(spark, [1])
    report = repair(source_rows(spark, [1, None, 2]), name, "id", day=DAY)
    assert (report.null_keys, report.appended_rows) == (1, 1)
    assert days(spark, name) == [2]


def test_empty_source_appends_nothing(spark):
    name, _ = landed(spark, [1])
    report = repair(source_rows(spark, []), name, "id", day=DAY)
    assert (report.source_rows, report.appended_rows) == (0, 0)
    assert days(spark, name) == []


def test_counts_that_cancel_out_are_repaired(spark):
    name, _ = landed(spark, [1, 1])
    report = repair(source_rows(spark, [1, 2]), name, "id", day=DAY)
    assert (report.status, report.appended_rows) == ("present", 1)
    assert days(spark, name) == [2]


def test_large_sources_take_the_other_way(spark, monkeypatch):
    name, _ = landed(spark, [1, 2, 5])
    monkeypatch.setattr("gapmend.plans.jobs.LOOKUP_KEYS", 0)
    with session_conf(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        report = repair(source_rows(spark, range(1, 8)), name, "id", day=DAY)
    assert report.appended_rows == 4
    assert days(spark, name) == [3, 4, 6, 7]


@pytest.mark.parametrize("most", [0, 1, 3, 4, 1000])
def test_few_missing_keys_are_looked_up(spark, monkeypatch, most):
    monkeypatch.setattr("gapmend.plans.jobs.LOOKUP_KEYS", most)
    name, _ = landed(spark, [1, 2, 5])
    source = source_rows(spark, [1, 2, 3, 3, 5, 6, 9, None])
    report = repair(source, name, "id", day=DAY)
    assert (report.missing_keys, report.appended_rows) == (3, 4)
    assert days(spark, name) == [3, 3, 6, 9]


def test_looked_up_keys_reach_the_scan(spark):
    path = fresh_path(spark, "wide")
    source_rows(spark, range(100)).write.parquet(path)
    read = _Source(spark.read.parquet(path), lambda df: df)
    text = read.lookup("id", [3, 77])._jdf.queryExecution().executedPlan().toString()
    assert "In(id, [3,77])" in text


def test_source_is_brought_to_the_target(spark):
    name, _ = day_table(spark, [(1, 5, None, OLD)], "id bigint, n int, dat_kafka string, day string")
    source = spark.createDataFrame([("x", "2", "7")], "extra string, ID string, N string")
    repair(source, name, "id", day=DAY)
    assert contents(spark, name)[-1] == (2, 7, None, DAY)
    with pytest.raises(SchemaMismatch):
        repair(source.drop("N"), name, "id", day=DAY)


def test_composite_key(spark):
    schema = "a int, b string, v string, day string"
    name, _ = day_table(spark, [(1, "x", "old", OLD)], schema)
    rows = [(1, "x", "new"), (1, "y", "new"), (2, None, "new")]
    source = spark.createDataFrame(rows, "a int, b string, v string")
    report = repair(source, name, ["a", "b"], day=DAY)
    assert (report.null_keys, report.appended_rows, report.min_missing) == (1, 1, None)
    with pytest.raises(ValueError):
        repair(source, name, ["a", "b"], "range", day=DAY)


def test_unknown_mode(spark):
    with pytest.raises(ValueError):
        repair(ids(spark, [1]), "t", "id", "partly")


def test_history_replaces(spark):
    path = fresh_path(spark, "history")
    source = spark.sql("SELECT CAST(7 AS decimal(9,0)) id, CAST(1.5 AS decimal(9,2)) v")
    for _ in range(2):
        history(change_envelope(source, "s.t", "2024-01-01 00:00:00"), path, "parquet")
    found = spark.read.parquet(path)
    assert found.dtypes[-2:] == [("id", "bigint"), ("v", "double")]
    assert tuple(found.first())[-2:] == (7, 1.5) and found.count() == 1


@pytest.mark.parametrize(
    "given, pushed", [("decimal(20,0)", True), ("int", True), ("string", False), ("decimal(9,2)", False)]
)
def test_range_is_taken_before_the_cast_where_that_is_the_same(spark, given, pushed):
    path = fresh_path(spark, "typed")
    values = "1, 2, 3, 4" if given != "decimal(9,2)" else "1.0, 2.7, 3.0, 4.2"
    rows = spark.sql(f"SELECT explode(array({values})) AS id")
    rows.select(rows.id.cast(given)).write.parquet(path)
    wanted = spark.createDataFrame([], "id bigint").schema
    read = _Source(spark.read.parquet(path), lambda df: conform(df, wanted))
    found = read.within("id", 2, 3)
    assert sorted(r.id for r in found.collect()) == [2, 3]
    text = found._jdf.queryExecution().executedPlan().toString()
    assert ("GreaterThanOrEqual(id,2" in text) == pushed


def test_key_range_needs_one_key(spark):
    name, _ = landed(spark, [1])
    with pytest.raises(ValueError):
        repair(source_rows(spark, [1]), name, ["id", "v"], key_range=(1, 2))


@pytest.mark.parametrize("limit, counted", [(1, True), (2, False)])
def test_hot_keys_are_sought_only_if_coverage_saw_any(spark, monkeypatch, limit, counted):
    name, _ = landed(spark, [1])
    asked = []

    def spy(df, keys):
        asked.append(keys)
        return hot_keys(df, keys)

    monkeypatch.setattr("gapmend.operators.joins.hot_keys", spy)
    monkeypatch.setattr("gapmend.operators.joins.HOT_ROWS", limit)
    monkeypatch.setattr("gapmend.plans.jobs.LOOKUP_KEYS", 0)
    with session_conf(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        report = repair(source_rows(spark, [1, 2, 2, 3, None, None, None]), name, "id", day=DAY)
    assert report.max_source_rows == 2
    assert asked == ([["id"]] if counted else [])
    assert days(spark, name) == [2, 2, 3]


def test_history_does_not_overwrite_what_it_reads(spark):
    path = fresh_path(spark, "history")
    spark.range(3).write.parquet(path)
    for source in (path, f"{path}/*.parquet"):
        with pytest.raises(ValueError, match="overwrite"):
            history(spark.read.parquet(source), path, "parquet")
    assert spark.read.parquet(path).count() == 3


def test_repair_counts_and_drops_undated_rows(spark):
    name, _ = day_table(spark, [(1, "a", None), (2, "b", "2024-01-01")])
    source = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id bigint, v string")
    report = repair(source, name, "id", day="2024-02-01")
    assert (report.undated_rows, report.appended_rows) == (1, 1)
    report = repair(source, name, "id", day="2024-02-01", drop_undated=True)
    assert report.undated_rows == 1
    assert repair(source, name, "id", day="2024-02-01").missing_rows == 1


def test_repair_sees_days_that_others_landed(spark):
    name, path = day_table(spark, [(1, "a", "2024-01-01")])
    other = spark.createDataFrame([(2, "b")], "id bigint, v string")
    other.write.parquet(f"{path}/day=2024-01-02")
    source = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id bigint, v string")
    assert repair(source, name, "id", day="2024-02-01").appended_rows == 1


def test_hot_keys_leave_no_file(spark, monkeypatch):
    from gapmend.operators import joins

    paths = []
    write = joins.write_shared

    def spy(*args, **options):
        paths.append(write(*args, **options))
        return paths[-1]

    monkeypatch.setattr(joins, "write_shared", spy)
    monkeypatch.setattr(joins, "HOT_ROWS", 1)
    with joins.hot_keys(spark.range(4).selectExpr("id % 2 AS id"), ["id"]) as hot:
        assert hot.count() == 2
    assert len(paths) == 1 and not delete_path(spark, paths[0].path)


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz", "date", "decimal(20,2)"])
def test_repair_by_other_keys(spark, kind):
    name, _ = day_table(spark, [], f"id {kind}, v string, day string")
    number = "CAST('2024-01-01' AS date) + CAST(id AS int)" if kind == "date" else (
        "CAST(id AS decimal(20,2)) / 4" if kind.startswith("decimal")
        else f"CAST(CAST('2024-03-31 00:30:00' AS timestamp_ntz) + make_interval(0, 0, 0, 0, CAST(id AS int)) AS {kind})"
    )
    with session_conf(spark, {"spark.sql.session.timeZone": "America/Sao_Paulo"}):
        source = spark.range(30).selectExpr(f"CAST({number} AS {kind}) AS id", "'new' AS v")
        assert repair(source.limit(12), name, "id", day=OLD).appended_rows == 12
        report = repair(source, name, "id", day=DAY)
    assert (report.missing_rows, report.appended_rows) == (18, 18)


def texts(spark, rows):
    return spark.createDataFrame(rows, "id string, v string, extra int")


def lost(spark, path):
    return sorted(map(tuple, spark.read.parquet(path).select("column", "value", "row.id", "row.extra").collect()))


@pytest.mark.parametrize("parse_once", [False, True])
@pytest.mark.parametrize("mode", ["exact", "full", "range"])
def test_rejected_casts_are_returned(spark, mode, parse_once):
    name, _ = day_table(spark, [(1, 10, OLD)], "id bigint, v int, day string")
    path = fresh_path(spark, "rejects")
    rows = [("1", "x", 1), ("2", "20", 2), ("3", "y", 3), ("four", "z", 4), (None, "w", 5), ("6", None, 6)]
    report = repair(
        texts(spark, rows), name, "id", mode, DAY, on_error="null", rejects_path=path, parse_once=parse_once
    )
    # A row that is there already is not written, one without a key neither.
    keyless = [("id", "four", "four", 4), ("v", "z", "four", 4)]
    if mode == "full":
        assert lost(spark, path) == sorted([("v", "x", "1", 1), ("v", "y", "3", 3), ("v", "w", None, 5), *keyless])
        assert (report.rejected_rows, report.appended_rows) == (4, 6)
    else:
        assert lost(spark, path) == sorted([("v", "y", "3", 3), *keyless])
        assert (report.rejected_rows, report.appended_rows) == (2, 3)
        landed = spark.table(name).where(f"day = '{DAY}'").select("id", "v")
        assert sorted(map(tuple, landed.collect())) == [(2, 20), (3, None), (6, None)]


def test_rejects_of_a_repair_without_gaps(spark):
    name, _ = landed(spark, [1, 2])
    for mode in ("exact", "range"):
        path = fresh_path(spark, "rejects")
        report = repair(source_rows(spark, [1, 2]), name, "id", mode, DAY, on_error="null", rejects_path=path)
        assert (report.appended_rows, report.rejected_rows) == (0, 0)
        assert spark.read.parquet(path).count() == 0
    assert spark.table(name).count() == 2


def test_rejects_need_their_own_path_and_null(spark):
    name, path = landed(spark, [1])
    source = source_rows(spark, [1, 2])
    with pytest.raises(ValueError, match="on_error"):
        repair(source, name, "id", rejects_path=fresh_path(spark, "rejects"))
    with pytest.raises(ValueError, match="exists"):
        repair(source, name, "id", on_error="null", rejects_path=path)
    with pytest.raises(ValueError, match="goes on"):
        repair(
            source, name, "id", "full", on_error="null", rejects_path=fresh_path(spark, "rejects"),
            run_id="a", staging_path=fresh_path(spark, "staged"),
        )


def test_rejects_of_a_range_leave_keyless_rows_out(spark):
    name, _ = day_table(spark, [(1, 10, OLD)], "id bigint, v int, day string")
    path = fresh_path(spark, "rejects")
    rows = [("2", "x", 2), ("9", "y", 9), ("four", "z", 4)]
    repair(texts(spark, rows), name, "id", day=DAY, key_range=(1, 5), on_error="null", rejects_path=path)
    assert lost(spark, path) == [("v", "x", "2", 2)]


def test_rejects_of_a_history(spark):
    rows = spark.sql("select cast(id as decimal(38,0)) * 5000000000000000000 as n, id, null as void from range(4)")
    path, out = fresh_path(spark, "rejects"), fresh_path(spark, "history")
    history(rows.drop("void"), out, "parquet", on_error="null", rejects_path=path)
    assert sorted(r.n or 0 for r in spark.read.parquet(out).collect()) == [0, 0, 0, 5 * 10**18]
    found = spark.read.parquet(path).select("column", "value", "target_type", "row.id").collect()
    assert sorted(map(tuple, found)) == [("n", str(k * 5 * 10**18), "bigint", k) for k in (2, 3)]
    checked = conform_with_rejects(rows, [("n", "int"), ("id", "bigint"), ("void", "string")])
    assert checked.columns == ["n", "id", "void", "rejected"]
    assert rejects(checked).select("row.*").columns == ["n", "id"] and rejects(checked).count() == 3
    with pytest.raises(ValueError, match="already"):
        conform_with_rejects(checked)
