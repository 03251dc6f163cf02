from datetime import datetime, timezone
from decimal import Decimal

import pytest
from pyspark.errors import ArithmeticException
from pyspark.sql import functions as F

from gapmend.functions import (
    SchemaMismatch,
    business_day,
    change_envelope,
    conform,
    file_name,
    partition_stamp,
    project_to_target,
    run_day,
    schema_drift,
    split_path,
    widen_decimals,
)
from gapmend.shared import fresh_path


def test_decimals_by_scale(spark):
    df = spark.sql(
        "SELECT CAST(1 AS decimal(10,0)) a, CAST(1.5 AS decimal(10,2)) b, "
        "array(CAST(1 AS decimal(10,0))) c, struct(CAST(1 AS decimal(10,0)) x) d, 'decimal,0' e"
    )
    assert widen_decimals(df).dtypes == [
        ("a", "bigint"),
        ("b", "double"),
        ("c", "array<decimal(10,0)>"),
        ("d", "struct<x:decimal(10,0)>"),
        ("e", "string"),
    ]


def test_decimal_that_no_long_can_hold(spark):
    huge = Decimal("99999999999999999999")
    df = spark.createDataFrame([(huge,)], "a decimal(38,0)")
    with pytest.raises(ArithmeticException):
        widen_decimals(df).collect()
    assert widen_decimals(df, on_error="null").first().a is None


def test_conform_is_one_projection(spark):
    df = spark.createDataFrame([("1", "x")], "`O_KEY` string, extra string")
    found = conform(df, [("o_key", "bigint"), ("dat_kafka", "timestamp"), ("gone", "int")])
    assert found.dtypes == [("O_KEY", "bigint"), ("extra", "string"), ("dat_kafka", "timestamp")]
    assert tuple(found.first()) == (1, "x", None)


def test_conform_to_a_struct_type(spark):
    df = spark.createDataFrame([("7", 2)], "a string, b int")
    wanted = spark.createDataFrame([], "a int, b int").schema
    assert conform(df, wanted).dtypes == [("a", "int"), ("b", "int")]


def test_conform_text_that_is_no_number(spark):
    df = spark.createDataFrame([("x",)], "a string")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        conform(df, [("a", "int")]).collect()
    assert conform(df, [("a", "int")], on_error="null").first().a is None


@pytest.mark.parametrize("types", ["all", 3, None])
def test_conform_rejects_other_arguments(spark, types):
    with pytest.raises(ValueError):
        conform(spark.range(1), types)


def test_conform_auto_in_any_case(spark):
    df = spark.sql("SELECT CAST(1 AS decimal(3,0)) a")
    assert conform(df, "AUTO").dtypes == [("a", "bigint")]


def test_projection_to_target(spark):
    df = spark.createDataFrame([(1, 2, 3)], "A int, b int, c int")
    assert project_to_target(df, ["c", "a"]).columns == ["c", "a"]
    with pytest.raises(SchemaMismatch, match="d"):
        project_to_target(df, ["a", "d"])


def test_drift(spark):
    rows = [("1", 300, 1, [1]), ("x", None, 2, [2])]
    df = spark.createDataFrame(rows, "a string, b int, c int, d array<int>")
    target = [("A", "int"), ("b", "tinyint"), ("d", "bigint"), ("e", "int"), ("dat_kafka", "string")]
    found = {r.column: tuple(r)[1:] for r in schema_drift(df, target).collect()}
    assert found == {
        "A": ("both", "string", "int", "cast", 2, 1),
        "b": ("both", "int", "tinyint", "cast", 1, 1),
        "c": ("source", "int", None, "extra", 2, 2),
        "d": ("both", "array<int>", "bigint", "incompatible", 2, 2),
        "e": ("target", None, "int", "missing", 0, 0),
        "dat_kafka": ("target", None, "string", "fill", 0, 0),
    }


def test_drift_without_a_look_at_the_rows(spark):
    df = spark.sql("SELECT assert_true(id < 0) AS x, id FROM range(3)")
    found = schema_drift(df, [("id", "int")], counted=False).collect()
    assert [(r.column, r.action, r.held, r.lost) for r in found] == [
        ("x", "extra", None, None),
        ("id", "cast", None, None),
    ]


def test_envelope_comes_first(spark):
    df = change_envelope(spark.range(1), "s.t", "2024-01-02 03:04:05")
    assert df.columns == ["table", "op_type", "op_ts", "current_ts", "pos", "id"]
    assert tuple(df.first()) == ("s.t", "null", "null", "2024-01-02 03:04:05", "null", 0)


def test_envelope_takes_the_time_of_the_query(spark):
    stamp = change_envelope(spark.range(1), "s.t").first().current_ts
    datetime.strptime(stamp, "%Y-%m-%d %H:%M:%S")


def test_stamp(spark):
    assert partition_stamp(spark.range(1), "2024-01-01").first().day == "2024-01-01"


@pytest.mark.parametrize(
    "ts, day",
    [
        ("2024-01-02 02:59:59.999999", "2024-01-01"),
        ("2024-01-02 03:00:00", "2024-01-02"),
        # Summer time was in force: two hours behind.
        ("2018-01-02 02:00:00", "2018-01-02"),
    ],
)
def test_business_day(spark, ts, day):
    df = spark.sql(f"SELECT timestamp_ntz'{ts}' AS local, timestamp'{ts}' AS instant")
    assert df.select(business_day(F.col("local"))).first()[0] == day
    assert df.select(business_day(F.col("instant"), from_zone=None)).first()[0] == day


def test_run_day():
    assert run_day(now=datetime(2024, 1, 1, 2, 30, tzinfo=timezone.utc)) == "2023-12-31"


@pytest.mark.parametrize(
    "path, parts",
    [
        ("s3a://bucket/a/day=1/f.avro", ("s3a", "bucket", "a/day=1/f.avro")),
        ("file:///tmp/f", ("file", "", "tmp/f")),
        ("file:/tmp/f", ("file", "", "tmp/f")),
    ],
)
def test_split_path(spark, path, parts):
    assert tuple(spark.range(1).select(split_path(F.lit(path)).alias("p")).first().p) == parts


def test_file_of_a_row(spark):
    path = fresh_path(spark, "file")
    spark.range(3).coalesce(1).write.parquet(path)
    df = file_name(spark.read.parquet(path).where("id > 0").withColumn("x", F.lit(1)))
    name = df.first().filename
    assert df.columns == ["id", "x", "filename"]
    assert path in name and name.endswith(".parquet")
    joined = spark.read.parquet(path).groupBy("id").count()
    for lost in (spark.range(1), joined):
        with pytest.raises(ValueError, match="not known"):
            file_name(lost)
