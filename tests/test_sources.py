import json

import pytest

from gapmend.operators import in_range, key_range
from gapmend.shared import (
    delete_path,
    fresh_path,
    narrow_scan,
    session_conf,
    shared_dir,
    write_shared,
)
from gapmend.sources import (
    avro_to_struct,
    csv_scan,
    jdbc_options,
    key_cuts,
    latest_avro_schema,
    range_predicates,
    read_source,
)
from gapmend.sources.jdbc import key_range_query


@pytest.fixture
def text(tmp_path):
    def write(content, encoding="utf-8"):
        path = tmp_path / "in.csv"
        path.write_bytes(content.encode(encoding))
        return str(path)

    return write


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_csv_is_all_text(spark, text):
    df = csv_scan(spark, text("a,b\n1,2.5\n"))
    assert df.dtypes == [("a", "string"), ("b", "string")]
    assert rows(df) == [("1", "2.5")]


def test_csv_null_marker(spark, text):
    assert rows(csv_scan(spark, text("a,b\nNA,x\n"), null_value="NA")) == [(None, "x")]


def test_csv_quoted_delimiter(spark, text):
    df = csv_scan(spark, text("a;b\n1;'b;c'\n"), delimiter=";", quote="'")
    assert rows(df) == [("1", "b;c")]


def test_csv_without_header(spark, text):
    df = csv_scan(spark, text("1,2\n"), header=False)
    assert df.columns == ["_c0", "_c1"] and rows(df) == [("1", "2")]


def test_csv_charset(spark, text):
    df = csv_scan(spark, text("a\nação\n", "iso-8859-1"), charset="ISO-8859-1")
    assert rows(df) == [("ação",)]


def test_source_by_name(spark, text):
    assert rows(read_source(spark, "csv", path=text("a\n1\n"))) == [("1",)]
    with pytest.raises(ValueError, match="database, csv, table"):
        read_source(spark, "queue")


def test_jdbc_strides_need_both_bounds():
    whole = jdbc_options("jdbc:x", "t", "id", 1, 90, 4, user="u")
    assert whole == {
        "url": "jdbc:x",
        "dbtable": "t",
        "fetchsize": "20000",
        "user": "u",
        "partitionColumn": "id",
        "lowerBound": "1",
        "upperBound": "90",
        "numPartitions": "4",
    }
    assert "partitionColumn" not in jdbc_options("jdbc:x", "t", "id", None, 90)


def test_jdbc_key_range_query():
    assert key_range_query("s.t", "id", 5) == (
        "(SELECT MIN(id) AS initrange, MAX(id) AS endrange FROM s.t WHERE id >= 5) key_range"
    )


def test_predicates_hold_every_row_once(spark):
    df = spark.sql("SELECT id FROM range(1000) UNION ALL SELECT 5000000 UNION ALL SELECT NULL")
    cuts = key_cuts(df, "id", 8)
    assert 1 <= len(cuts) <= 7
    parts = [df.where(p).count() for p in range_predicates("id", cuts)]
    assert sum(parts) == 1002 and max(parts) < 300
    assert range_predicates("id", []) == ["1 = 1"]
    assert key_cuts(spark.range(0), "id", 4) == []


def avro_file(spark, path, fields):
    """Write an Avro file with one record through the Avro library."""
    jvm = spark._jvm
    schema = jvm.org.apache.avro.Schema.Parser().parse(
        json.dumps({"type": "record", "name": "r", "fields": fields})
    )
    record = jvm.org.apache.avro.generic.GenericData.Record(schema)
    record.put("id", 1)
    target = jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target)
    writer = jvm.org.apache.avro.file.DataFileWriter(
        jvm.org.apache.avro.generic.GenericDatumWriter(schema)
    )
    writer.create(schema, out).append(record)
    writer.close()


def set_time(spark, path, millis):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.setTimes(target, millis, -1)


def test_schema_of_the_newest_file(spark):
    base = fresh_path(spark, "landing")
    old = [{"name": "id", "type": "int"}]
    new = [
        {"name": "id", "type": "int"},
        {"name": "at", "type": ["null", {"type": "long", "logicalType": "timestamp-millis"}]},
    ]
    avro_file(spark, f"{base}/day=2024-01-02/a.avro", old)
    avro_file(spark, f"{base}/day=2024-01-01/b.avro", new)
    avro_file(spark, f"{base}/holidays/c.avro", old)
    set_time(spark, f"{base}/day=2024-01-02/a.avro", 1_000_000)
    set_time(spark, f"{base}/day=2024-01-01/b.avro", 2_000_000)
    set_time(spark, f"{base}/holidays/c.avro", 3_000_000)
    schema = latest_avro_schema(spark, base)
    assert [f["name"] for f in schema["fields"]] == ["id", "at"]
    assert avro_to_struct(spark, schema).simpleString() == "struct<id:int,at:timestamp>"


def test_no_file_under_a_day(spark):
    base = fresh_path(spark, "landing")
    avro_file(spark, f"{base}/holidays/c.avro", [{"name": "id", "type": "int"}])
    with pytest.raises(FileNotFoundError):
        latest_avro_schema(spark, base)
    assert delete_path(spark, base)


def test_shared_folder_is_the_one_of_the_session(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_what_was_written_is_measured(spark):
    few = write_shared(spark.createDataFrame([("é", 1), (None, 2)], "a string, b int"), "few")
    assert (few.rows, few.memory, few.fits_broadcast()) == (2, 2 + 2 * 64, True)
    empty = write_shared(few.frame.where("b > 5"), "none")
    assert (empty.rows, empty.memory, empty.fits_broadcast()) == (0, 0, True)
    nested = write_shared(few.frame.selectExpr("array(a) AS a"), "nested")
    assert nested.memory is None and not nested.fits_broadcast()
    many = write_shared(spark.range(3_000_000), "many")
    assert many.rows == 3_000_000 and not many.fits_broadcast()
    with session_conf(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        assert not few.fits_broadcast()
    with session_conf(spark, {"spark.sql.autoBroadcastJoinThreshold": "1g"}):
        assert many.fits_broadcast()


def test_options_are_put_back(spark):
    name = "spark.sql.shuffle.partitions"
    with pytest.raises(RuntimeError):
        with session_conf(spark, {name: "3", "spark.gapmend.test": "x"}):
            assert spark.conf.get(name) == "3"
            raise RuntimeError
    assert spark.conf.get(name) == "8"
    assert spark.conf.get("spark.gapmend.test", None) is None


def test_splits_are_larger_for_keys_alone(spark):
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    with narrow_scan(spark):
        assert spark.conf.get(name) == str(1024**3)
        assert spark.range(5).count() == 5
    assert spark.conf.get(name) == before
    with session_conf(spark, {name: "4g"}), narrow_scan(spark):
        assert spark.conf.get(name) == str(4 * 1024**3)


@pytest.fixture
def fake_table(spark, monkeypatch):
    """Stands in for the reads of a database table with the given keys."""

    def serve(keys):
        table = spark.createDataFrame([(k,) for k in keys], "ID bigint")
        asked = []

        def probe(spark, url, name, key, low=None, high=None, **connection):
            return key_range(in_range(table, key, low, high), key)

        def scan(spark, url, name, key, low=None, high=None, num_partitions=40, **connection):
            asked.append((name, low, high, num_partitions))
            return in_range(table, key, low, high)

        def balanced(spark, url, name, key, cuts, low, high, **connection):
            asked.append(cuts)
            return in_range(table, key, low, high)

        monkeypatch.setattr("gapmend.sources.jdbc.jdbc_key_range", probe)
        monkeypatch.setattr("gapmend.sources.jdbc.jdbc_range_scan", scan)
        monkeypatch.setattr("gapmend.sources.jdbc.jdbc_balanced_scan", balanced)
        return asked

    return serve


def from_database(spark, **options):
    df = read_source(
        spark, "database", url="jdbc:x", schema="s", table="t", primary_key="id", **options
    )
    return sorted(r.ID for r in df.collect()), df


@pytest.mark.parametrize(
    "given, bounds",
    [
        ({}, (2, 30)),
        ({"init_range": 3}, (3, 30)),
        ({"end_range": 9}, (2, 9)),
        ({"init_range": 1, "end_range": 100}, (1, 100)),
    ],
)
def test_database_source_finds_its_bounds(spark, fake_table, given, bounds):
    asked = fake_table([2, 3, 9, 30])
    found, df = from_database(spark, **given)
    assert asked == [("s.t", *bounds, 40)]
    assert found == [k for k in [2, 3, 9, 30] if bounds[0] <= k <= bounds[1]]
    assert df.columns == ["table", "op_type", "op_ts", "current_ts", "pos", "ID"]
    assert df.first().table == "s.t"


def test_database_source_of_an_empty_table(spark, fake_table):
    asked = fake_table([])
    assert from_database(spark)[0] == []
    assert asked == [("(SELECT * FROM s.t WHERE 1 = 0) nothing", None, None, 1)]


def test_database_source_in_even_splits(spark, fake_table):
    asked = fake_table([*range(100), 1_000_000])
    found, _ = from_database(spark, balanced=True, num_partition=4)
    assert len(found) == 101
    assert len(asked[1]) == 3 and max(asked[1]) < 100
