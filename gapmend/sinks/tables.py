"""Day-partitioned tables: creation, appends, partitions.

Everything goes through the catalog with Spark SQL, so it works on data source
tables (``USING parquet``, ``USING avro``) and on Hive SerDe tables alike.
"""

from __future__ import annotations

import json
from contextlib import contextmanager
from typing import Any
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from gapmend.functions.columns import named, quoted
from gapmend.functions.conform import project_to_target
from gapmend.functions.stamps import partition_stamp
from gapmend.shared import delete_path, file_names, folder_names, path_exists, session_conf
from gapmend.sinks.files import replace_files
from gapmend.sources.avro_schema import newest_schema


def _text(value: str) -> str:
    """``value`` as a SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _prepare(spark: SparkSession, table: str, replace: bool) -> None:
    if "." in table:
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {table.rsplit('.', 1)[0]}")
    if replace:
        spark.sql(f"DROP TABLE IF EXISTS {table}")


def create_table(
    spark: SparkSession,
    table: str,
    schema: StructType,
    location: str,
    partition: str | None = "day",
    partition_type: str = "string",
    fmt: str = "parquet",
    replace: bool = False,
) -> None:
    """Declare an external table over ``location``.

    The partition column comes last; ``schema`` may hold it or not.
    """
    _prepare(spark, table, replace)
    columns = [
        f"{quoted(f.name)} {f.dataType.simpleString()}"
        for f in schema.fields
        if f.name.lower() != (partition or "").lower()
    ]
    by = ""
    if partition:
        columns.append(f"{quoted(partition)} {partition_type}")
        by = f"PARTITIONED BY ({quoted(partition)})"
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({', '.join(columns)}) "
        f"USING {fmt} {by} LOCATION {_text(location)}"
    )


def avro_table_ddl(
    table: str,
    location: str,
    avro_schema: dict | str,
    partition: str | None = None,
    partition_type: str = "string",
) -> str:
    """DDL of an external Hive Avro table.

    A dict is the schema itself, a string the address of a schema file.
    """
    if isinstance(avro_schema, dict):
        option = ("avro.schema.literal", json.dumps(avro_schema))
    elif isinstance(avro_schema, str):
        option = ("avro.schema.url", avro_schema)
    else:
        raise ValueError("avro_schema is a schema (dict) or the address of one (str)")
    by = f" PARTITIONED BY ({quoted(partition)} {partition_type})" if partition else ""
    return (
        f"CREATE EXTERNAL TABLE IF NOT EXISTS {table}{by} STORED AS AVRO "
        f"LOCATION {_text(location)} "
        f"TBLPROPERTIES ({_text(option[0])} = {_text(option[1])})"
    )


def create_avro_table(
    spark: SparkSession,
    table: str,
    location: str,
    avro_schema: dict | str,
    partition: str | None = None,
    partition_type: str = "string",
    replace: bool = False,
) -> None:
    """Declare an external Hive Avro table; the session needs Hive support."""
    ddl = avro_table_ddl(table, location, avro_schema, partition, partition_type)
    _prepare(spark, table, replace)
    spark.sql(ddl)


def declare_landing(
    spark: SparkSession,
    table: str,
    location: str,
    partition: str = "day",
    fmt: str = "avro",
    replace: bool = False,
    days: int | None = None,
) -> StructType:
    """Declare a landing table from the schema of its newest file.

    One step for files that another system writes under ``day=...`` folders:
    look up the schema, declare the table, register the days. Returns the
    schema. ``days`` looks for the file in so many of the last folders.
    """
    schema = newest_schema(spark, location, partition, fmt, days)
    create_table(spark, table, schema, location, partition, fmt=fmt, replace=replace)
    sync_partitions(spark, table)
    return schema


def table_schema(spark: SparkSession, table: str, partitions: bool = False) -> StructType:
    """Columns and types of a table, by default without its partition columns."""
    schema = spark.table(table).schema
    if partitions:
        return schema
    parts = partition_names(spark, table)
    return StructType([f for f in schema.fields if f.name.lower() not in parts])


def partition_names(spark: SparkSession, table: str) -> set[str]:
    """The partition columns of a table, in lower case."""
    return {c.name.lower() for c in spark.catalog.listColumns(table) if c.isPartition}


@contextmanager
def avro_file_extension(spark: SparkSession, extension: str = ".avro"):
    """Hive SerDe writes inside the body name their files with ``extension``."""
    with session_conf(spark, {"hive.output.file.extension": extension}):
        yield


def append_static(
    df: DataFrame,
    table: str,
    value: str,
    partition: str = "day",
    extension: str | None = None,
) -> None:
    """Append all rows of ``df`` to the one partition ``value``."""
    spark = df.sparkSession
    names = table_schema(spark, table).names
    rows = project_to_target(df, names)
    columns = ", ".join(map(quoted, names))
    statement = (
        f"INSERT INTO {table} PARTITION ({quoted(partition)} = {_text(value)}) "
        f"({columns}) SELECT {columns} FROM {{rows}}"
    )
    with named_files(spark, extension):
        spark.sql(statement, rows=rows)


def append_dynamic(
    df: DataFrame,
    table: str,
    partition: str = "day",
    value: str | None = None,
    extension: str | None = None,
    rebalance: bool = False,
) -> None:
    """Append ``df``, each row to the partition in its own column.

    With ``value`` all rows are stamped with it first. ``rebalance`` shuffles
    rows that spread over many days, so that a day gets few files; a day with
    much of the data is still split over several tasks.
    """
    spark = df.sparkSession
    if value is not None:
        df = partition_stamp(df, value, partition)
    rows = project_to_target(df, spark.table(table).columns)
    if rebalance:
        rows = rows.hint("rebalance", partition)
    settings = {"hive.exec.dynamic.partition.mode": "nonstrict"}
    with session_conf(spark, settings), named_files(spark, extension):
        rows.write.mode("append").insertInto(table)


def append_once(
    df: DataFrame, table: str, value: str, folder: str, partition: str = "day", fmt: str = "avro", extension: str | None = None
) -> int:
    """Append ``df`` to the partition ``value`` once, however often this is run
    with the same ``folder``; returns the rows that this run has appended.

    The folder belongs to the run. It gets the rows, then the names of the files
    that the partition has before the append, then a mark that all is there. A
    run that is repeated goes on from the last of these: rows that are complete
    are not computed again, files that a half-done append has left are removed
    first, and after the mark nothing is done. Nobody else may write to the
    partition until the run is through.
    """
    spark = df.sparkSession
    rows_at, before_at, landed_at = (f"{folder.rstrip('/')}/{part}" for part in ("rows", "before", "landed"))
    if path_exists(spark, landed_at):
        return 0
    if not path_exists(spark, rows_at):
        replace_files(df, rows_at, fmt)
    rows = spark.read.format(fmt).schema(df.schema).load(rows_at)
    place = _partition_location(spark, table, value, partition)
    if path_exists(spark, before_at):
        known = {row[0] for row in spark.read.parquet(before_at).collect()}
        for name in file_names(spark, place):
            if name not in known:
                delete_path(spark, f"{place}/{name}")
    else:
        names = spark.createDataFrame([(name,) for name in file_names(spark, place)], "file string")
        replace_files(names, before_at, "parquet")
    append_static(rows, table, value, partition, extension)
    replace_files(rows.agg(F.count(F.lit(1)).alias("rows")), landed_at, "parquet")
    return spark.read.parquet(landed_at).first()[0]


def _partition_location(spark: SparkSession, table: str, value: str, partition: str) -> str:
    """Where a partition lies or will lie."""
    spec = f"PARTITION ({quoted(partition)} = {_text(value)})"
    if spark.sql(f"SHOW PARTITIONS {table} {spec}").isEmpty():
        return f"{_location(spark, table).rstrip('/')}/{partition}={value}"
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table} {spec} AS JSON").first()[0]
    return json.loads(described)["location"].rstrip("/")


@contextmanager
def named_files(spark: SparkSession, extension: str | None):
    """:func:`avro_file_extension`, or nothing without an extension."""
    if extension is None:
        yield
    else:
        with avro_file_extension(spark, extension):
            yield


# Partitions that one statement adds to the catalog.
ADDED_AT_ONCE = 200


def partition_states(spark: SparkSession, table: str) -> DataFrame:
    """How the folders of a table with one partition column compare with its
    catalog: ``partition`` and ``state``, one of ``registered``, ``new`` (a folder
    that the catalog does not know) and ``gone`` (registered, without a folder).

    Only the table's own folder is listed, not the files below, so the cost is
    one entry for each day.
    """
    return spark.createDataFrame(_states(spark, table), "partition string, state string")


def _states(spark: SparkSession, table: str) -> list[tuple[str, str]]:
    names = [c.name for c in spark.catalog.listColumns(table) if c.isPartition]
    if len(names) != 1:
        raise ValueError(f"{table} has {len(names)} partition columns, not one")
    prefix = f"{names[0]}=".lower()
    listed = folder_names(spark, _location(spark, table))
    folders = {f"{names[0]}={name[len(prefix):]}" for name in listed if name.lower().startswith(prefix)}
    known = {row[0] for row in spark.sql(f"SHOW PARTITIONS {table}").collect()}
    states = [(known & folders, "registered"), (folders - known, "new"), (known - folders, "gone")]
    return sorted((name, state) for found, state in states for name in found)


def _location(spark: SparkSession, table: str) -> str:
    return json.loads(spark.sql(f"DESCRIBE TABLE EXTENDED {table} AS JSON").first()[0])["location"]


def sync_partitions(spark: SparkSession, table: str) -> DataFrame:
    """Register the partitions found on storage and list all of them.

    Needed for files that other systems landed. Appends made here register
    their partition themselves. Folders are compared with the catalog, and only
    new ones are added; a table with several partition columns is searched whole.
    A table whose folder does not exist yet has none.
    """
    if path_exists(spark, _location(spark, table)):
        if len(partition_names(spark, table)) == 1:
            new = [name for name, state in _states(spark, table) if state == "new"]
            for i in range(0, len(new), ADDED_AT_ONCE):
                specs = " ".join(f"PARTITION ({_spec(folder)})" for folder in new[i : i + ADDED_AT_ONCE])
                spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {specs}")
        else:
            spark.sql(f"MSCK REPAIR TABLE {table}")
    return spark.sql(f"SHOW PARTITIONS {table}")


# Fixed value: the folder of rows whose partition column is NULL.
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"


def _spec(folder: str) -> str:
    """A folder's name as a partition in SQL; names escape some characters."""
    name, value = folder.split("=", 1)
    return f"{quoted(name)} = {'null' if value == NULL_FOLDER else _text(unquote(value))}"


def null_partition_rows(df: DataFrame, partition: str = "day") -> DataFrame:
    """Rows that a write put into the partition for NULL days."""
    return df.where(named(partition).isNull())


def drop_partition(
    spark: SparkSession, table: str, value: Any, partition: str = "day"
) -> bool:
    """Remove a partition from the catalog and its files from storage.

    Dropping the partition of an external table alone would keep the files,
    and the next sync would bring them back. ``None`` is the NULL partition.
    Returns whether there was such a partition.
    """
    given = "null" if value is None else _text(str(value))
    spec = f"PARTITION ({quoted(partition)} = {given})"
    if spark.sql(f"SHOW PARTITIONS {table} {spec}").isEmpty():
        return False
    # As JSON, where no column can be taken for the location.
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table} {spec} AS JSON").first()[0]
    place = json.loads(described)["location"]
    spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {spec}")
    delete_path(spark, place)
    return True


def drop_null_partition(spark: SparkSession, table: str, partition: str = "day") -> bool:
    """Remove the partition that holds rows without a day."""
    return drop_partition(spark, table, None, partition)
