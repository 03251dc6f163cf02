"""The schema that a landing table is written with today."""

from __future__ import annotations

import json

from pyspark.sql import SparkSession, functions as F
from pyspark.sql.types import StructType


def newest_file(
    spark: SparkSession, location: str, day: str = "day", ending: str = "", days: int | None = None
) -> str:
    """The file under ``day=...`` folders that was changed last, by name among
    files of one time.

    Spark lists the folders, in a job of its own where they are many, and takes
    the newest file by an aggregate; no file is opened. ``days`` looks at so many
    of the last folders by name; ``ending`` leaves out other files. Hidden and
    empty files never count.
    """
    jvm = spark._jvm
    base = jvm.org.apache.hadoop.fs.Path(location)
    fs = base.getFileSystem(spark._jsc.hadoopConfiguration())
    folders = [f.getPath() for f in fs.listStatus(base) if f.isDirectory()]
    folders = sorted((f for f in folders if f.getName().startswith(f"{day}=")), key=lambda f: f.getName(), reverse=True)
    newest = None
    if folders:
        listed = spark.read.format("binaryFile").options(recursiveFileLookup=True, pathGlobFilter=f"*{ending}")
        files = listed.load([f.toString() for f in folders[:days]])
        newest = files.agg(F.max_by("path", F.struct("modificationTime", "path"))).first()[0]
    if newest is None:
        raise FileNotFoundError(f"no file under {location}/{day}=...")
    return newest


def latest_avro_schema(
    spark: SparkSession, location: str, day: str = "day", days: int | None = None
) -> dict:
    """The writer schema in the newest Avro file of a day-partitioned folder."""
    return avro_file_schema(spark, newest_file(spark, location, day, days=days))


def newest_schema(
    spark: SparkSession, location: str, day: str = "day", fmt: str = "avro", days: int | None = None
) -> StructType:
    """The Spark schema of the newest file, without the day; of the last ``days``
    folders alone, if given."""
    if fmt == "avro":
        return avro_to_struct(spark, latest_avro_schema(spark, location, day, days))
    return spark.read.format(fmt).load(newest_file(spark, location, day, days=days)).schema


def avro_file_schema(spark: SparkSession, path: str) -> dict:
    """The writer schema of one Avro file; reads its header only."""
    jvm = spark._jvm
    stream = jvm.org.apache.avro.mapred.FsInput(
        jvm.org.apache.hadoop.fs.Path(path), spark._jsc.hadoopConfiguration()
    )
    reader = jvm.org.apache.avro.file.DataFileReader.openReader(
        stream, jvm.org.apache.avro.generic.GenericDatumReader()
    )
    try:
        return json.loads(reader.getSchema().toString())
    finally:
        reader.close()


def avro_to_struct(spark: SparkSession, avro_schema: dict) -> StructType:
    """The Spark type of an Avro record schema."""
    jvm = spark._jvm
    parsed = jvm.org.apache.avro.Schema.Parser().parse(json.dumps(avro_schema))
    converted = jvm.org.apache.spark.sql.avro.SchemaConverters.toSqlType(parsed)
    return StructType.fromJson(json.loads(converted.dataType().json()))
