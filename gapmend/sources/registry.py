"""Sources by name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gapmend.sources.files import csv_scan
from gapmend.sources.jdbc import database_source


def table_scan(spark: SparkSession, name: str) -> DataFrame:
    """A table of the catalog."""
    return spark.table(name)


READERS = {"database": database_source, "csv": csv_scan, "table": table_scan}


def read_source(spark: SparkSession, kind: str, **options) -> DataFrame:
    """Read a source of the given kind: ``database``, ``csv`` or ``table``."""
    if kind not in READERS:
        raise ValueError(f"unknown source {kind!r}, use one of: {', '.join(READERS)}")
    return READERS[kind](spark, **options)
