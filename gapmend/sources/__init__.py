from gapmend.sources.avro_schema import avro_to_struct, latest_avro_schema, newest_file, newest_schema
from gapmend.sources.files import csv_scan
from gapmend.sources.jdbc import (
    database_source,
    jdbc_balanced_scan,
    jdbc_key_range,
    jdbc_options,
    jdbc_range_scan,
    key_cuts,
    range_predicates,
)
from gapmend.sources.registry import read_source, table_scan

__all__ = [
    "avro_to_struct",
    "csv_scan",
    "database_source",
    "jdbc_balanced_scan",
    "jdbc_key_range",
    "jdbc_options",
    "jdbc_range_scan",
    "key_cuts",
    "latest_avro_schema",
    "newest_file",
    "newest_schema",
    "range_predicates",
    "read_source",
    "table_scan",
]
