"""Text files as a source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def csv_scan(
    spark: SparkSession,
    path: str | list[str],
    header: bool = True,
    delimiter: str | None = None,
    null_value: str | None = None,
    quote: str | None = None,
    charset: str | None = None,
) -> DataFrame:
    """CSV files with every column as text; options left out keep Spark's default.

    Types come from the target later, so no pass over the data infers them.
    """
    options = {
        "sep": delimiter,
        "nullValue": null_value,
        "quote": quote,
        "encoding": charset,
    }
    given = {name: value for name, value in options.items() if value is not None}
    return spark.read.options(header=header, **given).csv(path)
