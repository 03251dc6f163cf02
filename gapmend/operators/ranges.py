"""Key ranges of a source."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DateType, NumericType, StringType

from gapmend.functions.columns import named
from gapmend.shared import narrow_scan


def exact_bounds(df: DataFrame, key: str) -> bool:
    """Whether values of ``key`` can go to the driver and back as plain values.

    Times cannot: the driver may live in another time zone than the session.
    """
    kind = df.select(named(key)).schema[0].dataType
    return isinstance(kind, (NumericType, StringType, DateType))


def key_range(df: DataFrame, key: str) -> DataFrame:
    """Lowest and highest key, as one row ``initrange, endrange``."""
    return df.agg(
        F.min(named(key)).alias("initrange"), F.max(named(key)).alias("endrange")
    )


def in_range(df: DataFrame, key: str, low: Any, high: Any) -> DataFrame:
    """Rows with ``low <= key <= high``; a bound of ``None`` is left open.

    Give plain values: they reach the scan as pushed filters, in files as
    well as over JDBC. Spark does not push scalar subqueries that far.
    """
    if low is not None:
        df = df.where(named(key) >= low)
    if high is not None:
        df = df.where(named(key) <= high)
    return df


def resolve_range(
    df: DataFrame, key: str, low: Any = None, high: Any = None
) -> tuple[Any, Any]:
    """Fill in the bounds that were not given from the source itself.

    An empty source yields ``(None, None)`` for bounds that were not given.
    """
    if low is None or high is None:
        with narrow_scan(df.sparkSession):
            probe = key_range(in_range(df, key, low, high), key).first()
        low = probe.initrange if low is None else low
        high = probe.endrange if high is None else high
    return low, high
