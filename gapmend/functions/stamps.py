"""Columns that a run adds to its rows: change envelope, day, file."""

from __future__ import annotations

from datetime import datetime
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame, functions as F

# The change record carries the text 'null', not a NULL, in the
# fields that a batch extract cannot know; days are counted in this time zone.
UNKNOWN = "null"
RUN_TS_FORMAT = "yyyy-MM-dd HH:mm:ss"
BUSINESS_ZONE = "America/Sao_Paulo"


def change_envelope(df: DataFrame, table: str, run_ts: str | Column | None = None) -> DataFrame:
    """Put the five change-record columns in front of the columns of ``df``.

    ``run_ts`` fixes the extraction time so that a run can be repeated; by
    default it is the time of the query.
    """
    if run_ts is None:
        run_ts = F.date_format(F.current_timestamp(), RUN_TS_FORMAT)
    elif isinstance(run_ts, str):
        run_ts = F.lit(run_ts)
    return df.select(
        F.lit(table).alias("table"),
        F.lit(UNKNOWN).alias("op_type"),
        F.lit(UNKNOWN).alias("op_ts"),
        run_ts.alias("current_ts"),
        F.lit(UNKNOWN).alias("pos"),
        "*",
    )


def partition_stamp(df: DataFrame, value: str | Column, column: str = "day") -> DataFrame:
    """Put every row into the partition ``value``."""
    return df.withColumn(column, value if isinstance(value, Column) else F.lit(value))


def business_day(ts: Column, zone: str = BUSINESS_ZONE, from_zone: str | None = "UTC") -> Column:
    """The calendar day of ``ts`` in ``zone``, as ``yyyy-MM-dd`` text.

    ``ts`` is wall-clock time in ``from_zone``. Pass ``from_zone=None`` for an
    instant (Spark ``timestamp``), which reads in the session's time zone.
    """
    source = F.current_timezone() if from_zone is None else F.lit(from_zone)
    local = F.convert_timezone(source, F.lit(zone), ts.cast("timestamp_ntz"))
    return local.cast("date").cast("string")


def run_day(zone: str = BUSINESS_ZONE, now: datetime | None = None) -> str:
    """Today in ``zone``; taken once, so a run past midnight keeps its day."""
    now = now or datetime.now(tz=ZoneInfo("UTC"))
    return now.astimezone(ZoneInfo(zone)).strftime("%Y-%m-%d")


def file_name(df: DataFrame, column: str = "filename") -> DataFrame:
    """Add the file that each row was read from.

    File sources carry it as metadata, which also survives shuffles in the
    same query. A table read directly through a SerDe has no metadata column,
    there the file of the running task is used. Other frames, such as joins and
    aggregates, have lost the file and are refused.
    """
    plan = df._jdf.queryExecution().analyzed()
    if any(a.name() == "_metadata" for a in _items(plan.metadataOutput())):
        return df.withColumn(column, F.col("_metadata.file_path"))
    while plan.getClass().getSimpleName() in ("Project", "Filter", "SubqueryAlias", "View"):
        plan = plan.children().head()
    if plan.getClass().getSimpleName() != "HiveTableRelation":
        raise ValueError("the files of these rows are not known; ask before joins and aggregates")
    return df.withColumn(column, F.input_file_name())


def _items(seq) -> list:
    return [seq.apply(i) for i in range(seq.length())]


def split_path(path: Column) -> Column:
    """Object-store address as a struct of ``scheme``, ``bucket`` and ``key``."""
    pattern = r"^([a-z0-9]+):(?://([^/]*))?/(.+)$"
    return F.struct(
        F.regexp_extract(path, pattern, 1).alias("scheme"),
        F.regexp_extract(path, pattern, 2).alias("bucket"),
        F.regexp_extract(path, pattern, 3).alias("key"),
    )
