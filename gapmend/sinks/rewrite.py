"""Remove duplicates from a table by rewriting the partitions that hold them."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, SparkSession, functions as F

from gapmend.functions.columns import any_null, as_list, named, none_null
from gapmend.operators.duplicates import (
    copies_to_write,
    dedup_by_place,
    find_duplicates,
    number_copies,
    survivors,
)
from gapmend.operators.gaps import Keys
from gapmend.shared import Written, session_conf, write_shared
from gapmend.sinks.tables import drop_partition, named_files


@dataclass(frozen=True)
class RewriteReport:
    """What :func:`rewrite_duplicates` did."""

    removed_rows: int
    rewritten: tuple[Any, ...]
    dropped: tuple[Any, ...]


def cleaned_days(
    df: DataFrame,
    keys: list[str],
    days: Sequence[Any],
    order_by: Sequence[str],
    duplicates: Written,
    copies: DataFrame,
    day: str,
) -> DataFrame:
    """The rows that stay in ``days``, which must be all days with a row to go.

    ``copies`` counts the duplicated keys per day.
    """
    touched = df.where(_is_one_of(day, days))
    if not duplicates.fits_broadcast():
        # The first copy of all days stays, and every other is dropped.
        placed = dedup_by_place(df, touched, keys, [day, *order_by], duplicates)
        if placed is not None:
            return placed
    if duplicates.fits_broadcast():
        single = touched.join(duplicates.for_join(), keys, "left_anti")
        single = single.select(*map(named, df.columns))
        others = touched.join(duplicates.for_join(), keys, "left_semi")
    else:
        single = touched.where(any_null(keys))
        others = touched.where(none_null(keys))
    # The lowest copy in the days at hand is the one that stays, unless the
    # key has a copy on an earlier day, which then loses no row.
    lowest = survivors(others, keys, [day, *order_by])
    first_day = copies.groupBy(*map(named, keys)).agg(
        F.min(F.struct(named(day))).alias("_first")
    )
    first = F.col("_first")
    kept = (
        lowest.join(first_day, keys, "left")
        .where(first.isNull() | named(day).eqNullSafe(first.getField(day)))
        .select(*map(named, df.columns))
    )
    return single.unionByName(kept)


def _is_one_of(day: str, days: Sequence[Any]):
    known = [d for d in days if d is not None]
    chosen = named(day).isin(known)
    return chosen | named(day).isNull() if len(known) < len(days) else chosen


def rewrite_duplicates(
    spark: SparkSession,
    table: str,
    keys: Keys,
    order_by: Sequence[str],
    day: str = "day",
    extension: str | None = None,
) -> RewriteReport:
    """Keep the first copy of each key by day, then ``order_by``.

    Days that lose no row are neither read in full nor written. The cleaned
    days are first written to the shared folder and then replace the old ones;
    a day left without a row is dropped with its files. A run that dies can be
    repeated; nobody else may write to these days meanwhile. Should it die while Spark moves the days into place, the cleaned
    rows are still in the shared folder, under ``cleaned-days-...``.
    """
    keys = as_list(keys)
    df = spark.table(table)
    done: list[Written] = []

    def kept_for_now(written: Written) -> Written:
        done.append(written)
        return written

    try:
        duplicates = kept_for_now(find_duplicates(df, keys))
        with copies_to_write(df, keys, [day], duplicates) as counted:
            copies = kept_for_now(write_shared(counted, "copies-by-day", narrow=True))
        extra = number_copies(copies.frame, keys, day)
        # One row per day that has to change: as many as the table has partitions.
        per_day = extra.groupBy(named(day)).agg(F.sum("extra_rows").alias("n")).collect()
        if not per_day:
            return RewriteReport(0, (), ())
        days = [row[0] for row in per_day]
        kept = cleaned_days(df, keys, days, order_by, duplicates, copies.frame, day)
        cleaned = write_shared(kept, "cleaned-days")
        left = {row[0] for row in cleaned.frame.select(named(day)).distinct().collect()}
        settings = {
            "spark.sql.sources.partitionOverwriteMode": "dynamic",
            "hive.exec.dynamic.partition.mode": "nonstrict",
        }
        with session_conf(spark, settings), named_files(spark, extension):
            # REBALANCE gathers a day into few files and splits a day that holds
            # much of the data over several tasks.
            rows = cleaned.frame.hint("rebalance", day).select(*map(named, df.columns))
            rows.write.insertInto(table, overwrite=True)
        dropped = tuple(d for d in days if d not in left)
        for value in dropped:
            drop_partition(spark, table, value, day)
        spark.catalog.refreshTable(table)
        # Only now: should the move into place fail, these rows are the copy.
        done.append(cleaned)
    finally:
        for written in done:
            written.drop()
    return RewriteReport(
        removed_rows=sum(row.n for row in per_day),
        rewritten=tuple(d for d in days if d in left),
        dropped=dropped,
    )
