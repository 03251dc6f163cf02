"""Joins of wide rows with one row per key, safe for hot keys."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, functions as F

from gapmend.functions.columns import named, none_null
from gapmend.shared import Written, session_conf, write_shared

# A key with more rows than this is hot, whatever the size of the table. Only if
# more than MAX_HOT_KEYS are, a key must also hold more than one part in
# MAX_HOT_KEYS of all rows, so that fewer than that are left.
HOT_ROWS = 1_000_000
MAX_HOT_KEYS = 10_000


# Size limit in bits of the filter that runtime_filter allows (32 MB).
MAX_FILTER_BITS = 2**28


@contextmanager
def runtime_filter(right: Written):
    """Let Spark drop left rows without a match before a shuffled join.

    Spark can build a Bloom filter of the right keys and apply it in the scan
    of the left side, but expects far fewer keys by default. Inside the body
    its limits fit ``right``. It also wants a comparison on the right side, a
    range of the key will do.
    """
    bits = min(max(8 * right.rows, 2**23), MAX_FILTER_BITS)
    prefix = "spark.sql.optimizer.runtime.bloomFilter"
    limits = {
        f"{prefix}.creationSideThreshold": max(right.memory or 0, 10 * 2**20),
        f"{prefix}.expectedNumItems": max(right.rows, 1),
        f"{prefix}.maxNumItems": max(right.rows, 4_000_000),
        f"{prefix}.numBits": bits,
        f"{prefix}.maxNumBits": max(bits, 2**26),
    }
    settings = {name: str(value) for name, value in limits.items()}
    with session_conf(right.frame.sparkSession, settings):
        yield


@contextmanager
def row_filter(right: Written):
    """:func:`runtime_filter` for scans of any size, by the first column of a join,
    where ``right`` is not broadcast."""
    if right.fits_broadcast():
        yield
        return
    settings = {
        "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0",
        "spark.sql.optimizer.runtimeFilter.number.threshold": "1",
    }
    with runtime_filter(right), session_conf(right.frame.sparkSession, settings):
        yield


@contextmanager
def hot_keys(df: DataFrame, keys: list[str]):
    """The keys that hold many rows of ``df``, ``None`` if there are none.

    They come to the driver, since there are few of them, and nothing stays in
    the shared folder.
    """
    spark = df.sparkSession
    counted = (
        df.where(none_null(keys))
        .groupBy(*map(named, keys))
        .agg(F.count(F.lit(1)).alias("_rows"))
    )
    seen = Observation()
    counted = counted.observe(seen, F.sum("_rows").alias("total"))
    hot = write_shared(counted.where(F.col("_rows") > HOT_ROWS), "hot-keys", narrow=True)
    try:
        if hot.rows == 0:
            yield None
            return
        found = hot.frame
        if hot.rows > MAX_HOT_KEYS:
            found = found.where(F.col("_rows") > F.lit(seen.get["total"]) / MAX_HOT_KEYS)
        rows = found.select(*map(named, keys))
        yield spark.createDataFrame(rows.collect(), rows.schema)
    finally:
        hot.drop()


def join_unique(
    left: DataFrame,
    right: DataFrame | Written,
    keys: list[str],
    how: str,
    most_rows: int | None = None,
) -> DataFrame:
    """Inner, semi or anti join of ``left`` with a side that has unique keys.

    A written right side that was measured to be small is broadcast. Else both
    sides are shuffled, except for the rows of hot keys: those stay where they
    are and get their few right rows by broadcast. The hot keys come from a
    count of the left keys and are limited in number by what makes them hot.
    The count is left out where ``most_rows``, the left rows of the most
    frequent key, is known and small.
    """
    if isinstance(right, Written):
        if right.fits_broadcast():
            return left.join(F.broadcast(right.frame), keys, how)
        right = right.frame.hint("merge")
    if most_rows is not None and most_rows <= HOT_ROWS:
        return left.join(right, keys, how)
    with hot_keys(left, keys) as hot:
        if hot is None:
            return left.join(right, keys, how)
        hot = F.broadcast(hot)
        usual = left.join(hot, keys, "left_anti").join(right, keys, how)
        few = F.broadcast(right.join(hot, keys, "left_semi"))
        return usual.unionByName(left.join(hot, keys, "left_semi").join(few, keys, how))
