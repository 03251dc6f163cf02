"""Tables of a database as a source, read by key range.

Stride bounds only decide how Spark splits a read. They never drop rows: the
first and the last split are open, and NULL keys go with the first. The range
itself is a filter that Spark sends to the database with every split.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession, functions as F

from gapmend.functions.columns import named
from gapmend.functions.stamps import change_envelope
from gapmend.operators.ranges import in_range

# Rows per round trip and parallel reads.
FETCH_SIZE = 20_000
RANGE_FETCH_SIZE = 50_000
NUM_PARTITIONS = 40


def jdbc_options(
    url: str,
    table: str,
    partition_column: str | None = None,
    low: Any = None,
    high: Any = None,
    num_partitions: int = NUM_PARTITIONS,
    fetch_size: int = FETCH_SIZE,
    **connection: str,
) -> dict[str, str]:
    """Reader options; ``connection`` holds user, password, driver and the like.

    ``table`` is a table name or a sub-query with its alias. Strides need
    both bounds, without them the read is a single task.
    """
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_size), **connection}
    if partition_column is not None and low is not None and high is not None:
        options.update(
            partitionColumn=partition_column,
            lowerBound=str(low),
            upperBound=str(high),
            numPartitions=str(num_partitions),
        )
    return options


def jdbc_key_range(
    spark: SparkSession,
    url: str,
    table: str,
    key: str,
    low: Any = None,
    high: Any = None,
    **connection: str,
) -> DataFrame:
    """Lowest and highest key as one row; the database computes both at once."""
    probe = key_range_query(table, key, low, high)
    return spark.read.format("jdbc").options(**jdbc_options(url, probe, **connection)).load()


def key_range_query(table: str, key: str, low: Any = None, high: Any = None) -> str:
    """The probe as a sub-query with an alias, usable in place of a table."""
    bounds = []
    if low is not None:
        bounds.append(f"{key} >= {low}")
    if high is not None:
        bounds.append(f"{key} <= {high}")
    where = f" WHERE {' AND '.join(bounds)}" if bounds else ""
    return (
        f"(SELECT MIN({key}) AS initrange, MAX({key}) AS endrange"
        f" FROM {table}{where}) key_range"
    )


def jdbc_range_scan(
    spark: SparkSession,
    url: str,
    table: str,
    key: str,
    low: Any = None,
    high: Any = None,
    num_partitions: int = NUM_PARTITIONS,
    fetch_size: int = RANGE_FETCH_SIZE,
    **connection: str,
) -> DataFrame:
    """Rows with ``low <= key <= high``, read in even strides of the key."""
    options = jdbc_options(
        url, table, key, low, high, num_partitions, fetch_size, **connection
    )
    return in_range(spark.read.format("jdbc").options(**options).load(), key, low, high)


def key_cuts(df: DataFrame, key: str, splits: int) -> list[Any]:
    """At most ``splits - 1`` keys that cut ``df`` into parts of like size.

    For keys with gaps or clusters, where even strides would leave most rows
    to a few tasks. Approximate in where it cuts, which moves no row out of
    the result. The list is as long as the number of splits asked for.
    """
    shares = [i / splits for i in range(1, splits)]
    if not shares:
        return []
    cuts = df.agg(F.percentile_approx(named(key), shares, 10_000).alias("cuts")).first()
    return sorted(set(cuts.cuts or []))


def range_predicates(key: str, cuts: Sequence[Any]) -> list[str]:
    """One predicate per split: together they hold every row exactly once."""
    if not cuts:
        return ["1 = 1"]
    inner = [f"{key} >= {a} AND {key} < {b}" for a, b in zip(cuts, cuts[1:])]
    return [f"{key} < {cuts[0]} OR {key} IS NULL", *inner, f"{key} >= {cuts[-1]}"]


def jdbc_balanced_scan(
    spark: SparkSession,
    url: str,
    table: str,
    key: str,
    cuts: Sequence[Any],
    low: Any = None,
    high: Any = None,
    fetch_size: int = RANGE_FETCH_SIZE,
    **connection: str,
) -> DataFrame:
    """Like :func:`jdbc_range_scan`, split at the given keys (:func:`key_cuts`)."""
    properties = {"fetchsize": str(fetch_size), **connection}
    rows = spark.read.jdbc(
        url, table, predicates=range_predicates(key, cuts), properties=properties
    )
    return in_range(rows, key, low, high)


def database_source(
    spark: SparkSession,
    url: str,
    schema: str,
    table: str,
    primary_key: str,
    init_range: int | None = None,
    end_range: int | None = None,
    num_partition: int = NUM_PARTITIONS,
    run_ts: str | None = None,
    balanced: bool = False,
    **connection: str,
) -> DataFrame:
    """A key range of a database table as change records.

    A bound that is not given is asked from the database. An empty table or
    range gives an empty frame, whatever arrives after the probe. Where most keys crowd into a part of the range,
    ``balanced`` reads the keys first and splits the rows evenly.
    """
    name = f"{schema}.{table}"
    if init_range is None or end_range is None:
        probe = jdbc_key_range(
            spark, url, name, primary_key, init_range, end_range, **connection
        ).first()
        # By position: databases differ in how they fold the names.
        init_range = _whole(probe[0]) if init_range is None else init_range
        end_range = _whole(probe[1]) if end_range is None else end_range
        if probe[0] is None:
            nothing = f"(SELECT * FROM {name} WHERE 1 = 0) nothing"
            rows = jdbc_range_scan(spark, url, nothing, primary_key, num_partitions=1, **connection)
            return change_envelope(rows, name, run_ts)
    rows = jdbc_range_scan(
        spark, url, name, primary_key, init_range, end_range, num_partition, **connection
    )
    if balanced:
        cuts = key_cuts(rows.select(named(primary_key)), primary_key, num_partition)
        rows = jdbc_balanced_scan(
            spark, url, name, primary_key, cuts, init_range, end_range, **connection
        )
    return change_envelope(rows, name, run_ts)


def _whole(bound: Any) -> int | None:
    return None if bound is None else int(bound)
