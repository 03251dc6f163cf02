"""The two jobs: repair a day-partitioned table, load the history of a source."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, replace
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import DataType, DecimalType, FractionalType, IntegralType

from gapmend.functions.columns import as_list, named, none_null
from gapmend.functions.conform import (
    FILLABLE,
    conform,
    conform_with_rejects,
    project_to_target,
    rejects,
    widen_decimals,
)
from gapmend.functions.stamps import run_day
from gapmend.operators.gaps import (
    Keys,
    compare_keys,
    count_keys,
    coverage_metrics,
    is_missing,
    narrowed,
)
from gapmend.operators.joins import join_unique, runtime_filter
from gapmend.operators.ranges import exact_bounds, in_range
from gapmend.shared import (
    Written,
    is_under,
    path_exists,
    read_paths,
    session_conf,
    write_shared,
)
from gapmend.sinks.files import replace_files, stage, write_files
from gapmend.sinks.tables import (
    append_dynamic,
    append_once,
    append_static,
    drop_null_partition,
    null_partition_rows,
    partition_names,
    sync_partitions,
    table_schema,
)

MODES = ("exact", "range", "full")

# Up to this many missing keys are named one by one to the source, which is as
# long as a list may be in most databases.
LOOKUP_KEYS = 1_000


@dataclass(frozen=True)
class RepairReport:
    """How the target covered the source, and how many rows were appended.

    ``max_source_rows`` belongs to the key that the source repeats most;
    ``undated_rows`` are the target's rows without a day; ``rejected_rows`` those
    with a failed cast, where ``rejects_path`` asked for them.
    """

    status: str
    source_rows: int = 0
    matched_rows: int = 0
    missing_rows: int = 0
    missing_keys: int = 0
    duplicated_keys: int = 0
    null_keys: int = 0
    max_source_rows: int = 0
    min_missing: Any = None
    max_missing: Any = None
    appended_rows: int = 0
    undated_rows: int = 0
    rejected_rows: int = 0


class RepairMismatch(RuntimeError):
    """An exact repair appended other rows than were missing."""


def _status(source_rows: int, matched_rows: int) -> str:
    if matched_rows == source_rows:
        return "present"
    return "duplicated" if matched_rows > source_rows else "missing"


@dataclass(frozen=True)
class _Source:
    """The source as it was read, and how it becomes rows of the target."""

    raw: DataFrame
    shape: Callable[[DataFrame], DataFrame]

    def rows(self) -> DataFrame:
        return self.shape(self.raw)

    def where(self, key: str, keep: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """Rows that pass a filter on ``key``, applied before any cast if that
        is the same, because a filter on a cast does not reach the scan.

        It is the same between equal types and between whole numbers. Other
        casts change the order (text) or make keys equal (floating point).
        """
        rows = self.rows()
        before, after = _type_of(self.raw, key), _type_of(rows, key)
        if before == after or (_is_whole(before) and _is_whole(after)):
            return self.shape(keep(self.raw))
        return keep(rows)

    def within(self, key: str, low: Any, high: Any) -> DataFrame:
        low, high = self._typed(key, [low, high])
        return self.where(key, lambda df: in_range(df, key, low, high))

    def lookup(self, key: str, values: list[Any]) -> DataFrame:
        values = self._typed(key, values)
        return self.where(key, lambda df: df.where(named(key).isin(values)))

    def _typed(self, key: str, values: list[Any]) -> list[Any]:
        """Values of a floating-point key in its own type: next to a ``double``
        Spark would skip the rounding of a key that is cast to ``float``."""
        kind = _type_of(self.rows(), key)
        if not isinstance(kind, FractionalType) or isinstance(kind, DecimalType):
            return values
        return [None if v is None else F.lit(v).cast(kind) for v in values]


# Spark takes a comparison on a whole number that is cast to floating point for
# one on the number itself, although the cast makes large numbers equal.
CAST_RULE = "org.apache.spark.sql.catalyst.optimizer.UnwrapCastInBinaryComparison"


@contextmanager
def _casts_as_written(read: _Source, key: str | None):
    """Compare a key that is cast to floating point after the cast."""
    spark = read.raw.sparkSession
    name = "spark.sql.optimizer.excludedRules"
    rows = read.rows()
    if key is None or not isinstance(_type_of(rows, key), FractionalType) or _type_of(read.raw, key) == _type_of(rows, key):
        yield
        return
    rules = [r for r in (spark.conf.get(name, None) or "").split(",") if r]
    with session_conf(spark, {name: ",".join([*rules, CAST_RULE])}):
        yield


def _type_of(df: DataFrame, column: str) -> DataType:
    return df.select(named(column)).schema[0].dataType


def _is_whole(data_type: DataType) -> bool:
    if isinstance(data_type, DecimalType):
        return data_type.scale == 0
    return isinstance(data_type, IntegralType)


def validate(
    source: DataFrame, target: DataFrame, keys: Keys
) -> tuple[RepairReport, Written]:
    """Coverage figures and the written missing keys.

    One job counts the source keys and writes the counts, which say how far
    the scan of the target can be narrowed. The next compares them with the
    target; the figures are observed on the rows that it filters and writes.
    So each side is read once, keys only.
    """
    keys = as_list(keys)
    counts = count_keys(source, keys)
    try:
        seen = Observation()
        most = F.max(F.when(none_null(keys), F.col("source_rows")))
        counted = compare_keys(counts.frame, narrowed(target, counts, keys), keys).observe(
            seen,
            *coverage_metrics(keys),
            F.coalesce(most, F.lit(0)).alias("max_source_rows"),
        )
        missing = counted.where(is_missing(keys)).select(*map(named, keys))
        written = write_shared(missing, "missing-keys", narrow=True)
    finally:
        counts.drop()
    figures = seen.get
    figures["matched_rows"] = int(figures["matched_rows"])
    status = _status(figures["source_rows"], figures["matched_rows"])
    return RepairReport(status=status, **figures), written


# Holds what casts have lost, beside the columns of the table.
REJECTED = "gapmend_rejected"


def _write_rejects(rows: DataFrame, path: str, fmt: str) -> tuple[Written, int]:
    """Write ``rows`` once, then the values they lost to ``path``.

    The second write reads the column of lost values alone. Gives the written
    rows, still with that column, and how many have lost something.
    """
    seen = Observation()
    lost = F.count(named(REJECTED)).alias("n")
    written = write_shared(rows.observe(seen, lost), "checked-rows")
    try:
        write_files(rejects(written.frame, REJECTED), path, fmt, "error")
    except BaseException:
        written.drop()
        raise
    return written, seen.get["n"]


def _lost_key(keys: list[str]) -> Column:
    names = [key.lower() for key in keys]
    lost = F.exists(named(REJECTED)["casts"], lambda cast: F.lower(cast["column"]).isin(names))
    return F.coalesce(lost, F.lit(False))


def _check_rejects(spark: SparkSession, path: str | None, on_error: str) -> None:
    if path is None:
        return
    if on_error != "null":
        raise ValueError("casts that fail are an error unless on_error is 'null'")
    if path_exists(spark, path):
        raise ValueError(f"{path} exists; rejects need a path of their own for each run")


def _lacking(
    read: _Source, keys: list[str], report: RepairReport, missing: Written, mode: str
) -> DataFrame:
    """The rows that an exact or range repair appends."""
    single = keys[0] if len(keys) == 1 else None
    if single is None or (mode == "exact" and not exact_bounds(missing.frame, single)):
        rows = read.rows()
    elif mode == "exact" and missing.rows <= LOOKUP_KEYS:
        rows = read.lookup(single, [row[0] for row in missing.frame.collect()])
        return rows.hint("rebalance")
    else:
        span = report.min_missing, report.max_missing
        rows = read.within(single, *span)
        missing = replace(missing, frame=in_range(missing.frame, single, *span))
    if mode == "range":
        return rows
    # Few rows from many tasks: REBALANCE gathers them into few files.
    chosen = join_unique(rows, missing, keys, "left_semi", report.max_source_rows)
    return chosen.select(*map(named, rows.columns)).hint("rebalance")


def repair(
    source: DataFrame,
    table: str,
    keys: Keys,
    mode: str = "exact",
    day: str | None = None,
    day_column: str = "day",
    key_range: tuple[Any, Any] | None = None,
    staging_path: str | None = None,
    staging_format: str = "avro",
    extension: str | None = None,
    fillable: Sequence[str] = FILLABLE,
    on_error: str = "fail",
    sync: bool = True,
    drop_undated: bool = False,
    run_id: str | None = None,
    parse_once: bool = False,
    rejects_path: str | None = None,
    rejects_format: str = "parquet",
) -> RepairReport:
    """Append rows of ``source`` to the partition ``day`` of ``table``.

    ``exact`` appends the rows whose key is missing and can be repeated at
    will, one run at a time; it raises if the appended rows are not as many as
    were missing, as when the source changes meanwhile. ``range`` appends
    everything from the lowest to the highest missing key, also what is there
    already. ``full`` appends everything without a look at the target. Rows
    with a NULL key are counted, and appended by ``full`` only.

    ``day`` defaults to today, fixed once per run. ``key_range`` limits source
    and target to an inclusive range of a single key. The source is read twice,
    its keys and then the rows to append, the target once.

    With ``sync`` the days that other systems have landed are registered
    first, since what is in them counts as missing otherwise. The report has
    the number of rows without a day; ``drop_undated`` removes them with their
    files at the end.

    The source is brought to the columns and types of the table first; it is
    an error if it lacks any that are not ``fillable``. With ``staging_path``
    the rows are written there before they are appended. ``extension`` ends
    the names of files that are written through a Hive SerDe.

    A ``full`` repair with a ``run_id`` can be repeated too: its staged rows and
    what it has landed are kept under that name in ``staging_path``, and a run of
    the same name goes on where the last one ended.

    ``parse_once`` is for sources that cannot be pruned, such as text: their rows
    are written once in the types of the table, sorted by key, so that both reads
    are of columns, and the second skips what is out of range.

    With ``on_error="null"`` a ``rejects_path`` that does not exist yet gets a row
    for each value that a cast has lost: column, value, both types, and the source
    row (:func:`~gapmend.functions.conform.rejects`). They are those of the rows to
    append, which are written once and both appended and judged from there, and of
    rows whose key was lost, which only ``full`` appends; finding the latter takes
    one more read of the source, and only if there are NULL keys. A ``key_range``
    leaves rows without a key out.
    """
    if mode not in MODES:
        raise ValueError(f"mode is one of {', '.join(MODES)}, not {mode!r}")
    keys = as_list(keys)
    if run_id is not None and (mode != "full" or staging_path is None):
        raise ValueError("a run_id is for a full repair with a staging_path")
    if mode == "range" and len(keys) != 1:
        raise ValueError("range repair needs exactly one key column")

    spark = source.sparkSession
    _check_rejects(spark, rejects_path, on_error)
    if rejects_path is not None and run_id is not None:
        raise ValueError("a run that goes on does not read its rows again, so it has no rejects")
    by_day = day_column.lower() in partition_names(spark, table)
    if sync and by_day:
        sync_partitions(spark, table)
        spark.catalog.refreshTable(table)
    wanted = table_schema(spark, table)

    def shape(df: DataFrame) -> DataFrame:
        if rejects_path is None:
            return project_to_target(conform(df, wanted, fillable, on_error), wanted)
        checked = conform_with_rejects(df, wanted, fillable, REJECTED)
        return project_to_target(checked, [*wanted.names, REJECTED])

    read, parsed = _Source(source, shape), None
    if parse_once:
        parsed = write_shared(shape(source).sortWithinPartitions(*map(named, keys)), "parsed-source")
        read = _Source(parsed.frame, lambda df: df)
    today = day or run_day()
    single = keys[0] if len(keys) == 1 else None
    if key_range is None:
        rows = read.rows()
    elif single is None:
        raise ValueError("a key range needs exactly one key column")
    else:
        rows = read.within(single, *key_range)

    rejected = 0

    def append(rows: DataFrame) -> int:
        nonlocal rejected
        if rejects_path is None:
            return land(rows)
        written, rejected = _write_rejects(rows, rejects_path, rejects_format)
        try:
            keyed = F.lit(True) if mode == "full" else none_null(keys)
            return land(written.frame.where(keyed).drop(REJECTED))
        finally:
            written.drop()

    def land(rows: DataFrame) -> int:
        if run_id is not None:
            folder = f"{staging_path.rstrip('/')}/{run_id}"
            return append_once(rows, table, today, folder, day_column, staging_format, extension)
        written = Observation()
        rows = rows.observe(written, F.count(F.lit(1)).alias("n"))
        if staging_path is None:
            append_dynamic(rows, table, day_column, today, extension)
        else:
            staged = stage(rows, staging_path, staging_format)
            append_static(staged, table, today, day_column, extension)
        return written.get["n"]

    undated = 0
    if by_day:
        undated = null_partition_rows(spark.table(table), day_column).count()

    def done(report: RepairReport) -> RepairReport:
        if drop_undated and undated:
            drop_null_partition(spark, table, day_column)
        return replace(report, undated_rows=undated, rejected_rows=rejected)

    missing = None
    try:
        if mode == "full":
            return done(RepairReport(status="full", appended_rows=append(rows)))
        target = spark.table(table)
        if key_range is not None:
            target = in_range(target, single, *key_range)
        with _casts_as_written(read, single):
            report, missing = validate(rows, target, keys)
        if report.missing_rows or rejects_path is not None:
            if report.missing_rows:
                lacking = _lacking(read, keys, report, missing, mode)
            else:
                lacking = read.rows().limit(0)
            if rejects_path is not None and key_range is None and report.null_keys:
                lacking = lacking.unionByName(read.rows().where(_lost_key(keys)))
            with runtime_filter(missing), _casts_as_written(read, single):
                report = replace(report, appended_rows=append(lacking))
        if mode == "exact" and report.appended_rows != report.missing_rows:
            raise RepairMismatch(
                f"{report.missing_rows} rows were missing in {table}, {report.appended_rows} were appended"
            )
        return done(report)
    finally:
        for written in (missing, parsed):
            if written is not None:
                written.drop()


def history(
    source: DataFrame,
    path: str,
    fmt: str = "avro",
    on_error: str = "fail",
    rejects_path: str | None = None,
    rejects_format: str = "parquet",
) -> None:
    """Replace the files under ``path`` with all rows of ``source``.

    Decimals are widened on the way. The job is one stage: every task writes
    what it read, beside the old files, which stay until all of it is there. A
    source that reads files under ``path`` is refused, since its files go.

    With ``on_error="null"`` a ``rejects_path`` that does not exist yet gets a row
    for each decimal that was too large, as in :func:`repair`. The rows are then
    written to the shared folder first, so that the source is still read once.
    """
    spark = source.sparkSession
    _check_rejects(spark, rejects_path, on_error)
    clash = [p for p in read_paths(source) if is_under(spark, p, path) or is_under(spark, path, p)]
    if clash:
        raise ValueError(f"the source reads {clash[0]}, which the history would overwrite")
    if rejects_path is None:
        replace_files(widen_decimals(source, on_error), path, fmt)
        return
    written, _ = _write_rejects(conform_with_rejects(source, column=REJECTED), rejects_path, rejects_format)
    try:
        replace_files(written.frame.drop(REJECTED), path, fmt)
    finally:
        written.drop()
