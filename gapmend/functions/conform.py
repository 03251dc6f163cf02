"""Bring a source frame to the column types and order of its target."""

from __future__ import annotations

import logging
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import (
    DataType,
    DecimalType,
    DoubleType,
    LongType,
    NullType,
    StructField,
    StructType,
)

from gapmend.functions.columns import named

log = logging.getLogger(__name__)

# Fixed value: the one target column that a source may lack; it becomes NULL.
FILLABLE = ("dat_kafka",)

Types = str | StructType | Iterable[tuple[str, str]]


class SchemaMismatch(ValueError):
    """The source lacks columns that the target needs."""


def _cast(column: Column, to: DataType, on_error: str) -> Column:
    if on_error == "fail":
        return column.cast(to)
    if on_error == "null":
        return column.try_cast(to)
    raise ValueError(f"on_error is 'fail' or 'null', not {on_error!r}")


def as_schema(types: StructType | Iterable[tuple[str, str]]) -> StructType:
    """A ``StructType`` from itself or from a ``DataFrame.dtypes`` list."""
    if isinstance(types, StructType):
        return types
    return StructType(
        [StructField(name, DataType.fromDDL(text)) for name, text in types]
    )


def _widened(data_type: DataType) -> DataType:
    if isinstance(data_type, DecimalType):
        return LongType() if data_type.scale == 0 else DoubleType()
    return data_type


def widen_decimals(df: DataFrame, on_error: str = "fail") -> DataFrame:
    """Whole-number decimals become ``bigint``, other decimals ``double``.

    Only top-level columns change; decimals inside arrays, maps and structs
    keep their type.
    """
    return df.select(
        [
            _cast(named(f.name), _widened(f.dataType), on_error).alias(f.name)
            if isinstance(f.dataType, DecimalType)
            else named(f.name)
            for f in df.schema.fields
        ]
    )


def conform(
    df: DataFrame,
    types: Types = "auto",
    fillable: Sequence[str] = FILLABLE,
    on_error: str = "fail",
) -> DataFrame:
    """Cast the columns of ``df`` to ``types`` in one projection.

    Names match without regard to case. Columns that ``types`` does not know
    stay as they are. A column of ``types`` that ``df`` lacks is added as a
    typed NULL if its name is in ``fillable``. ``types="auto"`` widens
    decimals instead.
    """
    if isinstance(types, str):
        if types.lower() != "auto":
            raise ValueError("types is 'auto', a StructType or a list of (name, type)")
        return widen_decimals(df, on_error)
    if not isinstance(types, (StructType, list, tuple)):
        raise ValueError("types is 'auto', a StructType or a list of (name, type)")

    wanted = {f.name.lower(): f for f in as_schema(types).fields}
    present = {f.name.lower() for f in df.schema.fields}
    fill = {name.lower() for name in fillable}

    columns = []
    for field in df.schema.fields:
        target = wanted.get(field.name.lower())
        if target is None:
            log.warning("column %s is not in the target", field.name)
        if target is None or target.dataType == field.dataType:
            columns.append(named(field.name))
        else:
            cast = _cast(named(field.name), target.dataType, on_error)
            columns.append(cast.alias(field.name))
    for name, target in wanted.items():
        if name in present:
            continue
        if name in fill:
            columns.append(F.lit(None).cast(target.dataType).alias(target.name))
        else:
            log.warning("column %s is missing from the source", target.name)
    return df.select(columns)


def conform_with_rejects(
    df: DataFrame,
    types: Types = "auto",
    fillable: Sequence[str] = FILLABLE,
    column: str = "rejected",
) -> DataFrame:
    """:func:`conform` with ``on_error="null"``, and what it could not carry.

    ``column`` is NULL for a row whose values all had a counterpart. Else it is
    a struct of ``casts``, one entry for each lost value with its column, the old
    value as text and both types, and ``row``, the source row as it was.
    :func:`rejects` makes a table of it. The value is looked at in the projection
    that casts it, so it costs no other pass, and rows without a failure carry
    nothing. Inside arrays, maps and structs only a value that is lost as a whole
    counts, as in :func:`schema_drift`.
    """
    auto = isinstance(types, str)
    fields = df.schema.fields if auto else as_schema(types).fields
    wanted = {f.name.lower(): StructField(f.name, _widened(f.dataType) if auto else f.dataType) for f in fields}
    if column.lower() in {*wanted, *(c.lower() for c in df.columns)}:
        raise ValueError(f"there is a column {column} already")
    casts = []
    for field in df.schema.fields:
        target = wanted.get(field.name.lower())
        if target is None or target.dataType == field.dataType or isinstance(field.dataType, NullType):
            continue
        value = named(field.name)
        entry = F.struct(
            F.lit(target.name).alias("column"),
            value.cast("string").alias("value"),
            _type_name(field).alias("source_type"),
            _type_name(target).alias("target_type"),
        )
        lost = value.isNotNull() & value.try_cast(target.dataType).isNull()
        casts.append(F.when(lost, entry))
    whole = F.struct(*[named(f.name) for f in df.schema.fields if not isinstance(f.dataType, NullType)])
    if casts:
        found = F.filter(F.array(*casts), lambda x: x.isNotNull())
    else:
        kind = "array<struct<column:string,value:string,source_type:string,target_type:string>>"
        found = F.array().cast(kind)
    lost = F.when(F.size(found) > 0, F.struct(found.alias("casts"), whole.alias("row")))
    checked = df.select("*", lost.alias(column))
    if not auto:
        types = StructType([*fields, checked.schema[column]])
    return conform(checked, types, fillable, "null")


def rejects(df: DataFrame, column: str = "rejected") -> DataFrame:
    """One row for each value that :func:`conform_with_rejects` could not carry:
    column, value, source_type, target_type, and row, the source row."""
    failed = df.select(named(column).alias("lost")).where(F.col("lost").isNotNull())
    each = failed.select(F.col("lost.row").alias("row"), F.explode("lost.casts").alias("cast"))
    return each.select("cast.column", "cast.value", "cast.source_type", "cast.target_type", "row")


def project_to_target(df: DataFrame, columns: StructType | Sequence[str]) -> DataFrame:
    """The columns of the target in its order; extra columns are left out."""
    names = columns.names if isinstance(columns, StructType) else list(columns)
    present = {name.lower() for name in df.columns}
    missing = [name for name in names if name.lower() not in present]
    if missing:
        raise SchemaMismatch(f"source lacks target columns: {', '.join(missing)}")
    return df.select([named(name).alias(name) for name in names])


@dataclass(frozen=True)
class _Drift:
    column: str
    side: str
    source: StructField | None
    target: StructField | None
    action: str


def _compare(df: DataFrame, target: StructType, fillable: Sequence[str]) -> list[_Drift]:
    wanted = {f.name.lower(): f for f in target.fields}
    present = {f.name.lower() for f in df.schema.fields}
    fill = {name.lower() for name in fillable}
    found = []
    for field in df.schema.fields:
        other = wanted.get(field.name.lower())
        if other is None:
            found.append(_Drift(field.name, "source", field, None, "extra"))
        elif other.dataType == field.dataType:
            found.append(_Drift(other.name, "both", field, other, "keep"))
        else:
            action = "cast" if _castable(df, field, other) else "incompatible"
            found.append(_Drift(other.name, "both", field, other, action))
    for name, other in wanted.items():
        if name not in present:
            action = "fill" if name in fill else "missing"
            found.append(_Drift(other.name, "target", None, other, action))
    return found


def _castable(df: DataFrame, field: StructField, target: StructField) -> bool:
    try:
        df.select(named(field.name).try_cast(target.dataType)).schema
    except AnalysisException:
        return False
    return True


def schema_drift(
    df: DataFrame,
    target: StructType | Iterable[tuple[str, str]],
    fillable: Sequence[str] = FILLABLE,
    counted: bool = True,
) -> DataFrame:
    """How the columns of ``df`` differ from ``target``, and what it costs.

    One row per column: which side has it, both types, what
    :func:`conform` does about it, how many values the source holds, and how
    many of them have no counterpart in the target (extra columns and values
    that the cast cannot carry). All counts come from one pass over ``df``;
    with ``counted=False`` they are NULL and ``df`` is not read.
    """
    rows = []
    for drift in _compare(df, as_schema(target), fillable):
        if not counted:
            held = lost = F.lit(None).cast("bigint")
        elif drift.source is None:
            held = lost = F.lit(0).cast("bigint")
        else:
            value = named(drift.source.name)
            held = F.count(value)
            if drift.action == "keep":
                lost = F.lit(0).cast("bigint")
            elif drift.action == "cast":
                cast = value.try_cast(drift.target.dataType)
                lost = F.count_if(value.isNotNull() & cast.isNull())
            else:
                lost = held
        rows.append(
            F.struct(
                F.lit(drift.column).alias("column"),
                F.lit(drift.side).alias("side"),
                _type_name(drift.source).alias("source_type"),
                _type_name(drift.target).alias("target_type"),
                F.lit(drift.action).alias("action"),
                held.alias("held"),
                lost.alias("lost"),
            )
        )
    if counted:
        report = df.agg(F.array(*rows).alias("drift"))
    else:
        report = df.sparkSession.range(1).select(F.array(*rows).alias("drift"))
    return report.select(F.inline("drift"))


def _type_name(field: StructField | None) -> Column:
    text = None if field is None else field.dataType.simpleString()
    return F.lit(text).cast("string")
