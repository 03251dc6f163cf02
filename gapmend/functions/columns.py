"""Column helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, functions as F


def named(name: str) -> Column:
    """The column called ``name``, also when the name holds dots or spaces."""
    return F.col(quoted(name))


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def as_list(names: str | Sequence[str]) -> list[str]:
    return [names] if isinstance(names, str) else list(names)


def any_null(names: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [named(n).isNull() for n in names])


def none_null(names: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [named(n).isNotNull() for n in names])
