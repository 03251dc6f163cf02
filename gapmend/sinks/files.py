"""Directories of files as a sink."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession

from gapmend.shared import beside, delete_path, move_path, path_exists


def write_files(df: DataFrame, path: str, fmt: str = "avro", mode: str = "overwrite") -> None:
    """Write ``df`` to a directory from the tasks that computed it, no shuffle.

    ``avro`` needs Spark's own Avro module on the class path.
    """
    df.write.format(fmt).mode(mode).save(path)


def replace_files(df: DataFrame, path: str, fmt: str = "avro") -> None:
    """Replace what is under ``path`` by ``df``, or leave it as it is.

    The rows are written beside it first; only complete ones take the place of
    the old, which are deleted last. A run that fails leaves the old rows and no
    other trace; one that is killed leaves them too, at ``path`` or, if killed
    between two renames, as ``path`` with ``.replaced-...`` behind, from where the
    next run puts them back. Nobody else may write to ``path`` meanwhile.
    """
    spark, path = df.sparkSession, path.rstrip("/")
    put_back(spark, path)
    new, old = (f"{path}.{what}-{uuid.uuid4().hex}" for what in ("writing", "replaced"))
    try:
        write_files(df, new, fmt, "error")
    except BaseException:
        delete_path(spark, new)
        raise
    there = path_exists(spark, path)
    if there:
        move_path(spark, path, old)
    try:
        move_path(spark, new, path)
    except BaseException:
        if there:
            move_path(spark, old, path)
        raise
    if there:
        delete_path(spark, old)


def put_back(spark: SparkSession, path: str) -> None:
    """After a run of :func:`replace_files` that was killed: the old rows, if it
    had moved them away and not put others there, and nothing else."""
    for place in beside(spark, path):
        left = re.search(r"\.(writing|replaced)-[0-9a-f]{32}$", place)
        if not left:
            continue
        if left[1] == "replaced" and not path_exists(spark, path):
            move_path(spark, place, path)
        else:
            delete_path(spark, place)


def stage(df: DataFrame, path: str, fmt: str = "avro") -> DataFrame:
    """Write ``df`` to ``path`` and give back the written rows."""
    write_files(df, path, fmt)
    return df.sparkSession.read.format(fmt).schema(df.schema).load(path)
