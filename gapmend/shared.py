"""Intermediate results, kept in the folder that all executors can see.

A multi-step job hands a small result (missing keys, duplicated keys, staged
partitions) from one step to the next as a written Parquet table. That cuts
the lineage and survives the loss of executors. The write also measures the
result, so the next step knows whether it can be broadcast.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager, nullcontext
from contextvars import ContextVar
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    MapType,
    StringType,
    StructType,
    VariantType,
)

from gapmend.functions.columns import quoted

# Largest result, as measured, that is sent to every executor.
BROADCAST_BYTES = 64 * 1024 * 1024

# Size of file splits for jobs that read keys alone.
NARROW_SPLIT_BYTES = 1024 * 1024 * 1024


def shared_dir(spark: SparkSession) -> str:
    """The checkpoint folder of the session; a temporary one only in local mode."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    folder = configured or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(
            "set spark.checkpoint.dir to a folder that every executor can reach"
        )
    folder = tempfile.mkdtemp(prefix="gapmend-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that nobody has used before."""
    path = f"{shared_dir(spark).rstrip('/')}/gapmend/{label}-{uuid.uuid4().hex}"
    given = _scratch.get()
    if given is not None:
        given.append(path)
    return path


# The paths that the innermost scratch_tables has given out.
_scratch: ContextVar[list[str] | None] = ContextVar("scratch", default=None)


@contextmanager
def scratch_tables(spark: SparkSession) -> Iterator[Callable[[str], None]]:
    """Delete at the end of the body, also after an error, what was written under
    fresh paths in it by the same thread.

    For steps whose result is written before the body ends. The body gets a
    function that spares a path; an enclosing scope then answers for it.
    """
    outer, given = _scratch.get(), []

    def keep(path: str) -> None:
        given.remove(path)
        if outer is not None:
            outer.append(path)

    token = _scratch.set(given)
    try:
        yield keep
    finally:
        _scratch.reset(token)
        for path in given:
            delete_path(spark, path)


def held_bytes(df: DataFrame) -> Column:
    """Aggregate: an upper bound for the memory that the columns of ``df`` need.

    NULL when a column has no size that a query can measure.
    """
    size = F.lit(0).cast("bigint")
    for field in df.schema.fields:
        if isinstance(field.dataType, (StringType, BinaryType)):
            width = F.coalesce(F.octet_length(F.col(quoted(field.name))), F.lit(0)) + 32
        elif isinstance(field.dataType, (ArrayType, MapType, StructType, VariantType)):
            width = F.lit(None)
        else:
            width = F.lit(32)
        size = size + width.cast("bigint")
    return F.sum(size)


def broadcast_limit(spark: SparkSession) -> int:
    """Bytes that may be broadcast: ``BROADCAST_BYTES`` or the session's own
    threshold if that is higher; nothing where the session forbids it."""
    conf = spark._jsparkSession.sessionState().conf()
    threshold = conf.autoBroadcastJoinThreshold()
    return -1 if threshold < 0 else max(threshold, BROADCAST_BYTES)


@dataclass(frozen=True)
class Written:
    """A result in the shared folder, its rows, and the memory they need."""

    frame: DataFrame
    path: str
    rows: int
    memory: int | None

    def fits_broadcast(self) -> bool:
        limit = broadcast_limit(self.frame.sparkSession)
        return self.memory is not None and self.memory <= limit

    def for_join(self) -> DataFrame:
        """The rows, broadcast if they were measured to fit, else shuffled."""
        return self.frame.hint("broadcast" if self.fits_broadcast() else "merge")

    def drop(self) -> None:
        delete_path(self.frame.sparkSession, self.path)


@contextmanager
def narrow_scan(spark: SparkSession):
    """Larger file splits for jobs that read the key columns alone.

    Spark cuts files by their size on disk. A cut that suits whole rows gives
    a job that needs one column of many a few rows per task, and a shuffle of
    that many tasks a block for each pair. Small tables still use all cores.
    """
    now = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    size = max(now, NARROW_SPLIT_BYTES)
    with session_conf(spark, {"spark.sql.files.maxPartitionBytes": str(size)}):
        yield


def write_shared(df: DataFrame, label: str, narrow: bool = False) -> Written:
    """Write ``df`` to the shared folder and read it back.

    ``narrow`` says that the job reads little of each row.
    """
    spark = df.sparkSession
    path = fresh_path(spark, label)
    seen = Observation()
    counted = df.observe(seen, F.count(F.lit(1)).alias("n"), held_bytes(df).alias("bytes"))
    with narrow_scan(spark) if narrow else nullcontext():
        counted.write.parquet(path)
    rows = seen.get["n"]
    memory = seen.get["bytes"] if rows else 0
    return Written(spark.read.schema(df.schema).parquet(path), path, rows, memory)


def _hadoop_path(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def delete_path(spark: SparkSession, path: str) -> bool:
    target, fs = _hadoop_path(spark, path)
    return fs.delete(target, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    target, fs = _hadoop_path(spark, path)
    return fs.exists(target)


def move_path(spark: SparkSession, path: str, to: str) -> None:
    """Rename a folder; an error if the file system says it could not."""
    source, fs = _hadoop_path(spark, path)
    if not fs.rename(source, spark._jvm.org.apache.hadoop.fs.Path(to)):
        raise OSError(f"could not rename {path} to {to}")


def beside(spark: SparkSession, path: str) -> list[str]:
    """Folders whose name is that of ``path``, a dot and more."""
    target, fs = _hadoop_path(spark, path)
    if not fs.exists(target.getParent()):
        return []
    found = [f.getPath() for f in fs.listStatus(target.getParent())]
    return [f.toString() for f in found if f.getName().startswith(f"{target.getName()}.")]


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """The names of the folders right under ``path``."""
    target, fs = _hadoop_path(spark, path)
    return [f.getPath().getName() for f in fs.listStatus(target) if f.isDirectory()]


def file_names(spark: SparkSession, path: str) -> list[str]:
    """The names of the files right under ``path``, none if it does not exist."""
    target, fs = _hadoop_path(spark, path)
    return [f.getPath().getName() for f in fs.listStatus(target) if f.isFile()] if fs.exists(target) else []


def plan_bytes(df: DataFrame) -> int:
    """Size of a result as Spark's statistics estimate it before it runs."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def read_paths(df: DataFrame) -> list[str]:
    """The places that file scans in the plan of ``df`` read."""
    found, todo = [], [df._jdf.queryExecution().analyzed()]
    while todo:
        plan = todo.pop()
        if plan.getClass().getSimpleName() == "LogicalRelation":
            relation = plan.relation()
            if relation.getClass().getSimpleName() == "HadoopFsRelation":
                roots = relation.location().rootPaths()
                found += [roots.apply(i).toString() for i in range(roots.length())]
        children = plan.children()
        todo += [children.apply(i) for i in range(children.length())]
    return found


def is_under(spark: SparkSession, path: str, folder: str) -> bool:
    """Whether ``path`` is ``folder`` or lies in it."""
    names = []
    for place in (path, folder):
        target, fs = _hadoop_path(spark, place)
        names.append(fs.makeQualified(target).toString().rstrip("/") + "/")
    return names[0].startswith(names[1])


@contextmanager
def session_conf(spark: SparkSession, settings: dict[str, str]):
    """Set runtime options for the body and put the old values back.

    They hold for the whole session, so queries that other threads plan in it
    meanwhile see them too; use a session of its own (``newSession``) there.
    """
    before = {name: spark.conf.get(name, None) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)
