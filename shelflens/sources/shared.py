"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# The scratch blocks that are open, each with the tables written in it; the last one owns what is written next.
_open: ContextVar[tuple[list[str], ...]] = ContextVar("scratch", default=())


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, which all executors share."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return folder


def delete_path(spark: SparkSession, name: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def move_path(spark: SparkSession, name: str, to: str) -> None:
    path, target = (spark.sparkContext._jvm.org.apache.hadoop.fs.Path(n) for n in (name, to))
    system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    system.mkdirs(target.getParent())
    if not system.rename(path, target):
        raise OSError(f"{name} could not be moved to {to}")


def write_once(df: DataFrame, name: str) -> DataFrame:
    """Write a frame that several branches of a plan need, and return the written table.

    It is computed once, its lineage ends there, and Spark knows its size when it
    plans the joins that follow.
    """
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    if _open.get():
        _open.get()[-1].append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Delete the tables that were written inside, once the results are written elsewhere.

    Blocks that overlap, in one thread or several, delete their own tables only.
    """
    mine: list[str] = []
    _open.set((*_open.get(), mine))
    try:
        yield
    finally:
        _open.set(tuple(other for other in _open.get() if other is not mine))
        for name in mine:
            delete_path(spark, name)
