"""Streams whose open rows are carried from one micro-batch to the next as a table beside the checkpoint.

Spark's state store keeps every open row in the memory of an executor, and writes
a file per operator and partition with each micro-batch. A table is read, sorted
and joined like any other: what doesn't fit into memory is on disk.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from shelflens.sources.shared import delete_path


def micros(spark: SparkSession, span: str) -> int:
    """A span of time as in ``withWatermark``, like ``7 days``."""
    return round(spark.range(1).select(F.expr(f"INTERVAL {span}")).first()[0].total_seconds() * 1_000_000)


@dataclass(frozen=True)
class Carried:
    """A stream of ``rows``, of which ``give`` makes what is due once the watermark has passed their ``end``.

    ``time`` and ``end`` are microseconds; the watermark is ``delay`` behind the latest
    time seen. Rows whose end the watermark of the micro-batches before has passed are
    left out, as are those without a time. Of rows with the same ``key`` the first
    counts, for as long as it is carried: until the watermark is ``memory`` past its
    time, which is ``delay`` at least and reaches to its end. Rows whose end has
    passed are carried with their ``lasting`` columns only.

    ``give`` gets the rows that are due, each once, and all that are carried, and adds
    no row of its own.
    """

    rows: DataFrame
    key: str
    time: Column
    end: Column
    delay: int
    memory: int
    lasting: list[str]
    give: Callable[[DataFrame, DataFrame], DataFrame]

    def step(self, batch: DataFrame, number: int, folder: str) -> DataFrame:
        """What is due after a micro-batch. The table of the micro-batch before is left, so that this one can be repeated."""
        spark, columns = batch.sparkSession, self.rows.columns
        rows, passed = batch.select(*columns, F.lit(True).alias("_new")).filter(self.time.isNotNull()), None
        if number:
            held = self._carried(spark, folder, number - 1)
            passed = self._watermark(held)
        if passed is not None:
            open_ = self.end > passed
            held = held.filter(self.time + self.memory > passed).select(
                *[F.col(c) if c in self.lasting else F.when(open_, F.col(c)).alias(c) for c in columns], F.lit(False).alias("_new")
            )
            rows = held.unionByName(rows.filter(open_))
        first = Window.partitionBy(self.key).orderBy("_new", self.time, F.xxhash64(*columns))
        once = rows.withColumn("_place", F.row_number().over(first)).filter("_place = 1").select(*columns)
        once.write.mode("overwrite").parquet(f"{folder}/batch={number}")
        if number > 1:
            delete_path(spark, f"{folder}/batch={number - 2}")
        kept = self._carried(spark, folder, number)
        now = self._watermark(kept)
        due = kept.filter(F.lit(False) if now is None else self.end <= now)
        return self.give(due if passed is None else due.filter(self.end > passed), kept)

    def _carried(self, spark: SparkSession, folder: str, number: int) -> DataFrame:
        return spark.read.schema(self.rows.schema).parquet(f"{folder}/batch={number}")

    def _watermark(self, rows: DataFrame) -> int | None:
        latest = rows.agg(F.max(self.time)).first()[0]
        return None if latest is None else latest - self.delay


def write_batches(stream: DataFrame | Carried, out: str, checkpoint: str) -> DataStreamWriter:
    """Every micro-batch in a folder of its own, which a repeated batch replaces: nothing stands there twice.

    The caller starts the writer. What is due comes out when it is complete, so the
    folders together hold each row once. Rows that are carried over stand in the
    ``open`` folder of the checkpoint.
    """
    carried = isinstance(stream, Carried)
    rows = stream.rows if carried else stream
    adaptive = rows.sparkSession.conf.get("spark.sql.adaptive.enabled")

    def write(batch: DataFrame, number: int) -> None:
        if carried:
            # A stream's own session plans without AQE; these are plain jobs.
            batch.sparkSession.conf.set("spark.sql.adaptive.enabled", adaptive)
            batch = stream.step(batch, number, f"{checkpoint}/open")
        batch.write.mode("overwrite").parquet(f"{out}/batch={number}")

    return rows.writeStream.outputMode("append").foreachBatch(write).option("checkpointLocation", checkpoint)
