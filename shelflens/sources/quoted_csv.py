"""Csv files whose quoted cells hold line breaks, read by many tasks."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

# The reader's helper travels with the job, so the package need not be installed on the executors.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

RECORDS = "file string, block long, part int, opens boolean, whole boolean, first boolean, record string"


class _Split:
    """Records of one byte range: whole ones, and what belongs to a record that began before or ends after it."""

    def __init__(self, file: str, block: int, inside: bool) -> None:
        self.file, self.block, self.inside = file, block, inside
        self.lines: list[str] = []
        self.opens, self.part, self.first = not inside, 0, block == 0

    def add(self, line: str) -> Iterator[tuple]:
        self.lines.append(line.removesuffix("\r"))
        self.inside ^= line.count('"') % 2 == 1
        if not self.inside:
            yield from self.take(True)

    def take(self, closed: bool) -> Iterator[tuple]:
        """What has been read since the last record ended; a record is whole if it began and ended here."""
        if self.lines:
            yield self.file, self.block, self.part, self.opens, self.opens and closed, self.first, "\n".join(self.lines)
            self.lines, self.opens, self.first = [], True, False
            self.part = 1


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in RECORDS.split(", ")]
    split, out = None, []

    def flushed(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.string(), pa.int64(), pa.int32(), pa.bool_(), pa.bool_(), pa.bool_(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    for batch in batches:
        for line, file, block, inside in zip(*(batch.column(i).to_pylist() for i in range(4))):
            if split is None or (split.file, split.block) != (file, block):
                if split is not None:
                    out += split.take(False)
                split = _Split(file, block, bool(inside))
            out += split.add(line)
            if len(out) >= 8192:
                yield flushed(out)
                out = []
    if split is not None:
        out += split.take(False)
    if out:
        yield flushed(out)


def records(spark: SparkSession, path: str) -> DataFrame:
    """Rows ``first, record``: the records of all files, ``first`` for the first one of each file.

    A line break ends a record if the quotes before it are even in number. Quotes are
    counted per byte range of the files; summed over the ranges before, they tell
    whether a range begins inside a cell. Ranges are then cut at true ends of
    records, and only what crosses the end of a range is put together anew, by a small
    shuffle. Line breaks within cells become ``\\n``. A quote that is never closed takes
    the rest of its file into one record. The files are read three times: for the quotes,
    for whole records, and for those that cross.
    """
    given = spark.read.option("lineSep", "\n").text(path)
    lines = given.select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
    )
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"')))
    ranges = lines.groupBy("file", "block").agg((F.sum(quotes) % 2).alias("odd"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    # One row per byte range.
    inside = ranges.select("file", "block", (F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2 == 1).alias("inside"))
    placed = lines.withColumn("at", F.monotonically_increasing_id()).join(inside, ["file", "block"])
    placed = placed.sortWithinPartitions("file", "block", "at").select("value", "file", "block", "inside")
    found = placed.mapInArrow(_records, RECORDS)
    # At most two parts per byte range stand in the window.
    order = Window.partitionBy("file").orderBy("block", "part")
    parts = found.filter("NOT whole").withColumn("number", F.sum(F.col("opens").cast("int")).over(order))
    crossing = parts.groupBy("file", "number").agg(
        F.array_sort(F.collect_list(F.struct("block", "part", "record", "first"))).alias("parts")
    )
    joined = crossing.select(F.col("parts")[0]["first"].alias("first"), F.array_join(F.col("parts.record"), "\n").alias("record"))
    return found.filter("whole").select("first", "record").unionByName(joined)


def read_quoted(spark: SparkSession, path: str, sep: str = ",", bad: str | None = None) -> DataFrame:
    """All columns of csv files as text; cells may hold quoted line breaks.

    Column names are those of the header line; a file whose first record differs raises
    when it is read. Records with too few or too many cells are null or cut there, and
    stand as a whole in the column ``bad``, if that is named.
    """
    columns = spark.read.options(header=True, sep=sep, escape='"').csv(path).columns
    corrupt = bad or "_bad_record"
    schema = StructType([StructField(c, StringType()) for c in [*columns, corrupt]])
    options = {"sep": sep, "escape": '"', "columnNameOfCorruptRecord": corrupt}
    # The schema of a parsed record may hold names that its text form could not.
    parsed = F.from_csv("record", ", ".join(f"`{f.name.replace('`', '``')}` string" for f in schema.fields), options)
    rows = records(spark, path).filter("record <> ''").select("first", parsed.alias("cells"))
    same = F.lit(True)
    for c in columns:
        same = same & F.col("cells").getField(c).eqNullSafe(F.lit(c))
    header = F.when(same, F.lit(True)).otherwise(F.raise_error(F.lit(f"a csv file of {path} has other columns than {columns}")).cast("boolean"))
    rows = rows.filter(~F.when(F.col("first"), header).otherwise(F.lit(False)))
    kept = rows.select("cells.*")
    return kept if bad else kept.drop(corrupt)
