"""Helpers that several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructField, StructType

from shelflens.sources.shared import shared_folder, write_once

__all__ = ["shared_folder", "write_once", "words", "table", "with_field", "MARK"]

# Words are runs of anything but space, tab and the line breaks up to \r.
WORD_BREAK = r"[\x20\x09-\x0D]+"
# Columns an operator adds for itself start with this, so that extra columns of a caller don't clash.
MARK = "_sl_"


def words(text: Column) -> Column:
    """The words of a text as an array; a null text has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), WORD_BREAK), "")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def with_field(schema: StructType, **fields: DataType) -> StructType:
    """A schema with more fields; a column of the same name is replaced."""
    kept = [f for f in schema.fields if f.name not in fields]
    return StructType(kept + [StructField(name, kind) for name, kind in fields.items()])
