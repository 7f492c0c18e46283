"""Null-aware numeric and comparison expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

NUMERIC_TEXT = r"^\s*[+-]?(([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?|(?i:inf(inity)?))\s*$"


def lenient_double(df: DataFrame, column: str) -> Column:
    """A column as a number; a text that is no plain number becomes null."""
    value = F.col(column)
    if not isinstance(df.schema[column].dataType, StringType):
        return value.cast("double")
    return F.when(value.rlike(NUMERIC_TEXT), value.try_cast("double"))


def lenient_long(df: DataFrame, column: str) -> Column:
    """A column as a whole number, also where it is written like ``2.0``; anything else becomes null."""
    number = lenient_double(df, column)
    whole = F.when((number == F.floor(number)) & (F.abs(number) < 2.0**53), number.try_cast("long"))
    return F.coalesce(F.col(column).try_cast("long"), whole) if isinstance(df.schema[column].dataType, StringType) else whole


def holds(condition: Column) -> Column:
    """A comparison with null counts as false."""
    return F.coalesce(condition, F.lit(False))


def differs(left: Column, right: Column) -> Column:
    """An inequality with null on either side counts as true."""
    return F.coalesce(left != right, F.lit(True))


def ratio(numerator: Column, denominator: Column) -> Column:
    """x/0 is signed infinity, 0/0 is null."""
    numerator, denominator = numerator.cast("double"), denominator.cast("double")
    return F.when(
        denominator == 0,
        F.when(numerator > 0, F.lit(float("inf"))).when(numerator < 0, F.lit(float("-inf"))),
    ).otherwise(numerator / denominator)


def right_closed_bins(value: Column, edges: list[float], labels: list[str]) -> Column:
    """Label of the first edge that is >= value; the last label has no upper edge."""
    pairs = zip(edges[1:], labels[1:-1])
    chain = reduce(lambda c, p: c.when(value <= p[0], p[1]), pairs, F.when(value <= edges[0], labels[0]))
    return chain.when(value.isNotNull(), labels[-1])
