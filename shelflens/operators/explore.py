"""Aggregates and filtered views over the curated and quarantined tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ALL = "All"


def inventory_totals(fact: DataFrame) -> DataFrame:
    """One row: records, mean effective stock, total stock movement."""
    return fact.agg(
        F.count("*").alias("records"),
        F.avg("effective_stock_level").alias("mean_effective_stock"),
        F.sum("stock_movement").alias("total_stock_movement"),
    )


def stock_by(fact: DataFrame, column: str) -> DataFrame:
    """Effective stock per value of a column, rows without a value left out."""
    return (
        fact.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.coalesce(F.sum("effective_stock_level"), F.lit(0.0)).alias("effective_stock_level"))
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, most frequent first, nulls left out."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("count"))
    return counts.orderBy(F.col("count").desc(), column)


def choices(df: DataFrame, column: str) -> DataFrame:
    """Distinct values to filter by."""
    return df.select(column).dropna().distinct()


def filter_fact(
    fact: DataFrame, store_name: str = ALL, category: str = ALL, reconciliation_status: str = ALL
) -> DataFrame:
    """Rows that equal every given value; "All" leaves a column unfiltered."""
    wanted = {"store_name": store_name, "category": category, "reconciliation_status": reconciliation_status}
    for column, value in wanted.items():
        if value != ALL and column in fact.columns:
            fact = fact.filter(F.col(column) == value)
    return fact


def with_suggestion(quarantined: DataFrame) -> DataFrame:
    """Quarantined rows for which a known id was suggested."""
    return quarantined.filter(F.col("suggested_product_id").isNotNull()).select(
        "product_id", "suggested_product_id", "fuzzy_match_score"
    )


def layer_counts(layers: dict[str, DataFrame]) -> DataFrame:
    """Rows per layer; datasets of one layer are added up by the caller's union or key."""
    counts = [df.agg(F.count("*").alias("records")).select(F.lit(name).alias("layer"), "records") for name, df in layers.items()]
    return reduce(DataFrame.unionByName, counts)
