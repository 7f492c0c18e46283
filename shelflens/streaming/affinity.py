"""Pair counts on a stream of sale lines: one count per product pair and tumbling window."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelflens.streaming.carried import Carried, micros, write_batches

__all__ = ["stream_pair_counts", "write_batches"]


def _pairs(items: DataFrame, basket: list[str], distinct: bool) -> DataFrame:
    """Product pairs of every basket with their ``pair_rows``, as in the batch, from rows of ``product_id, quantity_lines``.

    A join, so that a basket of many products is no single row, and can be split.
    """
    others = items.withColumnsRenamed({"product_id": "product_b", "quantity_lines": "_lines"})
    a, b, n = F.col("product_id"), F.col("product_b"), F.col("quantity_lines")
    pairs = items.join(others, basket)
    if distinct:
        return pairs.filter(a < b).select(*basket, a.alias("product_a"), b, F.lit(1).cast("long").alias("pair_rows"))
    rows = F.when(a < b, n * F.col("_lines")).otherwise(F.floor(n * (n - 1) / 2))
    return pairs.filter((a < b) | ((a == b) & (n > 1))).select(*basket, a.alias("product_a"), b, rows.alias("pair_rows"))


def stream_pair_counts(lines: DataFrame, window: str = "7 days", delay: str = "2 days", distinct: bool = False) -> Carried:
    """``window, product_a, product_b, pair_count`` of a stream of ``line_item_id, transaction_id, product_id, sold_at``.

    A basket is what a transaction holds within a window. A line that is sent again
    counts once. A window is given out, once, when the latest sale seen is ``delay``
    past its end; lines that are later than that are left out, so only those of
    open windows are carried over, and the ids of the last ones before. A stream that
    ends is closed by any later line, whose product may be null.

    Lines are counted per transaction and product before baskets are paired, so a
    product that repeats within a basket takes one row, and a product or a
    transaction with a large share of all lines is spread over tasks.
    """
    length, late = micros(lines.sparkSession, window), micros(lines.sparkSession, delay)
    sold = F.unix_micros("sold_at")
    end = sold - F.pmod(sold, F.lit(length)) + length

    def counts(due: DataFrame, kept: DataFrame) -> DataFrame:
        items = (
            due.dropna(subset=["transaction_id", "product_id"])
            .groupBy(end.alias("end"), "transaction_id", "product_id")
            .agg(F.count("*").alias("quantity_lines"))
        )
        pairs = _pairs(items, ["end", "transaction_id"], distinct)
        span = F.struct(F.timestamp_micros(F.col("end") - length).alias("start"), F.timestamp_micros("end").alias("end"))
        counted = pairs.groupBy("end", "product_a", "product_b").agg(F.sum("pair_rows").alias("pair_count"))
        return counted.select(span.alias("window"), "product_a", "product_b", "pair_count")

    rows = lines.select("line_item_id", "transaction_id", "product_id", "sold_at")
    return Carried(rows, "line_item_id", sold, end, late, max(late, length), ["line_item_id", "sold_at"], counts)
