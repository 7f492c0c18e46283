"""Best match of unknown ids among known ones, and the id shape check."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelflens.config import SKU_PATTERN
from shelflens.functions import similarity
from shelflens.functions.rules import has_code
from shelflens.operators.nearest import nearest
from shelflens.sources.shared import write_once


def best_matches(
    ids: DataFrame,
    known: DataFrame,
    threshold: int = 85,
    *,
    column: str = "product_id",
    order: str | None = None,
    low_scores: bool = True,
    normalizer: Callable[[Column], Column] = similarity.normalize,
) -> DataFrame:
    """Best known value of every distinct unknown one: ``id, match, score``.

    ``match`` is null below the threshold while the score is kept. Equal scores
    go to the first known value by ``order``, or to the smallest.

    Distinct normalized texts are searched for in tries of the known ones (see
    ``nearest``); the better the score found so far, the less is left to visit.
    ``low_scores=False`` leaves the scores below the threshold out, so that the search
    begins with the threshold.

    The distinct unknown and known texts are written once. Starts jobs.
    """
    value = F.col(column).cast("string")
    unknown = ids.filter(value.isNotNull()).select(value.alias("id")).distinct()
    unknown = write_once(unknown.withColumn("text", normalizer(F.col("id"))), "unknown")
    texts = unknown.select("text").distinct()
    choices = (
        known.filter(value.isNotNull())
        .select(normalizer(value).alias("text"), (F.col(order) if order else value).alias("rank"), value.alias("choice"))
        .groupBy("text")
        .agg(F.min(F.struct("rank", "choice")).alias("first"))
        .select("text", "first.rank", "first.choice")
    )
    choices = write_once(choices, "known")

    best = (
        nearest(texts, choices, threshold, low_scores)
        .filter(F.col("score") >= (0 if low_scores else threshold))
        .groupBy("text")
        .agg(F.min(F.struct((-F.col("score")).alias("minus"), "rank", "choice")).alias("best"))
        .select(
            "text",
            F.when(-F.col("best.minus") >= threshold, F.col("best.choice")).alias("match"),
            (-F.col("best.minus")).alias("score"),
        )
    )
    return unknown.join(best, "text").select("id", "match", "score")


def unknown_rows(quarantined: DataFrame) -> DataFrame:
    """Rows whose product id is not known."""
    return quarantined.filter(has_code("MISMATCHED_PRODUCT_ID"))


def suggest_ids(
    quarantined: DataFrame, products: DataFrame, threshold: int = 85, *, matches: DataFrame | None = None, **options
) -> DataFrame:
    """Add ``suggested_product_id`` and ``fuzzy_match_score`` to rows with an unknown id.

    Ids are only suggested, never repaired. Each distinct unknown id is matched
    once, and the result joined back. The rows are needed for both, so they are
    written once, unless ``matches`` of all unknown ids are given (see ``best_matches``).
    """
    if matches is None:
        quarantined = write_once(quarantined, "quarantined")
        matches = write_once(best_matches(unknown_rows(quarantined), products, threshold, **options), "matches")
    wanted = F.when(has_code("MISMATCHED_PRODUCT_ID"), F.col("product_id").cast("string"))
    return (
        quarantined.withColumn("_wanted", wanted)
        .join(matches.withColumnRenamed("id", "_wanted"), "_wanted", "left")
        .withColumnsRenamed({"match": "suggested_product_id", "score": "fuzzy_match_score"})
        .drop("_wanted")
    )


def apply_suggestions(quarantined: DataFrame) -> DataFrame:
    """Rows with a suggestion, their product id replaced, for an explicit second run."""
    return (
        quarantined.filter(F.col("suggested_product_id").isNotNull())
        .withColumn("product_id", F.col("suggested_product_id"))
        .drop("suggested_product_id", "fuzzy_match_score", "validation_status", "validation_errors")
    )


def sku_shape(column: str = "sku", pattern: str = SKU_PATTERN) -> Column:
    """Whether the column begins with the pattern, null counts as false."""
    return F.coalesce(F.col(column).cast("string").rlike(f"^(?:{pattern})"), F.lit(False))


def check_sku(df: DataFrame, column: str = "sku", pattern: str = SKU_PATTERN) -> DataFrame:
    """Add ``sku_valid``: the column begins with the pattern, null counts as false."""
    return df.withColumn("sku_valid", sku_shape(column, pattern))
