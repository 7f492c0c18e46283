"""Basket affinity: items per basket, product pairs, support, confidence, lift.

Lines are first counted per (transaction, product). That shuffle is keyed by both
columns, so a transaction or product with a large share of all lines is spread,
and afterwards a transaction holds at most one row per product.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelflens.config import AffinityConfig
from shelflens.functions.sketches import distinct_counts, distinct_sketches
from shelflens.sources.shared import write_once

CONFIG = AffinityConfig()

# Hash values that pairs are counted by before they are counted themselves.
BUCKETS = 1 << 20

# Columns of the score table, in order.
SCORE_COLUMNS = [
    "product_a",
    "product_b",
    "pair_count",
    "count_a",
    "count_b",
    "support",
    "confidence_a_to_b",
    "confidence_b_to_a",
    "p_b",
    "p_a",
    "lift",
    "product_a_name",
    "product_b_name",
]


def basket_items(lines: DataFrame) -> DataFrame:
    """``transaction_id, product_id, quantity_lines``: lines of a product in a basket."""
    return (
        lines.select("transaction_id", "product_id")
        .dropna()
        .groupBy("transaction_id", "product_id")
        .agg(F.count("*").alias("quantity_lines"))
    )


def baskets(items: DataFrame, min_size: int = 2) -> DataFrame:
    """One row per transaction with at least ``min_size`` lines.

    ``items`` is a sorted array of (product, lines) and has at most one entry per
    product, whatever the number of lines; ``basket_size`` counts the lines.
    """
    return (
        items.groupBy("transaction_id")
        .agg(
            F.array_sort(F.collect_list(F.struct("product_id", "quantity_lines"))).alias("items"),
            F.sum("quantity_lines").alias("basket_size"),
        )
        .filter(F.col("basket_size") >= min_size)
    )


def product_lists(basket_rows: DataFrame) -> DataFrame:
    """Baskets with ``products``, the list that repeats a product once per line."""
    repeated = F.transform("items", lambda i: F.array_repeat(i["product_id"], i["quantity_lines"].cast("int")))
    return basket_rows.select("transaction_id", F.flatten(repeated).alias("products"), "basket_size")


def _pair_up(items: DataFrame, distinct: bool) -> DataFrame:
    """Join the items of a transaction with each other, in product order.

    ``pair_rows`` is how many pairs of lines stand behind a product pair, so a
    repeated product costs one row and not one row per pair of lines.
    """
    a = items.select("transaction_id", F.col("product_id").alias("product_a"), F.col("quantity_lines").alias("lines_a"))
    b = items.select("transaction_id", F.col("product_id").alias("product_b"), F.col("quantity_lines").alias("lines_b"))
    if distinct:
        pairs = a.join(b, "transaction_id").filter(F.col("product_a") < F.col("product_b"))
        return pairs.select("transaction_id", "product_a", "product_b", F.lit(1).cast("long").alias("pair_rows"))
    same = F.col("product_a") == F.col("product_b")
    rows = F.when(same, F.expr("lines_a * (lines_a - 1) div 2")).otherwise(F.col("lines_a") * F.col("lines_b"))
    return (
        a.join(b, "transaction_id")
        .filter((F.col("product_a") < F.col("product_b")) | (same & (F.col("lines_a") > 1)))
        .select("transaction_id", "product_a", "product_b", rows.alias("pair_rows"))
    )


def product_pairs(items: DataFrame, distinct: bool = False) -> DataFrame:
    """All product pairs of all baskets, a <= b, with ``pair_rows`` occurrences each.

    A product that occurs in several lines of a basket pairs with itself, and its
    other pairs count once per line; ``distinct=True`` counts it once.
    """
    return _pair_up(items, distinct)


def expand_pairs(pairs: DataFrame, step: int = 10_000) -> DataFrame:
    """One row per pair occurrence. Repeats are made in two steps of bounded arrays."""
    left = F.col("pair_rows") - F.col("_from")
    return (
        pairs.withColumn("_from", F.explode(F.sequence(F.lit(0).cast("long"), F.col("pair_rows") - 1, F.lit(step).cast("long"))))
        .withColumn("_one", F.explode(F.array_repeat(F.lit(1), F.least(left, F.lit(step)).cast("int"))))
        .select("transaction_id", "product_a", "product_b")
    )


def product_counts(items: DataFrame) -> DataFrame:
    """Number of distinct transactions per product, from basket items."""
    return items.groupBy("product_id").agg(F.count("*").alias("product_count"))


def daily_baskets(lines: DataFrame, header: DataFrame, deviation: float = 0.01) -> DataFrame:
    """Per product and sale day a ``sketch`` of the transactions that hold the product.

    Lines are counted per product, day and task before anything is shuffled; a sketch
    has a bounded size, however many transactions there are. New days are added.
    """
    dated = lines.dropna(subset=["product_id"]).join(header.select("transaction_id", "sale_date"), "transaction_id")
    return distinct_sketches(dated, "transaction_id", "product_id", F.to_date("sale_date").alias("sale_day"), deviation=deviation)


def approximate_product_counts(days: DataFrame) -> DataFrame:
    """As ``product_counts`` for the days given, off by the deviation of their sketches."""
    return distinct_counts(days, "product_id", name="product_count")


def pair_counts(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("product_a", "product_b").agg(F.sum("pair_rows").alias("pair_count"))


def total_transactions(header: DataFrame) -> Column:
    """Rows of the sales header, as a scalar subquery."""
    return header.agg(F.count("*").cast("double")).scalar()


def _with_bound(items: DataFrame, distinct: bool) -> DataFrame:
    """Items with ``bound``, the most pairs that this product has with any other here.

    A pair (a, b) has lines of a x lines of b occurrences in a basket, at most
    lines of a x most lines of any product. That is 1 where nothing repeats.
    """
    if distinct:
        return items.withColumn("bound", F.lit(1).cast("long"))
    most = F.max("quantity_lines").over(Window.partitionBy("transaction_id"))
    return items.withColumn("bound", F.col("quantity_lines") * most)


def frequent_products(items: DataFrame, header: DataFrame, config: AffinityConfig = CONFIG) -> DataFrame:
    """``product_id, product_count`` of the products that can reach the minimum support.

    Products whose bounds add up to less than the least pair count are left out;
    this loses no pair. Of distinct items at most (mean basket size / minimum
    support) products remain, however many baskets there are.
    """
    return (
        _with_bound(items, config.distinct)
        .groupBy("product_id")
        .agg(F.count("*").alias("product_count"), F.sum("bound").alias("bound"))
        # The same division as for the support, so that rounding drops no pair at the edge.
        .filter(F.col("bound") / total_transactions(header) >= config.min_support)
        .select("product_id", "product_count")
    )


def frequent_pairs(items: DataFrame, frequent: DataFrame, distinct: bool = False) -> DataFrame:
    """Pairs of the frequent products in all baskets: those that scores are made of."""
    return _pair_up(items.join(frequent.select("product_id"), "product_id", "left_semi"), distinct)


def _bucket() -> Column:
    return F.pmod(F.xxhash64("product_a", "product_b"), F.lit(BUCKETS))


def frequent_buckets(pairs: DataFrame, header: DataFrame, config: AffinityConfig = CONFIG) -> DataFrame:
    """``bucket``: hash values of pairs whose pairs together reach the minimum support.

    However many different pairs there are, a task passes on at most BUCKETS counts.
    A pair that is frequent is in a frequent bucket, so none is lost. Written.
    """
    counts = pairs.groupBy(_bucket().alias("bucket")).agg(F.sum("pair_rows").alias("pair_rows"))
    kept = counts.filter(F.col("pair_rows") / total_transactions(header) >= config.min_support)
    return write_once(kept.select("bucket"), "frequent_buckets")


def candidate_pairs(items: DataFrame, header: DataFrame, frequent: DataFrame, config: AffinityConfig = CONFIG) -> DataFrame:
    """Pairs of the frequent products that may reach the minimum support: those in frequent buckets.

    Baskets are paired twice, first to count buckets, then to count the pairs left; so
    the many pairs that occur a few times are never shuffled or kept. Where all pairs
    of the frequent products have a bucket of their own anyway, they are paired once.
    """
    pairs = frequent_pairs(items, frequent, config.distinct)
    products = frequent.count()
    if products * (products + 1) // 2 <= BUCKETS:
        return pairs
    # At most BUCKETS numbers.
    kept = F.broadcast(frequent_buckets(pairs, header, config))
    return pairs.withColumn("bucket", _bucket()).join(kept, "bucket", "left_semi").drop("bucket")


def affinity(
    items: DataFrame,
    header: DataFrame,
    products: DataFrame,
    config: AffinityConfig = CONFIG,
    frequent: DataFrame | None = None,
    pairs: DataFrame | None = None,
) -> DataFrame:
    """Scores of the product pairs that pass the three thresholds.

    Only the direction a -> b of a pair a <= b is tested.

    Baskets are paired after infrequent products are dropped (``frequent_products``), and
    of many pairs only those in frequent buckets are counted (``candidate_pairs``). The
    frequent products are written, so Spark knows their size when it chooses how to join them;
    this starts a job. Items are read twice and best passed as a written table.
    ``frequent`` and ``pairs``: what ``frequent_products`` and ``frequent_pairs``
    gave, if already written.
    """
    total = total_transactions(header)
    if frequent is None:
        frequent = write_once(frequent_products(items, header, config), "frequent_products")
    if pairs is None:
        pairs = candidate_pairs(items, header, frequent, config)
    # Names of the few remaining products only, however long the product master is.
    names = products.select("product_id", "product_name").join(frequent, "product_id", "left_semi")

    def side(name: str) -> list[DataFrame]:
        counted = frequent.toDF(f"product_{name}", f"count_{name}")
        return [counted, names.toDF(f"product_{name}", f"product_{name}_name")]

    scores = (
        pair_counts(pairs)
        .withColumn("total", total)
        .withColumn("support", F.col("pair_count") / F.col("total"))
        .filter(F.col("support") >= config.min_support)
    )
    (counts_a, names_a), (counts_b, names_b) = side("a"), side("b")
    return (
        scores.join(counts_a, "product_a")
        .join(counts_b, "product_b")
        .withColumns(
            {
                "confidence_a_to_b": F.col("pair_count") / F.col("count_a"),
                "confidence_b_to_a": F.col("pair_count") / F.col("count_b"),
                "p_b": F.col("count_b") / F.col("total"),
                "p_a": F.col("count_a") / F.col("total"),
            }
        )
        .withColumn("lift", F.col("confidence_a_to_b") / F.col("p_b"))
        .filter((F.col("confidence_a_to_b") >= config.min_confidence) & (F.col("lift") >= config.min_lift))
        .join(names_a, "product_a", "left")
        .join(names_b, "product_b", "left")
        .select(*SCORE_COLUMNS)
    )


def top_affinities(scores: DataFrame, n: int = CONFIG.top_n) -> DataFrame:
    """The n pairs of highest lift, ranked, with a recommendation text.

    Ties go by product ids. The rank window sees the n limited rows only.
    """
    order = [F.col("lift").desc(), F.col("product_a"), F.col("product_b")]
    names = [F.coalesce(F.col(f"product_{side}_name"), F.lit("nan")) for side in ("a", "b")]
    return (
        scores.orderBy(*order)
        .limit(n)
        .withColumn("rank", F.row_number().over(Window.orderBy(*order)))
        .select(
            "rank",
            "product_a",
            "product_a_name",
            "product_b",
            "product_b_name",
            F.round("support", 4).alias("support"),
            F.round("confidence_a_to_b", 4).alias("confidence_a_to_b"),
            F.round("lift", 4).alias("lift"),
            "pair_count",
            F.concat(F.lit("Customers who buy "), names[0], F.lit(" also buy "), names[1]).alias("recommendation"),
        )
    )


def basket_stats(lines: DataFrame, header: DataFrame, products: DataFrame) -> DataFrame:
    """One row: transactions, lines, products, sold products, baskets, mean basket size."""
    sizes = (
        lines.select("transaction_id", "product_id")
        .filter(F.col("transaction_id").isNotNull())
        .groupBy("transaction_id")
        .agg(F.count("*").alias("size"))
    )
    stats = sizes.agg(
        F.count("*").alias("baskets"),
        F.count_if(F.col("size") >= 2).alias("baskets_with_pairs"),
        F.avg("size").alias("mean_basket_size"),
    )
    sold = lines.agg(
        F.count("*").alias("total_line_items"),
        F.countDistinct("product_id").alias("unique_products_in_sales"),
    )
    return stats.select(
        header.agg(F.count("*")).scalar().alias("total_transactions"),
        products.agg(F.count("*")).scalar().alias("total_products"),
        "*",
        F.inline(F.array(sold.select(F.struct("*")).scalar())),
    )


def pair_totals(items: DataFrame, distinct: bool = False) -> DataFrame:
    """One row: pair rows of all baskets. A basket of n lines has n(n-1)/2, so nothing is paired."""
    size = "1" if distinct else "quantity_lines"
    return (
        items.groupBy("transaction_id")
        .agg(F.sum(F.expr(size)).alias("size"))
        .agg(F.sum(F.expr("size * (size - 1) div 2")).alias("total_product_pairs"))
    )


def basket_counters(distinct: bool = False) -> list[Column]:
    """Counters over ``baskets``: those of fewer than two lines have no pairs."""
    size = F.size("items").cast("long") if distinct else F.col("basket_size")
    return [F.sum(F.floor(size * (size - 1) / 2)).alias("total_product_pairs")]


def affinity_metrics(
    items: DataFrame, header: DataFrame, products: DataFrame, config: AffinityConfig = CONFIG
) -> DataFrame:
    """One row of run counters: pair rows, pairs above the thresholds, pairs returned. Starts a job, as ``affinity``."""
    rows = pair_totals(items, config.distinct)
    above = affinity(items, header, products, config).agg(F.count("*")).scalar()
    return rows.withColumns(
        {"pairs_above_thresholds": above, "total_transactions": header.agg(F.count("*")).scalar()}
    ).withColumn("top_affinities", F.least("pairs_above_thresholds", F.lit(config.top_n).cast("long")))
