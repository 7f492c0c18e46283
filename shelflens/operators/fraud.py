"""Refund enrichment, validation, fraud detectors, severity and result tables.

Behaviour counts are aggregates joined back rather than windows: a window would
put all refunds of one customer into one task, while an aggregate is reduced
before its shuffle. The aggregate is written before the join: Spark then knows
its size, broadcasts it only if small, and else shuffles both sides for this
join, so that AQE can split a customer that holds many of the refunds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelflens.config import FraudConfig
from shelflens.functions.numbers import differs, holds, ratio, right_closed_bins
from shelflens.functions.quantiles import exact_quantiles
from shelflens.functions.rules import Rule, apply_rules, has_code, is_invalid, is_valid, present, render_all
from shelflens.functions.sketches import approximate_quantiles, merged_quantile_sketch, quantile_sketch, quantiles
from shelflens.operators.inventory import keep_existing
from shelflens.sources.shared import write_once

CONFIG = FraudConfig()

UNMATCHED_DAYS = 999

# Points of the detectors.
POINTS = {
    "HIGH_FREQUENCY": 30,
    "HIGH_VALUE": 20,
    "REPEAT_PRODUCT": 25,
    "AMOUNT_EXCEEDED": 50,
    "PAYMENT_MISMATCH": 15,
    "ZSCORE_ANOMALY": 20,
    "IQR_ANOMALY": 15,
    "HIGH_REFUND_RATIO": 25,
}
# Points of the two optional detectors are a choice of this library.
OPTIONAL_POINTS = {"HIGH_VALUE_FREQUENT": 40, "OUTSIDE_WINDOW": 15}

# Output columns, in order.
FRAUD_COLUMNS = [
    "refund_id",
    "original_transaction_id",
    "customer_id",
    "customer_name",
    "refund_date",
    "refund_amount",
    "original_amount",
    "refund_ratio",
    "product_id",
    "product_name",
    "payment_mode",
    "original_payment_mode",
    "days_since_purchase",
    "refund_count",
    "product_refund_count",
    "validation_status",
    "validation_errors",
    "fraud_flags",
    "fraud_score",
    "fraud_severity",
]

# Output columns, in order.
CLEAN_COLUMNS = [
    "refund_id",
    "original_transaction_id",
    "customer_id",
    "refund_date",
    "refund_amount",
    "product_id",
    "refund_reason",
]


def enrich_refunds(refunds: DataFrame, header: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    """Refunds with their sale, customer and product, refund ratio and days since the sale.

    Sale columns that a refund also has get the suffix ``_original``. A refund
    without a sale counts as 999 days late.
    """
    sale_columns = ["transaction_id", "customer_id", "sale_date", "total_amount", "payment_mode"]
    renames = {c: f"{c}_original" for c in sale_columns if c in refunds.columns}
    sales = header.select(*sale_columns).withColumnsRenamed(renames)
    buyers = customers.select(
        "customer_id", "customer_name", "customer_tier", "total_purchases", "total_refunds", "account_status"
    )
    goods = products.select("product_id", "product_name", "category")
    days = F.datediff(F.to_date("refund_date"), F.to_date("sale_date"))
    return (
        refunds.join(sales, F.col("original_transaction_id") == F.col("transaction_id"), "left")
        .join(buyers, "customer_id", "left")
        .join(goods, "product_id", "left")
        .withColumns(
            {
                "refund_ratio": ratio(F.col("refund_amount"), F.col("original_amount")),
                "days_since_purchase": F.coalesce(days, F.lit(UNMATCHED_DAYS)),
            }
        )
    )


def _payment_differs() -> Column:
    return differs(F.col("payment_mode"), F.col("original_payment_mode"))


def validate_refunds(enriched: DataFrame, config: FraudConfig = CONFIG) -> DataFrame:
    """Add codes and status; a null on either side of a match counts as a mismatch."""
    rules = [Rule("AMOUNT_EXCEEDED", holds(F.col("refund_ratio") > config.max_refund_ratio))]
    if config.require_customer_match:
        rules.append(Rule("CUSTOMER_MISMATCH", differs(F.col("customer_id"), F.col("customer_id_original"))))
    rules.append(Rule("OUTSIDE_WINDOW", holds(F.col("days_since_purchase") > config.allowed_refund_window_days)))
    if config.require_payment_mode_match:
        rules.append(Rule("PAYMENT_MISMATCH", _payment_differs()))
    return apply_rules(enriched, rules)


def refund_behaviour(refunds: DataFrame) -> DataFrame:
    """Per customer and product: refunds of both, refunds and refund sum of the customer.

    The product figures are written, since the customer figures are summed from
    them and joined back: both are reduced before they are shuffled, and the join
    can split a customer with many products, which a window could not. Rows
    without a customer have no behaviour. Starts a job.
    """
    products = write_once(
        refunds.filter(F.col("customer_id").isNotNull())
        .groupBy("customer_id", "product_id")
        .agg(F.count("*").alias("product_refund_count"), F.sum("refund_amount").alias("_amount")),
        "refunds_by_product",
    )
    customers = products.groupBy("customer_id").agg(
        F.sum("product_refund_count").alias("refund_count"),
        F.coalesce(F.sum("_amount"), F.lit(0.0)).alias("customer_refund_amount"),
    )
    # Rebalanced, so that beyond broadcast size the join shuffles both of its sides and AQE can split a customer.
    return products.join(customers.hint("rebalance"), "customer_id").select(
        "customer_id",
        "product_id",
        F.when(F.col("product_id").isNotNull(), F.col("product_refund_count")).alias("product_refund_count"),
        "refund_count",
        "customer_refund_amount",
    )


def join_behaviour(df: DataFrame, behaviour: DataFrame) -> DataFrame:
    """Behaviour columns on every refund, also where the product is null."""
    known = behaviour.withColumnsRenamed({"customer_id": "_customer", "product_id": "_product"})
    match = (F.col("customer_id") == F.col("_customer")) & F.col("product_id").eqNullSafe(F.col("_product"))
    return df.join(known, match, "left").drop("_customer", "_product")


def recent_refunds(refunds: DataFrame, keys: list[str], days: int) -> DataFrame:
    """Refund count and sum per key over the ``days`` up to each day with refunds.

    Refunds are summed per key and day first, so the sliding window sees one row
    per calendar day and key.
    """
    day = F.to_date("refund_date")
    span = Window.partitionBy(*keys).orderBy(F.unix_date("refund_day")).rangeBetween(-days, Window.currentRow)
    return (
        refunds.dropna(subset=keys)
        .groupBy(*keys, day.alias("refund_day"))
        .agg(F.count("*").alias("day_count"), F.sum("refund_amount").alias("day_amount"))
        .filter(F.col("refund_day").isNotNull())
        .select(
            *keys,
            "refund_day",
            F.sum("day_count").over(span).alias("recent_count"),
            F.sum("day_amount").over(span).alias("recent_amount"),
        )
    )


def _join_recent(df: DataFrame, refunds: DataFrame, keys: list[str], days: int, count: str, amount: str | None = None) -> DataFrame:
    recent = write_once(recent_refunds(refunds, keys, days), "recent_refunds").withColumnsRenamed(
        {"recent_count": count, "recent_amount": amount or "_unused"}
    )
    df = df.withColumn("refund_day", F.to_date("refund_date"))
    return df.join(recent, [*keys, "refund_day"], "left").drop("refund_day", "_unused")


def _add_flags(df: DataFrame, detectors: dict[str, Column]) -> DataFrame:
    points = {**POINTS, **OPTIONAL_POINTS}
    flags = present([(hit, code) for code, hit in detectors.items()])
    score = F.lit(0)
    for code, hit in detectors.items():
        score = score + F.when(hit, points[code]).otherwise(0)
    if "fraud_flags" in df.columns:
        flags, score = F.concat("fraud_flags", flags), F.col("fraud_score") + score
    return df.withColumns({"fraud_flags": flags, "fraud_score": score})


def fraud_patterns(
    validated: DataFrame, config: FraudConfig = CONFIG, refunds: DataFrame | None = None
) -> DataFrame:
    """Flags and points of the behaviour and value rules.

    Counts are taken over ``refunds`` if given, else over ``validated``. Where
    the enrichment is not a written table, passing the plain refunds spares its
    joins a second run; it gives the same counts as long as the keys of the
    joined tables are unique.
    """
    base = validated if refunds is None else refunds
    df = join_behaviour(validated, write_once(refund_behaviour(base), "refund_behaviour"))
    # A frequent window as long as the refund window is the same table: joined once, each wide row is shuffled once less.
    shared = config.high_value_frequent_enabled and config.high_value_frequent_days == config.refund_window_days
    if shared:
        df = _join_recent(df.drop("refund_count"), base, ["customer_id"], config.refund_window_days, "recent_count", "recent_amount")
        df = df.withColumn("refund_count", F.col("recent_count"))
    elif config.refund_window_days is not None:
        df = _join_recent(df.drop("refund_count"), base, ["customer_id"], config.refund_window_days, "refund_count")
    if config.product_window_days is not None:
        df = _join_recent(
            df.drop("product_refund_count"),
            base,
            ["customer_id", "product_id"],
            config.product_window_days,
            "product_refund_count",
        )
    if shared:
        df = df.select(*[c for c in df.columns if c not in ("recent_count", "recent_amount")], "recent_count", "recent_amount")
    elif config.high_value_frequent_enabled:
        df = _join_recent(
            df, base, ["customer_id"], config.high_value_frequent_days, "recent_count", "recent_amount"
        )
    return pattern_flags(df, config)


def pattern_flags(df: DataFrame, config: FraudConfig = CONFIG) -> DataFrame:
    """Flags and points of the behaviour and value rules, from counts that stand beside every refund."""
    detectors = {
        "HIGH_FREQUENCY": holds(F.col("refund_count") > config.max_refunds),
        "HIGH_VALUE": holds(F.col("refund_amount") > config.high_value_amount),
        "REPEAT_PRODUCT": holds(F.col("product_refund_count") > config.max_same_product_refunds),
    }
    if config.amount_exceeded_enabled:
        detectors["AMOUNT_EXCEEDED"] = holds(F.col("refund_ratio") > 1.0)
    if config.payment_mismatch_enabled:
        detectors["PAYMENT_MISMATCH"] = _payment_differs()
    if config.high_value_frequent_enabled:
        detectors["HIGH_VALUE_FREQUENT"] = holds(
            (F.col("recent_count") >= config.high_value_frequent_refunds)
            & (F.col("recent_amount") >= config.high_value_frequent_amount)
        )
    if config.outside_window_enabled:
        detectors["OUTSIDE_WINDOW"] = holds(F.col("days_since_purchase") > config.allowed_refund_window_days)
    return _add_flags(df, detectors)


def _quartiles(refunds: DataFrame, config: FraudConfig) -> DataFrame:
    """One row ``q0, q1``: exact quartiles, or by a sketch if a rank error is allowed."""
    shares = [0.25, 0.75]
    if config.quartile_rank_error is None:
        return exact_quantiles(refunds, "refund_amount", shares)
    return approximate_quantiles(refunds, "refund_amount", shares, config.quartile_rank_error)


def amount_stats(refunds: DataFrame, config: FraudConfig = CONFIG) -> DataFrame:
    """One row: mean, sample deviation, quartiles and count of the refund amount."""
    quartiles = _quartiles(refunds, config).select(F.struct("q0", "q1")).scalar()
    return refunds.agg(
        F.avg("refund_amount").alias("mean_amount"),
        F.stddev_samp("refund_amount").alias("std_amount"),
        F.count("refund_amount").alias("amounts"),
    ).select("*", F.inline(F.array(quartiles)).alias("q1", "q3"))


def daily_amounts(refunds: DataFrame, error: float = 0.001) -> DataFrame:
    """Per day of refunds what statistics of the amounts for any span of days are made from.

    ``refund_day, amounts, mean, squares`` (sum of squared deviations from the day's
    mean) and a quantile ``sketch``. New days are added to the table, and a day that
    changed is replaced; no refund is read again.
    """
    amount = F.col("refund_amount")
    return refunds.groupBy(F.to_date("refund_date").alias("refund_day")).agg(
        F.count(amount).alias("amounts"),
        F.avg(amount).alias("mean"),
        (F.var_pop(amount) * F.count(amount)).alias("squares"),
        quantile_sketch(amount, error).alias("sketch"),
    )


def amount_stats_of(days: DataFrame, *keys: Column, error: float = 0.001) -> DataFrame:
    """As ``amount_stats`` for each key, from rows of ``daily_amounts`` made with the same error.

    Count, mean and deviation are exact, quartiles have a rank that is off by ``error``
    at most.
    """
    n, total = F.sum("amounts"), F.sum(F.col("amounts") * F.col("mean"))
    between = F.sum(F.col("amounts") * F.col("mean") * F.col("mean")) - total * total / n
    merged = days.groupBy(*keys).agg(
        F.when(n > 0, total / n).alias("mean_amount"),
        F.when(n > 1, F.sqrt(F.greatest(F.sum("squares") + between, F.lit(0.0)) / (n - 1))).alias("std_amount"),
        F.coalesce(n, F.lit(0)).alias("amounts"),
        merged_quantile_sketch("sketch", error).alias("_sketch"),
    )
    q1, q3 = quantiles(F.col("_sketch"), [0.25, 0.75])
    return merged.withColumns({"q1": q1, "q3": q3}).drop("_sketch")


def statistical_anomalies(
    scored: DataFrame, config: FraudConfig = CONFIG, refunds: DataFrame | None = None
) -> DataFrame:
    """Flags and points of the outlier detectors, against statistics of all refunds.

    The statistics enter as scalar subqueries, computed once. ``refunds`` as in
    ``fraud_patterns``; needs the behaviour columns of that step.
    """
    if not config.anomaly_enabled:
        return scored
    base = scored if refunds is None else refunds
    amount = F.col("refund_amount")
    df, detectors = scored, {}
    if config.zscore_enabled:
        spread = base.agg(F.struct(F.avg("refund_amount").alias("mean"), F.stddev_samp("refund_amount").alias("std")))
        df = df.withColumn("_spread", spread.scalar())
        mean, std = F.col("_spread.mean"), F.col("_spread.std")
        df = df.withColumn("zscore_amount", F.when(holds(std > 0), (amount - mean) / std).otherwise(0.0))
        detectors["ZSCORE_ANOMALY"] = holds(F.abs("zscore_amount") > config.zscore_threshold)
    if config.iqr_enabled:
        quartiles = _quartiles(base, config).select(F.struct("q0", "q1"))
        df = df.withColumn("_quartiles", quartiles.scalar())
        q1, q3 = F.col("_quartiles.q0"), F.col("_quartiles.q1")
        reach = (q3 - q1) * config.iqr_multiplier
        detectors["IQR_ANOMALY"] = holds((amount < q1 - reach) | (amount > q3 + reach))
    if config.refund_ratio_enabled:
        df = df.withColumn(
            "customer_refund_ratio",
            F.when(
                F.col("customer_id").isNotNull(),
                F.coalesce(ratio(F.col("customer_refund_amount"), F.col("total_purchases")), F.lit(0.0)),
            ),
        )
        detectors["HIGH_REFUND_RATIO"] = holds(F.col("customer_refund_ratio") > config.max_customer_refund_ratio)
    return _add_flags(df, detectors).drop("_spread", "_quartiles") if detectors else df


def severity(df: DataFrame) -> DataFrame:
    """Add ``fraud_severity`` from the score: 0, up to 30, up to 60, above."""
    labels = ["CLEAN", "LOW", "MEDIUM", "HIGH"]
    return df.withColumn("fraud_severity", right_closed_bins(F.col("fraud_score"), [0, 30, 60], labels))


def score_refunds(
    refunds: DataFrame, header: DataFrame, customers: DataFrame, products: DataFrame, config: FraudConfig = CONFIG
) -> DataFrame:
    """Enrichment, validation, all detectors and severity.

    The enriched refunds are written once: the behaviour counts and statistics
    read a few columns of that table instead of repeating the joins.
    """
    enriched = write_once(enrich_refunds(refunds, header, customers, products), "enriched_refunds")
    validated = validate_refunds(enriched, config)
    return severity(statistical_anomalies(fraud_patterns(validated, config), config, enriched))


def fraud_flags(
    scored: DataFrame, config: FraudConfig = CONFIG, stamped: bool = True, ordered: bool = True
) -> DataFrame:
    """All refunds with codes and flags as text, highest score first."""
    df = render_all(keep_existing(scored, FRAUD_COLUMNS), "validation_errors", "fraud_flags")
    if stamped:
        df = df.withColumn("detection_timestamp", F.current_timestamp())
    df = df.withColumn("pipeline_version", F.lit(config.version))
    return df.orderBy(F.col("fraud_score").desc(), "refund_id") if ordered else df


def suspicious_customers(scored: DataFrame, customers: DataFrame, ordered: bool = True) -> DataFrame:
    """Customers with points: refunds, amount, total score, union of flags, risk level.

    The union of flags is one maximum per flag, so the aggregate has a fixed size
    and no list of a customer's refunds is gathered. Names are joined to the
    customers that remain.
    """
    # A column of numbers per flag: the group by stays a hash aggregate.
    codes = [*POINTS, *OPTIONAL_POINTS]
    hits = [F.max(has_code(code, "fraud_flags").cast("int")).alias(code) for code in codes]
    totals = (
        scored.filter(F.col("customer_id").isNotNull())
        .groupBy("customer_id")
        .agg(
            F.count("refund_id").alias("total_refunds_count"),
            F.coalesce(F.sum("refund_amount"), F.lit(0.0)).alias("total_refund_amount"),
            F.sum("fraud_score").alias("total_fraud_score"),
            *hits,
        )
        .filter(F.col("total_fraud_score") > 0)
    )
    owners = (
        customers.filter(F.col("customer_id").isNotNull())
        .groupBy("customer_id")
        .agg(*[F.min(c).alias(c) for c in ("customer_name", "customer_tier", "account_status")])
    )
    labels = ["LOW_RISK", "MEDIUM_RISK", "HIGH_RISK", "CRITICAL_RISK"]
    names = F.concat_ws("; ", *[F.when(F.col(code) == 1, F.lit(code)) for code in sorted(codes)])
    df = totals.join(owners, "customer_id", "left").select(
        "customer_id",
        "customer_name",
        "customer_tier",
        "account_status",
        "total_refunds_count",
        "total_refund_amount",
        "total_fraud_score",
        names.alias("all_fraud_flags"),
        right_closed_bins(F.col("total_fraud_score"), [30, 60, 100], labels).alias("risk_level"),
    )
    return df.orderBy(F.col("total_fraud_score").desc(), "customer_id") if ordered else df


def clean_refunds(scored: DataFrame) -> DataFrame:
    """Refunds without any fraud flag; they may still be invalid."""
    return keep_existing(scored.filter(F.col("fraud_severity") == "CLEAN"), CLEAN_COLUMNS)


def fraud_counters() -> list[Column]:
    """Run counters but for that of the suspicious customers."""

    def code(name: str) -> Column:
        return F.count_if(has_code(name)).alias(f"invalid_{name.lower()}")

    def flag(name: str) -> Column:
        return F.count_if(has_code(name, "fraud_flags")).alias(f"flag_{name.lower()}")

    return [
        F.count("*").alias("total_refunds"),
        F.count_if(is_valid()).alias("valid_refunds"),
        F.count_if(is_invalid()).alias("invalid_refunds"),
        *[code(c) for c in ("AMOUNT_EXCEEDED", "CUSTOMER_MISMATCH", "OUTSIDE_WINDOW", "PAYMENT_MISMATCH")],
        *[flag(c) for c in POINTS],
        F.count_if(F.col("fraud_score") > 0).alias("total_fraud_flags"),
        F.count_if(F.col("fraud_severity") == "CLEAN").alias("clean_refunds"),
    ]


def fraud_metrics(scored: DataFrame) -> DataFrame:
    """One row of run counters."""
    risky = F.when(F.col("fraud_score") > 0, F.col("customer_id"))
    return scored.agg(*fraud_counters(), F.count_distinct(risky).alias("suspicious_customers"))
