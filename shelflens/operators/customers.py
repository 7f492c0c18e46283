"""Recency, frequency, value scores, churn state, segment and lifetime value."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelflens.config import CustomerConfig

CONFIG = CustomerConfig()


def last_day(history: DataFrame) -> Column:
    """Day of the newest purchase, the default day to count recency from."""
    return history.agg(F.max(F.to_date("date"))).scalar()


def customer_base(history: DataFrame, customers: DataFrame | None = None, as_of: Column | None = None) -> DataFrame:
    """Per customer: days since the last purchase, purchases, amount spent, tenure in days.

    With ``customers`` given, those without a purchase appear with null recency
    and zeros. Everything is one aggregate, reduced before its shuffle.
    """
    day = F.to_date("date")
    as_of = last_day(history) if as_of is None else as_of
    base = (
        history.filter(F.col("customer_id").isNotNull())
        .groupBy("customer_id")
        .agg(
            F.max(day).alias("_last"),
            F.min(day).alias("_first"),
            F.count("*").alias("frequency"),
            F.sum("amount").alias("monetary"),
        )
        .select(
            "customer_id",
            F.datediff(as_of, "_last").alias("recency_days"),
            "frequency",
            "monetary",
            F.datediff(as_of, "_first").alias("tenure_days"),
        )
    )
    if customers is None:
        return base
    return (
        customers.select("customer_id")
        .dropna()
        .distinct()
        .join(base, "customer_id", "left")
        .fillna({"frequency": 0, "monetary": 0.0})
    )


def _steps(value: Column, points: tuple, ascending: bool) -> Column:
    """1..5 by the cut points; ``ascending`` gives 5 to the highest values."""
    if ascending:
        tests = [(value >= p, i + 2) for i, p in enumerate(points)][::-1]
    else:
        tests = [(value < points[0], 5), *[(value <= p, 4 - i) for i, p in enumerate(points[1:])]]
    chain = reduce(lambda c, t: c.when(*t), tests[1:], F.when(*tests[0]))
    return chain.otherwise(1)


def rfm_scores(base: DataFrame, config: CustomerConfig = CONFIG) -> DataFrame:
    """Add scores 1..5 and their sum; a customer without a purchase scores 0."""
    bought = F.col("frequency") > 0
    scores = {
        "r_score": _steps(F.col("recency_days"), config.recency_days, ascending=False),
        "f_score": _steps(F.col("frequency"), config.frequency, ascending=True),
        "m_score": _steps(F.col("monetary"), config.monetary, ascending=True),
    }
    scored = base.withColumns({name: F.when(bought, s).otherwise(0) for name, s in scores.items()})
    return scored.withColumn("rfm_score", F.col("r_score") + F.col("f_score") + F.col("m_score"))


def churn_status(base: DataFrame, config: CustomerConfig = CONFIG) -> DataFrame:
    """Add ``churn_status`` by days since the last purchase; no purchase is churned."""
    days = F.col("recency_days")
    active, risk, churning = config.churn_days
    status = (
        F.when(days < active, "ACTIVE").when(days < risk, "AT_RISK").when(days <= churning, "CHURNING")
    ).otherwise("CHURNED")
    return base.withColumn("churn_status", status)


def segments(scored: DataFrame) -> DataFrame:
    """Add ``segment`` by the sum of the three scores."""
    total = F.col("rfm_score")
    names = (
        F.when(total >= 9, "CHAMPIONS")
        .when(total >= 7, "LOYAL CUSTOMERS")
        .when(total >= 5, "POTENTIAL LOYALISTS")
        .when(total >= 3, "AT RISK")
        .otherwise("LOST")
    )
    return scored.withColumn("segment", names)


def lifetime_value(scored: DataFrame, config: CustomerConfig = CONFIG) -> DataFrame:
    """Add ``clv``: predicted annual revenue x weight of the scores x profit margin.

    Annual revenue is the amount spent per day of tenure x 365, with a tenure of
    at least 365 days; the weight is the score sum over its maximum of 15.
    """
    tenure = F.greatest(F.coalesce("tenure_days", F.lit(0)), F.lit(365))
    annual = F.col("monetary") * 365 / tenure
    return scored.withColumns(
        {"annual_revenue": annual, "clv": annual * (F.col("rfm_score") / 15) * config.profit_margin}
    )


def segment_distribution(segmented: DataFrame) -> DataFrame:
    """Customers and their percentage per segment; the total is summed over the few segments."""
    counts = segmented.groupBy("segment").agg(F.count("*").alias("customers"))
    total = segmented.agg(F.count("*")).scalar()
    return counts.withColumn("percent", F.round(F.col("customers") * 100.0 / total, 1))
