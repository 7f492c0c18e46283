"""Sketches against exact quantiles and counts, whole, in halves and by day."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from shelflens.config import FraudConfig
from shelflens.functions import sketches
from shelflens.operators import affinity as aff
from shelflens.operators import fraud as frd

SHARES = [0.01, 0.25, 0.5, 0.75, 0.99]


@pytest.fixture(scope="module")
def values(spark):
    """Skewed values with many ties."""
    x = F.when(F.col("id") % 3 == 0, F.lit(5.0)).otherwise(F.pow(F.col("id") % 9973, F.lit(2.0)))
    return spark.range(0, 200_000, 1, 8).select("id", x.alias("x")).checkpoint()


def ranks_hold(df, found, error):
    n = df.count()
    for p, q in zip(SHARES, found):
        low, high = df.agg(F.count_if(F.col("x") < q), F.count_if(F.col("x") <= q)).first()
        assert low <= (p + error) * n and high >= (p - error) * n, (p, q)


@pytest.mark.parametrize("error", [0.01, 0.001])
def test_rank_error(values, error):
    ranks_hold(values, sketches.approximate_quantiles(values, "x", SHARES, error).first(), error)


def test_halves_merged_hold_the_bound_of_the_whole(values):
    halves = values.groupBy((F.col("id") < 70_000).alias("half")).agg(sketches.quantile_sketch(F.col("x"), 0.005).alias("sketch"))
    assert halves.count() == 2
    merged = halves.agg(sketches.merged_quantile_sketch("sketch", 0.005).alias("s"))
    ranks_hold(values, merged.select(*sketches.quantiles(F.col("s"), SHARES)).first(), 0.005)


def test_one_pass_and_one_exchange(values):
    plan = sketches.approximate_quantiles(values, "x", SHARES)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.count("Scan") == 1


def test_nothing_null_and_nan(spark):
    df = spark.createDataFrame([(None,), (float("nan"),)], "x double")
    assert list(sketches.approximate_quantiles(df, "x", [0.5]).first()) == [None]
    assert sketches.approximate_quantiles(df.union(spark.createDataFrame([(3.0,)], "x double")), "x", [0.5]).first()[0] == 3.0


def test_sizes_for_errors():
    assert sketches.rank_error(sketches.k_for(0.01)) <= 0.01 < sketches.rank_error(sketches.k_for(0.01) - 2)
    assert sketches.lg_for(0.01) == 14 and sketches.lg_for(0.02) == 12
    for wrong in (lambda: sketches.k_for(1e-9), lambda: sketches.lg_for(1e-9)):
        with pytest.raises(ValueError):
            wrong()


@pytest.fixture(scope="module")
def refunds(spark):
    day = F.date_add(F.lit("2024-01-20"), (F.col("id") % 30).cast("int"))
    amount = F.when(F.col("id") % 50 != 0, F.pow(F.col("id") % 997, F.lit(1.5)))
    return spark.range(0, 20_000, 1, 4).select(day.alias("refund_date"), amount.alias("refund_amount")).checkpoint()


def test_days_merge_into_any_span(refunds):
    days = frd.daily_amounts(refunds, 0.002).checkpoint()
    assert days.count() == 30
    spans = frd.amount_stats_of(days, F.month("refund_day").alias("m"), error=0.002).collect()
    for got in spans:
        want = frd.amount_stats(refunds.filter(F.month("refund_date") == got.m)).first()
        assert got.amounts == want.amounts
        assert (got.mean_amount, got.std_amount) == pytest.approx((want.mean_amount, want.std_amount))
        assert (got.q1, got.q3) == pytest.approx((want.q1, want.q3), rel=0.02)
    # A day that is added later gives the same as all days at once.
    first, rest = frd.daily_amounts(refunds.filter("refund_date < '2024-02-01'"), 0.002), frd.daily_amounts(refunds.filter("refund_date >= '2024-02-01'"), 0.002)
    both, whole = (frd.amount_stats_of(d, F.lit(1).alias("one"), error=0.002).first() for d in (first.union(rest), days))
    assert (both.amounts, both.mean_amount, both.std_amount) == pytest.approx((whole.amounts, whole.mean_amount, whole.std_amount))


def test_days_without_amounts(spark):
    none = spark.createDataFrame([(None, None), (None, 2.0)], "refund_date date, refund_amount double")
    found = frd.amount_stats_of(frd.daily_amounts(none.limit(1)), F.lit(1).alias("one")).first()
    assert (found.amounts, found.mean_amount, found.std_amount, found.q1) == (0, None, None, None)


def test_quartiles_of_a_run_by_sketch(refunds):
    allowed = replace(FraudConfig(), quartile_rank_error=0.001)
    exact, near = frd.amount_stats(refunds).first(), frd.amount_stats(refunds, allowed).first()
    assert (near.q1, near.q3) == pytest.approx((exact.q1, exact.q3), rel=0.02) and near.mean_amount == exact.mean_amount


def test_product_counts_by_day(spark):
    lines = spark.range(0, 60_000, 1, 4).select((F.col("id") % 20_000).alias("transaction_id"), F.concat(F.lit("p"), F.col("id") % 7).alias("product_id"))
    header = spark.range(20_000).select(F.col("id").alias("transaction_id"), F.date_add(F.lit("2024-01-01"), (F.col("id") % 10).cast("int")).alias("sale_date"))
    days = aff.daily_baskets(lines, header, 0.01).checkpoint()
    assert days.count() == 70
    exact = {r.product_id: r.product_count for r in aff.product_counts(aff.basket_items(lines)).collect()}
    for r in aff.approximate_product_counts(days).collect():
        assert abs(r.product_count - exact[r.product_id]) <= 0.04 * exact[r.product_id]
    week = aff.approximate_product_counts(days.filter("sale_day < '2024-01-08'")).collect()
    assert len(week) == 7 and all(r.product_count < exact[r.product_id] for r in week)
