"""Refund rules, detectors and tables, with null and zero traps and hot keys."""

from dataclasses import replace
from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelflens.config import FraudConfig
from shelflens.functions.quantiles import exact_quantiles
from shelflens.functions.rules import render_codes
from shelflens.operators import fraud as frd
from tests import seed
from tests.conftest import rows

REFUND = (
    "refund_id string, original_transaction_id long, customer_id long, refund_date date, refund_amount double, "
    "original_amount double, product_id string, payment_mode string, original_payment_mode string"
)


def refund(key, sale=1, customer=1, day=date(2024, 1, 20), amount=10.0, original=10.0, product="PRD001", mode="CASH", before="CASH"):
    return (key, sale, customer, day, amount, original, product, mode, before)


def enriched(spark, *data):
    df = spark.createDataFrame(list(data), REFUND)
    return frd.enrich_refunds(df, seed.header(spark), seed.customers(spark), seed.products(spark))


def text(df, key, column):
    return dict(rows(df.select(key, render_codes(F.col(column)))))


def test_enrichment(spark):
    df = enriched(
        spark,
        refund("plain"),
        refund("no sale", sale=99),
        refund("before sale", day=date(2024, 1, 1)),
        refund("free", original=0.0),
        refund("free and nothing", amount=0.0, original=0.0),
        refund("free and less", amount=-1.0, original=0.0),
    )
    found = {r["refund_id"]: (r["refund_ratio"], r["days_since_purchase"]) for r in df.collect()}
    assert found["plain"] == (1.0, 5)
    assert found["no sale"] == (1.0, 999)
    assert found["before sale"] == (1.0, -14)
    assert found["free"][0] == float("inf") and found["free and less"][0] == float("-inf")
    assert found["free and nothing"][0] is None
    assert {"customer_id_original", "payment_mode_original", "customer_tier", "category"} <= set(df.columns)


def test_validation_rules(spark):
    df = enriched(
        spark,
        refund("good"),
        refund("more", amount=11.0),
        refund("free", original=0.0),
        refund("nothing", amount=0.0, original=0.0),
        refund("other customer", customer=2),
        refund("no customer", customer=None),
        refund("no sale", sale=99),
        refund("late", day=date(2024, 2, 15)),
        refund("last day", day=date(2024, 2, 14)),
        refund("payment", mode="CARD"),
        refund("no payment", before=None),
    )
    assert text(frd.validate_refunds(df), "refund_id", "validation_errors") == {
        "good": "",
        "more": "AMOUNT_EXCEEDED; ",
        "free": "AMOUNT_EXCEEDED; ",
        "nothing": "",
        "other customer": "CUSTOMER_MISMATCH; ",
        "no customer": "CUSTOMER_MISMATCH; ",
        "no sale": "CUSTOMER_MISMATCH; OUTSIDE_WINDOW; ",
        "late": "OUTSIDE_WINDOW; ",
        "last day": "",
        "payment": "PAYMENT_MISMATCH; ",
        "no payment": "PAYMENT_MISMATCH; ",
    }
    relaxed = FraudConfig(require_customer_match=False, require_payment_mode_match=False, max_refund_ratio=2.0)
    errors = text(frd.validate_refunds(df, relaxed), "refund_id", "validation_errors")
    assert {k for k, v in errors.items() if v} == {"free", "no sale", "late"}


def test_counts_ignore_null_keys(spark):
    data = [refund(f"r{i}", customer=None) for i in range(5)]
    data += [refund(f"s{i}", product=None) for i in range(4)] + [refund("t", customer=2)]
    scored = frd.fraud_patterns(frd.validate_refunds(enriched(spark, *data)))
    found = {r["refund_id"]: (r["refund_count"], r["product_refund_count"]) for r in scored.collect()}
    assert found["r0"] == (None, None) and found["s0"] == (4, None) and found["t"] == (1, 1)
    flags = text(scored, "refund_id", "fraud_flags")
    assert flags["r0"] == "" and flags["s0"] == "HIGH_FREQUENCY; "


def test_points_add_up_and_bins(spark):
    scored = frd.score_refunds(seed.refunds(spark), seed.header(spark), seed.customers(spark), seed.products(spark))
    for row in scored.collect():
        assert row["fraud_score"] == sum(frd.POINTS[f] for f in row["fraud_flags"])
    bins = spark.createDataFrame([(s,) for s in (0, 1, 30, 31, 60, 61)], "fraud_score int")
    assert [r["fraud_severity"] for r in frd.severity(bins).orderBy("fraud_score").collect()] == [
        "CLEAN", "LOW", "LOW", "MEDIUM", "MEDIUM", "HIGH",
    ]


def test_switches(spark):
    validated = frd.validate_refunds(enriched(spark, refund("a", amount=1000.0, mode="CARD")))
    quiet = FraudConfig(amount_exceeded_enabled=False, payment_mismatch_enabled=False, anomaly_enabled=False)
    flagged = frd.statistical_anomalies(frd.fraud_patterns(validated, quiet), quiet)
    assert text(flagged, "refund_id", "fraud_flags") == {"a": "HIGH_VALUE; "}
    # A single amount has no deviation, so its score is 0 and not null.
    single = frd.statistical_anomalies(frd.fraud_patterns(validated, FraudConfig()), FraudConfig())
    assert single.first()["zscore_amount"] == 0.0


def test_recent_counts_against_brute_force(spark):
    draw = np.random.default_rng(5)
    start = date(2024, 1, 1)
    data = [
        refund(f"r{i}", customer=int(draw.integers(1, 4)), day=start + timedelta(days=int(draw.integers(0, 120))), amount=float(draw.integers(1, 50)))
        for i in range(150)
    ]
    config = replace(
        FraudConfig(), refund_window_days=30, product_window_days=60, high_value_frequent_enabled=True,
        high_value_frequent_amount=100.0, outside_window_enabled=True,
    )
    scored = frd.fraud_patterns(frd.validate_refunds(enriched(spark, *data), config), config)
    found = {r["refund_id"]: r for r in scored.collect()}
    assert len(found) == len(data)
    for key, _, customer, day, *_ in data:
        near = [o for o in data if o[2] == customer and day - timedelta(days=30) <= o[3] <= day]
        row = found[key]
        assert row["refund_count"] == len(near)
        assert ("HIGH_VALUE_FREQUENT" in row["fraud_flags"]) == (len(near) >= 2 and sum(o[4] for o in near) >= 100)
        assert ("OUTSIDE_WINDOW" in row["fraud_flags"]) == (row["days_since_purchase"] > 30)


def test_hot_customer_stays_whole(spark):
    """A third of all refunds belong to one customer and product."""
    data = [refund(f"h{i}", customer=1) for i in range(300)]
    data += [refund(f"c{i}", customer=2 + i % 10, product=f"PRD{i % 7:03d}") for i in range(600)]
    scored = frd.fraud_patterns(frd.validate_refunds(enriched(spark, *data)))
    assert scored.count() == 900
    assert scored.filter("refund_id LIKE 'h%' AND refund_count = 300 AND product_refund_count = 300").count() == 300


@pytest.mark.parametrize("kind", ["normal", "ties", "tails", "tiny"])
def test_quantiles_match_numpy(spark, kind):
    draw = np.random.default_rng(11)
    values = {
        "normal": draw.normal(0, 100, 2000),
        "ties": draw.integers(-3, 4, 999).astype(float),
        "tails": np.exp(draw.normal(0, 8, 1500)) * draw.choice([-1, 1], 1500),
        "tiny": np.array([5.0, 7.0]),
    }[kind]
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,), (float("nan"),)], "v double")
    wanted = [0.0, 0.01, 0.25, 0.5, 0.75, 0.999, 1.0]
    found = exact_quantiles(df, "v", wanted).first()
    assert list(found) == pytest.approx(list(np.quantile(values, wanted)), rel=1e-12, abs=1e-12)


def test_quantile_of_nothing_is_null(spark):
    assert exact_quantiles(spark.createDataFrame([], "v double"), "v", [0.5]).first()["q0"] is None


def test_suspicious_customers_of_doubled_master(spark):
    customers = seed.customers(spark)
    scored = frd.score_refunds(seed.refunds(spark), seed.header(spark), customers.union(customers), seed.products(spark))
    table = frd.suspicious_customers(scored, customers.union(customers))
    worst = table.filter("customer_id = 12").first()
    assert worst["total_refunds_count"] == 8  # every refund twice, as the join gives them
    assert table.count() == table.select("customer_id").distinct().count()


def test_equal_windows_join_once(spark):
    """A frequent window as long as the refund window is joined once, with the same columns and counts."""
    data = [refund(f"r{i}", customer=1 + i % 3, day=date(2024, 1, 1) + timedelta(days=i % 40), amount=60.0) for i in range(30)]
    validated = frd.validate_refunds(enriched(spark, *data))
    config = replace(FraudConfig(), refund_window_days=30, product_window_days=60, high_value_frequent_enabled=True)
    same, apart = frd.fraud_patterns(validated, config), frd.fraud_patterns(validated, replace(config, high_value_frequent_days=31))

    def joins(df):
        return str(df._jdf.queryExecution().optimizedPlan()).count("Join LeftOuter")

    assert joins(same) == joins(apart) - 1
    assert same.columns == apart.columns
    assert same.filter("recent_count IS DISTINCT FROM refund_count").count() == 0
    assert same.filter("recent_amount IS NULL").count() == 0
