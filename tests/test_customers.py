"""Customer scores, churn, segments and value."""

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from shelflens.operators import customers as cus
from shelflens.plans.runs import run_customers
from tests.conftest import rows

TODAY = date(2024, 6, 30)


def purchases(spark, data):
    """Rows of (customer, days ago, amount)."""
    return spark.createDataFrame(
        [(c, i, TODAY - timedelta(days=d), float(a)) for i, (c, d, a) in enumerate(data)],
        "customer_id long, transaction_id long, date date, amount double",
    )


def test_base_counts_from_last_day(spark):
    history = purchases(spark, [(1, 0, 5), (1, 400, 7), (2, 30, 1), (None, 0, 9)])
    assert rows(cus.customer_base(history)) == [(1, 0, 2, 12.0, 400), (2, 30, 1, 1.0, 30)]
    everyone = spark.createDataFrame([(1,), (2,), (3,), (3,), (None,)], "customer_id long")
    assert rows(cus.customer_base(history, everyone))[2] == (3, None, 0, 0.0, None)
    later = cus.customer_base(history, as_of=F.lit(date(2024, 7, 10)))
    assert rows(later, "customer_id", "recency_days") == [(1, 10), (2, 40)]


def test_score_edges(spark):
    base = spark.createDataFrame(
        [(0, 8, 2000.0), (6, 7, 1999.0), (7, 6, 1000.0), (15, 5, 999.0), (16, 4, 500.0), (30, 3, 499.0), (31, 2, 200.0),
         (60, 2, 199.0), (61, 1, 0.0), (None, 0, 0.0)],
        "recency_days int, frequency long, monetary double",
    )
    found = [tuple(r) for r in cus.rfm_scores(base).select("r_score", "f_score", "m_score", "rfm_score").collect()]
    assert sorted(found) == sorted(
        [(5, 5, 5, 15), (5, 4, 4, 13), (4, 4, 4, 12), (4, 3, 3, 10), (3, 3, 3, 9), (3, 2, 2, 7), (2, 2, 2, 6),
         (2, 2, 1, 5), (1, 1, 1, 3), (0, 0, 0, 0)]
    )


def test_churn_edges(spark):
    base = spark.createDataFrame([(d,) for d in (0, 29, 30, 59, 60, 90, 91, None)], "recency_days int")
    found = [r["churn_status"] for r in cus.churn_status(base).collect()]
    assert found == ["ACTIVE", "ACTIVE", "AT_RISK", "AT_RISK", "CHURNING", "CHURNING", "CHURNED", "CHURNED"]


def test_segments_and_distribution(spark):
    scored = spark.createDataFrame([(s,) for s in (15, 9, 8, 7, 6, 5, 4, 3, 0)], "rfm_score int")
    segmented = cus.segments(scored)
    assert rows(cus.segment_distribution(segmented)) == [
        ("AT RISK", 2, 22.2),
        ("CHAMPIONS", 2, 22.2),
        ("LOST", 1, 11.1),
        ("LOYAL CUSTOMERS", 2, 22.2),
        ("POTENTIAL LOYALISTS", 2, 22.2),
    ]


def test_lifetime_value(spark):
    scored = spark.createDataFrame([(1000.0, 730, 15), (1000.0, 10, 3), (0.0, None, 0)], "monetary double, tenure_days int, rfm_score int")
    found = cus.lifetime_value(scored).select("annual_revenue", "clv").collect()
    assert [tuple(r) for r in found] == [
        pytest.approx((500.0, 100.0)), pytest.approx((1000.0, 40.0)), (0.0, 0.0),
    ]


def test_run_covers_every_segment(spark, tmp_path):
    history = purchases(
        spark,
        [(1, 1 + d, 300) for d in range(8)]  # 5 + 5 + 5
        + [(2, 10, 300), (2, 20, 300)]  # 4 + 2 + 3
        + [(3, 20, 300)]  # 3 + 1 + 2
        + [(4, 100, 10)]  # 1 + 1 + 1
        + [(6, 10, 100), (6, 12, 60)]  # 4 + 2 + 1
        + [(None, 0, 9)],
    )
    people = spark.createDataFrame([(i,) for i in (1, 2, 3, 4, 5, 6)], "customer_id long")
    tables = run_customers({"customer_transactions_history": history, "customer_details": people}, str(tmp_path))
    assert rows(tables["customer_scores"], "customer_id", "rfm_score", "segment", "churn_status") == [
        (1, 15, "CHAMPIONS", "ACTIVE"),
        (2, 9, "CHAMPIONS", "ACTIVE"),
        (3, 6, "POTENTIAL LOYALISTS", "ACTIVE"),
        (4, 3, "AT RISK", "CHURNED"),
        (5, 0, "LOST", "CHURNED"),
        (6, 7, "LOYAL CUSTOMERS", "ACTIVE"),
    ]
    assert rows(tables["customer_segments"], "segment", "customers") == [
        ("AT RISK", 1), ("CHAMPIONS", 2), ("LOST", 1), ("LOYAL CUSTOMERS", 1), ("POTENTIAL LOYALISTS", 1),
    ]
    report = {r["metric"]: r["value"] for r in spark.read.json(f"{tmp_path}/reports/customers").collect()}
    assert report["customers.customers"] == 6 and report["customers.churned"] == 2
    assert report["customers.total_spent"] == 2400 + 600 + 300 + 10 + 160
