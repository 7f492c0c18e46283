"""Published results for the seed data, through the end-to-end runs."""

import pytest
from pyspark.sql import functions as F

from shelflens.operators.fraud import amount_stats
from shelflens.plans.runs import run_affinity, run_fraud, run_inventory
from tests import seed
from tests.conftest import rows


def report(spark, out, name):
    return {r["metric"]: r["value"] for r in spark.read.json(f"{out}/reports/{name}").collect()}


@pytest.fixture(scope="module")
def inventory(spark, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("inventory"))
    inputs = {
        "inventory_snapshot": seed.snapshots(spark),
        "restock_events": seed.restocks(spark),
        "products": seed.products(spark),
        "stores": seed.stores(spark),
    }
    return out, run_inventory(inputs, out)


def test_inventory_report(spark, inventory):
    metrics = report(spark, inventory[0], "inventory")
    expected = {
        "snapshot.total": 30,
        "snapshot.valid": 24,
        "snapshot.invalid": 5,
        "snapshot.duplicates": 1,
        "snapshot.negative_stock": 1,
        "snapshot.mismatched_product_id": 1,
        "snapshot.capacity_exceeded": 0,
        "restock.total": 28,
        "restock.valid": 22,
        "restock.invalid": 6,
        "restock.exceeded_restock_max": 3,
        "restock.mismatched_product_id": 1,
        "curated.records": 24,
        "curated.mean_effective_stock": 353.125,
        "curated.total_stock_movement": 1120,
        "quarantine.records": 11,
        "quarantine.fuzzy_matches_found": 2,
        "quarantine.unmatched_products": 0,
        "sku.snapshot_product_id.non_standard": 24,
        "sku.restock_product_id.non_standard": 22,
    }
    assert {k: metrics[k] for k in expected} == expected


def test_inventory_fact(inventory):
    fact = {r["snapshot_id"]: r for r in inventory[1]["inventory_fact"].collect()}
    assert len(fact) == 24
    assert "S001" not in fact and fact["S019"]["effective_stock_level"] == 597
    assert fact["S018"]["incoming_restock"] == 0 and fact["S018"]["stock_movement"] == -1
    assert fact["S030"]["effective_stock_level"] == 80


def test_quarantine(inventory):
    snapshot = inventory[1]["quarantine_inventory_snapshot"]
    assert rows(snapshot, "snapshot_id", "validation_errors", "suggested_product_id", "fuzzy_match_score", "error_type") == [
        ("S020", "MISSING_STORE_ID; ", None, None, "MISSING_FIELD"),
        ("S021", "MISSING_PRODUCT_ID; ", None, None, "MISSING_FIELD"),
        ("S022", "MISSING_SNAPSHOT_DATE; ", None, None, "MISSING_FIELD"),
        ("S023", "NEGATIVE_STOCK; ", None, None, "NEGATIVE_STOCK"),
        ("S025", "MISMATCHED_PRODUCT_ID; ", "PRD001", 86, "MISMATCHED_PRODUCT"),
    ]
    restock = inventory[1]["quarantine_restock_events"]
    assert rows(restock, "restock_id", "error_type", "max_restock_quantity", "fuzzy_match_score") == [
        ("R017", "EXCEEDED_LIMIT", 150.0, None),
        ("R018", "EXCEEDED_LIMIT", 150.0, None),
        ("R019", "MISSING_FIELD", 500.0, None),
        ("R020", "MISSING_FIELD", None, None),
        ("R021", "EXCEEDED_LIMIT", 500.0, None),
        ("R026", "MISMATCHED_PRODUCT", None, 86),
    ]


def test_affinity(spark, tmp_path):
    inputs = {
        "store_sales_header": seed.header(spark),
        "store_sales_line_items": seed.lines(spark),
        "products": seed.products(spark),
    }
    tables = run_affinity(inputs, str(tmp_path))
    metrics = report(spark, str(tmp_path), "affinity")
    assert metrics["baskets.total_transactions"] == 25
    assert metrics["baskets.total_line_items"] == 70
    assert metrics["baskets.total_products"] == 10
    assert metrics["baskets.unique_products_in_sales"] == 7
    assert metrics["baskets.mean_basket_size"] == pytest.approx(2.8)
    assert metrics["pairs.total_product_pairs"] == 69
    assert tables["pairs"].select("product_a", "product_b").distinct().count() == 14
    top = rows(tables["top_affinities"], "rank", "product_a", "product_b", "lift", "confidence_a_to_b", "pair_count")
    assert top == [
        (1, "PRD001", "PRD005", 1.4706, 0.2941, 5),
        (2, "PRD003", "PRD004", 1.3333, 0.2667, 4),
        (3, "PRD003", "PRD007", 1.3333, 0.2667, 4),
        (4, "PRD002", "PRD008", 1.3158, 0.2105, 4),
        (5, "PRD001", "PRD004", 1.1765, 0.2353, 4),
        (6, "PRD001", "PRD003", 1.0784, 0.6471, 11),
        (7, "PRD002", "PRD004", 1.0526, 0.2105, 4),
        (8, "PRD001", "PRD002", 1.0062, 0.7647, 13),
    ]


def test_fraud(spark, tmp_path):
    inputs = {
        "refund_transactions": seed.refunds(spark),
        "store_sales_header": seed.header(spark),
        "customer_details": seed.customers(spark),
        "products": seed.products(spark),
    }
    tables = run_fraud(inputs, str(tmp_path))
    metrics = report(spark, str(tmp_path), "fraud")
    expected = {
        "total_refunds": 30,
        "valid_refunds": 16,
        "invalid_refunds": 14,
        "invalid_amount_exceeded": 9,
        "invalid_customer_mismatch": 13,
        "invalid_outside_window": 1,
        "invalid_payment_mismatch": 6,
        "flag_high_frequency": 14,
        "flag_high_value": 8,
        "flag_repeat_product": 7,
        "flag_zscore_anomaly": 1,
        "flag_iqr_anomaly": 0,
        "total_fraud_flags": 20,
        "suspicious_customers": 6,
        "clean_refunds": 10,
    }
    assert {k: metrics[f"fraud.{k}"] for k in expected} == expected
    severities = {r["fraud_severity"]: r["count"] for r in tables["fraud_flags"].groupBy("fraud_severity").count().collect()}
    assert severities == {"HIGH": 9, "MEDIUM": 5, "LOW": 6, "CLEAN": 10}
    suspicious = tables["suspicious_customers"].orderBy(F.desc("total_fraud_score"))
    assert [tuple(r) for r in suspicious.select("customer_id", "total_fraud_score", "risk_level").collect()] == [
        (12, 580, "CRITICAL_RISK"),
        (11, 430, "CRITICAL_RISK"),
        (1, 270, "CRITICAL_RISK"),
        (2, 75, "HIGH_RISK"),
        (5, 40, "MEDIUM_RISK"),
        (3, 20, "LOW_RISK"),
    ]
    flags = suspicious.first()["all_fraud_flags"]
    assert set(flags.split("; ")) == {
        "HIGH_VALUE",
        "PAYMENT_MISMATCH",
        "ZSCORE_ANOMALY",
        "HIGH_FREQUENCY",
        "HIGH_REFUND_RATIO",
        "AMOUNT_EXCEEDED",
    }
    worst = tables["fraud_flags"].filter("refund_id = 'F023'").first()
    assert worst["fraud_score"] == 160 and worst["days_since_purchase"] == 21
    clean = {r["refund_id"] for r in tables["clean_refunds"].collect()}
    assert clean == {f"F{i:03d}" for i in (3, 5, 8, 9, 16, 17, 18, 27, 28, 29)}


def test_refund_statistics(spark):
    stats = amount_stats(seed.refunds(spark)).first()
    assert stats["mean_amount"] == pytest.approx(219.1333, abs=1e-4)
    assert stats["std_amount"] == pytest.approx(165.6019, abs=1e-4)
    assert (stats["q1"], stats["q3"]) == (90.0, 315.0)
