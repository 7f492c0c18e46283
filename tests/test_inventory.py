"""Snapshot and restock rules, one small frame per rule and trap."""

import pytest
from pyspark.sql import functions as F

from shelflens.config import InventoryConfig
from shelflens.functions.rules import error_type, render_codes
from shelflens.operators import inventory as inv
from tests.conftest import rows

SNAPSHOT = (
    "snapshot_id string, store_id string, product_id string, snapshot_date string, snapshot_level string, "
    "max_capacity double, damaged_quantity double, expired_quantity double"
)
RESTOCK = "restock_id string, store_id string, product_id string, restock_date string, incoming_quantity string"


@pytest.fixture
def products(spark):
    return spark.createDataFrame(
        [("P1", "One", "Food", 1.5, 100.0), ("P2", "Two", "Food", 2.5, None)],
        "product_id string, product_name string, category string, unit_price double, max_restock_quantity double",
    )


def snapshot(spark, *data):
    return spark.createDataFrame([(*row, None, None)[:8] for row in data], SNAPSHOT)


def codes(df, key):
    return dict(rows(df.select(key, render_codes(F.col("validation_errors")))))


def test_snapshot_rules(spark, products):
    df = snapshot(
        spark,
        ("good", "A", "P1", "d", "5", 10.0),
        ("blank store", "  ", "P1", "d", "5", 10.0),
        ("null all", None, None, None, None, 10.0),
        ("no number", "A", "P1", "d", "many", 10.0),
        ("java suffix", "A", "P1", "d", "5d", 10.0),
        ("not a number", "A", "P1", "d", "NaN", 10.0),
        ("negative", "A", "P1", "d", "-1", 10.0),
        ("unknown", "A", "P9", "d", "5", 10.0),
        ("blank product", "A", " ", "d", "5", 10.0),
        ("too full", "A", "P1", "d", "11", 10.0),
        ("no capacity", "A", "P1", "d", "11", None),
        ("both", "", "P9", "d", "-2", -3.0),
    )
    tagged = inv.tag_snapshot(df, products)
    assert codes(tagged, "snapshot_id") == {
        "good": "",
        "blank store": "MISSING_STORE_ID; ",
        "null all": "MISSING_STORE_ID; MISSING_PRODUCT_ID; MISSING_SNAPSHOT_DATE; MISSING_SNAPSHOT_LEVEL; ",
        "no number": "",
        "java suffix": "",
        "not a number": "",
        "negative": "NEGATIVE_STOCK; ",
        "unknown": "MISMATCHED_PRODUCT_ID; ",
        "blank product": "MISSING_PRODUCT_ID; MISMATCHED_PRODUCT_ID; ",
        "too full": "CAPACITY_EXCEEDED; ",
        "no capacity": "",
        "both": "MISSING_STORE_ID; NEGATIVE_STOCK; MISMATCHED_PRODUCT_ID; CAPACITY_EXCEEDED; ",
    }
    valid = {r["snapshot_id"]: r["snapshot_level"] for r in tagged.filter("validation_status = 'VALID'").collect()}
    assert set(valid) == {"good", "no number", "java suffix", "not a number", "too full", "no capacity"}
    assert valid["no number"] is None and valid["java suffix"] is None and valid["not a number"] is None


def test_optional_rules(spark, products):
    df = snapshot(spark, ("x", "A", "P1", "d", "5", 10.0, -1.0, -1.0))
    assert codes(inv.tag_snapshot(df, products), "snapshot_id") == {"x": ""}
    strict = InventoryConfig(check_damaged=True, check_expired=True)
    assert codes(inv.tag_snapshot(df, products, strict), "snapshot_id") == {"x": "NEGATIVE_DAMAGED; NEGATIVE_EXPIRED; "}


def test_newer_invalid_row_replaces_valid_one(spark, products):
    df = snapshot(
        spark,
        ("S2", "A", "P1", "d", "-5", 10.0),
        ("S1", "A", "P1", "d", "5", 10.0),
        ("S10", "A", "P2", "d", "1", 10.0),  # text order: S9 is the newer one
        ("S9", "A", "P2", "d", "2", 10.0),
        ("N1", None, None, None, "1", 10.0),  # null keys are equal
        ("N2", None, None, None, "2", 10.0),
    )
    valid, invalid = inv.validate_snapshot(df, products)
    assert rows(valid, "snapshot_id") == [("S9",)]
    assert rows(invalid, "snapshot_id") == [("N2",), ("S2",)]
    metrics = inv.snapshot_metrics(df, products).first()
    assert (metrics["total"], metrics["valid"], metrics["invalid"], metrics["duplicates"]) == (6, 1, 2, 3)
    assert metrics["negative_stock"] == 1


def test_duplicates_leave_the_map_side(spark, products):
    plan = inv.latest_snapshot(snapshot(spark, ("a", "A", "P1", "d", "5", 1.0)))._jdf.queryExecution().toString()
    physical = plan[plan.index("Physical Plan") :]
    assert physical.count("WindowGroupLimit") >= 2  # once before and once after the exchange
    assert "Partial" in physical


def test_restock_rules(spark, products):
    df = spark.createDataFrame(
        [
            ("good", "A", "P1", "d", "100"),
            ("zero", "A", "P1", "d", "0"),
            ("minus", "A", "P1", "d", "-3"),
            ("too much", "A", "P1", "d", "101"),
            ("no limit", "A", "P2", "d", "9999"),
            ("unknown", "A", "P9", "d", "5"),
            ("no number", "A", "P1", "d", "x"),
            ("missing", "A", None, "d", None),
        ],
        RESTOCK,
    )
    tagged = inv.tag_restock(df, products)
    assert codes(tagged, "restock_id") == {
        "good": "",
        "zero": "INVALID_QUANTITY; ",
        "minus": "INVALID_QUANTITY; ",
        "too much": "EXCEEDED_RESTOCK_MAX; ",
        "no limit": "",
        "unknown": "MISMATCHED_PRODUCT_ID; ",
        "no number": "",
        "missing": "MISSING_PRODUCT_ID; MISSING_INCOMING_QUANTITY; ",
    }
    valid, invalid = inv.validate_restock(df, products)
    assert valid.count() == 3 and invalid.count() == 5
    metrics = inv.restock_metrics(df, products).first()
    assert (metrics["total"], metrics["valid"], metrics["invalid_quantity"]) == (8, 3, 2)


def test_duplicate_master_key_doubles_rows(spark, products):
    doubled = products.union(products.filter("product_id = 'P1'"))
    df = spark.createDataFrame([("a", "A", "P1", "d", "5")], RESTOCK)
    assert inv.tag_restock(df, doubled).count() == 2
    assert inv.tag_snapshot(snapshot(spark, ("a", "A", "P1", "d", "5", 1.0)), doubled).count() == 1


def test_reconcile(spark, products):
    snap, _ = inv.validate_snapshot(
        snapshot(
            spark,
            ("S1", "A", "P1", "d", "10", 99.0, 1.0, 2.0),
            ("S2", "A", "P2", "d", "1", 99.0, 5.0, None),
            ("S3", "B", "P1", "d", "text", 99.0, None, None),
        ),
        products,
    )
    restock, _ = inv.validate_restock(
        spark.createDataFrame(
            [("R1", "A", "P1", "d", "4"), ("R2", "A", "P1", "d", "6"), ("R3", "B", "P1", "d", "x")], RESTOCK
        ),
        products,
    )
    result = inv.reconcile(snap, restock)
    columns = ["snapshot_id", "incoming_restock", "effective_stock_level", "stock_movement", "reconciliation_status"]
    assert rows(result, *columns, "negative_effective_stock_flag") == [
        ("S1", 10.0, 17.0, 7.0, "RECONCILED", False),
        ("S2", 0.0, -4.0, -5.0, "FLAGGED_NEGATIVE", True),
        ("S3", 0.0, None, 0.0, "RECONCILED", False),
    ]


def test_fact_keeps_existing_columns(spark, products):
    stores = spark.createDataFrame([("A", "Shop", "C", "R")], "store_id string, store_name string, city string, region string")
    slim = spark.createDataFrame([("A", "P1", 3.0), ("Z", "P9", 4.0)], "store_id string, product_id string, snapshot_level double")
    fact = inv.inventory_fact(slim, products, stores)
    assert fact.columns == [
        "store_id", "product_id", "snapshot_level", "reconciled_at", "product_name", "category", "unit_price",
        "store_name", "city", "region", "pipeline_version", "created_at",
    ]
    assert rows(fact, "product_id", "product_name", "store_name") == [("P1", "One", "Shop"), ("P9", None, None)]


def test_error_types(spark):
    cases = {
        (): "UNKNOWN",
        ("CAPACITY_EXCEEDED",): "OTHER",
        ("EXCEEDED_RESTOCK_MAX",): "EXCEEDED_LIMIT",
        ("INVALID_QUANTITY",): "INVALID_VALUE",
        ("MISSING_STORE_ID", "MISSING_PRODUCT_ID"): "MISSING_FIELD",
        ("MISSING_STORE_ID", "NEGATIVE_STOCK", "MISMATCHED_PRODUCT_ID"): "MISSING_FIELD|NEGATIVE_STOCK|MISMATCHED_PRODUCT",
    }
    df = spark.createDataFrame([(list(c), e) for c, e in cases.items()] + [(None, "UNKNOWN")], "errors array<string>, expected string")
    assert df.filter(error_type(F.col("errors")) != F.col("expected")).count() == 0


def test_quarantine_audit_has_all_columns(spark):
    a = spark.createDataFrame([("a", ["X"])], "snapshot_id string, validation_errors array<string>")
    b = spark.createDataFrame([("b", ["EXCEEDED_RESTOCK_MAX"], 5.0)], "restock_id string, validation_errors array<string>, max_restock_quantity double")
    audit = inv.quarantine_audit(inv.quarantine(a, "one"), inv.quarantine(b, "two"))
    assert rows(audit, "source_dataset", "snapshot_id", "restock_id", "max_restock_quantity", "error_type") == [
        ("one", "a", None, None, "OTHER"),
        ("two", None, "b", 5.0, "EXCEEDED_LIMIT"),
    ]
    assert rows(inv.rows_with_code(audit, "EXCEEDED_"), "restock_id") == [("b",)]
