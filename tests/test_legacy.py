"""The single-table inventory run."""

import pytest
from pyspark.sql import functions as F

from shelflens.config import LegacyConfig
from shelflens.functions.rules import render_codes
from shelflens.operators import legacy as leg
from shelflens.plans.runs import run_units
from tests.conftest import rows

UNITS = (
    "Store_ID string, Product_ID string, Date string, Inventory_Level double, Units_Sold double, "
    "Units_Ordered double, Price double, Discount double"
)


@pytest.fixture
def units(spark):
    return spark.createDataFrame(
        [
            ("A", "P1", "2024-01-01", 10.0, 3.0, 5.0, 1.0, 0.0),
            ("A", "P1", "2024-01-02", 10.0, 30.0, None, 1.0, 0.0),
            ("A", "P2", "2024-01-01", 99.0, 0.0, 5.0, 1.0, 0.1),
            ("", "P1", "2024-01-01", -1.0, 0.0, 0.0, 1.0, 0.0),
            ("A", " ", "2024-01-01", 1.0, -1.0, 0.0, 0.0, 0.0),
            ("A", "P3", None, 1.0, 1.0, 0.0, None, 0.0),
        ],
        UNITS,
    )


CONFIG = LegacyConfig(key=("Store_ID", "Product_ID"), max_capacity=100.0)


def test_rules_and_classes(units):
    _, invalid = leg.validate_units(units)
    found = leg.quarantine_units(invalid)
    errors = found.select(render_codes(F.col("validation_errors")), "error_type")
    assert rows(errors) == [
        ("Missing Date; ", "MISSING_FIELD"),
        ("Missing Store_ID; Negative inventory; ", "MISSING_FIELD"),
        ("Negative units sold; Invalid price; ", "NEGATIVE_VALUE"),  # a blank is not missing here
    ]


def test_reconciliation(units):
    valid, _ = leg.validate_units(units)
    latest = leg.latest_units(valid, CONFIG)
    fact = leg.units_fact(leg.reconcile_units(latest, CONFIG), CONFIG)
    columns = ["Product_ID", "final_stock_level", "restock_in", "stock_movement", "reconciliation_status"]
    assert rows(fact, *columns) == [
        ("P1", -20.0, 0.0, -30.0, "FLAGGED_NEGATIVE"),
        ("P2", 104.0, 5.0, 5.0, "FLAGGED_CAPACITY"),
    ]
    assert "last_updated" in fact.columns
    metrics = leg.units_metrics(units, CONFIG).first().asDict()
    assert metrics == {
        "total_records": 6, "valid_records": 3, "invalid_records": 3, "duplicates_removed": 1,
        "negative_stock_flags": 1, "capacity_exceeded_flags": 1,
    }


def test_absent_columns_count_as_zero(spark):
    df = spark.createDataFrame([("A", 5.0)], "Store_ID string, Inventory_Level double")
    assert leg.reconcile_units(df).first()["final_stock_level"] == 5.0
    assert leg.validate_units(df)[0].count() == 1


def test_run(spark, units, tmp_path):
    tables = run_units(units, str(tmp_path), CONFIG)
    assert tables["inventory_units"].count() == 2
    assert tables["quarantine_inventory_units"].count() == 3
