"""Increments of the inventory against one run over all rows."""

import os
import random

import pytest

from shelflens.functions.rules import render_all
from shelflens.operators import inventory as inv
from shelflens.plans.increments import add_increment
from tests import seed
from tests.conftest import rows

DAYS = ["2024-01-01", "2024-01-02", "2024-01-03", None, "a/b=c d"]
SNAPSHOT = "snapshot_id string, store_id string, product_id string, snapshot_date string, snapshot_level string, max_capacity double, damaged_quantity double, expired_quantity double"
RESTOCK = "restock_id string, store_id string, product_id string, restock_date string, incoming_quantity string, restock_type string"


@pytest.fixture(scope="module")
def inputs(spark):
    rng = random.Random(2)
    products = [r.product_id for r in seed.products(spark).collect()][:4] + ["ZZZ", None]
    snapshots = [
        (f"S{i:03d}", rng.choice("AB"), rng.choice(products), rng.choice(DAYS), rng.choice(["5", "40", "-1", "n/a"]), 100.0, 1.0, None)
        for i in range(120)
    ]
    restocks = [(f"R{i}", rng.choice("AB"), rng.choice(products), rng.choice(DAYS), rng.choice(["3", "0", "9999"]), "X") for i in range(60)]
    return snapshots, restocks, seed.products(spark), seed.stores(spark)


def whole(spark, snapshots, restocks, products, stores):
    valid, bad = inv.validate_snapshot(spark.createDataFrame(snapshots, SNAPSHOT), products)
    good, odd = inv.validate_restock(spark.createDataFrame(restocks, RESTOCK), products)
    fact = inv.inventory_fact(inv.reconcile(valid, good), products, stores, stamped=False)
    audit = inv.quarantine_audit(inv.quarantine(bad, "inventory_snapshot", False), inv.quarantine(odd, "restock_events", False))
    return rows(fact), rows(render_all(audit, "validation_errors"))


def layer(spark, out, name):
    found = spark.read.option("basePath", f"{out}/{name}").parquet(f"{out}/{name}").drop("day")
    return rows(found)


def files(out):
    return {os.path.join(d, f): os.path.getmtime(os.path.join(d, f)) for d, _, fs in os.walk(out) for f in fs if f.endswith(".parquet")}


@pytest.mark.parametrize("order", [[0, 1, 2], [2, 0, 1, 0]])
def test_increments_give_the_whole_run(spark, tmp_path, inputs, order):
    """In any order, and with one of them repeated."""
    snapshots, restocks, products, stores = inputs
    out = str(tmp_path)
    for i in order:
        parts = spark.createDataFrame(snapshots[i::3], SNAPSHOT), spark.createDataFrame(restocks[i::3], RESTOCK)
        add_increment(*parts, products, stores, out, f"n{i}", stamped=False)
    fact, audit = whole(spark, *inputs)
    assert layer(spark, out, "fact") == fact and layer(spark, out, "quarantine") == audit


def test_other_days_keep_their_files(spark, tmp_path, inputs):
    snapshots, restocks, products, stores = inputs
    out = str(tmp_path)
    add_increment(spark.createDataFrame(snapshots, SNAPSHOT), spark.createDataFrame(restocks, RESTOCK), products, stores, out, "first", stamped=False)
    before = files(out)
    newer = [("S999", "A", snapshots[0][2], "2024-01-02", "7", 100.0, 0.0, 0.0)]
    touched = add_increment(spark.createDataFrame(newer, SNAPSHOT), spark.createDataFrame([], RESTOCK), products, stores, out, "second", stamped=False)
    assert touched == ["2024-01-02"]
    after = files(out)
    same = {f for f in before if after.get(f) == before[f]}
    assert {f for f in before if "day=2024-01-02" not in f} <= same
    assert not any("day=2024-01-02" in f for f in same if "/restocks/" not in f)
    fact, audit = whole(spark, snapshots + newer, restocks, products, stores)
    assert layer(spark, out, "fact") == fact and layer(spark, out, "quarantine") == audit


def test_a_day_that_loses_its_rows_goes(spark, tmp_path, inputs):
    """The only valid snapshot of a day is replaced by an invalid one."""
    *_, products, stores = inputs
    out, known = str(tmp_path), products.first().product_id
    none = spark.createDataFrame([], RESTOCK)
    for i, level in enumerate(["5", "-5"]):
        one = [(f"S{i}", "A", known, "2024-02-01", level, 100.0, 0.0, 0.0), (f"S{i}", "A", known, "2024-02-02", "5", 100.0, 0.0, 0.0)]
        add_increment(spark.createDataFrame(one, SNAPSHOT), none, products, stores, out, f"n{i}", stamped=False)
    assert sorted(d for d in os.listdir(f"{out}/fact") if d.startswith("day")) == ["day=2024-02-02"]
    assert len(layer(spark, out, "quarantine")) == 1
