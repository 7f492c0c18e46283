"""Rows and values that must not be lost or swapped."""

import pytest

from tests.conftest import rows
from shelflens.config import AffinityConfig, Dataset
from shelflens.functions.numbers import lenient_double
from shelflens.operators import affinity, matching
from shelflens.sources import sinks
from shelflens.sources.readers import load_dataset
from shelflens.sources.shared import scratch, write_once


@pytest.mark.parametrize("total, both, support", [(100, 7, 0.07), (200, 14, 0.07), (100, 14, 0.14), (300, 21, 0.07), (100, 7, 0.06)])
def test_pair_at_the_edge_of_support(spark, total, both, support):
    lines = [(f"t{i}", p) for i in range(both) for p in ("A", "B")] + [(f"t{i}", f"p{i % 9}") for i in range(both, total)]
    lines = spark.createDataFrame(lines, "transaction_id string, product_id string")
    header = lines.select("transaction_id").distinct()
    products = spark.createDataFrame([("A", "a"), ("B", "b")], "product_id string, product_name string")
    config = AffinityConfig(min_support=support, min_confidence=0.0, min_lift=0.0)
    found = affinity.affinity(affinity.basket_items(lines), header, products, config)
    assert [(r.product_a, r.product_b, r.support) for r in found.collect()] == [("A", "B", both / total)]


def test_whole_numbers_written_with_a_point(spark, tmp_path):
    (tmp_path / "a.csv").write_text("n,x\n2.0,5d\n7,1.5\n2.5,inf\n9007199254740993,\nx,-Infinity\n")
    df = load_dataset(spark, "a", str(tmp_path), {"a": Dataset("a.csv", types={"n": "long", "x": "double"})})
    assert [tuple(r) for r in df.collect()] == [(2, None), (7, 1.5), (None, float("inf")), (9007199254740993, None), (None, float("-inf"))]


def test_infinite_texts(spark):
    df = spark.createDataFrame([("inf",), ("+Infinity",), (" -INF ",), ("infin",), ("nan",)], "v string")
    inf = float("inf")
    assert [r[0] for r in df.select(lenient_double(df, "v")).collect()] == [inf, inf, -inf, None, None]


def test_every_branch_of_a_pattern_is_anchored(spark):
    df = spark.createDataFrame([("A1",), ("B1",), ("xx-B",)], "sku string")
    assert rows(matching.check_sku(df, pattern="^A|B").filter("sku_valid"), "sku") == [("A1",), ("B1",)]


def test_files_with_columns_in_another_order_raise(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "1.csv").write_text("product_id,name\nP1,Tea\n")
    (tmp_path / "a" / "2.csv").write_text("name,product_id\nRice,P2\n")
    df = load_dataset(spark, "a", str(tmp_path), {"a": Dataset("a")})
    with pytest.raises(Exception, match="(?i)header"):
        df.collect()


def test_overlapping_scratch_blocks(spark):
    first, second = scratch(spark), scratch(spark)
    first.__enter__()
    mine = write_once(spark.range(3).toDF("a"), "first")
    second.__enter__()
    other = write_once(spark.range(4).toDF("a"), "second")
    first.__exit__(None, None, None)
    assert other.count() == 4
    later = write_once(spark.range(5).toDF("a"), "later")
    second.__exit__(None, None, None)
    for gone in (mine, other, later):
        with pytest.raises(Exception, match="(?i)not exist|not found|no such"):
            spark.read.parquet(gone.inputFiles()[0]).count()


def test_an_empty_rerun_clears_the_quarantine(spark, tmp_path):
    bad = spark.createDataFrame([("a", ["MISSING"])], "id string, validation_errors array<string>")
    assert sinks.write_quarantine(bad, str(tmp_path), "x").count() == 1
    assert sinks.write_quarantine(bad.limit(0), str(tmp_path), "x") is None
    assert not list((tmp_path / "quarantine" / "quarantine_x").glob("quarantine_x.*"))
