"""Exact quantiles of values that lie close together or far apart."""

import pytest
from pyspark.sql import functions as F

from shelflens.functions.quantiles import exact_quantiles

SHARES = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]
SHAPES = {
    "one_bucket": lambda: F.lit(1.7e9) + F.col("id") * 0.01,
    "tiny": lambda: F.col("id") * 1e-10,
    "equal": lambda: F.lit(3.5),
    "both_signs": lambda: (F.col("id") - 50_000) * 1.5,
    "one_far_off": lambda: F.when(F.col("id") == 7, 1e300).otherwise(F.col("id") * 1e-7),
}


@pytest.mark.parametrize("shape", SHAPES)
def test_equals_percentile(spark, shape):
    df = spark.range(100_000).select(SHAPES[shape]().alias("x"))
    mine = exact_quantiles(df, "x", SHARES).first()
    theirs = df.agg(F.percentile("x", F.array(*map(F.lit, SHARES)))).first()[0]
    assert list(mine) == pytest.approx(theirs, rel=1e-12)


def test_infinite_null_and_nan(spark):
    df = spark.createDataFrame([(float("-inf"),), (1.0,), (2.0,), (float("inf"),), (None,), (float("nan"),)], "x double")
    found = exact_quantiles(df, "x", [1 / 3]).first()[0]
    assert found == pytest.approx(1.0)


def test_empty(spark):
    assert exact_quantiles(spark.range(0).select(F.col("id").cast("double").alias("x")), "x", [0.5]).first()[0] is None
