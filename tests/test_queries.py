"""Every registered query against its SQL on the smallest tables, and plan properties."""

import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from checks import roles
from checks.compare import compare, connect
from checks.queries import ORACLES, QUERIES
from shelflens.operators import fraud
from shelflens.operators.fraud import join_behaviour, refund_behaviour
from shelflens.operators.inventory import tag_snapshot
from shelflens.sources.shared import write_once

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    outcome = compare(spark, con, name, SF)
    assert outcome.startswith("same" if name in ORACLES else "rows only"), outcome


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def plan_of(df):
    text = df._jdf.queryExecution().toString()
    return text[text.index("Physical Plan") :]


@pytest.mark.parametrize("name", ["inventory_fact", "affinity_scores", "fraud_flags", "best_matches", "refund_amount_stats"])
def test_no_cross_join(spark, name):
    plan = plan_of(QUERIES[name](spark, SF))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_columns_and_filters_reach_the_scan(spark, monkeypatch):
    written = []

    def keep_plan(df, name):
        written.append(plan_of(df))
        return write_once(df, name)

    monkeypatch.setattr(fraud, "write_once", keep_plan)
    refund_behaviour(roles.refunds(spark, SF))
    (plan,) = written
    assert "PushedFilters: [IsNotNull(l_returnflag), EqualTo(l_returnflag,R)" in plan
    assert "l_shipdate" not in plan


def test_hot_key_join_is_split(spark):
    """A third of all rows has one key and nothing may be broadcast: AQE splits that key."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        hot = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id"))
        product = F.concat(F.lit("p"), hot % 5)
        refunds = spark.range(0, 30000, 1, 8).select(
            hot.alias("customer_id"), product.alias("product_id"), F.rand(1).alias("refund_amount"), F.uuid().alias("refund_id")
        )
        behaviour = write_once(refund_behaviour(refunds), "behaviour")
        snapshots = refunds.select("product_id", F.lit("5").alias("snapshot_level"), "refund_id")
        masters = spark.range(20000).select(F.concat(F.lit("p"), F.col("id")).alias("product_id"))
        for joined in (join_behaviour(refunds, behaviour), tag_snapshot(snapshots, masters)):
            assert joined.count() == 30000
            joined.collect()
            assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
