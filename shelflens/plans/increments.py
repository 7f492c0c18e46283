"""The inventory fact table day by day: new rows touch the days they name, and no others.

Layers under a folder, each partitioned by ``day`` (the date key as text, ``none`` for null):

``snapshots``   the latest version of every key, as read
``restocks``    all restock rows, by increment within the day
``fact``        the inventory fact table
``quarantine``  invalid snapshots and restocks of the day
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from shelflens.config import InventoryConfig
from shelflens.functions.rules import is_invalid, is_valid, render_all
from shelflens.operators import inventory as inv
from shelflens.sources.shared import delete_path, scratch, write_once

NO_DAY = "none"


def _day(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(NO_DAY)).alias("day")


def read_days(spark: SparkSession, path: str, schema: StructType, *keys: str) -> DataFrame:
    """A layer of which there may be no day yet; ``schema`` without the partition columns, which are text."""
    fields = [f for f in schema.fields if f.name not in keys]
    whole = StructType(fields + [StructField(k, StringType()) for k in keys])
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place):
        return spark.createDataFrame([], whole)
    return spark.read.schema(whole).parquet(path)


def _replace_days(df: DataFrame, path: str, days: list[str], *keys: str) -> None:
    """Write the rows of ``days``, which replace what their partitions hold; a day without rows loses its partition."""
    spark = df.sparkSession
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path)
    written = [r.day for r in df.select("day").distinct().collect()]
    gone = [d for d in days if d not in set(written)]
    if gone:
        left = spark.read.schema(df.schema).parquet(path).filter(F.col("day").isin(gone))
        for row in left.select(F.col("_metadata.file_path").alias("file")).distinct().collect():
            delete_path(spark, os.path.dirname(row.file))


def add_increment(
    snapshot: DataFrame,
    restock: DataFrame,
    products: DataFrame,
    stores: DataFrame,
    out: str,
    increment: str,
    config: InventoryConfig = InventoryConfig(),
    stamped: bool = True,
) -> list[str]:
    """Add new snapshots and restocks to the layers under ``out``; returns the days they touch.

    A newer version of a snapshot replaces the older one, restocks add up. For the days
    that new rows name, the layers are made anew from all rows of those days; other days
    are neither read nor written. Increments in any order give the tables of one run
    over all rows. An increment that is repeated under its name, after a failure or not,
    adds nothing twice.

    The days of an increment go through the driver, one text per day. Masters are taken
    as they are now; days that are not touched keep what older masters gave. Starts jobs.
    """
    spark = products.sparkSession
    with scratch(spark):
        new = write_once(snapshot.withColumn("day", _day("snapshot_date")), "new_snapshots")
        added = write_once(restock.withColumn("day", _day("restock_date")), "new_restocks")
        named = [r.day for r in new.select("day").distinct().collect()]
        restocked = [r.day for r in added.select("day").distinct().collect()]
        days = sorted({*named, *restocked})

        known = read_days(spark, f"{out}/snapshots", snapshot.schema, "day")
        both = known.filter(F.col("day").isin(named)).unionByName(new)
        latest = write_once(inv.latest_snapshot(both, config), "latest")  # apart from what it replaces
        _replace_days(latest, f"{out}/snapshots", named, "day")
        # Its own partition in each day: a repeated increment replaces itself.
        _replace_days(added.withColumn("increment", F.lit(increment)), f"{out}/restocks", [], "day", "increment")

        touched = F.col("day").isin(days)
        kept = read_days(spark, f"{out}/snapshots", snapshot.schema, "day").filter(touched).drop("day")
        arrived = read_days(spark, f"{out}/restocks", restock.schema, "day", "increment").filter(touched).drop("day", "increment")
        kept = write_once(inv.tag_snapshot(kept, products, config), "tagged_snapshots")
        arrived = write_once(inv.tag_restock(arrived, products, config), "tagged_restocks")
        reconciled = inv.reconcile(kept.filter(is_valid()), arrived.filter(is_valid()))
        fact = inv.inventory_fact(reconciled, products, stores, config, stamped)
        fact = write_once(fact.withColumn("day", _day("snapshot_date")), "fact")
        _replace_days(fact, f"{out}/fact", days, "day")
        audit = inv.quarantine_audit(
            inv.quarantine(kept.filter(is_invalid()), "inventory_snapshot", stamped).withColumn("day", _day("snapshot_date")),
            inv.quarantine(arrived.filter(is_invalid()), "restock_events", stamped).withColumn("day", _day("restock_date")),
        )
        audit = write_once(render_all(audit, "validation_errors"), "quarantine")
        _replace_days(audit, f"{out}/quarantine", days, "day")
    return days
