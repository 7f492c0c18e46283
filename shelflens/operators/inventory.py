"""Snapshot and restock validation, reconciliation and the inventory fact table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelflens.config import InventoryConfig
from shelflens.functions.numbers import holds, lenient_double
from shelflens.functions.rules import (
    Rule,
    apply_rules,
    error_type,
    has_code,
    is_invalid,
    is_valid,
    missing_rules,
)

CONFIG = InventoryConfig()

# Output columns, in order.
FACT_COLUMNS = [
    "snapshot_id",
    "store_id",
    "product_id",
    "snapshot_date",
    "snapshot_level",
    "incoming_restock",
    "damaged_quantity",
    "expired_quantity",
    "effective_stock_level",
    "stock_movement",
    "max_capacity",
    "reconciliation_status",
    "negative_effective_stock_flag",
    "reconciled_at",
]


def keep_existing(df: DataFrame, columns: list[str]) -> DataFrame:
    """The listed columns that the frame has, in list order."""
    return df.select(*[c for c in columns if c in df.columns])


def known_products(products: DataFrame) -> DataFrame:
    """Distinct ids of the master.

    Rebalanced, so that a join beyond broadcast size shuffles both of its sides
    itself: only then does AQE split a product that holds many of the rows.
    """
    known = products.select("product_id").dropna().distinct().withColumn("_known", F.lit(True))
    return known.hint("rebalance")


def _unknown_product() -> Column:
    return F.col("product_id").isNotNull() & F.col("_known").isNull()


def tag_snapshot(snapshot: DataFrame, products: DataFrame, config: InventoryConfig = CONFIG) -> DataFrame:
    """Every snapshot row with its error codes and status.

    Missing fields are tested on the text as read, so a text that is no number
    passes and becomes null.
    """
    quantities = ("snapshot_level", "max_capacity", "damaged_quantity", "expired_quantity")
    number = {c: F.col(f"_{c}") for c in quantities if c in snapshot.columns}
    rules = missing_rules(snapshot, config.snapshot_fields)
    if "snapshot_level" in number:
        rules.append(Rule("NEGATIVE_STOCK", holds(number["snapshot_level"] < 0)))
    rules.append(Rule("MISMATCHED_PRODUCT_ID", _unknown_product()))
    if "snapshot_level" in number and "max_capacity" in number:
        over = holds(number["snapshot_level"] > number["max_capacity"])
        rules.append(Rule("CAPACITY_EXCEEDED", over, warning=True))
    if config.check_damaged:
        rules.append(Rule("NEGATIVE_DAMAGED", holds(number["damaged_quantity"] < 0)))
    if config.check_expired:
        rules.append(Rule("NEGATIVE_EXPIRED", holds(number["expired_quantity"] < 0)))
    joined = snapshot.join(known_products(products), "product_id", "left").withColumns(
        {f"_{c}": lenient_double(snapshot, c) for c in number}
    )
    converted = {c: number[c] for c in ("snapshot_level", "max_capacity") if c in number}
    tagged = apply_rules(joined, rules).withColumns(converted)
    return tagged.select(*snapshot.columns, "validation_status", "validation_errors")


def latest_snapshot(snapshot: DataFrame, config: InventoryConfig = CONFIG) -> DataFrame:
    """One row per key, the one with the highest version text; null keys are equal.

    ``row_number() = 1`` lets Spark keep one row per key in every task before the
    shuffle, so a key that holds a large share of all rows does not travel.
    Remaining columns break ties, so a rerun gives the same row.
    """
    rest = [c for c in snapshot.columns if c not in (*config.snapshot_key, config.snapshot_version)]
    newest = Window.partitionBy(*config.snapshot_key).orderBy(
        F.col(config.snapshot_version).cast("string").desc(), *[F.col(c).desc() for c in rest]
    )
    return snapshot.withColumn("_version", F.row_number().over(newest)).filter("_version = 1").drop("_version")


def validate_snapshot(
    snapshot: DataFrame, products: DataFrame, config: InventoryConfig = CONFIG
) -> tuple[DataFrame, DataFrame]:
    """Deduplicated snapshots, split into valid and invalid rows.

    A newer invalid row replaces an older valid one. The codes depend on single
    rows only, so duplicates are dropped first and never reach the join.
    """
    tagged = tag_snapshot(latest_snapshot(snapshot, config), products, config)
    return tagged.filter(is_valid()), tagged.filter(is_invalid())


def tag_restock(restock: DataFrame, products: DataFrame, config: InventoryConfig = CONFIG) -> DataFrame:
    """Every restock row with codes, status and its product's ``max_restock_quantity``."""
    quantity = F.col("_quantity")
    limits = products.select("product_id", "max_restock_quantity").filter(F.col("product_id").isNotNull())
    rules = [
        *missing_rules(restock, config.restock_fields),
        Rule("INVALID_QUANTITY", holds(quantity <= 0)),
        Rule("EXCEEDED_RESTOCK_MAX", holds(quantity > F.col("max_restock_quantity"))),
        Rule("MISMATCHED_PRODUCT_ID", _unknown_product()),
    ]
    joined = restock.join(limits.withColumn("_known", F.lit(True)), "product_id", "left").withColumn(
        "_quantity", lenient_double(restock, "incoming_quantity")
    )
    return (
        apply_rules(joined, rules)
        .withColumn("incoming_quantity", quantity)
        .select(*restock.columns, "validation_status", "validation_errors", "max_restock_quantity")
    )


def validate_restock(
    restock: DataFrame, products: DataFrame, config: InventoryConfig = CONFIG
) -> tuple[DataFrame, DataFrame]:
    """Restock rows split into valid and invalid; all events of a day are kept."""
    tagged = tag_restock(restock, products, config)
    return tagged.filter(is_valid()), tagged.filter(is_invalid())


def count_codes(*names: str) -> list[Column]:
    """One counter per code over a tagged frame."""
    return [F.count_if(has_code(name)).alias(name.lower()) for name in names]


def snapshot_counters(columns: list[str], config: InventoryConfig = CONFIG) -> list[Column]:
    """Counters over all tagged rows, duplicates included."""
    fields = [f"MISSING_{f.upper()}" for f in config.snapshot_fields if f in columns]
    return [
        F.count("*").alias("total"),
        *count_codes(*fields, "NEGATIVE_STOCK", "MISMATCHED_PRODUCT_ID", "CAPACITY_EXCEEDED"),
    ]


def split_counters() -> list[Column]:
    return [F.count_if(is_valid()).alias("valid"), F.count_if(is_invalid()).alias("invalid")]


def restock_counters(columns: list[str], config: InventoryConfig = CONFIG) -> list[Column]:
    fields = [f"MISSING_{f.upper()}" for f in config.restock_fields if f in columns]
    return [
        F.count("*").alias("total"),
        *split_counters(),
        *count_codes(*fields, "INVALID_QUANTITY", "EXCEEDED_RESTOCK_MAX", "MISMATCHED_PRODUCT_ID"),
    ]


def fact_counters() -> list[Column]:
    return [
        F.count("*").alias("records"),
        F.avg("effective_stock_level").alias("mean_effective_stock"),
        F.sum("stock_movement").alias("total_stock_movement"),
    ]


def quarantine_counters(fuzzy: bool) -> list[Column]:
    matched = F.col("suggested_product_id").isNotNull() if fuzzy else None
    found = [F.count("*").alias("records")]
    if fuzzy:
        found += [
            F.count_if(matched).alias("fuzzy_matches_found"),
            F.count_if(F.col("fuzzy_match_score").isNotNull() & ~matched).alias("unmatched_products"),
        ]
    return found


def snapshot_metrics(snapshot: DataFrame, products: DataFrame, config: InventoryConfig = CONFIG) -> DataFrame:
    """One row of counters: codes over all rows, valid and invalid after deduplication."""
    kept = tag_snapshot(latest_snapshot(snapshot, config), products, config).agg(*split_counters())
    kept = kept.select(F.struct("valid", "invalid")).scalar()
    tagged = tag_snapshot(snapshot, products, config)
    return tagged.agg(*snapshot_counters(snapshot.columns, config)).select(
        "*",
        F.inline(F.array(kept)),
    ).withColumn("duplicates", F.col("total") - F.col("valid") - F.col("invalid"))


def restock_metrics(restock: DataFrame, products: DataFrame, config: InventoryConfig = CONFIG) -> DataFrame:
    """One row of counters over the tagged rows."""
    return tag_restock(restock, products, config).agg(*restock_counters(restock.columns, config))


def restock_by_key(restock: DataFrame) -> DataFrame:
    """Incoming quantity per store, product and day, partly summed before the shuffle."""
    keys = ["store_id", "product_id", "restock_date"]
    return (
        restock.dropna(subset=keys)
        .groupBy(*keys)
        .agg(F.coalesce(F.sum("incoming_quantity"), F.lit(0.0)).alias("incoming_restock"))
        .withColumnRenamed("restock_date", "snapshot_date")
    )


def reconcile(snapshot: DataFrame, restock: DataFrame) -> DataFrame:
    """Effective stock of valid snapshots: level + restock - damaged - expired."""
    def or_zero(name: str) -> Column:
        return F.coalesce(F.col(name).cast("double"), F.lit(0.0))

    movement = F.col("incoming_restock") - F.col("damaged_quantity") - F.col("expired_quantity")
    negative = holds(F.col("effective_stock_level") < 0)
    return (
        snapshot.join(restock_by_key(restock), ["store_id", "product_id", "snapshot_date"], "left")
        .withColumns({c: or_zero(c) for c in ("incoming_restock", "damaged_quantity", "expired_quantity")})
        .withColumns({"effective_stock_level": F.col("snapshot_level") + movement, "stock_movement": movement})
        .withColumns(
            {
                "reconciliation_status": F.when(negative, "FLAGGED_NEGATIVE").otherwise("RECONCILED"),
                "negative_effective_stock_flag": negative,
            }
        )
    )


def inventory_fact(
    reconciled: DataFrame,
    products: DataFrame,
    stores: DataFrame,
    config: InventoryConfig = CONFIG,
    stamped: bool = True,
) -> DataFrame:
    """Fact table: reconciled rows with product and store attributes.

    Masters are joined as they are, so a key that occurs twice there doubles its
    rows. ``stamped`` adds the two wall clock columns.
    """
    if stamped:
        reconciled = reconciled.withColumn("reconciled_at", F.current_timestamp())
    fact = (
        keep_existing(reconciled, FACT_COLUMNS)
        .join(products.select("product_id", "product_name", "category", "unit_price"), "product_id", "left")
        .join(stores.select("store_id", "store_name", "city", "region"), "store_id", "left")
    )
    added = ["product_name", "category", "unit_price", "store_name", "city", "region"]
    fact = keep_existing(fact, [*FACT_COLUMNS, *added]).withColumn("pipeline_version", F.lit(config.version))
    return fact.withColumn("created_at", F.current_timestamp()) if stamped else fact


def quarantine(invalid: DataFrame, dataset: str, stamped: bool = True) -> DataFrame:
    """Invalid rows with their source and error class; codes stay an array."""
    df = invalid.withColumns(
        {"source_dataset": F.lit(dataset), "error_type": error_type(F.col("validation_errors"))}
    )
    return df.withColumn("quarantine_date", F.current_timestamp()) if stamped else df


def quarantine_audit(*quarantined: DataFrame) -> DataFrame:
    """All quarantined rows of several datasets in one frame, missing columns null."""
    first, *rest = quarantined
    for df in rest:
        first = first.unionByName(df, allowMissingColumns=True)
    return first


def rows_with_code(df: DataFrame, code: str) -> DataFrame:
    """Rows whose codes contain a text."""
    return df.filter(F.exists("validation_errors", lambda e: e.contains(code)))

