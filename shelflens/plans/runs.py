"""End-to-end runs: named inputs in, written layers out.

A step that feeds several outputs is written to the staging layer once and read
from there.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelflens.config import AffinityConfig, CustomerConfig, FraudConfig, InventoryConfig, LegacyConfig
from shelflens.functions.rules import is_invalid, is_valid
from shelflens.operators import affinity as aff
from shelflens.operators import customers as cus
from shelflens.operators import fraud as frd
from shelflens.operators import inventory as inv
from shelflens.operators import legacy as leg
from shelflens.operators import matching
from shelflens.operators.metrics import Counters, all_metrics, metric_rows, thresholds, value_rows
from shelflens.sources import sinks
from shelflens.sources.readers import load_dataset
from shelflens.sources.shared import scratch, write_once


INVENTORY_THRESHOLDS = ("fuzzy_threshold", "name_threshold")
AFFINITY_THRESHOLDS = ("min_support", "min_confidence", "min_lift", "top_n")
FRAUD_THRESHOLDS = (
    "max_refund_ratio",
    "allowed_refund_window_days",
    "max_refunds",
    "high_value_amount",
    "max_same_product_refunds",
    "zscore_threshold",
    "iqr_multiplier",
    "max_customer_refund_ratio",
)


def load_inputs(spark: SparkSession, base: str, *names: str) -> dict[str, DataFrame]:
    return {name: load_dataset(spark, name, base) for name in names}


def run_inventory(
    inputs: dict[str, DataFrame], out: str, config: InventoryConfig = InventoryConfig()
) -> dict[str, DataFrame | None]:
    """Snapshots and restocks to the inventory fact table, quarantine and report.

    The report's counters are taken by the plans that write the layers. Codes of all
    snapshots, also of those that deduplication drops, are counted while the input is
    archived; so that plan joins the known products.
    """
    counters, spark = Counters(), inputs["products"].sparkSession
    products, stores = inputs["products"], inputs["stores"]
    given = inputs["inventory_snapshot"]
    as_read = {f"_read_{c}": F.col(c) for c in given.columns}
    coded = inv.tag_snapshot(given.withColumns(as_read), products, config)
    coded = counters.watch(coded, "snapshot", *inv.snapshot_counters(given.columns, config))
    snapshot = sinks.archive_raw(coded.select(*[F.col(r).alias(c) for r, c in zip(as_read, given.columns)]), out, "inventory_snapshot")
    restock = sinks.archive_raw(inputs["restock_events"], out, "restock_events")

    def staged(df: DataFrame, group: str, own: list[Column], name: str) -> DataFrame:
        df = counters.watch(df, group, *own)
        if config.sku_enabled:
            odd = is_valid() & ~matching.sku_shape("product_id", config.sku_pattern)
            df = counters.watch(df, f"sku.{group}_product_id", F.count_if(odd).alias("non_standard"))
        return sinks.write_table(df, f"{out}/staging/{name}")

    kept = inv.tag_snapshot(inv.latest_snapshot(snapshot, config), products, config)
    kept = staged(kept, "snapshot", inv.split_counters(), "snapshots")
    tagged = inv.tag_restock(restock, products, config)
    tagged = staged(tagged, "restock", inv.restock_counters(restock.columns, config), "restocks")

    reconciled = inv.reconcile(kept.filter(is_valid()), tagged.filter(is_valid()))
    fact = counters.watch(inv.inventory_fact(reconciled, products, stores, config), "curated", *inv.fact_counters())
    fact = sinks.write_curated(fact, out, "inventory_fact", config.also_save_csv)

    written: dict[str, DataFrame | None] = {}
    rejected = {"inventory_snapshot": kept.filter(is_invalid()), "restock_events": tagged.filter(is_invalid())}
    with scratch(spark):
        if config.fuzzy_enabled:
            # An id that is unknown in both is matched once.
            unknown = reduce(DataFrame.union, [matching.unknown_rows(df).select(F.col("product_id").cast("string")) for df in rejected.values()])
            matches = write_once(matching.best_matches(unknown, products, config.fuzzy_threshold), "matches")
            rejected = {name: matching.suggest_ids(df, products, matches=matches) for name, df in rejected.items()}
        for name, invalid in rejected.items():
            invalid = counters.watch(inv.quarantine(invalid, name), "quarantine", *inv.quarantine_counters(config.fuzzy_enabled))
            written[name] = sinks.write_quarantine(invalid, out, name, config.also_save_csv)

    found = counters.values()
    found["snapshot.duplicates"] = found["snapshot.total"] - found["snapshot.valid"] - found["snapshot.invalid"]
    groups = {"threshold": thresholds(spark, config, *INVENTORY_THRESHOLDS)}
    if config.sku_enabled:  # the master is an input, no layer
        groups["sku.products_sku"] = products.agg(F.count_if(~matching.sku_shape("sku", config.sku_pattern)).alias("non_standard"))
    sinks.write_report(all_metrics(groups).unionByName(value_rows(spark, found)), out, "inventory")
    return {
        "inventory_fact": fact,
        "quarantine_inventory_snapshot": written["inventory_snapshot"],
        "quarantine_restock_events": written["restock_events"],
    }


def run_affinity(
    inputs: dict[str, DataFrame], out: str, config: AffinityConfig = AffinityConfig()
) -> dict[str, DataFrame]:
    """Sales lines to baskets, pairs, affinity scores, recommendations and report.

    Baskets are paired once; ``pairs`` are those of products that can reach the support.
    Pairs, scores and recommendations are counted by the plans that write them.
    """
    header, lines = inputs["store_sales_header"], inputs["store_sales_line_items"]
    products, counters = inputs["products"], Counters()
    items = sinks.write_table(aff.basket_items(lines), f"{out}/staging/basket_items")
    baskets = counters.watch(aff.baskets(items), "pairs", *aff.basket_counters(config.distinct))
    baskets = sinks.write_table(baskets, f"{out}/staging/transaction_baskets")
    frequent = sinks.write_table(aff.frequent_products(items, header, config), f"{out}/staging/frequent_products")
    pairs = sinks.write_table(aff.frequent_pairs(items, frequent, config.distinct), f"{out}/staging/product_pairs")
    found = aff.affinity(items, header, products, config, frequent, pairs)
    found = counters.watch(found, "scores", F.count("*").alias("pairs_above_thresholds"))
    scores = sinks.write_curated(found, out, "affinity_scores", config.also_save_csv)
    best = counters.watch(aff.top_affinities(scores, config.top_n), "top", F.count("*").alias("returned"))
    top = sinks.write_curated(best, out, "top_affinities", config.also_save_csv)
    groups = {
        "baskets": aff.basket_stats(lines, header, products),
        "threshold": thresholds(lines.sparkSession, config, *AFFINITY_THRESHOLDS),
    }
    sinks.write_report(all_metrics(groups).unionByName(value_rows(lines.sparkSession, counters.values())), out, "affinity")
    return {"baskets": baskets, "pairs": pairs, "affinity_scores": scores, "top_affinities": top}


def run_fraud(
    inputs: dict[str, DataFrame], out: str, config: FraudConfig = FraudConfig()
) -> dict[str, DataFrame]:
    """Refunds to fraud flags, suspicious customers, clean refunds and report."""
    customers = inputs["customer_details"]
    enriched = sinks.write_table(
        frd.enrich_refunds(
            inputs["refund_transactions"], inputs["store_sales_header"], customers, inputs["products"]
        ),
        f"{out}/staging/enriched_refunds",
    )
    validated, counters = frd.validate_refunds(enriched, config), Counters()
    with scratch(customers.sparkSession):
        flagged = frd.statistical_anomalies(frd.fraud_patterns(validated, config), config, validated)
        flagged = counters.watch(frd.severity(flagged), "fraud", *frd.fraud_counters())
        scored = sinks.write_table(flagged, f"{out}/staging/validated_refunds")
    # One row per customer with a score.
    suspicious = counters.watch(frd.suspicious_customers(scored, customers), "fraud", F.count("*").alias("suspicious_customers"))
    tables = {
        "fraud_flags": frd.fraud_flags(scored, config),
        "suspicious_customers": suspicious,
        "clean_refunds": frd.clean_refunds(scored),
    }
    written = {name: sinks.write_curated(df, out, name, config.also_save_csv) for name, df in tables.items()}
    limits = metric_rows(thresholds(customers.sparkSession, config, *FRAUD_THRESHOLDS), "threshold.")
    sinks.write_report(limits.unionByName(value_rows(customers.sparkSession, counters.values())), out, "fraud")
    return written


def run_units(units: DataFrame, out: str, config: LegacyConfig = LegacyConfig()) -> dict[str, DataFrame | None]:
    """The single-table inventory run: deduplication follows the split here."""
    raw, counters = sinks.archive_raw(units, out, "inventory"), Counters()
    tagged = counters.watch(leg.tag_units(raw, config), "units", *leg.units_counters())
    tagged = sinks.write_table(tagged, f"{out}/staging/inventory_units")
    invalid = tagged.filter(is_invalid())
    fact = leg.units_fact(leg.reconcile_units(leg.latest_units(tagged.filter(is_valid()), config), config), config)
    curated = sinks.write_curated(counters.watch(fact, "units", *leg.units_fact_counters()), out, "inventory_units")
    audit = sinks.write_quarantine(leg.quarantine_units(invalid), out, "inventory_units")
    found = counters.values()
    found["units.duplicates_removed"] = found["units.valid_records"] - found.pop("units.curated")
    sinks.write_report(value_rows(units.sparkSession, found), out, "inventory_units")
    return {"inventory_units": curated, "quarantine_inventory_units": audit}


def run_customers(
    inputs: dict[str, DataFrame], out: str, config: CustomerConfig = CustomerConfig()
) -> dict[str, DataFrame]:
    """Purchases to scores, churn status, segment and lifetime value of every customer, and report."""
    history, customers = inputs["customer_transactions_history"], inputs["customer_details"]
    base = sinks.write_table(cus.customer_base(history, customers), f"{out}/staging/customer_base")
    valued = cus.lifetime_value(cus.segments(cus.churn_status(cus.rfm_scores(base, config), config)), config)
    counters = Counters()
    valued = counters.watch(
        valued,
        "customers",
        F.count("*").alias("customers"),
        F.sum("monetary").alias("total_spent"),
        F.sum("clv").alias("total_lifetime_value"),
        F.count_if(F.col("churn_status") == "CHURNED").alias("churned"),
    )
    scores = sinks.write_curated(valued, out, "customer_scores", config.also_save_csv)
    segments = sinks.write_curated(cus.segment_distribution(scores), out, "customer_segments", config.also_save_csv)
    sinks.write_report(value_rows(customers.sparkSession, counters.values()), out, "customers")
    return {"customer_scores": scores, "customer_segments": segments}
