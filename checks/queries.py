"""Every operator as a query over the driver's tables, with its SQL counterpart."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import roles
from checks.role_sql import ANOMALIES, DETECTORS, error_type, flags, points, with_roles
from shelflens.config import DATASETS, AffinityConfig, Dataset, FraudConfig, InventoryConfig, LegacyConfig
from shelflens.functions import sketches
from shelflens.functions.quantiles import exact_quantiles
from shelflens.functions.rules import has_code, render_all
from shelflens.operators import affinity as aff
from shelflens.operators import customers as cus
from shelflens.operators import explore
from shelflens.operators import fraud as frd
from shelflens.operators import inventory as inv
from shelflens.operators import legacy as leg
from shelflens.operators import matching
from shelflens.operators.metrics import all_metrics, thresholds
from shelflens.plans import runs
from shelflens.plans.increments import add_increment
from shelflens.plans.runs import AFFINITY_THRESHOLDS, FRAUD_THRESHOLDS, INVENTORY_THRESHOLDS
from shelflens.sources import readers, sinks
from shelflens.sources.readers import load_dataset, load_layer
from shelflens.sources.shared import move_path, shared_folder, write_once
from shelflens.streaming.affinity import stream_pair_counts, write_batches
from shelflens.streaming.fraud import stream_fraud_patterns

Query = Callable[[SparkSession, str], DataFrame]

# Thresholds at the scale of the driver's data.
FRAUD = FraudConfig(
    max_refunds=15,
    high_value_amount=90000.0,
    max_same_product_refunds=2,
    zscore_threshold=1.7,
    iqr_multiplier=0.25,
)
DISTINCT = AffinityConfig(distinct=True)
LEGACY = LegacyConfig(key=("Store_ID", "Product_ID"), max_capacity=50.0)

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query, and its SQL over the roles where there is one."""

    def register(function: Query) -> Query:
        QUERIES[name] = lambda spark, sf: _plain(function(spark, sf))
        if sql is not None:
            ORACLES[name] = with_roles(sql)
        return function

    return register


def _plain(df: DataFrame) -> DataFrame:
    """Code arrays as text, dates as ISO text."""
    df = render_all(df, "validation_errors", "fraud_flags")
    dates = {f.name: F.col(f.name).cast("string") for f in df.schema.fields if f.dataType.simpleString() == "date"}
    return df.withColumns(dates) if dates else df


def _rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


# --- inventory: validation -------------------------------------------------


def _snapshot(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    return inv.validate_snapshot(roles.snapshots(spark, sf), roles.products(spark, sf))


def _restock(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    return inv.validate_restock(roles.restocks(spark, sf), roles.products(spark, sf))


SNAPSHOT = """snapshot_id, store_id, product_id, snapshot_date, snapshot_level, max_capacity, damaged_quantity,
 expired_quantity, validation_status, validation_errors"""
RESTOCK = """restock_id, store_id, product_id, restock_date, incoming_quantity, restock_type, validation_status,
 validation_errors, max_restock_quantity"""


@query("snapshot_tagged", f"SELECT {SNAPSHOT} FROM all_snapshots")
def snapshot_tagged(spark, sf):
    return inv.tag_snapshot(roles.snapshots(spark, sf), roles.products(spark, sf))


STRICT_TESTS = {"NEGATIVE_DAMAGED": "damaged_quantity < 3", "NEGATIVE_EXPIRED": "expired_quantity < 3"}
STRICT_CODES = " || ".join(f"CASE WHEN {test} THEN '{code}; ' ELSE '' END" for code, test in STRICT_TESTS.items())


@query(
    "snapshot_tagged_strict",
    f"""SELECT snapshot_id, product_id, damaged_quantity - 3 AS damaged_quantity, expired_quantity - 3 AS expired_quantity,
    snapshot_level, CASE WHEN replace(codes, 'CAPACITY_EXCEEDED; ', '') = '' THEN 'VALID' ELSE 'INVALID' END
    AS validation_status, codes AS validation_errors
    FROM (SELECT *, validation_errors || {STRICT_CODES} AS codes FROM all_snapshots)""",
)
def snapshot_tagged_strict(spark, sf):
    """The rules that are off by default, on quantities lowered so that some fall below zero."""
    lowered = {c: F.col(c) - 3 for c in ("damaged_quantity", "expired_quantity")}
    rows = roles.snapshots(spark, sf).withColumns(lowered)
    strict = InventoryConfig(check_damaged=True, check_expired=True)
    return inv.tag_snapshot(rows, roles.products(spark, sf), strict).select(
        "snapshot_id", "product_id", *lowered, "snapshot_level", "validation_status", "validation_errors"
    )


@query(
    "snapshot_latest",
    f"""SELECT snapshot_id, store_id, product_id, snapshot_date, snapshot_text AS snapshot_level, max_capacity,
    damaged_quantity, expired_quantity FROM kept_snapshots""",
)
def snapshot_latest(spark, sf):
    return inv.latest_snapshot(roles.snapshots(spark, sf))


@query("snapshot_valid", f"SELECT {SNAPSHOT} FROM kept_snapshots WHERE validation_status = 'VALID'")
def snapshot_valid(spark, sf):
    return _snapshot(spark, sf)[0]


@query("snapshot_invalid", f"SELECT {SNAPSHOT} FROM kept_snapshots WHERE validation_status = 'INVALID'")
def snapshot_invalid(spark, sf):
    return _snapshot(spark, sf)[1]


def _counted(*codes: str) -> str:
    return ", ".join(f"count(*) FILTER (contains(validation_errors, '{c}')) AS {c.lower()}" for c in codes)


SNAPSHOT_COUNTERS = f"""SELECT count(*) AS total, {_counted("MISSING_STORE_ID", "MISSING_PRODUCT_ID",
 "MISSING_SNAPSHOT_DATE", "MISSING_SNAPSHOT_LEVEL", "NEGATIVE_STOCK", "MISMATCHED_PRODUCT_ID", "CAPACITY_EXCEEDED")},
 (SELECT count(*) FROM kept_snapshots WHERE validation_status = 'VALID') AS valid,
 (SELECT count(*) FROM kept_snapshots WHERE validation_status = 'INVALID') AS invalid,
 count(*) - (SELECT count(*) FROM kept_snapshots) AS duplicates FROM all_snapshots"""


@query("snapshot_metrics", SNAPSHOT_COUNTERS)
def snapshot_metrics(spark, sf):
    return inv.snapshot_metrics(roles.snapshots(spark, sf), roles.products(spark, sf))


@query("restock_valid", f"SELECT {RESTOCK} FROM all_restocks WHERE validation_status = 'VALID'")
def restock_valid(spark, sf):
    return _restock(spark, sf)[0]


@query("restock_invalid", f"SELECT {RESTOCK} FROM all_restocks WHERE validation_status = 'INVALID'")
def restock_invalid(spark, sf):
    return _restock(spark, sf)[1]


RESTOCK_COUNTERS = f"""SELECT count(*) AS total, count(*) FILTER (validation_status = 'VALID') AS valid,
 count(*) FILTER (validation_status = 'INVALID') AS invalid, {_counted("MISSING_STORE_ID", "MISSING_PRODUCT_ID",
 "MISSING_RESTOCK_DATE", "MISSING_INCOMING_QUANTITY", "INVALID_QUANTITY", "EXCEEDED_RESTOCK_MAX",
 "MISMATCHED_PRODUCT_ID")} FROM all_restocks"""


@query("restock_metrics", RESTOCK_COUNTERS)
def restock_metrics(spark, sf):
    return inv.restock_metrics(roles.restocks(spark, sf), roles.products(spark, sf))


@query(
    "restock_with_infinite_quantity",
    """SELECT restock_id, product_id, CASE WHEN restock_type = 'BULK' THEN 'inf' ELSE 'finite' END AS kind,
    CASE WHEN restock_type = 'BULK' AND (SELECT count(*) FROM products p WHERE p.product_id = r.product_id) > 0
         THEN 'EXCEEDED' ELSE '' END AS found FROM restocks r""",
)
def restock_with_infinite_quantity(spark, sf):
    """Bulk restocks written as an infinite number exceed the limit of every known product."""
    bulk = F.col("restock_type") == "BULK"
    rows = roles.restocks(spark, sf).withColumn("incoming_quantity", F.when(bulk, " Infinity").otherwise("0.5"))
    tagged = inv.tag_restock(rows, roles.products(spark, sf))
    over = F.when(F.array_contains("validation_errors", "EXCEEDED_RESTOCK_MAX"), "EXCEEDED").otherwise("")
    kind = F.when(F.col("incoming_quantity") == float("inf"), "inf").otherwise("finite")
    return tagged.select("restock_id", "product_id", kind.alias("kind"), over.alias("found"))


@query(
    "rows_with_capacity_warning",
    f"SELECT {SNAPSHOT} FROM all_snapshots WHERE contains(validation_errors, 'CAPACITY_EXCEEDED')",
)
def rows_with_capacity_warning(spark, sf):
    return inv.rows_with_code(snapshot_tagged(spark, sf), "CAPACITY_EXCEEDED")


@query(
    "unknown_product_rows",
    "SELECT * FROM snapshots WHERE product_id IS NOT NULL AND product_id NOT IN (SELECT product_id FROM products)",
)
def unknown_product_rows(spark, sf):
    known = inv.known_products(roles.products(spark, sf))
    return roles.snapshots(spark, sf).filter("product_id IS NOT NULL").join(known, "product_id", "left_anti")


# --- inventory: matching ---------------------------------------------------


def _unknown_ids(spark, sf) -> DataFrame:
    both = [_snapshot(spark, sf)[1], _restock(spark, sf)[1]]
    snapshot, restock = [df.filter(has_code("MISMATCHED_PRODUCT_ID")).select("product_id") for df in both]
    return snapshot.unionByName(restock)


@query("best_matches", "SELECT id, match, score FROM matches")
def best_matches(spark, sf):
    return matching.best_matches(_unknown_ids(spark, sf), roles.products(spark, sf))


SUGGESTED = f"""SELECT {SNAPSHOT}, match AS suggested_product_id, score AS fuzzy_match_score FROM kept_snapshots
 LEFT JOIN matches ON product_id = id WHERE validation_status = 'INVALID'"""


@query("suggested_ids", SUGGESTED)
def suggested_ids(spark, sf):
    return matching.suggest_ids(_snapshot(spark, sf)[1], roles.products(spark, sf))


@query(
    "rows_with_suggestion",
    f"""SELECT product_id, suggested_product_id, fuzzy_match_score FROM ({SUGGESTED})
    WHERE suggested_product_id IS NOT NULL""",
)
def rows_with_suggestion(spark, sf):
    # Only accepted matches are shown, so scores below the threshold are not needed.
    matched = matching.suggest_ids(_snapshot(spark, sf)[1], roles.products(spark, sf), low_scores=False)
    return explore.with_suggestion(matched)


@query("best_name_matches", "SELECT id, match, score FROM name_matches")
def best_name_matches(spark, sf):
    """Product names with their words turned round and one word added, token order ignored."""
    names = roles.products(spark, sf).select(F.col("product_name").alias("name"))
    shuffled = names.select(F.concat_ws(" ", F.reverse(F.split("name", " ")), F.lit("x")).alias("name"))
    return matching.best_matches(
        shuffled, names, 80, column="name", normalizer=matching.similarity.token_sort
    )


SKU_SHAPE = "'^SKU-[A-Z]{3}-[0-9]{3}$'"


@query("sku_check", f"SELECT *, coalesce(regexp_matches(sku, {SKU_SHAPE}), false) AS sku_valid FROM products")
def sku_check(spark, sf):
    return matching.check_sku(roles.products(spark, sf))


@query(
    "sku_check_alternatives",
    "SELECT product_id, sku, coalesce(regexp_matches(sku, '^(SKU-P|STA)'), false) AS sku_valid FROM products",
)
def sku_check_alternatives(spark, sf):
    """Every branch of a pattern is matched at the start: no SKU begins with STA, though some hold it."""
    return matching.check_sku(roles.products(spark, sf), pattern="^SKU-P|STA").select("product_id", "sku", "sku_valid")


@query(
    "sku_check_on_product_id",
    f"""SELECT {SNAPSHOT}, coalesce(regexp_matches(product_id, {SKU_SHAPE}), false) AS sku_valid FROM kept_snapshots
    WHERE validation_status = 'VALID'""",
)
def sku_check_on_product_id(spark, sf):
    return matching.check_sku(_snapshot(spark, sf)[0], "product_id")


# --- inventory: reconciliation, fact, quarantine ---------------------------


@query("restock_by_key", "SELECT * FROM restock_sums")
def restock_by_key(spark, sf):
    return inv.restock_by_key(_restock(spark, sf)[0])


def _reconciled(spark, sf) -> DataFrame:
    return inv.reconcile(_snapshot(spark, sf)[0], _restock(spark, sf)[0])


@query("reconciled", "SELECT * FROM reconciled")
def reconciled(spark, sf):
    return _reconciled(spark, sf).drop("validation_status", "validation_errors")


def _fact(spark, sf) -> DataFrame:
    products, stores = roles.products(spark, sf), roles.stores(spark, sf)
    return inv.inventory_fact(_reconciled(spark, sf), products, stores, stamped=False)


@query("inventory_fact", "SELECT * FROM fact")
def inventory_fact(spark, sf):
    return _fact(spark, sf)


def _quarantine_sql(columns: str, table: str, dataset: str) -> str:
    return f"""SELECT {columns}, '{dataset}' AS source_dataset, {error_type("validation_errors")} AS error_type
    FROM {table} WHERE validation_status = 'INVALID'"""


QUARANTINED_SNAPSHOT = _quarantine_sql(SNAPSHOT, "kept_snapshots", "inventory_snapshot")
QUARANTINED_RESTOCK = _quarantine_sql(RESTOCK, "all_restocks", "restock_events")


@query("quarantine_snapshot", QUARANTINED_SNAPSHOT)
def quarantine_snapshot(spark, sf):
    return inv.quarantine(_snapshot(spark, sf)[1], "inventory_snapshot", stamped=False)


@query("quarantine_restock", QUARANTINED_RESTOCK)
def quarantine_restock(spark, sf):
    return inv.quarantine(_restock(spark, sf)[1], "restock_events", stamped=False)


@query(
    "quarantine_error_types",
    f"""SELECT source_dataset, error_type, count(*) AS count FROM (
      SELECT source_dataset, error_type FROM ({QUARANTINED_SNAPSHOT})
      UNION ALL SELECT source_dataset, error_type FROM ({QUARANTINED_RESTOCK})) GROUP BY 1, 2""",
)
def quarantine_error_types(spark, sf):
    audit = inv.quarantine_audit(quarantine_snapshot(spark, sf), quarantine_restock(spark, sf))
    return audit.groupBy("source_dataset", "error_type").agg(F.count("*").alias("count"))


# --- inventory: exploration ------------------------------------------------


@query(
    "inventory_totals",
    """SELECT count(*) AS records, round(avg(effective_stock_level), 6) AS mean_effective_stock,
    sum(stock_movement) AS total_stock_movement FROM fact""",
)
def inventory_totals(spark, sf):
    return _rounded(explore.inventory_totals(_fact(spark, sf)), 6, "mean_effective_stock")


def _stock_by(column: str) -> None:
    @query(
        f"stock_by_{column}",
        f"""SELECT {column}, coalesce(sum(effective_stock_level), 0) AS effective_stock_level FROM fact
        WHERE {column} IS NOT NULL GROUP BY 1""",
    )
    def stock(spark, sf):
        return explore.stock_by(_fact(spark, sf), column)


_stock_by("store_name")
_stock_by("category")


@query("status_counts", "SELECT reconciliation_status, count(*) AS count FROM fact GROUP BY 1")
def status_counts(spark, sf):
    return explore.value_counts(_reconciled(spark, sf), "reconciliation_status")


@query("store_choices", "SELECT DISTINCT store_name FROM fact WHERE store_name IS NOT NULL")
def store_choices(spark, sf):
    return explore.choices(_fact(spark, sf), "store_name")


@query(
    "fact_filtered",
    "SELECT * FROM fact WHERE category = 'PROMO' AND reconciliation_status = 'FLAGGED_NEGATIVE'",
)
def fact_filtered(spark, sf):
    return explore.filter_fact(_fact(spark, sf), category="PROMO", reconciliation_status="FLAGGED_NEGATIVE")


@query("fact_filtered_by_store", "SELECT * FROM fact WHERE store_name = (SELECT min(store_name) FROM stores)")
def fact_filtered_by_store(spark, sf):
    fact = write_once(_fact(spark, sf), "fact")
    name = roles.stores(spark, sf).agg(F.min("store_name")).first()[0]
    return explore.filter_fact(fact, store_name=name)


@query(
    "layer_counts",
    """SELECT 'raw' AS layer, (SELECT count(*) FROM snapshots) + (SELECT count(*) FROM restocks) AS records
    UNION ALL SELECT 'curated', count(*) FROM kept_snapshots WHERE validation_status = 'VALID'
    UNION ALL SELECT 'quarantine', (SELECT count(*) FROM kept_snapshots WHERE validation_status = 'INVALID')
      + (SELECT count(*) FROM all_restocks WHERE validation_status = 'INVALID')""",
)
def layer_counts(spark, sf):
    def ids(df: DataFrame, column: str) -> DataFrame:
        return df.select(F.col(column).alias("id"))

    raw = ids(roles.snapshots(spark, sf), "snapshot_id").unionByName(ids(roles.restocks(spark, sf), "restock_id"))
    bad = ids(_snapshot(spark, sf)[1], "snapshot_id").unionByName(ids(_restock(spark, sf)[1], "restock_id"))
    return explore.layer_counts({"raw": raw, "curated": ids(_reconciled(spark, sf), "snapshot_id"), "quarantine": bad})


@query(
    "inventory_report",
    f"""SELECT 'snapshot.' || metric AS metric, value FROM (UNPIVOT (
      SELECT COLUMNS(*)::DOUBLE FROM ({SNAPSHOT_COUNTERS})) ON COLUMNS(*) INTO NAME metric VALUE value)
    UNION ALL SELECT 'restock.' || metric, value FROM (UNPIVOT (
      SELECT COLUMNS(*)::DOUBLE FROM ({RESTOCK_COUNTERS})) ON COLUMNS(*) INTO NAME metric VALUE value)""",
)
def inventory_report(spark, sf):
    return all_metrics({"snapshot": snapshot_metrics(spark, sf), "restock": restock_metrics(spark, sf)})


# --- single-table inventory ------------------------------------------------

UNITS = """"Store_ID", "Product_ID", CAST("Date" AS VARCHAR) AS "Date", "Inventory_Level", "Units_Sold",
 "Units_Ordered", "Price", "Discount", validation_status, validation_errors"""


@query("units_valid", f"SELECT {UNITS} FROM tagged_units WHERE validation_status = 'VALID'")
def units_valid(spark, sf):
    return leg.validate_units(roles.units(spark, sf), LEGACY)[0]


@query(
    "units_quarantine",
    f"""SELECT {UNITS}, CASE WHEN contains(validation_errors, 'Missing') THEN 'MISSING_FIELD'
      WHEN contains(validation_errors, 'Negative') THEN 'NEGATIVE_VALUE'
      WHEN contains(validation_errors, 'Invalid') THEN 'INVALID_VALUE' ELSE 'UNKNOWN' END AS error_type
    FROM tagged_units WHERE validation_status = 'INVALID'""",
)
def units_quarantine(spark, sf):
    return leg.quarantine_units(leg.validate_units(roles.units(spark, sf), LEGACY)[1], stamped=False)


@query("units_latest", f"SELECT {UNITS} FROM latest_units")
def units_latest(spark, sf):
    return leg.latest_units(units_valid(spark, sf), LEGACY)


@query("units_fact", 'SELECT * REPLACE (CAST("Date" AS VARCHAR) AS "Date") FROM units_fact')
def units_fact(spark, sf):
    return leg.units_fact(leg.reconcile_units(units_latest(spark, sf), LEGACY), LEGACY, stamped=False)


@query(
    "units_metrics",
    """SELECT count(*) AS total_records, count(*) FILTER (validation_status = 'VALID') AS valid_records,
      count(*) FILTER (validation_status = 'INVALID') AS invalid_records,
      valid_records - (SELECT count(*) FROM units_fact) AS duplicates_removed,
      (SELECT count(*) FROM units_fact WHERE negative_stock_flag) AS negative_stock_flags,
      (SELECT count(*) FROM units_fact WHERE capacity_exceeded_flag) AS capacity_exceeded_flags
    FROM tagged_units""",
)
def units_metrics(spark, sf):
    return leg.units_metrics(roles.units(spark, sf), LEGACY)


# --- affinity --------------------------------------------------------------


def _items(spark, sf) -> DataFrame:
    return aff.basket_items(roles.lines(spark, sf))


@query(
    "baskets",
    """SELECT transaction_id, string_agg(product_id || ' x' || n, ', ' ORDER BY product_id) AS items,
    CAST(sum(n) AS BIGINT) AS basket_size FROM items GROUP BY 1 HAVING sum(n) >= 2""",
)
def baskets(spark, sf):
    text = F.transform("items", lambda i: F.concat(i["product_id"], F.lit(" x"), i["quantity_lines"].cast("string")))
    return aff.baskets(_items(spark, sf)).withColumn("items", F.array_join(text, ", "))


@query(
    "basket_product_lists",
    """SELECT transaction_id, string_agg(product_id, ', ' ORDER BY product_id) AS products,
    count(*) AS basket_size FROM lines GROUP BY 1 HAVING count(*) >= 2""",
)
def basket_product_lists(spark, sf):
    return aff.product_lists(aff.baskets(_items(spark, sf))).withColumn("products", F.array_join("products", ", "))


@query("product_pairs", "SELECT * FROM pairs_list")
def product_pairs(spark, sf):
    return aff.product_pairs(_items(spark, sf))


@query("product_pairs_distinct", "SELECT * FROM pairs_distinct")
def product_pairs_distinct(spark, sf):
    return aff.product_pairs(_items(spark, sf), distinct=True)


@query(
    "product_pair_rows",
    "SELECT transaction_id, product_a, product_b FROM (SELECT *, unnest(range(pair_rows)) AS i FROM pairs_list)",
)
def product_pair_rows(spark, sf):
    return aff.expand_pairs(product_pairs(spark, sf))


@query(
    "pair_counts",
    "SELECT product_a, product_b, CAST(sum(pair_rows) AS BIGINT) AS pair_count FROM pairs_list GROUP BY 1, 2",
)
def pair_counts(spark, sf):
    return aff.pair_counts(product_pairs(spark, sf))


@query("product_counts", "SELECT * FROM product_count")
def product_counts(spark, sf):
    return aff.product_counts(_items(spark, sf))


@query("product_counts_sketched", "SELECT product_id, product_count, true AS within FROM product_count")
def product_counts_sketched(spark, sf):
    """Transactions per product from sketches by product and day: exact counts, and whether four deviations hold."""
    days = write_once(aff.daily_baskets(roles.lines(spark, sf), roles.header(spark, sf), 0.01), "daily_baskets")
    near = aff.approximate_product_counts(days).withColumnRenamed("product_count", "estimate")
    off = F.abs(F.col("estimate") - F.col("product_count")) / F.col("product_count")
    return product_counts(spark, sf).join(near, "product_id").select("product_id", "product_count", (off <= 0.04).alias("within"))


def _affinity(spark, sf, config: AffinityConfig = AffinityConfig()) -> DataFrame:
    items = write_once(_items(spark, sf), "basket_items")
    return aff.affinity(items, roles.header(spark, sf), roles.brands(spark, sf), config)


@query("affinity_scores", "SELECT * FROM affinity_list")
def affinity_scores(spark, sf):
    return _affinity(spark, sf)


@query("affinity_scores_distinct", "SELECT * FROM affinity_distinct")
def affinity_scores_distinct(spark, sf):
    return _affinity(spark, sf, DISTINCT)


def _top_sql(scores: str) -> str:
    return f"""SELECT CAST(row_number() OVER (ORDER BY lift DESC, product_a, product_b) AS INTEGER) AS rank,
      product_a, product_a_name, product_b, product_b_name, round(support, 4) AS support,
      round(confidence_a_to_b, 4) AS confidence_a_to_b, round(lift, 4) AS lift, pair_count,
      'Customers who buy ' || product_a_name || ' also buy ' || product_b_name AS recommendation
    FROM {scores} ORDER BY lift DESC, product_a, product_b LIMIT 10"""


@query("top_affinities", _top_sql("affinity_list"))
def top_affinities(spark, sf):
    return aff.top_affinities(_affinity(spark, sf))


@query("top_affinities_distinct", _top_sql("affinity_distinct"))
def top_affinities_distinct(spark, sf):
    return aff.top_affinities(_affinity(spark, sf, DISTINCT))


BASKET_STATS = """SELECT (SELECT count(*) FROM header) AS total_transactions, (SELECT count(*) FROM lines) AS total_line_items,
      (SELECT count(*) FROM brands) AS total_products,
      (SELECT count(DISTINCT product_id) FROM lines) AS unique_products_in_sales, count(*) AS baskets,
      count(*) FILTER (size >= 2) AS baskets_with_pairs, round(avg(size), 6) AS mean_basket_size
    FROM (SELECT count(*) AS size FROM lines GROUP BY transaction_id)"""


@query("basket_stats", BASKET_STATS)
def basket_stats(spark, sf):
    stats = aff.basket_stats(roles.lines(spark, sf), roles.header(spark, sf), roles.brands(spark, sf))
    return _rounded(stats, 6, "mean_basket_size")


@query(
    "affinity_metrics",
    """SELECT CAST(sum(pair_rows) AS BIGINT) AS total_product_pairs,
      (SELECT count(*) FROM affinity_list) AS pairs_above_thresholds,
      least((SELECT count(*) FROM affinity_list), 10) AS top_affinities,
      (SELECT count(*) FROM header) AS total_transactions FROM pairs_list""",
)
def affinity_metrics(spark, sf):
    items = write_once(_items(spark, sf), "basket_items")
    return aff.affinity_metrics(items, roles.header(spark, sf), roles.brands(spark, sf))


def _edge_sql() -> str:
    """Rows whose support is the largest there is, the very edge."""
    return "SELECT product_a, product_b, pair_count FROM affinity_list WHERE support = (SELECT max(support) FROM affinity_list)"


@query("affinity_scores_edge", _edge_sql())
def affinity_scores_edge(spark, sf):
    """The least support is set to exactly that of the most frequent pair, which must stay."""
    items = write_once(_items(spark, sf), "basket_items")
    header, brands = roles.header(spark, sf), roles.brands(spark, sf)
    edge = aff.affinity(items, header, brands).agg(F.max("support")).first()[0]
    found = aff.affinity(items, header, brands, replace(AffinityConfig(), min_support=edge or 1.0))
    return found.select("product_a", "product_b", "pair_count")


@query(
    "pair_counts_hashed",
    """WITH sold AS (SELECT l_orderkey AS t, l_partkey AS p, count(*) AS n FROM lineitem GROUP BY 1, 2)
    SELECT a.p AS product_a, b.p AS product_b, CAST(sum(CASE WHEN a.p = b.p THEN a.n * (a.n - 1) // 2 ELSE a.n * b.n END) AS BIGINT) AS pair_count
    FROM sold a JOIN sold b USING (t) WHERE a.p < b.p OR (a.p = b.p AND a.n > 1) GROUP BY ALL HAVING pair_count >= 2""",
)
def pair_counts_hashed(spark, sf):
    """Pairs of single parts that occur twice or more, of which buckets rule out most before they are counted."""
    lines = roles.table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("transaction_id"), F.col("l_partkey").alias("product_id"))
    items, header = write_once(aff.basket_items(lines), "basket_items"), roles.header(spark, sf)
    twice = AffinityConfig(min_support=2 / max(1, header.count()))
    frequent = write_once(aff.frequent_products(items, header, twice), "frequent_products")
    return aff.pair_counts(aff.candidate_pairs(items, header, frequent, twice)).filter("pair_count >= 2")


def _unpivoted(prefix: str, sql: str) -> str:
    return f"""SELECT '{prefix}.' || metric AS metric, value FROM (UNPIVOT (
      SELECT COLUMNS(*)::DOUBLE FROM ({sql})) ON COLUMNS(*) INTO NAME metric VALUE value)"""


def _threshold_sql(config: object, names: tuple[str, ...]) -> str:
    return " UNION ALL ".join(f"SELECT 'threshold.{n}', CAST({getattr(config, n)} AS DOUBLE)" for n in names)


@query(
    "affinity_report",
    _unpivoted(
        "affinity",
        """SELECT CAST(sum(pair_rows) AS BIGINT) AS total_product_pairs,
        (SELECT count(*) FROM affinity_list) AS pairs_above_thresholds,
        least((SELECT count(*) FROM affinity_list), 10) AS top_affinities,
        (SELECT count(*) FROM header) AS total_transactions FROM pairs_list""",
    )
    + " UNION ALL "
    + _threshold_sql(AffinityConfig(), AFFINITY_THRESHOLDS),
)
def affinity_report(spark, sf):
    limits = thresholds(spark, AffinityConfig(), *AFFINITY_THRESHOLDS)
    return all_metrics({"affinity": affinity_metrics(spark, sf), "threshold": limits})


# --- refunds ---------------------------------------------------------------


def _enriched(spark, sf) -> DataFrame:
    return frd.enrich_refunds(
        roles.refunds(spark, sf), roles.header(spark, sf), roles.customers(spark, sf), roles.brands(spark, sf)
    )


def _scored(spark, sf, config: FraudConfig = FRAUD) -> DataFrame:
    return frd.score_refunds(
        roles.refunds(spark, sf),
        roles.header(spark, sf),
        roles.customers(spark, sf),
        roles.brands(spark, sf),
        config,
    )


ENRICHED = "* REPLACE (CAST(refund_date AS VARCHAR) AS refund_date, CAST(sale_date AS VARCHAR) AS sale_date)"


@query("enriched_refunds", f"SELECT {ENRICHED} FROM enriched")
def enriched_refunds(spark, sf):
    return _enriched(spark, sf)


@query("validated_refunds", "SELECT refund_id, refund_amount, validation_status, validation_errors FROM validated")
def validated_refunds(spark, sf):
    validated = frd.validate_refunds(_enriched(spark, sf))
    return validated.select("refund_id", "refund_amount", "validation_status", "validation_errors")


@query(
    "validated_refunds_relaxed",
    """SELECT refund_id, refund_amount, CASE WHEN coalesce(refund_ratio > 1.0, false) OR days_since_purchase > 30
      THEN 'INVALID' ELSE 'VALID' END AS validation_status FROM enriched""",
)
def validated_refunds_relaxed(spark, sf):
    relaxed = replace(FRAUD, require_customer_match=False, require_payment_mode_match=False)
    validated = frd.validate_refunds(_enriched(spark, sf), relaxed)
    return validated.select("refund_id", "refund_amount", "validation_status")


@query(
    "refund_behaviour",
    """SELECT customer_id, product_id, CASE WHEN product_id IS NOT NULL THEN count(*) END AS product_refund_count,
      CAST(sum(count(*)) OVER c AS BIGINT) AS refund_count,
      round(sum(sum(refund_amount)) OVER c, 2) AS customer_refund_amount
    FROM refunds WHERE customer_id IS NOT NULL GROUP BY 1, 2 WINDOW c AS (PARTITION BY customer_id)""",
)
def refund_behaviour(spark, sf):
    return _rounded(frd.refund_behaviour(roles.refunds(spark, sf)), 2, "customer_refund_amount")


@query(
    "fraud_patterns",
    f"""SELECT refund_id, refund_amount, refund_count, product_refund_count, {flags(DETECTORS)} AS fraud_flags,
      {points(DETECTORS)} AS fraud_score FROM behaved""",
)
def fraud_patterns(spark, sf):
    enriched = write_once(_enriched(spark, sf), "enriched_refunds")
    return frd.fraud_patterns(frd.validate_refunds(enriched), FRAUD).select(
        "refund_id", "refund_amount", "refund_count", "product_refund_count", "fraud_flags", "fraud_score"
    )


@query(
    "refund_amount_stats",
    """SELECT round(mean_amount, 4) AS mean_amount, round(std_amount, 4) AS std_amount, amounts, round(q1, 4) AS q1,
      round(q3, 4) AS q3 FROM stats""",
)
def refund_amount_stats(spark, sf):
    refunds = write_once(roles.refunds(spark, sf).select("refund_amount"), "refund_amounts")
    return _rounded(frd.amount_stats(refunds), 4, "mean_amount", "std_amount", "q1", "q3")


SHARES = [0.05, 0.25, 0.5, 0.75, 0.95, 0.999]


@query(
    "refund_amount_sketches",
    "SELECT unnest([0.05, 0.25, 0.5, 0.75, 0.95, 0.999]) AS share, (SELECT amounts FROM stats) AS amounts, true AS within",
)
def refund_amount_sketches(spark, sf):
    """Quantiles of sketches made by day and merged: whether their exact ranks are off by the stated error at most."""
    error = 0.001
    refunds = write_once(roles.refunds(spark, sf).select("refund_date", "refund_amount"), "refund_amounts")
    days = write_once(frd.daily_amounts(refunds, error), "daily_amounts")
    whole = days.agg(sketches.merged_quantile_sketch("sketch", error).alias("sketch"))
    found = whole.select(F.array(*sketches.quantiles(F.col("sketch"), SHARES))).first()[0]
    amount, n = F.col("refund_amount"), F.count("refund_amount")
    below = lambda p, q: (F.count_if(amount < q) <= (p + error) * n) & (F.count_if(amount <= q) >= (p - error) * n)
    rows = F.array(*[F.struct(F.lit(p).alias("share"), n.alias("amounts"), below(p, q).alias("within")) for p, q in zip(SHARES, found)])
    return refunds.agg(rows.alias("rows")).select(F.inline("rows"))


@query(
    "refund_amount_stats_by_month",
    """SELECT strftime(refund_date, '%Y-%m') AS month, count(refund_amount) AS amounts, round(avg(refund_amount) + 1e-6, 4) AS mean_amount,
      round(stddev_samp(refund_amount) + 1e-6, 4) AS std_amount, true AS quartiles_within FROM refunds GROUP BY 1""",
)
def refund_amount_stats_by_month(spark, sf):
    """Daily statistics merged into months; the quartiles against the refunds of the month."""
    error = 0.001
    refunds = write_once(roles.refunds(spark, sf).select("refund_date", "refund_amount"), "refund_amounts")
    month = lambda day: F.date_format(day, "yyyy-MM").alias("month")
    days = write_once(frd.daily_amounts(refunds, error), "daily_amounts")
    months = write_once(frd.amount_stats_of(days, month("refund_day"), error=error), "months")
    amount, n = F.col("refund_amount"), F.count("refund_amount")
    off = lambda p, q: (F.count_if(amount < q) > (p + error) * n) | (F.count_if(amount <= q) < (p - error) * n)
    checked = refunds.select(month("refund_date"), "refund_amount").join(months, "month").groupBy("month")
    checked = checked.agg((~(off(0.25, F.col("q1")) | off(0.75, F.col("q3")))).alias("quartiles_within"))
    found = months.join(checked, "month").select("month", "amounts", "mean_amount", "std_amount", "quartiles_within")
    # Off the ties of rounding, where sums in another order would fall to either side.
    return _rounded(found.withColumns({c: F.col(c) + 1e-6 for c in ("mean_amount", "std_amount")}), 4, "mean_amount", "std_amount")


@query(
    "price_quantiles",
    "SELECT "
    + ", ".join(f"round(quantile_cont(l_extendedprice, {p}), 4) AS q{i}" for i, p in enumerate([0, 0.1, 0.5, 0.999, 1]))
    + " FROM lineitem",
)
def price_quantiles(spark, sf):
    wanted = exact_quantiles(roles.table(spark, sf, "lineitem"), "l_extendedprice", [0, 0.1, 0.5, 0.999, 1])
    return _rounded(wanted, 4, *wanted.columns)


@query(
    "statistical_anomalies",
    f"""SELECT refund_id, refund_amount, round((refund_amount - mean_amount) / std_amount, 4) + 0.0 AS zscore_amount,
      round(customer_refund_ratio, 6) AS customer_refund_ratio, {flags(ANOMALIES)} AS fraud_flags,
      {points(ANOMALIES)} AS fraud_score FROM behaved, stats""",
)
def statistical_anomalies(spark, sf):
    enriched = write_once(_enriched(spark, sf), "enriched_refunds")
    behaviour = write_once(frd.refund_behaviour(enriched), "refund_behaviour")
    behaved = frd.join_behaviour(frd.validate_refunds(enriched), behaviour)
    found = frd.statistical_anomalies(behaved, FRAUD, enriched).select(
        "refund_id", "refund_amount", "zscore_amount", "customer_refund_ratio", "fraud_flags", "fraud_score"
    )
    found = _rounded(_rounded(found, 4, "zscore_amount"), 6, "customer_refund_ratio")
    return found.withColumn("zscore_amount", F.col("zscore_amount") + 0.0)  # no negative zero


@query("severity_counts", "SELECT fraud_severity, count(*) AS count FROM scored GROUP BY 1")
def severity_counts(spark, sf):
    return explore.value_counts(_scored(spark, sf), "fraud_severity")


FRAUD_FLAGS = """SELECT refund_id, original_transaction_id, customer_id, customer_name,
  CAST(refund_date AS VARCHAR) AS refund_date, refund_amount, original_amount, refund_ratio, product_id, product_name,
  payment_mode, original_payment_mode, days_since_purchase, refund_count, product_refund_count, validation_status,
  validation_errors, fraud_flags, fraud_score, fraud_severity, '1.0' AS pipeline_version FROM scored"""


@query("fraud_flags", FRAUD_FLAGS)
def fraud_flags(spark, sf):
    return frd.fraud_flags(_scored(spark, sf), FRAUD, stamped=False, ordered=False)


@query("fraud_flags_by_score", FRAUD_FLAGS + " ORDER BY fraud_score DESC, refund_id")
def fraud_flags_by_score(spark, sf):
    # A global sort looks at its input twice, so the input is a written table, as in the run.
    return frd.fraud_flags(write_once(_scored(spark, sf), "scored"), FRAUD, stamped=False)


FLAG_NAMES = [name for name, _, _ in DETECTORS + ANOMALIES]
UNION_OF_FLAGS = ", ".join(
    f"CASE WHEN bool_or(contains(fraud_flags, '{name}')) THEN '{name}' END" for name in sorted(FLAG_NAMES)
)


@query(
    "suspicious_customers",
    f"""SELECT customer_id, min(customer_name) AS customer_name, min(customer_tier) AS customer_tier,
      min(account_status) AS account_status, count(refund_id) AS total_refunds_count,
      round(sum(refund_amount), 2) AS total_refund_amount, CAST(sum(fraud_score) AS BIGINT) AS total_fraud_score,
      concat_ws('; ', {UNION_OF_FLAGS}) AS all_fraud_flags,
      CASE WHEN sum(fraud_score) <= 30 THEN 'LOW_RISK' WHEN sum(fraud_score) <= 60 THEN 'MEDIUM_RISK'
           WHEN sum(fraud_score) <= 100 THEN 'HIGH_RISK' ELSE 'CRITICAL_RISK' END AS risk_level
    FROM scored WHERE customer_id IS NOT NULL GROUP BY 1 HAVING sum(fraud_score) > 0""",
)
def suspicious_customers(spark, sf):
    table = frd.suspicious_customers(_scored(spark, sf), roles.customers(spark, sf))
    return _rounded(table, 2, "total_refund_amount")


@query(
    "clean_refunds",
    """SELECT refund_id, original_transaction_id, customer_id, CAST(refund_date AS VARCHAR) AS refund_date, refund_amount,
      product_id, refund_reason FROM scored WHERE fraud_severity = 'CLEAN'""",
)
def clean_refunds(spark, sf):
    return frd.clean_refunds(_scored(spark, sf))


FRAUD_COUNTERS = ", ".join(
    [f"count(*) FILTER (contains(validation_errors, '{c}')) AS invalid_{c.lower()}"
     for c in ("AMOUNT_EXCEEDED", "CUSTOMER_MISMATCH", "OUTSIDE_WINDOW", "PAYMENT_MISMATCH")]
    + [f"count(*) FILTER (contains(fraud_flags, '{c}')) AS flag_{c.lower()}" for c in FLAG_NAMES]
)


FRAUD_METRICS = f"""SELECT count(*) AS total_refunds, count(*) FILTER (validation_status = 'VALID') AS valid_refunds,
      count(*) FILTER (validation_status = 'INVALID') AS invalid_refunds, {FRAUD_COUNTERS},
      count(*) FILTER (fraud_score > 0) AS total_fraud_flags,
      count(DISTINCT customer_id) FILTER (fraud_score > 0) AS suspicious_customers,
      count(*) FILTER (fraud_severity = 'CLEAN') AS clean_refunds FROM scored"""


@query("fraud_metrics", FRAUD_METRICS)
def fraud_metrics(spark, sf):
    return frd.fraud_metrics(_scored(spark, sf))


@query("fraud_report", _unpivoted("fraud", FRAUD_METRICS) + " UNION ALL " + _threshold_sql(FRAUD, FRAUD_THRESHOLDS))
def fraud_report(spark, sf):
    return all_metrics({"fraud": fraud_metrics(spark, sf), "threshold": thresholds(spark, FRAUD, *FRAUD_THRESHOLDS)})


WITHOUT = replace(
    FRAUD, amount_exceeded_enabled=False, payment_mismatch_enabled=False, zscore_enabled=False, refund_ratio_enabled=False
)
FEW = [*DETECTORS[:3], ANOMALIES[1]]


@query(
    "fraud_flags_without_detectors",
    f"SELECT refund_id, {flags(FEW)} AS fraud_flags, {points(FEW)} AS fraud_score FROM behaved, stats",
)
def fraud_flags_without_detectors(spark, sf):
    return _scored(spark, sf, WITHOUT).select("refund_id", "fraud_flags", "fraud_score")


@query(
    "recent_refunds",
    """SELECT DISTINCT customer_id, CAST(refund_date AS VARCHAR) AS refund_day, count(*) OVER w AS recent_count,
      round(sum(refund_amount) OVER w, 2) AS recent_amount
    FROM refunds WHERE customer_id IS NOT NULL
    WINDOW w AS (PARTITION BY customer_id ORDER BY refund_date RANGE BETWEEN INTERVAL 30 DAY PRECEDING AND CURRENT ROW)""",
)
def recent_refunds(spark, sf):
    recent = frd.recent_refunds(roles.refunds(spark, sf), ["customer_id"], 30)
    return _rounded(recent, 2, "recent_amount")


OPTIONAL = replace(
    FRAUD,
    max_refunds=1,
    refund_window_days=30,
    max_same_product_refunds=1,
    product_window_days=60,
    high_value_frequent_enabled=True,
    high_value_frequent_amount=120000.0,
    outside_window_enabled=True,
)


def _recent_sql(keys: str, days: int) -> str:
    return f"OVER (PARTITION BY {keys} ORDER BY refund_date RANGE BETWEEN INTERVAL {days} DAY PRECEDING AND CURRENT ROW)"


OPTIONAL_DETECTORS = [
    ("HIGH_FREQUENCY", 30, "coalesce(recent_count > 1, false)"),
    ("HIGH_VALUE", 20, "refund_amount > 90000"),
    ("REPEAT_PRODUCT", 25, "coalesce(recent_product > 1, false)"),
    *DETECTORS[3:],
    ("HIGH_VALUE_FREQUENT", 40, "coalesce(recent_count >= 2 AND recent_amount >= 120000, false)"),
    ("OUTSIDE_WINDOW", 15, "days_since_purchase > 30"),
]


WINDOWED = f"""SELECT refund_id, refund_amount, recent_count AS refund_count, recent_product AS product_refund_count,
      {flags(OPTIONAL_DETECTORS)} AS fraud_flags, {points(OPTIONAL_DETECTORS)} AS fraud_score
    FROM (SELECT *,
      CASE WHEN customer_id IS NOT NULL THEN count(*) {_recent_sql("customer_id", 30)} END AS recent_count,
      CASE WHEN customer_id IS NOT NULL THEN sum(refund_amount) {_recent_sql("customer_id", 30)} END AS recent_amount,
      CASE WHEN customer_id IS NOT NULL AND product_id IS NOT NULL
           THEN count(*) {_recent_sql("customer_id, product_id", 60)} END AS recent_product
      FROM validated)"""


@query("fraud_patterns_windowed", WINDOWED)
def fraud_patterns_windowed(spark, sf):
    enriched = write_once(_enriched(spark, sf), "enriched_refunds")
    return frd.fraud_patterns(frd.validate_refunds(enriched), OPTIONAL).select(
        "refund_id", "refund_amount", "refund_count", "product_refund_count", "fraud_flags", "fraud_score"
    )


# --- customers -------------------------------------------------------------


def _base(spark, sf) -> DataFrame:
    return cus.customer_base(roles.history(spark, sf), roles.customers(spark, sf))


@query("rfm_scores", "SELECT * REPLACE (round(monetary, 5) AS monetary) FROM rfm")
def rfm_scores(spark, sf):
    return _rounded(cus.rfm_scores(_base(spark, sf)), 5, "monetary")


@query(
    "churn_status",
    """SELECT customer_id, recency_days, CASE WHEN recency_days < 30 THEN 'ACTIVE' WHEN recency_days < 60 THEN 'AT_RISK'
      WHEN recency_days <= 90 THEN 'CHURNING' ELSE 'CHURNED' END AS churn_status FROM base""",
)
def churn_status(spark, sf):
    return cus.churn_status(_base(spark, sf)).select("customer_id", "recency_days", "churn_status")


@query("customer_segments", "SELECT customer_id, rfm_score, segment FROM segmented")
def customer_segments(spark, sf):
    return cus.segments(cus.rfm_scores(_base(spark, sf))).select("customer_id", "rfm_score", "segment")


@query(
    "lifetime_value",
    """SELECT customer_id, round(annual, 7) AS annual_revenue, round(annual * (rfm_score / 15) * 0.2, 7) AS clv
    FROM (SELECT *, monetary * 365 / greatest(coalesce(tenure_days, 0), 365) AS annual FROM rfm)""",
)
def lifetime_value(spark, sf):
    valued = cus.lifetime_value(cus.rfm_scores(_base(spark, sf)))
    return _rounded(valued, 7, "annual_revenue", "clv").select("customer_id", "annual_revenue", "clv")


@query(
    "segment_distribution",
    """SELECT segment, count(*) AS customers, round(count(*) * 100.0 / sum(count(*)) OVER (), 1) AS percent
    FROM segmented GROUP BY 1""",
)
def segment_distribution(spark, sf):
    return cus.segment_distribution(customer_segments(spark, sf))


# --- sources and sinks ------------------------------------------------------


def _folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


@query(
    "source_csv",
    """SELECT * REPLACE (CASE WHEN snapshot_level = 'n/a' THEN NULL ELSE snapshot_level END AS snapshot_level)
    FROM snapshots""",
)
def source_csv(spark, sf):
    """Snapshots written as csv and loaded by name; a text for "no value" is null."""
    base = _folder(spark, "source_csv")
    sinks.write_csv(roles.snapshots(spark, sf), f"{base}/raw/inventory_snapshot.csv")
    return load_dataset(spark, "inventory_snapshot", base)


@query("source_json", "SELECT * REPLACE (CAST(sale_date AS VARCHAR) AS sale_date) FROM header")
def source_json(spark, sf):
    """Sales as JSON lines, with the declared types after loading."""
    base, rows = _folder(spark, "source_json"), roles.header(spark, sf)
    rows.write.json(f"{base}/sales")
    types = {"sale_date": "date", "total_amount": "double", "customer_id": "long", "transaction_id": "long"}
    loaded = load_dataset(spark, "sales", base, {"sales": Dataset("sales", "json", types=types)})
    return loaded.select(*rows.columns)


@query(
    "source_csv_quoted",
    """SELECT product_id, product_name || chr(10) || 'kind "' || category || '",' || chr(10) AS product_name, sku, category, unit_price,
      max_restock_quantity, CAST(NULL AS VARCHAR) AS bad FROM products""",
)
def source_csv_quoted(spark, sf):
    """Products as csv whose names hold line breaks, quotes and commas, cut at true ends of records."""
    base = _folder(spark, "source_csv_quoted")
    name = F.concat("product_name", F.lit("\n"), F.lit('kind "'), "category", F.lit('",\n'))
    sinks.write_csv(roles.products(spark, sf).withColumn("product_name", name), f"{base}/products")
    quoted = replace(DATASETS["products"], path="products", line_breaks=True, bad_records="bad")
    return load_dataset(spark, "products", base, {"products": quoted})


@query("source_parquet", "SELECT * FROM products")
def source_parquet(spark, sf):
    """Products through the raw archive, loaded by name."""
    base = _folder(spark, "source_parquet")
    sinks.archive_raw(roles.products(spark, sf), base, "products")
    return load_dataset(spark, "products", base, {"products": Dataset("raw/products_raw.parquet", "parquet")})


@query("curated_sink", "SELECT * FROM fact")
def curated_sink(spark, sf):
    base = _folder(spark, "curated_sink")
    sinks.write_curated(_fact(spark, sf), base, "inventory_fact", also_csv=False)
    return load_layer(spark, f"{base}/curated/inventory_fact/inventory_fact.parquet")


@query("quarantine_sink", QUARANTINED_SNAPSHOT)
def quarantine_sink(spark, sf):
    return sinks.write_quarantine(quarantine_snapshot(spark, sf), _folder(spark, "quarantine_sink"), "inventory_snapshot")


@query("stamped_fact", "SELECT snapshot_id, true AS stamped FROM fact")
def stamped_fact(spark, sf):
    """The wall clock columns are set, whatever they hold."""
    fact = inv.inventory_fact(_reconciled(spark, sf), roles.products(spark, sf), roles.stores(spark, sf))
    return fact.select("snapshot_id", (F.col("reconciled_at").isNotNull() & F.col("created_at").isNotNull()).alias("stamped"))


@query(
    "source_json_declared",
    """SELECT transaction_id, CAST(NULL AS VARCHAR) AS store_id, customer_id, CAST(sale_date AS VARCHAR) AS sale_date, total_amount,
      payment_mode FROM header""",
)
def source_json_declared(spark, sf):
    """Sales as JSON lines by the columns that the dataset declares, in one pass; a column that no line has is null."""
    base = _folder(spark, "source_json")
    roles.header(spark, sf).write.json(f"{base}/sales")
    sales = replace(DATASETS["store_sales_header"], path="sales", file_type="json")
    sales = replace(sales, types={**sales.types, "customer_id": "long", "transaction_id": "long"})
    return load_dataset(spark, "sales", base, {"sales": sales})


@query(
    "missing_columns",
    """SELECT 'customer_details' AS dataset, '' AS missing, (SELECT count(*) FROM customers) AS records
    UNION ALL SELECT 'products', '', count(*) FROM products UNION ALL SELECT 'restock_events', '', count(*) FROM restocks
    UNION ALL SELECT 'store_sales_header', 'store_id', count(*) FROM header""",
)
def missing_columns(spark, sf):
    """Required columns that the roles of four datasets lack."""
    frames = {"customer_details": roles.customers, "products": roles.products, "restock_events": roles.restocks, "store_sales_header": roles.header}
    found = []
    for name, role in frames.items():
        df = role(spark, sf)
        absent = ",".join(readers.missing_columns(df, DATASETS[name].required))
        found.append(df.agg(F.lit(name).alias("dataset"), F.lit(absent).alias("missing"), F.count("*").alias("records")))
    return reduce(DataFrame.unionAll, found)


@query(
    "curated_csv",
    "SELECT product_id, product_name, sku, category, CAST(unit_price AS VARCHAR) AS unit_price FROM products",
)
def curated_csv(spark, sf):
    """The csv copy of a curated table, read as text."""
    base = _folder(spark, "curated_csv")
    table = roles.products(spark, sf).select("product_id", "product_name", "sku", "category", F.col("unit_price").cast("string").alias("unit_price"))
    sinks.write_curated(table, base, "products")
    return spark.read.options(header=True, escape='"').csv(f"{base}/curated/products/products.csv")


# --- whole runs: the layers they write, and their reports ---------------------


def _report(spark: SparkSession, out: str, name: str) -> DataFrame:
    rows = spark.read.schema("metric string, value double").json(f"{out}/reports/{name}")
    return rows.withColumn("value", F.round("value", 4))


RESTOCK_MATCHES = "SELECT product_id, match, score FROM all_restocks LEFT JOIN matches ON product_id = id WHERE validation_status = 'INVALID'"
ODD = f"NOT coalesce(regexp_matches(product_id, {SKU_SHAPE}), false)"

INVENTORY_RUN = f"""SELECT metric, round(value, 4) AS value FROM ({_unpivoted("snapshot", SNAPSHOT_COUNTERS)}
  UNION ALL {_unpivoted("restock", RESTOCK_COUNTERS)}
  UNION ALL {_unpivoted("curated", "SELECT count(*) AS records, avg(effective_stock_level) AS mean_effective_stock, sum(stock_movement) AS total_stock_movement FROM fact")}
  UNION ALL {_unpivoted("quarantine", f"""SELECT count(*) AS records, count(match) AS fuzzy_matches_found,
    count(*) FILTER (score IS NOT NULL AND match IS NULL) AS unmatched_products
    FROM (SELECT product_id, suggested_product_id AS match, fuzzy_match_score AS score FROM ({SUGGESTED}) UNION ALL {RESTOCK_MATCHES})""")}
  UNION ALL {_unpivoted("sku.products_sku", f"SELECT count(*) FILTER (NOT coalesce(regexp_matches(sku, {SKU_SHAPE}), false)) AS non_standard FROM products")}
  UNION ALL {_unpivoted("sku.snapshot_product_id", f"SELECT count(*) FILTER ({ODD}) AS non_standard FROM kept_snapshots WHERE validation_status = 'VALID'")}
  UNION ALL {_unpivoted("sku.restock_product_id", f"SELECT count(*) FILTER ({ODD}) AS non_standard FROM all_restocks WHERE validation_status = 'VALID'")}
  UNION ALL {_threshold_sql(InventoryConfig(), INVENTORY_THRESHOLDS)})"""


@query("inventory_run_report", INVENTORY_RUN)
def inventory_run_report(spark, sf):
    """The report of a whole run: every group, counted while the layers are written."""
    inputs = {
        "inventory_snapshot": roles.snapshots(spark, sf),
        "restock_events": roles.restocks(spark, sf),
        "products": roles.products(spark, sf),
        "stores": roles.stores(spark, sf),
    }
    out = _folder(spark, "inventory_run")
    runs.run_inventory(inputs, out, InventoryConfig(also_save_csv=False))
    return _report(spark, out, "inventory")


@query("incremental_fact", "SELECT * FROM fact")
def incremental_fact(spark, sf):
    """The fact table from two increments of snapshots and restocks, the later versions not always in the later one."""
    out = _folder(spark, "increments")
    snapshots, restocks = roles.snapshots(spark, sf), roles.restocks(spark, sf)
    for i in (1, 0):
        parts = [df.filter(F.pmod(F.xxhash64(id), F.lit(2)) == i) for df, id in ((snapshots, "snapshot_id"), (restocks, "restock_id"))]
        add_increment(*parts, roles.products(spark, sf), roles.stores(spark, sf), out, f"part{i}", stamped=False)
    return load_layer(spark, f"{out}/fact").drop("day")


def _affinity_run(spark, sf) -> str:
    lines = {"store_sales_header": roles.header, "store_sales_line_items": roles.lines, "products": roles.brands}
    out = _folder(spark, "affinity_run")
    runs.run_affinity({name: role(spark, sf) for name, role in lines.items()}, out, AffinityConfig(also_save_csv=False))
    return out


AFFINITY_RUN = f"""{_unpivoted("pairs", "SELECT CAST(sum(pair_rows) AS BIGINT) AS total_product_pairs FROM pairs_list")}
  UNION ALL {_unpivoted("scores", "SELECT count(*) AS pairs_above_thresholds FROM affinity_list")}
  UNION ALL {_unpivoted("top", "SELECT least(count(*), 10) AS returned FROM affinity_list")}
  UNION ALL {_unpivoted("baskets", BASKET_STATS)}
  UNION ALL {_threshold_sql(AffinityConfig(), AFFINITY_THRESHOLDS)}"""


@query("affinity_run_report", f"SELECT metric, round(value, 4) AS value FROM ({AFFINITY_RUN})")
def affinity_run_report(spark, sf):
    return _report(spark, _affinity_run(spark, sf), "affinity")


@query("staged_baskets", "SELECT transaction_id, count(*) AS basket_size FROM lines GROUP BY 1 HAVING count(*) >= 2")
def staged_baskets(spark, sf):
    """Baskets in the staging layer of a run."""
    return load_layer(spark, f"{_affinity_run(spark, sf)}/staging/transaction_baskets").select("transaction_id", "basket_size")


def _fraud_run(spark, sf) -> str:
    inputs = {
        "refund_transactions": roles.refunds(spark, sf),
        "store_sales_header": roles.header(spark, sf),
        "customer_details": roles.customers(spark, sf),
        "products": roles.brands(spark, sf),
    }
    out = _folder(spark, "fraud_run")
    runs.run_fraud(inputs, out, replace(FRAUD, also_save_csv=False))
    return out


@query(
    "fraud_run_report",
    f"SELECT metric, round(value, 4) AS value FROM ({_unpivoted('fraud', FRAUD_METRICS)} UNION ALL {_threshold_sql(FRAUD, FRAUD_THRESHOLDS)})",
)
def fraud_run_report(spark, sf):
    return _report(spark, _fraud_run(spark, sf), "fraud")


# --- streams -----------------------------------------------------------------


def _replayed(spark: SparkSession, rows: DataFrame, arrived: str, dated: str, last: Callable[[Column], Column], name: str, stream) -> str:
    """Run a stream over rows that arrive year by year, some of them twice; it is stopped and started again in between.

    ``stream`` makes a writer from the streaming frame, an output and a checkpoint
    folder. What arrives last is a row of nulls but for ``dated``, which is ``last`` of
    its latest value. Returns the output folder.
    """
    base = _folder(spark, name)
    columns, schema = rows.drop(arrived).columns, rows.drop(arrived).schema
    # Written once, a folder per year, which is moved to the stream's input when it arrives.
    twice = F.when(F.xxhash64(*columns) % 20 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    sent = rows.select(*columns, F.year(arrived).alias("_year"), F.explode(twice).alias("_time")).filter("_year IS NOT NULL")
    sent.drop("_time").write.partitionBy("_year").parquet(f"{base}/rows")
    years = [r[0] for r in spark.read.parquet(f"{base}/rows").select("_year").distinct().orderBy("_year").collect()]
    for year in [*years, None]:
        if year is not None:
            move_path(spark, f"{base}/rows/_year={year}", f"{base}/in/{year}")
        else:
            found = spark.read.schema(schema).parquet(f"{base}/in/*")
            closing = [(last(F.max(c)) if c == dated else F.lit(None).cast(t)).alias(c) for c, t in found.dtypes]
            found.agg(*closing).write.parquet(f"{base}/in/closing")
        frame = spark.readStream.schema(schema).parquet(f"{base}/in/*")
        running = stream(frame, f"{base}/out", f"{base}/checkpoint").trigger(availableNow=True).start()
        running.awaitTermination()
    return f"{base}/out"


@query(
    "streamed_pair_counts",
    """WITH sold AS (SELECT CAST(time_bucket(INTERVAL '7 days', CAST(o_orderdate AS TIMESTAMP), TIMESTAMP '1970-01-01') AS DATE)::VARCHAR AS week,
      l_orderkey, p_brand, count(*) AS n FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey GROUP BY 1, 2, 3)
    SELECT week, a.p_brand AS product_a, b.p_brand AS product_b,
      CAST(sum(CASE WHEN a.p_brand = b.p_brand THEN a.n * (a.n - 1) // 2 ELSE a.n * b.n END) AS BIGINT) AS pair_count
    FROM sold a JOIN sold b USING (week, l_orderkey) WHERE a.p_brand < b.p_brand OR (a.p_brand = b.p_brand AND a.n > 1) GROUP BY ALL""",
)
def streamed_pair_counts(spark, sf):
    """Lines replayed in the order of arrival, some sent twice: pair counts per week as in the batch."""
    lines = roles.sale_lines(spark, sf)

    def last(latest):
        return latest + F.expr("INTERVAL 60 DAYS")

    def stream(frame, out, checkpoint):
        return write_batches(stream_pair_counts(frame, "7 days", "31 days"), out, checkpoint)

    found = spark.read.parquet(_replayed(spark, lines, "arrived", "sold_at", last, "sale_lines", stream))
    return found.select(F.to_date("window.start").alias("week"), "product_a", "product_b", "pair_count")


@query("streamed_fraud_patterns", WINDOWED)
def streamed_fraud_patterns(spark, sf):
    """Refunds replayed in the order of arrival, up to 29 days late, some sent twice: flags as in the batch."""
    late = F.pmod(F.xxhash64("refund_id"), F.lit(30)).cast("int")
    refunds = _enriched(spark, sf)
    # Ids of the tables recur on different refunds, which a stream would take for one that is sent again.
    refunds = refunds.withColumn("refund_id", F.concat_ws("|", "refund_id", F.xxhash64(*refunds.columns)))
    refunds = refunds.withColumn("arrived", F.date_add("refund_date", late))

    def last(latest):
        return F.date_add(latest, 100)

    def stream(frame, out, checkpoint):
        return write_batches(stream_fraud_patterns(frd.validate_refunds(frame), OPTIONAL, "31 days"), out, checkpoint)

    found = spark.read.parquet(_replayed(spark, refunds, "arrived", "refund_date", last, "refunds", stream))
    found = found.filter("refund_id IS NOT NULL")  # all but the closing row
    found = found.withColumn("refund_id", F.substring_index("refund_id", "|", 1))
    return found.select("refund_id", "refund_amount", "refund_count", "product_refund_count", "fraud_flags", "fraud_score")
