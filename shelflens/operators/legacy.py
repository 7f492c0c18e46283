"""The older single-table inventory run: validation, deduplication, reconciliation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelflens.config import LegacyConfig
from shelflens.functions.numbers import holds
from shelflens.functions.rules import Rule, apply_rules, is_invalid, is_valid
from shelflens.operators.inventory import keep_existing

CONFIG = LegacyConfig()

# Output columns, in order.
FACT_COLUMNS = [
    "Store_ID",
    "Product_ID",
    "Date",
    "Inventory_Level",
    "Units_Sold",
    "Units_Ordered",
    "final_stock_level",
    "restock_in",
    "restock_out",
    "stock_movement",
    "Price",
    "Discount",
    "reconciliation_status",
    "negative_stock_flag",
    "capacity_exceeded_flag",
]


def tag_units(df: DataFrame, config: LegacyConfig = CONFIG) -> DataFrame:
    """Every row with codes and status; only null and the empty text are missing."""
    rules = [
        Rule(f"Missing {c}", F.col(c).isNull() | holds(F.col(c).cast("string") == ""))
        for c in config.required
        if c in df.columns
    ]
    tests = [
        ("Inventory_Level", "Negative inventory", lambda c: c < 0),
        ("Units_Sold", "Negative units sold", lambda c: c < 0),
        ("Price", "Invalid price", lambda c: c <= 0),
    ]
    rules += [Rule(code, holds(test(F.col(c)))) for c, code, test in tests if c in df.columns]
    return apply_rules(df, rules)


def validate_units(df: DataFrame, config: LegacyConfig = CONFIG) -> tuple[DataFrame, DataFrame]:
    tagged = tag_units(df, config)
    return tagged.filter(is_valid()), tagged.filter(is_invalid())


def latest_units(valid: DataFrame, config: LegacyConfig = CONFIG) -> DataFrame:
    """One valid row per key, the one of the last date; other columns break ties."""
    rest = [c for c in valid.columns if c not in (*config.key, "Date", "validation_status", "validation_errors")]
    last = Window.partitionBy(*config.key).orderBy(F.col("Date").desc(), *[F.col(c).desc() for c in rest])
    return valid.withColumn("_version", F.row_number().over(last)).filter("_version = 1").drop("_version")


def reconcile_units(df: DataFrame, config: LegacyConfig = CONFIG) -> DataFrame:
    """Final stock = level + ordered - sold; the capacity flag overrides the negative one."""

    def or_zero(name: str) -> Column:
        return F.coalesce(F.col(name).cast("double"), F.lit(0.0)) if name in df.columns else F.lit(0.0)

    movement = F.col("restock_in") - F.col("restock_out")
    return (
        df.withColumns({"restock_in": or_zero("Units_Ordered"), "restock_out": or_zero("Units_Sold")})
        .withColumn("final_stock_level", F.col("Inventory_Level") + F.col("restock_in") - F.col("restock_out"))
        .withColumns(
            {
                "stock_movement": movement,
                "negative_stock_flag": holds(F.col("final_stock_level") < 0),
                "capacity_exceeded_flag": holds(F.col("final_stock_level") > config.max_capacity),
            }
        )
        .withColumn(
            "reconciliation_status",
            F.when(F.col("capacity_exceeded_flag"), "FLAGGED_CAPACITY")
            .when(F.col("negative_stock_flag"), "FLAGGED_NEGATIVE")
            .otherwise("RECONCILED"),
        )
    )


def units_fact(reconciled: DataFrame, config: LegacyConfig = CONFIG, stamped: bool = True) -> DataFrame:
    fact = keep_existing(reconciled, FACT_COLUMNS)
    if stamped:
        fact = fact.withColumn("last_updated", F.current_timestamp())
    return fact.withColumn("pipeline_version", F.lit(config.version))


def units_error_type(errors: Column) -> Column:
    """Class of the first kind of error present."""
    text = F.array_join(errors, "; ")
    return (
        F.when(text.contains("Missing"), "MISSING_FIELD")
        .when(text.contains("Negative"), "NEGATIVE_VALUE")
        .when(text.contains("Invalid"), "INVALID_VALUE")
        .otherwise("UNKNOWN")
    )


def quarantine_units(invalid: DataFrame, stamped: bool = True) -> DataFrame:
    df = invalid.withColumn("error_type", units_error_type(F.col("validation_errors")))
    return df.withColumn("quarantine_date", F.current_timestamp()) if stamped else df


def units_counters() -> list[Column]:
    """Counters over all tagged rows."""
    return [
        F.count("*").alias("total_records"),
        F.count_if(is_valid()).alias("valid_records"),
        F.count_if(is_invalid()).alias("invalid_records"),
    ]


def units_fact_counters() -> list[Column]:
    return [
        F.count("*").alias("curated"),
        F.count_if("negative_stock_flag").alias("negative_stock_flags"),
        F.count_if("capacity_exceeded_flag").alias("capacity_exceeded_flags"),
    ]


def units_metrics(df: DataFrame, config: LegacyConfig = CONFIG) -> DataFrame:
    """One row of run counters."""
    tagged = tag_units(df, config)
    fact = reconcile_units(latest_units(tagged.filter(is_valid()), config), config)
    final = fact.agg(*units_fact_counters()).select(F.struct("*")).scalar()
    return (
        tagged.agg(*units_counters())
        .select("*", F.inline(F.array(final)))
        .withColumn("duplicates_removed", F.col("valid_records") - F.col("curated"))
        .drop("curated")
    )
