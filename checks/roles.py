"""The driver's tables in the roles of the library's inputs.

Defects that the rules look for are derived from column values of the tables, so
they grow with the data. ``checks.role_sql`` holds the same roles as SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


SCHEMAS: dict[str, StructType] = {}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A table of the driver; its schema is looked up in the files once."""
    path = f"{sf}/{name}.parquet"
    if path not in SCHEMAS:
        SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(SCHEMAS[path]).parquet(path)


def _at(discount: float, tax: float) -> Column:
    return (F.col("l_discount") == discount) & (F.col("l_tax") == tax)


def _key(prefix: str, column: str, width: int) -> Column:
    return F.concat(F.lit(prefix), F.lpad(F.col(column).cast("string"), width, "0"))


def _product_id() -> Column:
    """Product key of a line; some are null, mistyped or foreign."""
    return (
        F.when(_at(0.1, 0.01), F.lit(None))
        .when(_at(0.1, 0.02), _key("PROD_", "l_partkey", 8))
        .when(_at(0.1, 0.03), F.concat(F.lit("ITEM-"), F.col("l_partkey").cast("string")))
        .otherwise(_key("PRD", "l_partkey", 8))
    )


def _store_id() -> Column:
    store = F.concat(F.lit("ST"), F.lpad((F.col("l_suppkey") % 10).cast("string"), 7, "0"))
    return F.when(_at(0.0, 0.01), F.lit(None)).when(_at(0.0, 0.02), F.lit("  ")).otherwise(store)


def _year_start() -> Column:
    day = F.concat(F.year("l_shipdate").cast("string"), F.lit("-01-01"))
    return F.when(~_at(0.0, 0.03), day)


def _count_text(minus: int) -> Column:
    """Quantity as text; some are null or no number."""
    number = (F.col("l_quantity") - minus).cast("long").cast("string")
    return F.when(_at(0.1, 0.08), F.lit("n/a")).when(~_at(0.0, 0.0), number)


def products(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select(
        _key("PRD", "p_partkey", 8).alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.concat(
            F.lit("SKU-"), F.upper(F.substring("p_type", 1, 3)), F.lit("-"), (F.col("p_size") * 10).cast("string")
        ).alias("sku"),
        F.col("p_type").alias("category"),
        F.col("p_retailprice").alias("unit_price"),
        F.col("p_size").cast("double").alias("max_restock_quantity"),
    )


def stores(spark: SparkSession, sf: str) -> DataFrame:
    nation, region = table(spark, sf, "nation"), table(spark, sf, "region")
    return (
        table(spark, sf, "supplier")
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"), "left")
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left")
        .select(
            _key("ST", "s_suppkey", 7).alias("store_id"),
            F.col("s_name").alias("store_name"),
            F.col("n_name").alias("city"),
            F.col("r_name").alias("region"),
        )
    )


def snapshots(spark: SparkSession, sf: str) -> DataFrame:
    line = F.col("l_linenumber")
    return (
        table(spark, sf, "lineitem")
        .filter("l_linestatus = 'F'")
        .select(
            F.concat(_key("SNP", "l_orderkey", 10), F.lit("-"), line.cast("string")).alias("snapshot_id"),
            _store_id().alias("store_id"),
            _product_id().alias("product_id"),
            _year_start().alias("snapshot_date"),
            _count_text(2).alias("snapshot_level"),
            (line + 40).cast("double").alias("max_capacity"),
            F.when(F.col("l_discount") != 0.05, F.round(F.col("l_discount") * 100)).alias("damaged_quantity"),
            F.when(F.col("l_tax") != 0.04, F.round(F.col("l_tax") * 100)).alias("expired_quantity"),
        )
    )


def restocks(spark: SparkSession, sf: str) -> DataFrame:
    return (
        table(spark, sf, "lineitem")
        .filter("l_linestatus = 'O'")
        .select(
            F.concat(_key("RST", "l_orderkey", 10), F.lit("-"), F.col("l_linenumber").cast("string")).alias(
                "restock_id"
            ),
            _store_id().alias("store_id"),
            _product_id().alias("product_id"),
            _year_start().alias("restock_date"),
            _count_text(1).alias("incoming_quantity"),
            F.when(F.col("l_returnflag") == "A", "BULK").otherwise("REGULAR").alias("restock_type"),
        )
    )


def header(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("transaction_id"),
        F.col("o_custkey").alias("customer_id"),
        F.to_date("o_orderdate").alias("sale_date"),
        F.col("o_totalprice").alias("total_amount"),
        F.col("o_orderpriority").alias("payment_mode"),
    )


def lines(spark: SparkSession, sf: str) -> DataFrame:
    """Sales lines with the brand as the product, so that products recur in baskets."""
    part = table(spark, sf, "part").select("p_partkey", "p_brand")
    return (
        table(spark, sf, "lineitem")
        .join(part, F.col("l_partkey") == F.col("p_partkey"))
        .select(F.col("l_orderkey").alias("transaction_id"), F.col("p_brand").alias("product_id"))
    )


def sale_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Lines as a till sends them: with a number, the time of sale, and the day of arrival, up to 29 days later."""
    part, orders = table(spark, sf, "part").select("p_partkey", "p_brand"), table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    late = (F.col("l_orderkey") % 30).cast("int")
    return (
        table(spark, sf, "lineitem")
        .join(part, F.col("l_partkey") == F.col("p_partkey"))
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .select(
            F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice").alias("line_item_id"),
            F.col("l_orderkey").alias("transaction_id"),
            F.col("p_brand").alias("product_id"),
            F.col("o_orderdate").cast("timestamp").alias("sold_at"),
            F.date_add(F.to_date("o_orderdate"), late).alias("arrived"),
        )
    )


def brands(spark: SparkSession, sf: str) -> DataFrame:
    return (
        table(spark, sf, "part")
        .groupBy(F.col("p_brand").alias("product_id"))
        .agg(F.upper(F.min("p_brand")).alias("product_name"), F.min("p_type").alias("category"))
    )


def refunds(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    part = table(spark, sf, "part").select("p_partkey", "p_brand")
    price = F.col("l_extendedprice")
    quantity = F.col("l_quantity")
    return (
        table(spark, sf, "lineitem")
        .filter("l_returnflag = 'R'")
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(part, F.col("l_partkey") == F.col("p_partkey"))
        .select(
            F.concat_ws("-", _key("REF", "l_orderkey", 10), "l_linenumber", "l_suppkey").alias("refund_id"),
            F.when(F.col("l_tax") == 0.08, -F.col("l_orderkey") - 1)
            .otherwise(F.col("l_orderkey"))
            .alias("original_transaction_id"),
            F.when(_at(0.0, 0.0), F.lit(None))
            .when(F.col("l_discount") == 0.01, F.col("o_custkey") + 1)
            .otherwise(F.col("o_custkey"))
            .alias("customer_id"),
            F.to_date("l_shipdate").alias("refund_date"),
            (F.floor(price * (1 - F.col("l_discount")) * (1 + F.col("l_tax")) * 100) / 100).alias("refund_amount"),
            F.when(_at(0.02, 0.0), 0.0).otherwise(price).alias("original_amount"),
            F.when(~_at(0.03, 0.0), F.col("p_brand")).alias("product_id"),
            F.when(F.col("l_linestatus") == "F", "Damaged").otherwise("Changed mind").alias("refund_reason"),
            F.col("o_orderpriority").alias("payment_mode"),
            F.when(quantity == 50, F.lit(None))
            .when(quantity > 45, "1-URGENT")
            .otherwise(F.col("o_orderpriority"))
            .alias("original_payment_mode"),
        )
    )


def customers(spark: SparkSession, sf: str) -> DataFrame:
    spent = (
        table(spark, sf, "orders").groupBy("o_custkey").agg(F.round(F.sum("o_totalprice"), 2).alias("total_purchases"))
    )
    return (
        table(spark, sf, "customer")
        .join(spent, F.col("c_custkey") == F.col("o_custkey"), "left")
        .select(
            F.col("c_custkey").alias("customer_id"),
            F.col("c_name").alias("customer_name"),
            F.col("c_mktsegment").alias("customer_tier"),
            "total_purchases",
            F.col("c_acctbal").alias("total_refunds"),
            F.when(F.col("c_acctbal") < 0, "FLAGGED").otherwise("ACTIVE").alias("account_status"),
        )
    )


def history(spark: SparkSession, sf: str) -> DataFrame:
    """Purchases, amounts in thousands."""
    return table(spark, sf, "orders").select(
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderkey").alias("transaction_id"),
        F.to_date("o_orderdate").alias("date"),
        (F.col("o_totalprice") / 1000).alias("amount"),
    )


def units(spark: SparkSession, sf: str) -> DataFrame:
    """The single table of the older inventory run."""
    store = F.concat(F.lit("ST"), (F.col("l_suppkey") % 10).cast("string"))
    return table(spark, sf, "lineitem").select(
        F.when(_at(0.0, 0.01), "").when(~_at(0.0, 0.02), store).alias("Store_ID"),
        _key("P", "l_partkey", 8).alias("Product_ID"),
        F.to_date("l_shipdate").alias("Date"),
        (F.col("l_quantity") - 2).alias("Inventory_Level"),
        F.when(_at(0.05, 0.05), -1.0).otherwise(F.round(F.col("l_tax") * 100) * 5).alias("Units_Sold"),
        F.when(F.col("l_discount") != 0.07, F.round(F.col("l_discount") * 100)).alias("Units_Ordered"),
        F.when(F.col("l_extendedprice") < 1500, 0.0).otherwise(F.col("l_extendedprice")).alias("Price"),
        F.col("l_discount").alias("Discount"),
    )
