"""Settings of every operator, as dataclasses with the default values."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Dataset:
    """Where a dataset lies, how it is read, and which columns it must have."""

    path: str
    file_type: str = "csv"
    delimiter: str = ","
    encoding: str = "utf-8"
    required: tuple[str, ...] = ()
    types: dict[str, str] = field(default_factory=dict)
    # All columns of json files. They are read as text, by name, in one pass; without
    # them, names and types are inferred by reading the files once more.
    columns: tuple[str, ...] = ()
    # Whether csv cells may hold quoted line breaks. UTF-8 files are then cut at true ends of
    # records; a file of another encoding is read by one task.
    line_breaks: bool = False
    # With line_breaks: a column that holds the whole text of records with too few or too many cells.
    bad_records: str | None = None


# Dataset names, file locations, required columns, column types.
# Quantities that are cast leniently later, and dates that only serve as keys,
# stay text.
DATASETS: dict[str, Dataset] = {
    "inventory_snapshot": Dataset(
        path="raw/inventory_snapshot.csv",
        columns=(
            "snapshot_id",
            "store_id",
            "product_id",
            "snapshot_date",
            "snapshot_level",
            "max_capacity",
            "damaged_quantity",
            "expired_quantity",
        ),
        required=("snapshot_id", "store_id", "product_id", "snapshot_date", "snapshot_level"),
        types={
            "max_capacity": "double",
            "damaged_quantity": "double",
            "expired_quantity": "double",
        },
    ),
    "restock_events": Dataset(
        path="raw/restock_events.csv",
        columns=(
            "restock_id",
            "store_id",
            "product_id",
            "restock_date",
            "incoming_quantity",
            "restock_type",
            "supplier_id",
        ),
        required=("restock_id", "store_id", "product_id", "restock_date", "incoming_quantity"),
    ),
    "products": Dataset(
        path="raw/products.csv",
        columns=(
            "product_id",
            "product_name",
            "sku",
            "category",
            "unit_price",
            "max_restock_quantity",
            "status",
        ),
        required=("product_id", "product_name", "sku"),
        types={"unit_price": "double", "max_restock_quantity": "double"},
    ),
    "stores": Dataset(
        path="raw/stores.csv",
        columns=("store_id", "store_name", "location", "city", "region", "store_type", "capacity_tier"),
        required=("store_id", "store_name"),
    ),
    "store_sales_header": Dataset(
        path="raw/store_sales_header.csv",
        columns=("transaction_id", "store_id", "customer_id", "sale_date", "total_amount", "payment_mode"),
        required=("transaction_id", "store_id", "customer_id", "sale_date", "total_amount"),
        types={"sale_date": "date", "total_amount": "double"},
    ),
    "store_sales_line_items": Dataset(
        path="raw/store_sales_line_items.csv",
        columns=("line_item_id", "transaction_id", "product_id", "quantity", "unit_price", "line_total"),
        required=("line_item_id", "transaction_id", "product_id", "quantity", "unit_price"),
        types={"quantity": "long", "unit_price": "double", "line_total": "double"},
    ),
    "customer_details": Dataset(
        path="raw/customer_details.csv",
        columns=(
            "customer_id",
            "customer_name",
            "email",
            "phone",
            "registration_date",
            "customer_tier",
            "total_purchases",
            "total_refunds",
            "account_status",
        ),
        required=("customer_id", "customer_name"),
        types={
            "registration_date": "date",
            "total_purchases": "double",
            "total_refunds": "double",
        },
    ),
    "refund_transactions": Dataset(
        path="raw/refund_transactions.csv",
        columns=(
            "refund_id",
            "original_transaction_id",
            "customer_id",
            "refund_date",
            "refund_amount",
            "original_amount",
            "product_id",
            "refund_reason",
            "payment_mode",
            "original_payment_mode",
            "store_id",
            "processed_by",
        ),
        required=(
            "refund_id",
            "original_transaction_id",
            "customer_id",
            "refund_date",
            "refund_amount",
            "original_amount",
        ),
        types={"refund_date": "date", "refund_amount": "double", "original_amount": "double"},
    ),
    "customer_transactions_history": Dataset(
        path="raw/customer_transactions_history.csv",
        columns=("customer_id", "transaction_id", "date", "amount"),
        required=("customer_id", "transaction_id", "date", "amount"),
        types={"date": "date", "amount": "double"},
    ),
}


# Fields, keys, thresholds and patterns of the classes below.
SKU_PATTERN = "^SKU-[A-Z]{3}-[0-9]{3}$"


@dataclass(frozen=True)
class InventoryConfig:
    snapshot_fields: tuple[str, ...] = ("store_id", "product_id", "snapshot_date", "snapshot_level")
    restock_fields: tuple[str, ...] = ("store_id", "product_id", "restock_date", "incoming_quantity")
    snapshot_key: tuple[str, ...] = ("store_id", "product_id", "snapshot_date")
    snapshot_version: str = "snapshot_id"
    # Declared rules that are off by default.
    check_damaged: bool = False
    check_expired: bool = False
    fuzzy_enabled: bool = True
    fuzzy_threshold: int = 85
    name_threshold: int = 80
    sku_enabled: bool = True
    sku_pattern: str = SKU_PATTERN
    version: str = "2.0"
    also_save_csv: bool = True


@dataclass(frozen=True)
class LegacyConfig:
    required: tuple[str, ...] = ("Store_ID", "Product_ID", "Date", "Inventory_Level")
    key: tuple[str, ...] = ("Store_ID", "Product_ID", "Date")
    max_capacity: float = 10000.0
    version: str = "1.0"


@dataclass(frozen=True)
class AffinityConfig:
    min_support: float = 0.01
    min_confidence: float = 0.1
    min_lift: float = 1.0
    top_n: int = 10
    # False counts repeated lines of one product; True counts a product once per basket.
    distinct: bool = False
    also_save_csv: bool = True


@dataclass(frozen=True)
class FraudConfig:
    max_refund_ratio: float = 1.0
    allowed_refund_window_days: int = 30
    require_customer_match: bool = True
    require_payment_mode_match: bool = True

    max_refunds: int = 3
    high_value_amount: float = 300.0
    max_same_product_refunds: int = 2
    amount_exceeded_enabled: bool = True
    payment_mismatch_enabled: bool = True

    anomaly_enabled: bool = True
    zscore_enabled: bool = True
    zscore_threshold: float = 2.0
    iqr_enabled: bool = True
    iqr_multiplier: float = 1.5
    # Quartiles are exact, or by a sketch in one pass if their rank may be off by this share.
    quartile_rank_error: float | None = None
    refund_ratio_enabled: bool = True
    max_customer_refund_ratio: float = 0.30

    # Options beside the defaults: counts within a span of days instead of over
    # the whole history, and two detectors that are declared but switched off.
    refund_window_days: int | None = None
    product_window_days: int | None = None
    high_value_frequent_enabled: bool = False
    high_value_frequent_refunds: int = 2
    high_value_frequent_amount: float = 500.0
    high_value_frequent_days: int = 30
    outside_window_enabled: bool = False

    version: str = "1.0"
    also_save_csv: bool = True


@dataclass(frozen=True)
class CustomerConfig:
    """Cut points of the customer scores.

    The outer points (7 and 60 days, 1 and 8 purchases, 200 and 2000 spent) are
    given; the inner ones and the value terms are choices of this library.
    """

    recency_days: tuple[int, int, int, int] = (7, 15, 30, 60)
    frequency: tuple[int, int, int, int] = (2, 4, 6, 8)
    monetary: tuple[float, float, float, float] = (200.0, 500.0, 1000.0, 2000.0)
    churn_days: tuple[int, int, int] = (30, 60, 90)
    profit_margin: float = 0.2
    also_save_csv: bool = True
