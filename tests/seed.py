"""Seed data in compact form.

Fixed values: the quantities, dates and keys below are those for which the
expected results in test_golden.py are published. Names are left out or our own.
"""

from datetime import date

# store, product, day of January 2024, level, capacity, damaged, expired
SNAPSHOTS = [
    ("A", 1, 15, 500, 1000, 5, 3),
    ("A", 2, 15, 300, 800, 2, 1),
    ("A", 3, 15, 150, 500, 0, 0),
    ("B", 1, 15, 450, 1000, 10, 5),
    ("B", 2, 15, 200, 800, 3, 2),
    ("B", 4, 15, 600, 1200, 8, 4),
    ("C", 1, 15, 350, 1000, 2, 1),
    ("C", 3, 15, 250, 500, 1, 0),
    ("A", 1, 16, 480, 1000, 3, 2),
    ("A", 2, 16, 280, 800, 1, 1),
    ("A", 3, 16, 140, 500, 2, 0),
    ("B", 1, 16, 420, 1000, 5, 3),
    ("B", 2, 16, 180, 800, 2, 1),
    ("B", 4, 16, 580, 1200, 4, 2),
    ("C", 1, 16, 330, 1000, 1, 1),
    ("C", 3, 16, 240, 500, 0, 1),
    ("A", 5, 15, 100, 400, 0, 0),
    ("B", 5, 15, 120, 400, 1, 0),
    ("A", 1, 15, 505, 1000, 5, 3),
    (None, 2, 17, 300, 800, 2, 1),
    ("A", None, 17, 150, 500, 0, 0),
    ("B", 1, None, 450, 1000, 10, 5),
    ("C", 6, 17, -50, 500, 0, 0),
    ("A", 7, 17, 200, 300, 0, 0),
    ("B", "PROD_001", 17, 180, 400, 2, 1),
    ("A", 1, 17, 520, 1000, 4, 2),
    ("A", 2, 17, 310, 800, 1, 0),
    ("B", 3, 17, 200, 500, 3, 1),
    ("C", 4, 17, 400, 1200, 5, 2),
    ("A", 8, 17, 50, 200, 0, 0),
]

# store, product, day of January 2024, quantity
RESTOCKS = [
    ("A", 1, 15, 100),
    ("A", 2, 15, 50),
    ("A", 3, 15, 30),
    ("B", 1, 15, 80),
    ("B", 2, 15, 40),
    ("B", 4, 15, 120),
    ("C", 1, 15, 60),
    ("C", 3, 15, 25),
    ("A", 1, 16, 90),
    ("A", 2, 16, 45),
    ("A", 3, 16, 20),
    ("B", 1, 16, 75),
    ("B", 2, 16, 35),
    ("B", 4, 16, 100),
    ("C", 1, 16, 55),
    ("C", 3, 16, 15),
    ("A", 5, 15, 200),
    ("B", 5, 15, 180),
    (None, 1, 17, 50),
    ("A", None, 17, 30),
    ("B", 1, 17, 5000),
    ("A", 1, 17, 85),
    ("A", 2, 17, 40),
    ("B", 3, 17, 50),
    ("C", 4, 17, 70),
    ("A", "PROD_001", 17, 60),
    ("B", 6, 17, 100),
    ("A", 8, 17, 30),
]

# most that may be restocked, per product 1..10
RESTOCK_MAX = [500, 300, 200, 400, 150, 250, 200, 300, 250, 150]

# products of the baskets of sales 1..25
BASKETS = "123 125 37 124 23 135 1237 28 123 34 125 137 28 1234 12 135 27 1234 238 125 137 123 28 1234 12".split()

# customer of sales 1..25, and the days of January 2024
BUYERS = [1, 2, 3, 1, 4, 5, 2, 6, 7, 3, 8, 9, 10, 1, 2, 4, 5, 3, 6, 7, 8, 9, 10, 1, 2]
SALE_DAYS = [15] * 5 + [16] * 5 + [17] * 5 + [18] * 5 + [19] * 5

# total purchases of customers 1..12
PURCHASES = [45000, 28000, 12000, 52000, 18000, 8500, 22000, 38000, 9500, 15000, 5000, 3000]

# sale, customer, (month, day) of 2024, refunded, original, product, payment, original payment
REFUNDS = [
    (1, 1, (1, 20), 90, 90, 1, "CASH", "CASH"),
    (2, 2, (1, 21), 70, 70, 2, "CARD", "CARD"),
    (3, 3, (1, 22), 144, 144, 3, "UPI", "UPI"),
    (4, 1, (1, 23), 135, 135, 1, "CARD", "CARD"),
    (5, 4, (1, 24), 140, 140, 2, "CASH", "CASH"),
    (6, 5, (1, 25), 550, 550, 5, "UPI", "UPI"),
    (7, 2, (1, 26), 105, 105, 2, "CARD", "CARD"),
    (8, 6, (1, 27), 65, 65, 8, "CASH", "CASH"),
    (9, 7, (1, 28), 216, 216, 3, "CARD", "CARD"),
    (10, 3, (1, 29), 320, 320, 4, "UPI", "UPI"),
    (1, 11, (1, 30), 150, 90, 1, "CASH", "CASH"),
    (2, 11, (1, 30), 200, 70, 2, "CARD", "CARD"),
    (3, 11, (1, 31), 180, 144, 3, "UPI", "UPI"),
    (4, 11, (1, 31), 250, 135, 1, "CASH", "CARD"),
    (5, 11, (2, 1), 300, 140, 2, "CARD", "CASH"),
    (11, 8, (2, 2), 135, 135, 1, "CASH", "CASH"),
    (12, 9, (2, 3), 144, 144, 3, "CARD", "CARD"),
    (13, 10, (2, 4), 105, 105, 2, "UPI", "UPI"),
    (14, 1, (2, 5), 90, 90, 1, "CARD", "CARD"),
    (15, 2, (2, 6), 70, 70, 2, "CASH", "CASH"),
    (16, 12, (2, 7), 500, 135, 1, "UPI", "CASH"),
    (17, 12, (2, 7), 450, 35, 2, "CARD", "UPI"),
    (18, 12, (2, 8), 600, 90, 1, "CASH", "CARD"),
    (19, 12, (2, 8), 380, 70, 2, "UPI", "CASH"),
    (20, 5, (2, 9), 550, 550, 5, "UPI", "UPI"),
    (1, 1, (5, 15), 90, 90, 1, "CASH", "CASH"),
    (21, 7, (2, 10), 90, 90, 1, "CASH", "CASH"),
    (22, 8, (2, 11), 70, 70, 2, "CARD", "CARD"),
    (23, 9, (2, 12), 65, 65, 8, "UPI", "UPI"),
    (24, 1, (2, 13), 320, 320, 4, "CARD", "CARD"),
]


def product_key(product):
    return f"PRD{product:03d}" if isinstance(product, int) else product


def _day(day):
    return None if day is None else f"2024-01-{day}"


def products(spark):
    data = [
        (product_key(i), f"Item {i}", f"SKU-ITM-{i:03d}", "Dairy" if i % 2 else "Grains", 10.0 * i, float(most))
        for i, most in enumerate(RESTOCK_MAX, 1)
    ]
    return spark.createDataFrame(
        data,
        "product_id string, product_name string, sku string, category string, unit_price double, "
        "max_restock_quantity double",
    )


def stores(spark):
    data = [(s, f"Store {s}", f"City {s}", "North") for s in "ABC"]
    return spark.createDataFrame(data, "store_id string, store_name string, city string, region string")


def snapshots(spark):
    data = [
        (f"S{i:03d}", store, product_key(p), _day(day), str(level), float(cap), float(damaged), float(expired))
        for i, (store, p, day, level, cap, damaged, expired) in enumerate(SNAPSHOTS, 1)
    ]
    return spark.createDataFrame(
        data,
        "snapshot_id string, store_id string, product_id string, snapshot_date string, snapshot_level string, "
        "max_capacity double, damaged_quantity double, expired_quantity double",
    )


def restocks(spark):
    data = [
        (f"R{i:03d}", store, product_key(p), _day(day), str(quantity))
        for i, (store, p, day, quantity) in enumerate(RESTOCKS, 1)
    ]
    return spark.createDataFrame(
        data,
        "restock_id string, store_id string, product_id string, restock_date string, incoming_quantity string",
    )


def header(spark):
    data = [(i, c, date(2024, 1, d), 100.0, "CASH") for i, (c, d) in enumerate(zip(BUYERS, SALE_DAYS), 1)]
    return spark.createDataFrame(
        data, "transaction_id long, customer_id long, sale_date date, total_amount double, payment_mode string"
    )


def lines(spark):
    data = [(i, product_key(int(p))) for i, basket in enumerate(BASKETS, 1) for p in basket]
    return spark.createDataFrame(data, "transaction_id long, product_id string")


def customers(spark):
    data = [(i, f"Name {i}", "GOLD", float(p), 0.0, "ACTIVE") for i, p in enumerate(PURCHASES, 1)]
    return spark.createDataFrame(
        data,
        "customer_id long, customer_name string, customer_tier string, total_purchases double, "
        "total_refunds double, account_status string",
    )


def refunds(spark):
    data = [
        (f"F{i:03d}", sale, c, date(2024, *day), float(amount), float(original), product_key(p), "reason", mode, before)
        for i, (sale, c, day, amount, original, p, mode, before) in enumerate(REFUNDS, 1)
    ]
    return spark.createDataFrame(
        data,
        "refund_id string, original_transaction_id long, customer_id long, refund_date date, refund_amount double, "
        "original_amount double, product_id string, refund_reason string, payment_mode string, "
        "original_payment_mode string",
    )
