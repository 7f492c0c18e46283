"""The roles of ``checks.roles`` as SQL common table expressions."""

from __future__ import annotations

import re

AT = "(l_discount = {} AND l_tax = {})"


def at(discount: float, tax: float) -> str:
    return AT.format(discount, tax)


PRODUCT_ID = f"""CASE WHEN {at(0.1, 0.01)} THEN NULL
       WHEN {at(0.1, 0.02)} THEN 'PROD_' || lpad(CAST(l_partkey AS VARCHAR), 8, '0')
       WHEN {at(0.1, 0.03)} THEN 'ITEM-' || CAST(l_partkey AS VARCHAR)
       ELSE 'PRD' || lpad(CAST(l_partkey AS VARCHAR), 8, '0') END"""
STORE_ID = f"""CASE WHEN {at(0.0, 0.01)} THEN NULL WHEN {at(0.0, 0.02)} THEN '  '
       ELSE 'ST' || lpad(CAST(l_suppkey % 10 AS VARCHAR), 7, '0') END"""
YEAR_START = f"CASE WHEN {at(0.0, 0.03)} THEN NULL ELSE CAST(year(l_shipdate) AS VARCHAR) || '-01-01' END"


def count_text(minus: int) -> str:
    return f"""CASE WHEN {at(0.1, 0.08)} THEN 'n/a' WHEN {at(0.0, 0.0)} THEN NULL
       ELSE CAST(CAST(l_quantity - {minus} AS BIGINT) AS VARCHAR) END"""


def codes(*pairs: tuple[str, str]) -> str:
    """Text of the codes whose condition holds."""
    return " || ".join(f"CASE WHEN {test} THEN '{code}; ' ELSE '' END" for code, test in pairs)


def missing(column: str) -> str:
    return f"({column} IS NULL OR trim(CAST({column} AS VARCHAR)) = '')"


ROLES: dict[str, str] = {}

ROLES["products"] = """
SELECT 'PRD' || lpad(CAST(p_partkey AS VARCHAR), 8, '0') AS product_id, p_name AS product_name,
       'SKU-' || upper(substr(p_type, 1, 3)) || '-' || CAST(p_size * 10 AS VARCHAR) AS sku,
       p_type AS category, p_retailprice AS unit_price, CAST(p_size AS DOUBLE) AS max_restock_quantity
FROM part"""

ROLES["stores"] = """
SELECT 'ST' || lpad(CAST(s_suppkey AS VARCHAR), 7, '0') AS store_id, s_name AS store_name,
       n_name AS city, r_name AS region
FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey"""

ROLES["snapshots"] = f"""
SELECT 'SNP' || lpad(CAST(l_orderkey AS VARCHAR), 10, '0') || '-' || CAST(l_linenumber AS VARCHAR) AS snapshot_id,
       {STORE_ID} AS store_id, {PRODUCT_ID} AS product_id, {YEAR_START} AS snapshot_date,
       {count_text(2)} AS snapshot_level, CAST(l_linenumber + 40 AS DOUBLE) AS max_capacity,
       CASE WHEN l_discount <> 0.05 THEN round(l_discount * 100) END AS damaged_quantity,
       CASE WHEN l_tax <> 0.04 THEN round(l_tax * 100) END AS expired_quantity
FROM lineitem WHERE l_linestatus = 'F'"""

ROLES["restocks"] = f"""
SELECT 'RST' || lpad(CAST(l_orderkey AS VARCHAR), 10, '0') || '-' || CAST(l_linenumber AS VARCHAR) AS restock_id,
       {STORE_ID} AS store_id, {PRODUCT_ID} AS product_id, {YEAR_START} AS restock_date,
       {count_text(1)} AS incoming_quantity,
       CASE WHEN l_returnflag = 'A' THEN 'BULK' ELSE 'REGULAR' END AS restock_type
FROM lineitem WHERE l_linestatus = 'O'"""

ROLES["tagged_snapshots"] = f"""
SELECT s.* REPLACE (TRY_CAST(snapshot_level AS DOUBLE) AS snapshot_level),
       {codes(("MISSING_STORE_ID", missing("store_id")), ("MISSING_PRODUCT_ID", missing("s.product_id")),
              ("MISSING_SNAPSHOT_DATE", missing("snapshot_date")), ("MISSING_SNAPSHOT_LEVEL", missing("snapshot_level")),
              ("NEGATIVE_STOCK", "coalesce(TRY_CAST(snapshot_level AS DOUBLE) < 0, false)"),
              ("MISMATCHED_PRODUCT_ID", "s.product_id IS NOT NULL AND s.product_id NOT IN (SELECT product_id FROM products)"),
              ("CAPACITY_EXCEEDED", "coalesce(TRY_CAST(snapshot_level AS DOUBLE) > max_capacity, false)"))}
       AS validation_errors
FROM snapshots s"""

ROLES["all_snapshots"] = """
SELECT *, CASE WHEN replace(validation_errors, 'CAPACITY_EXCEEDED; ', '') = '' THEN 'VALID' ELSE 'INVALID' END
       AS validation_status
FROM tagged_snapshots"""

ROLES["kept_snapshots"] = """
SELECT * FROM all_snapshots
QUALIFY row_number() OVER (PARTITION BY store_id, product_id, snapshot_date
  ORDER BY snapshot_id DESC, snapshot_text DESC NULLS LAST, max_capacity DESC NULLS LAST,
           damaged_quantity DESC NULLS LAST, expired_quantity DESC NULLS LAST) = 1"""

ROLES["all_restocks"] = f"""
SELECT r.* REPLACE (TRY_CAST(incoming_quantity AS DOUBLE) AS incoming_quantity), max_restock_quantity,
       {codes(("MISSING_STORE_ID", missing("store_id")), ("MISSING_PRODUCT_ID", missing("r.product_id")),
              ("MISSING_RESTOCK_DATE", missing("restock_date")),
              ("MISSING_INCOMING_QUANTITY", missing("incoming_quantity")),
              ("INVALID_QUANTITY", "coalesce(TRY_CAST(incoming_quantity AS DOUBLE) <= 0, false)"),
              ("EXCEEDED_RESTOCK_MAX", "coalesce(TRY_CAST(incoming_quantity AS DOUBLE) > max_restock_quantity, false)"),
              ("MISMATCHED_PRODUCT_ID", "r.product_id IS NOT NULL AND p.product_id IS NULL"))}
       AS validation_errors,
       CASE WHEN validation_errors = '' THEN 'VALID' ELSE 'INVALID' END AS validation_status
FROM restocks r LEFT JOIN products p ON r.product_id = p.product_id"""

ROLES["restock_sums"] = """
SELECT store_id, product_id, restock_date AS snapshot_date, coalesce(sum(incoming_quantity), 0) AS incoming_restock
FROM all_restocks WHERE validation_status = 'VALID' GROUP BY 1, 2, 3"""

ROLES["reconciled"] = """
SELECT s.snapshot_id, s.store_id, s.product_id, s.snapshot_date, s.snapshot_level,
       coalesce(incoming_restock, 0) AS incoming_restock, coalesce(damaged_quantity, 0) AS damaged_quantity,
       coalesce(expired_quantity, 0) AS expired_quantity,
       coalesce(incoming_restock, 0) - coalesce(damaged_quantity, 0) - coalesce(expired_quantity, 0) AS stock_movement,
       snapshot_level + stock_movement AS effective_stock_level, s.max_capacity,
       CASE WHEN effective_stock_level < 0 THEN 'FLAGGED_NEGATIVE' ELSE 'RECONCILED' END AS reconciliation_status,
       coalesce(effective_stock_level < 0, false) AS negative_effective_stock_flag
FROM kept_snapshots s LEFT JOIN restock_sums r USING (store_id, product_id, snapshot_date)
WHERE validation_status = 'VALID'"""

ROLES["fact"] = """
SELECT r.*, product_name, category, unit_price, store_name, city, region, '2.0' AS pipeline_version
FROM reconciled r LEFT JOIN products USING (product_id) LEFT JOIN stores USING (store_id)"""


def error_type(column: str) -> str:
    tests = [
        ("MISSING_FIELD", "MISSING_"),
        ("NEGATIVE_STOCK", "NEGATIVE_STOCK"),
        ("MISMATCHED_PRODUCT", "MISMATCHED_PRODUCT_ID"),
        ("EXCEEDED_LIMIT", "EXCEEDED_"),
        ("INVALID_VALUE", "INVALID_"),
    ]
    parts = ", ".join(f"CASE WHEN contains({column}, '{text}') THEN '{name}' END" for name, text in tests)
    return f"CASE WHEN {column} = '' THEN 'UNKNOWN' ELSE coalesce(nullif(concat_ws('|', {parts}), ''), 'OTHER') END"


# Best match: bit-parallel common subsequence length over the position masks of
# a known text. Texts have fewer than 40 characters here.
def normalized(column: str) -> str:
    return f"trim(regexp_replace(lower({column}), '\\W', ' ', 'g'))"


def token_sorted(column: str) -> str:
    return f"array_to_string(list_sort(string_split({normalized(column)}, ' ')), ' ')"


def matches(unknown: str, known: str, threshold: int) -> str:
    return f"""
SELECT id, CASE WHEN score >= {threshold} THEN choice END AS match, score FROM (
  SELECT id, choice, CAST(round_even(200.0 * (length(y) - bit_count(free)) / (length(x) + length(y)), 0) AS INTEGER) AS score
  FROM (
    SELECT u.id, u.t AS x, k.choice, k.t AS y,
           list_reduce(list_transform(string_split(u.t, ''), lambda c: coalesce(k.masks[c], 0)),
             lambda v, m: ((v + (v & m)) | (v - (v & m))) & ((1::BIGINT << length(k.t)) - 1),
             (1::BIGINT << length(k.t)) - 1) AS free
    FROM {unknown} u, (
      SELECT choice, t, map_from_entries(list((c, mask))) AS masks FROM (
        SELECT choice, t, substr(t, CAST(i AS BIGINT), 1) AS c, bit_or(1::BIGINT << CAST(i - 1 AS BIGINT)) AS mask
        FROM {known}, generate_series(1, 40) g(i)
        WHERE i <= length(t) GROUP BY 1, 2, 3)
      GROUP BY 1, 2) k)
) QUALIFY row_number() OVER (PARTITION BY id ORDER BY score DESC, choice) = 1"""


ROLES["unknown_ids"] = f"""
SELECT id, {normalized("id")} AS t FROM (
  SELECT product_id AS id FROM kept_snapshots WHERE contains(validation_errors, 'MISMATCHED_PRODUCT_ID')
  UNION SELECT product_id FROM all_restocks WHERE contains(validation_errors, 'MISMATCHED_PRODUCT_ID'))"""
ROLES["known_ids"] = f"SELECT product_id AS choice, {normalized('product_id')} AS t FROM products"
ROLES["matches"] = matches("unknown_ids", "known_ids", 85)

ROLES["unknown_names"] = f"""
SELECT id, {token_sorted("id")} AS t FROM (
  SELECT DISTINCT array_to_string(list_reverse(string_split(product_name, ' ')), ' ') || ' x' AS id FROM products)"""
ROLES["known_names"] = f"""
SELECT min(product_name) AS choice, t FROM (SELECT product_name, {token_sorted("product_name")} AS t FROM products)
GROUP BY t"""
ROLES["name_matches"] = matches("unknown_names", "known_names", 80)

ROLES["header"] = """
SELECT o_orderkey AS transaction_id, o_custkey AS customer_id, CAST(o_orderdate AS DATE) AS sale_date,
       o_totalprice AS total_amount, o_orderpriority AS payment_mode
FROM orders"""

ROLES["lines"] = """
SELECT l_orderkey AS transaction_id, p_brand AS product_id FROM lineitem JOIN part ON l_partkey = p_partkey"""

ROLES["brands"] = """
SELECT p_brand AS product_id, upper(p_brand) AS product_name, min(p_type) AS category FROM part GROUP BY p_brand"""

ROLES["items"] = """
SELECT transaction_id, product_id, count(*) AS n FROM lines GROUP BY 1, 2"""

ROLES["pairs_list"] = """
SELECT a.transaction_id, a.product_id AS product_a, b.product_id AS product_b,
       CASE WHEN a.product_id = b.product_id THEN a.n * (a.n - 1) // 2 ELSE a.n * b.n END AS pair_rows
FROM items a JOIN items b ON a.transaction_id = b.transaction_id
 AND (a.product_id < b.product_id OR (a.product_id = b.product_id AND a.n > 1))"""

ROLES["pairs_distinct"] = """
SELECT a.transaction_id, a.product_id AS product_a, b.product_id AS product_b, CAST(1 AS BIGINT) AS pair_rows
FROM items a JOIN items b ON a.transaction_id = b.transaction_id AND a.product_id < b.product_id"""

ROLES["product_count"] = """
SELECT product_id, count(DISTINCT transaction_id) AS product_count FROM lines GROUP BY 1"""


def affinity(pairs: str) -> str:
    return f"""
SELECT product_a, product_b, pair_count, a.product_count AS count_a, b.product_count AS count_b,
       pair_count / total AS support, pair_count / a.product_count AS confidence_a_to_b,
       pair_count / b.product_count AS confidence_b_to_a, b.product_count / total AS p_b, a.product_count / total AS p_a,
       confidence_a_to_b / p_b AS lift, na.product_name AS product_a_name, nb.product_name AS product_b_name
FROM (SELECT product_a, product_b, CAST(sum(pair_rows) AS BIGINT) AS pair_count FROM {pairs} GROUP BY 1, 2)
JOIN product_count a ON product_a = a.product_id JOIN product_count b ON product_b = b.product_id
LEFT JOIN brands na ON product_a = na.product_id LEFT JOIN brands nb ON product_b = nb.product_id,
(SELECT CAST(count(*) AS DOUBLE) AS total FROM header)
WHERE support >= 0.01 AND confidence_a_to_b >= 0.1 AND lift >= 1.0"""


ROLES["affinity_list"] = affinity("pairs_list")
ROLES["affinity_distinct"] = affinity("pairs_distinct")

ROLES["customers"] = """
SELECT c_custkey AS customer_id, c_name AS customer_name, c_mktsegment AS customer_tier, total_purchases,
       c_acctbal AS total_refunds, CASE WHEN c_acctbal < 0 THEN 'FLAGGED' ELSE 'ACTIVE' END AS account_status
FROM customer LEFT JOIN (SELECT o_custkey, round(sum(o_totalprice), 2) AS total_purchases FROM orders GROUP BY 1)
  ON c_custkey = o_custkey"""

ROLES["refunds"] = f"""
SELECT 'REF' || lpad(CAST(l_orderkey AS VARCHAR), 10, '0') || '-' || CAST(l_linenumber AS VARCHAR) || '-'
         || CAST(l_suppkey AS VARCHAR) AS refund_id,
       CASE WHEN l_tax = 0.08 THEN -l_orderkey - 1 ELSE l_orderkey END AS original_transaction_id,
       CASE WHEN {at(0.0, 0.0)} THEN NULL WHEN l_discount = 0.01 THEN o_custkey + 1 ELSE o_custkey END AS customer_id,
       CAST(l_shipdate AS DATE) AS refund_date,
       floor(l_extendedprice * (1 - l_discount) * (1 + l_tax) * 100) / 100 AS refund_amount,
       CASE WHEN {at(0.02, 0.0)} THEN 0.0 ELSE l_extendedprice END AS original_amount,
       CASE WHEN NOT {at(0.03, 0.0)} THEN p_brand END AS product_id,
       CASE WHEN l_linestatus = 'F' THEN 'Damaged' ELSE 'Changed mind' END AS refund_reason,
       o_orderpriority AS payment_mode,
       CASE WHEN l_quantity = 50 THEN NULL WHEN l_quantity > 45 THEN '1-URGENT' ELSE o_orderpriority END
         AS original_payment_mode
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
WHERE l_returnflag = 'R'"""

ROLES["enriched"] = """
SELECT r.*, h.transaction_id, h.customer_id AS customer_id_original, sale_date, total_amount,
       h.payment_mode AS payment_mode_original, customer_name, customer_tier, total_purchases, total_refunds,
       account_status, product_name, category,
       CASE WHEN original_amount = 0 THEN CASE WHEN refund_amount > 0 THEN CAST('inf' AS DOUBLE) END
            ELSE refund_amount / original_amount END AS refund_ratio,
       CAST(coalesce(refund_date - sale_date, 999) AS INTEGER) AS days_since_purchase
FROM refunds r LEFT JOIN header h ON original_transaction_id = transaction_id
LEFT JOIN customers c ON r.customer_id = c.customer_id LEFT JOIN brands b ON r.product_id = b.product_id"""

PAYMENT_DIFFERS = "coalesce(payment_mode <> original_payment_mode, true)"

ROLES["validated"] = f"""
SELECT *, {codes(("AMOUNT_EXCEEDED", "coalesce(refund_ratio > 1.0, false)"),
                 ("CUSTOMER_MISMATCH", "coalesce(customer_id <> customer_id_original, true)"),
                 ("OUTSIDE_WINDOW", "days_since_purchase > 30"),
                 ("PAYMENT_MISMATCH", PAYMENT_DIFFERS))} AS validation_errors,
       CASE WHEN validation_errors = '' THEN 'VALID' ELSE 'INVALID' END AS validation_status
FROM enriched"""

ROLES["behaved"] = """
SELECT v.*,
  CASE WHEN customer_id IS NOT NULL THEN count(*) OVER (PARTITION BY customer_id) END AS refund_count,
  CASE WHEN customer_id IS NOT NULL AND product_id IS NOT NULL
       THEN count(*) OVER (PARTITION BY customer_id, product_id) END AS product_refund_count,
  CASE WHEN customer_id IS NOT NULL
       THEN coalesce(CASE WHEN total_purchases = 0 THEN CASE WHEN sum(refund_amount) OVER (PARTITION BY customer_id) > 0
                       THEN CAST('inf' AS DOUBLE) END
                     ELSE sum(refund_amount) OVER (PARTITION BY customer_id) / total_purchases END, 0) END
    AS customer_refund_ratio
FROM validated v"""

ROLES["stats"] = """
SELECT avg(refund_amount) AS mean_amount, stddev_samp(refund_amount) AS std_amount,
       quantile_cont(refund_amount, 0.25) AS q1, quantile_cont(refund_amount, 0.75) AS q3, count(refund_amount) AS amounts
FROM refunds"""

# Thresholds at the scale of this data; see checks.queries.
DETECTORS = [
    ("HIGH_FREQUENCY", 30, "coalesce(refund_count > 15, false)"),
    ("HIGH_VALUE", 20, "refund_amount > 90000"),
    ("REPEAT_PRODUCT", 25, "coalesce(product_refund_count > 2, false)"),
    ("AMOUNT_EXCEEDED", 50, "coalesce(refund_ratio > 1.0, false)"),
    ("PAYMENT_MISMATCH", 15, PAYMENT_DIFFERS),
]
ANOMALIES = [
    ("ZSCORE_ANOMALY", 20, "abs((refund_amount - mean_amount) / std_amount) > 1.7"),
    ("IQR_ANOMALY", 15, "refund_amount < q1 - 0.25 * (q3 - q1) OR refund_amount > q3 + 0.25 * (q3 - q1)"),
    ("HIGH_REFUND_RATIO", 25, "coalesce(customer_refund_ratio > 0.30, false)"),
]


def points(detectors) -> str:
    return " + ".join(f"CASE WHEN {test} THEN {n} ELSE 0 END" for _, n, test in detectors)


def flags(detectors) -> str:
    return codes(*[(name, test) for name, _, test in detectors])


ROLES["scored"] = f"""
SELECT *, CASE WHEN fraud_score <= 0 THEN 'CLEAN' WHEN fraud_score <= 30 THEN 'LOW' WHEN fraud_score <= 60 THEN 'MEDIUM'
            ELSE 'HIGH' END AS fraud_severity
FROM (SELECT *, {flags(DETECTORS + ANOMALIES)} AS fraud_flags, {points(DETECTORS + ANOMALIES)} AS fraud_score
      FROM behaved, stats)"""

ROLES["history"] = """
SELECT o_custkey AS customer_id, o_orderkey AS transaction_id, CAST(o_orderdate AS DATE) AS date,
       o_totalprice / 1000 AS amount FROM orders"""

ROLES["base"] = """
SELECT c.customer_id, CAST((SELECT max(date) FROM history) - max(date) AS INTEGER) AS recency_days,
       count(transaction_id) AS frequency, coalesce(sum(amount), 0) AS monetary,
       CAST((SELECT max(date) FROM history) - min(date) AS INTEGER) AS tenure_days
FROM customers c LEFT JOIN history h USING (customer_id) GROUP BY 1"""

ROLES["rfm"] = """
SELECT *, r_score + f_score + m_score AS rfm_score FROM (
  SELECT *,
    CASE WHEN frequency = 0 THEN 0 WHEN recency_days < 7 THEN 5 WHEN recency_days <= 15 THEN 4
         WHEN recency_days <= 30 THEN 3 WHEN recency_days <= 60 THEN 2 ELSE 1 END AS r_score,
    CASE WHEN frequency = 0 THEN 0 WHEN frequency >= 8 THEN 5 WHEN frequency >= 6 THEN 4 WHEN frequency >= 4 THEN 3
         WHEN frequency >= 2 THEN 2 ELSE 1 END AS f_score,
    CASE WHEN frequency = 0 THEN 0 WHEN monetary >= 2000 THEN 5 WHEN monetary >= 1000 THEN 4 WHEN monetary >= 500 THEN 3
         WHEN monetary >= 200 THEN 2 ELSE 1 END AS m_score
  FROM base)"""

ROLES["segmented"] = """
SELECT *, CASE WHEN rfm_score >= 9 THEN 'CHAMPIONS' WHEN rfm_score >= 7 THEN 'LOYAL CUSTOMERS'
               WHEN rfm_score >= 5 THEN 'POTENTIAL LOYALISTS' WHEN rfm_score >= 3 THEN 'AT RISK' ELSE 'LOST' END AS segment
FROM rfm"""

ROLES["units"] = f"""
SELECT CASE WHEN {at(0.0, 0.01)} THEN '' WHEN NOT {at(0.0, 0.02)} THEN 'ST' || CAST(l_suppkey % 10 AS VARCHAR) END AS "Store_ID",
       'P' || lpad(CAST(l_partkey AS VARCHAR), 8, '0') AS "Product_ID", CAST(l_shipdate AS DATE) AS "Date",
       l_quantity - 2 AS "Inventory_Level",
       CASE WHEN {at(0.05, 0.05)} THEN -1.0 ELSE round(l_tax * 100) * 5 END AS "Units_Sold",
       CASE WHEN l_discount <> 0.07 THEN round(l_discount * 100) END AS "Units_Ordered",
       CASE WHEN l_extendedprice < 1500 THEN 0.0 ELSE l_extendedprice END AS "Price", l_discount AS "Discount"
FROM lineitem"""

ROLES["tagged_units"] = f"""
SELECT *, {codes(("Missing Store_ID", "(Store_ID IS NULL OR Store_ID = '')"),
                 ("Missing Product_ID", "(Product_ID IS NULL OR Product_ID = '')"),
                 ("Missing Date", "Date IS NULL"), ("Missing Inventory_Level", "Inventory_Level IS NULL"),
                 ("Negative inventory", "coalesce(Inventory_Level < 0, false)"),
                 ("Negative units sold", "coalesce(Units_Sold < 0, false)"),
                 ("Invalid price", "coalesce(Price <= 0, false)"))} AS validation_errors,
       CASE WHEN validation_errors = '' THEN 'VALID' ELSE 'INVALID' END AS validation_status
FROM units"""

ROLES["latest_units"] = """
SELECT * FROM tagged_units WHERE validation_status = 'VALID'
QUALIFY row_number() OVER (PARTITION BY Store_ID, Product_ID ORDER BY Date DESC, Inventory_Level DESC NULLS LAST,
  Units_Sold DESC NULLS LAST, Units_Ordered DESC NULLS LAST, Price DESC NULLS LAST, Discount DESC NULLS LAST) = 1"""

ROLES["units_fact"] = """
SELECT Store_ID, Product_ID, Date, Inventory_Level, Units_Sold, Units_Ordered,
       Inventory_Level + coalesce(Units_Ordered, 0) - coalesce(Units_Sold, 0) AS final_stock_level,
       coalesce(Units_Ordered, 0) AS restock_in, coalesce(Units_Sold, 0) AS restock_out,
       coalesce(Units_Ordered, 0) - coalesce(Units_Sold, 0) AS stock_movement, Price, Discount,
       CASE WHEN final_stock_level > 50 THEN 'FLAGGED_CAPACITY' WHEN final_stock_level < 0 THEN 'FLAGGED_NEGATIVE'
            ELSE 'RECONCILED' END AS reconciliation_status,
       coalesce(final_stock_level < 0, false) AS negative_stock_flag,
       coalesce(final_stock_level > 50, false) AS capacity_exceeded_flag, '1.0' AS pipeline_version
FROM latest_units"""

# The text of the level decides ties, so it is carried beside the number.
ROLES["tagged_snapshots"] = ROLES["tagged_snapshots"].replace("SELECT s.*", "SELECT s.snapshot_level AS snapshot_text, s.*", 1)


def with_roles(body: str) -> str:
    """The body with the roles it uses, and those they use, in front."""
    used: list[str] = []

    def visit(text: str) -> None:
        for name in ROLES:
            if name not in used and re.search(rf"(FROM|JOIN|,)\s+{name}\b", text):
                visit(ROLES[name])
                if name not in used:
                    used.append(name)

    visit(body)
    if not used:
        return body
    return "WITH " + ",\n".join(f"{name} AS ({ROLES[name]})" for name in used) + "\n" + body
