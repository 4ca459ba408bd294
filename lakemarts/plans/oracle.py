"""DuckDB oracle SQL for every registered query.

The oracle is written independently of the Spark plans: it follows the
straightforward relational shape (raw mapping → cleansing with a window
dedup → inner joins to dimensions → group by), while the Spark side uses
semi-joins and pre-aggregation.  Agreement of the two is the correctness
check.

Two engine differences are neutralised here:

* DuckDB divides decimals as doubles and rounds doubles in binary, while
  Spark's ``round(avg(x), 2)`` and ``round(100.0 * a / b, 2)`` are exact
  HALF_UP decimal operations.  The helpers below compute those roundings in
  exact integer arithmetic.
* Output types are normalised on both sides: numbers → DOUBLE; dates,
  timestamps and booleans → VARCHAR (``comparable`` on the Spark side).
"""

from __future__ import annotations

import re

# The recorded checks, written out here so that a check dropped
# from the code under test shows as a difference.
KEY_CHECKS = {
    "customers": (["customer_id", "customer_unique_id"], ["customer_id"]),
    "orders": (["order_id", "customer_id"], ["order_id"]),
    "order_items": (["order_id", "order_item_id", "product_id", "seller_id"], ["order_id", "order_item_id"]),
    "payments": (["order_id", "payment_sequential", "payment_value"], ["order_id", "payment_sequential"]),
    "reviews": (["review_id", "order_id", "review_score"], ["review_id"]),
    "products": (["product_id"], ["product_id"]),
    "sellers": (["seller_id"], ["seller_id"]),
}
REFERENCES = [
    ("orders", "customers", "customer_id"),
    ("order_items", "orders", "order_id"),
    ("order_items", "products", "product_id"),
    ("order_items", "sellers", "seller_id"),
    ("payments", "orders", "order_id"),
    ("reviews", "orders", "order_id"),
]
RULES = [
    ("order_items", "non_negative_item_amounts", "Price, freight, and item total must not be negative.",
     "price >= 0 AND freight_value >= 0 AND item_total_amount >= 0"),
    ("payments", "non_negative_payment_value", "Payment value must not be negative.", "payment_value >= 0"),
    ("reviews", "valid_review_score", "Review score must be between 1 and 5.", "review_score BETWEEN 1 AND 5"),
    ("orders", "valid_delivery_sequence", "Delivery date must not occur before purchase date.",
     "order_delivered_customer_date IS NULL OR order_delivered_customer_date >= order_purchase_timestamp"),
]
MART_KEYS = {
    "mart_daily_sales": (["date_key", "total_orders", "payment_total"], "date_key"),
    "mart_product_performance": (["product_key", "total_orders", "gross_sales"], "product_key"),
    "mart_customer_summary": (["customer_unique_id", "total_orders", "lifetime_payment_value"], "customer_unique_id"),
    "mart_delivery_quality": (["delivery_quality_key", "year_month", "customer_state"], "delivery_quality_key"),
}

# ------------------------------------------------------------ exact rounding


def avg2_dec(x: str) -> str:
    """round(avg(x), 2) for decimal(p,2) x: avg keeps 6 decimals (HALF_UP),
    then rounds to 2 (HALF_UP)."""
    c = f"CAST(sum({x}) * 100 AS HUGEINT)"
    n = f"CAST(nullif(count({x}), 0) AS HUGEINT)"
    return f"(sign({c}) * (((2 * abs({c}) * 10000 + {n}) // (2 * {n}) + 5000) // 10000) / 100.0)"


def avg2_int(x: str) -> str:
    """round(avg(x), 2) for an integer x, HALF_UP on the exact mean."""
    k = f"CAST(sum({x}) AS HUGEINT)"
    n = f"CAST(nullif(count({x}), 0) AS HUGEINT)"
    return f"(sign({k}) * ((2 * abs({k}) * 100 + {n}) // (2 * {n})) / 100.0)"


def avg2_cents(x: str) -> str:
    """round(avg(x), 2) for a double x that already holds 2 decimals."""
    k = f"sum(CAST(round({x} * 100) AS HUGEINT))"
    n = f"CAST(nullif(count({x}), 0) AS HUGEINT)"
    return f"(sign({k}) * ((2 * abs({k}) + {n}) // (2 * {n})) / 100.0)"


def pct2(num: str, den: str) -> str:
    """round(100.0 * num / nullif(den, 0), 2) for non-negative counts."""
    a = f"CAST({num} AS HUGEINT)"
    b = f"CAST(nullif({den}, 0) AS HUGEINT)"
    return f"(((20000 * {a} + {b}) // (2 * {b})) / 100.0)"


KINDS = {"s": "VARCHAR", "i": "DOUBLE", "f": "DOUBLE", "d": "VARCHAR", "t": "VARCHAR", "b": "VARCHAR"}


def typed(source: str, spec: str, where: str = "") -> str:
    """SELECT with normalised output types; spec is 'name:kind ...'."""
    cols = []
    for item in spec.split():
        name, kind = item.split(":")
        cols.append(f"CAST({name} AS {KINDS[kind]}) AS {name}")
    return f"SELECT {', '.join(cols)} FROM {source}" + (f" WHERE {where}" if where else "")


def _dedup(inner: str, key: str, order: str) -> str:
    return (
        f"SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {order}) AS rn "
        f"FROM ({inner}) x) y WHERE rn = 1"
    )


def _asc(cols: str) -> str:
    return ", ".join(f"{c} ASC NULLS LAST" for c in cols.split())


# --------------------------------------------------------------------- CTEs
# Each entry: name -> body.  Dependencies are found by name.

CTES: dict[str, str] = {}

# Raw mapping of the benchmark tables (FIXTURES.md §2).
CTES["customers_raw"] = """
select concat(' C', cast(c_custkey as string), ' ') as customer_id,
       concat('U', cast(c_custkey - c_custkey % 3 as string)) as customer_unique_id,
       lpad(cast(c_nationkey * 137 as string), 5, '0') as customer_zip_code_prefix,
       n_name as customer_city,
       lower(substr(r_name, 1, 2)) as customer_state
from customer
join nation on c_nationkey = n_nationkey
join region on n_regionkey = r_regionkey"""

CTES["orders_raw"] = """
select concat('O', cast(o_orderkey as string)) as order_id,
       concat('C', cast(o_custkey as string)) as customer_id,
       case o_orderstatus when 'F' then ' Delivered' when 'O' then 'shipped' else 'processing' end as order_status,
       cast(o_orderdate as string) as order_purchase_timestamp,
       case when o_orderstatus <> 'P' then cast(o_orderdate + interval '1' day as string) end as order_approved_at,
       case when o_orderstatus = 'F' then cast(o_orderdate + interval '2' day as string) end as order_delivered_carrier_date,
       case when o_orderstatus = 'F' and o_orderkey % 20 <> 19
            then cast(o_orderdate + interval '1' day * (o_orderkey % 45) as string) end as order_delivered_customer_date,
       cast(o_orderdate + interval '30' day as string) as order_estimated_delivery_date
from orders"""

CTES["order_items_raw"] = """
select concat('O', cast(l_orderkey as string)) as order_id,
       cast(l_linenumber as string) as order_item_id,
       concat('P', cast(l_partkey as string)) as product_id,
       concat('S', cast(l_suppkey as string)) as seller_id,
       cast(l_shipdate as string) as shipping_limit_date,
       cast(cast(l_extendedprice as decimal(12,2)) as string) as price,
       cast(cast(l_quantity as decimal(12,2)) as string) as freight_value
from lineitem"""

CTES["payments_raw"] = """
select concat('O', cast(l_orderkey as string)) as order_id,
       cast(row_number() over (partition by l_orderkey order by l_returnflag) as string) as payment_sequential,
       case l_returnflag when 'A' then 'Credit_Card ' when 'N' then 'boleto' else 'voucher' end as payment_type,
       cast(n as string) as payment_installments,
       cast(v as string) as payment_value
from (select l_orderkey, l_returnflag, count(*) as n,
             sum(cast(l_extendedprice as decimal(12,2))) as v
      from lineitem group by l_orderkey, l_returnflag) g"""

CTES["reviews_raw"] = """
select concat('R', cast(event_id - case when event_id % 10 = 9 then 1 else 0 end as string)) as review_id,
       concat('O', cast(event_id as string)) as order_id,
       case event_type when 'signup' then '5' when 'purchase' then '4' when 'view' then '3'
                       when 'click' then '2' else '0' end as review_score,
       cast(null as string) as review_comment_title,
       case when value > 50 then event_type else '  ' end as review_comment_message,
       cast(ts as string) as review_creation_date,
       cast(ts + interval '1' day as string) as review_answer_timestamp
from events"""

CTES["products_raw"] = """
select concat('P', cast(p_partkey as string)) as product_id,
       case when p_type <> 'STANDARD' then p_type end as product_category_name,
       cast(length(p_name) as string) as product_name_lenght,
       cast(p_size * 10 as string) as product_description_lenght,
       cast(p_size % 5 as string) as product_photos_qty,
       cast(p_size * 100 as string) as product_weight_g,
       cast(p_size as string) as product_length_cm,
       cast(p_size + 1 as string) as product_height_cm,
       cast(p_size + 2 as string) as product_width_cm
from part"""

CTES["sellers_raw"] = """
select concat('S', cast(s_suppkey as string)) as seller_id,
       lpad(cast(s_nationkey * 137 as string), 5, '0') as seller_zip_code_prefix,
       n_name as seller_city,
       lower(substr(r_name, 1, 2)) as seller_state
from supplier
join nation on s_nationkey = n_nationkey
join region on n_regionkey = r_regionkey"""

# Silver: clean, filter, then keep the first row per key by a total order.
CTES["c_customers"] = """
SELECT trim(customer_id) AS customer_id, trim(customer_unique_id) AS customer_unique_id,
       try_cast(customer_zip_code_prefix AS INTEGER) AS customer_zip_code_prefix,
       lower(trim(customer_city)) AS customer_city, upper(trim(customer_state)) AS customer_state
FROM customers_raw"""
CTES["s_customers"] = _dedup(
    "SELECT * FROM c_customers WHERE customer_id IS NOT NULL AND length(customer_id) > 0",
    "customer_id",
    _asc("customer_unique_id customer_zip_code_prefix customer_city customer_state"),
)

CTES["c_orders"] = """
SELECT trim(order_id) AS order_id, trim(customer_id) AS customer_id, lower(trim(order_status)) AS order_status,
       try_cast(order_purchase_timestamp AS TIMESTAMP) AS order_purchase_timestamp,
       try_cast(order_approved_at AS TIMESTAMP) AS order_approved_at,
       try_cast(order_delivered_carrier_date AS TIMESTAMP) AS order_delivered_carrier_date,
       try_cast(order_delivered_customer_date AS TIMESTAMP) AS order_delivered_customer_date,
       try_cast(order_estimated_delivery_date AS TIMESTAMP) AS order_estimated_delivery_date
FROM orders_raw"""
CTES["d_orders"] = _dedup(
    "SELECT * FROM c_orders WHERE order_id IS NOT NULL AND length(order_id) > 0",
    "order_id",
    _asc(
        "customer_id order_status order_purchase_timestamp order_approved_at order_delivered_carrier_date "
        "order_delivered_customer_date order_estimated_delivery_date"
    ),
)
CTES["s_orders"] = """
SELECT *,
       date_diff('day', CAST(order_purchase_timestamp AS DATE), CAST(order_delivered_customer_date AS DATE)) AS delivery_days,
       CASE WHEN order_delivered_customer_date IS NULL OR order_estimated_delivery_date IS NULL THEN NULL
            WHEN order_delivered_customer_date > order_estimated_delivery_date THEN TRUE
            ELSE FALSE END AS is_delivered_late,
       CAST(order_purchase_timestamp AS DATE) AS purchase_date
FROM d_orders"""

CTES["c_order_items"] = """
SELECT trim(order_id) AS order_id, try_cast(order_item_id AS INTEGER) AS order_item_id,
       trim(product_id) AS product_id, trim(seller_id) AS seller_id,
       try_cast(shipping_limit_date AS TIMESTAMP) AS shipping_limit_date,
       try_cast(price AS DECIMAL(12,2)) AS price, try_cast(freight_value AS DECIMAL(12,2)) AS freight_value
FROM order_items_raw"""
CTES["f_order_items"] = """
SELECT * FROM c_order_items
WHERE order_id IS NOT NULL AND order_item_id IS NOT NULL AND product_id IS NOT NULL AND seller_id IS NOT NULL
  AND price >= 0 AND freight_value >= 0"""
CTES["d_order_items"] = _dedup(
    "SELECT * FROM f_order_items",
    "order_id, order_item_id",
    _asc("product_id seller_id shipping_limit_date price freight_value"),
)
CTES["s_order_items"] = "SELECT *, round(price + freight_value, 2) AS item_total_amount FROM d_order_items"

CTES["c_payments"] = """
SELECT trim(order_id) AS order_id, try_cast(payment_sequential AS INTEGER) AS payment_sequential,
       lower(trim(payment_type)) AS payment_type, try_cast(payment_installments AS INTEGER) AS payment_installments,
       try_cast(payment_value AS DECIMAL(12,2)) AS payment_value
FROM payments_raw"""
CTES["s_payments"] = _dedup(
    "SELECT * FROM c_payments WHERE order_id IS NOT NULL AND payment_sequential IS NOT NULL AND payment_value >= 0",
    "order_id, payment_sequential",
    _asc("payment_type payment_installments payment_value"),
)

CTES["c_reviews"] = """
SELECT trim(review_id) AS review_id, trim(order_id) AS order_id, try_cast(review_score AS INTEGER) AS review_score,
       trim(review_comment_title) AS review_comment_title, trim(review_comment_message) AS review_comment_message,
       try_cast(review_creation_date AS TIMESTAMP) AS review_creation_date,
       try_cast(review_answer_timestamp AS TIMESTAMP) AS review_answer_timestamp
FROM reviews_raw"""
CTES["d_reviews"] = _dedup(
    "SELECT * FROM c_reviews WHERE review_id IS NOT NULL AND order_id IS NOT NULL AND review_score BETWEEN 1 AND 5",
    "review_id",
    "review_creation_date DESC NULLS LAST, review_answer_timestamp DESC NULLS LAST, order_id ASC NULLS LAST, "
    + _asc("review_score review_comment_title review_comment_message"),
)
CTES["s_reviews"] = """
SELECT *, CASE WHEN review_comment_message IS NOT NULL AND length(review_comment_message) > 0
               THEN TRUE ELSE FALSE END AS has_comment
FROM d_reviews"""

CTES["c_products"] = """
SELECT trim(product_id) AS product_id, lower(trim(product_category_name)) AS product_category_name,
       try_cast(product_name_lenght AS INTEGER) AS product_name_length,
       try_cast(product_description_lenght AS INTEGER) AS product_description_length,
       try_cast(product_photos_qty AS INTEGER) AS product_photos_qty,
       try_cast(product_weight_g AS INTEGER) AS product_weight_g,
       try_cast(product_length_cm AS INTEGER) AS product_length_cm,
       try_cast(product_height_cm AS INTEGER) AS product_height_cm,
       try_cast(product_width_cm AS INTEGER) AS product_width_cm
FROM products_raw"""
CTES["d_products"] = _dedup(
    "SELECT * FROM c_products WHERE product_id IS NOT NULL",
    "product_id",
    _asc(
        "product_category_name product_name_length product_description_length product_photos_qty "
        "product_weight_g product_length_cm product_height_cm product_width_cm"
    ),
)
CTES["s_products"] = (
    "SELECT *, product_length_cm * product_height_cm * product_width_cm AS product_volume_cm3 FROM d_products"
)

CTES["c_sellers"] = """
SELECT trim(seller_id) AS seller_id, try_cast(seller_zip_code_prefix AS INTEGER) AS seller_zip_code_prefix,
       lower(trim(seller_city)) AS seller_city, upper(trim(seller_state)) AS seller_state
FROM sellers_raw"""
CTES["s_sellers"] = _dedup(
    "SELECT * FROM c_sellers WHERE seller_id IS NOT NULL AND length(seller_id) > 0",
    "seller_id",
    _asc("seller_zip_code_prefix seller_city seller_state"),
)

# Gold.
CTES["dim_customers"] = """
SELECT sha256(customer_id) AS customer_key, customer_id, customer_unique_id, customer_zip_code_prefix,
       customer_city, customer_state
FROM s_customers"""
CTES["dim_products"] = """
SELECT sha256(product_id) AS product_key, product_id, coalesce(product_category_name, 'unknown') AS product_category_name,
       product_name_length, product_description_length, product_photos_qty, product_weight_g,
       product_length_cm, product_height_cm, product_width_cm, product_volume_cm3
FROM s_products"""
CTES["dim_sellers"] = """
SELECT sha256(seller_id) AS seller_key, seller_id, seller_zip_code_prefix, seller_city, seller_state
FROM s_sellers"""
CTES["dim_date"] = """
SELECT CAST(strftime(full_date, '%Y%m%d') AS INTEGER) AS date_key, full_date,
       dayofmonth(full_date) AS day_of_month, dayofweek(full_date) + 1 AS day_of_week,
       strftime(full_date, '%A') AS day_name, weekofyear(full_date) AS week_of_year,
       month(full_date) AS month_number, strftime(full_date, '%B') AS month_name,
       quarter(full_date) AS quarter_number, year(full_date) AS year_number,
       strftime(full_date, '%Y-%m') AS year_month, dayofweek(full_date) IN (0, 6) AS is_weekend
FROM (SELECT DISTINCT purchase_date AS full_date FROM s_orders WHERE purchase_date IS NOT NULL) d"""
CTES["items_per_order"] = """
SELECT order_id, count(*) AS item_count, count(DISTINCT product_id) AS distinct_product_count,
       count(DISTINCT seller_id) AS distinct_seller_count, sum(price) AS item_subtotal,
       sum(freight_value) AS freight_total, sum(item_total_amount) AS order_total
FROM s_order_items GROUP BY order_id"""
CTES["payments_per_order"] = """
SELECT order_id, count(*) AS payment_record_count, count(DISTINCT payment_type) AS payment_type_count,
       coalesce(array_to_string(list_sort(list_distinct(list(payment_type))), ', '), '') AS payment_types,
       max(payment_installments) AS maximum_installments, sum(payment_value) AS payment_total
FROM s_payments GROUP BY order_id"""
CTES["reviews_per_order"] = f"""
SELECT order_id, count(DISTINCT review_id) AS review_count,
       {avg2_int('review_score')} AS average_review_score,
       bool_or(has_comment) AS has_review_comment
FROM s_reviews GROUP BY order_id"""
CTES["fct_orders"] = """
SELECT sha256(o.order_id) AS order_key, o.order_id, c.customer_key,
       CAST(strftime(o.purchase_date, '%Y%m%d') AS INTEGER) AS order_date_key,
       o.order_status, o.order_purchase_timestamp, o.order_approved_at, o.order_delivered_carrier_date,
       o.order_delivered_customer_date, o.order_estimated_delivery_date, o.delivery_days, o.is_delivered_late,
       coalesce(i.item_count, 0) AS item_count,
       coalesce(i.distinct_product_count, 0) AS distinct_product_count,
       coalesce(i.distinct_seller_count, 0) AS distinct_seller_count,
       coalesce(i.item_subtotal, 0) AS item_subtotal,
       coalesce(i.freight_total, 0) AS freight_total,
       coalesce(i.order_total, 0) AS order_total,
       coalesce(p.payment_record_count, 0) AS payment_record_count,
       coalesce(p.payment_type_count, 0) AS payment_type_count,
       p.payment_types,
       coalesce(p.maximum_installments, 0) AS maximum_installments,
       coalesce(p.payment_total, 0) AS payment_total,
       r.review_count, r.average_review_score, r.has_review_comment,
       1 AS order_count,
       round(coalesce(p.payment_total, 0) - coalesce(i.order_total, 0), 2) AS payment_difference
FROM s_orders o
JOIN dim_customers c ON o.customer_id = c.customer_id
LEFT JOIN items_per_order i ON o.order_id = i.order_id
LEFT JOIN payments_per_order p ON o.order_id = p.order_id
LEFT JOIN reviews_per_order r ON o.order_id = r.order_id"""
CTES["fct_order_items"] = """
SELECT sha256(concat_ws('||', i.order_id, CAST(i.order_item_id AS VARCHAR))) AS order_item_key,
       i.order_id, i.order_item_id, c.customer_key, p.product_key, s.seller_key,
       CAST(strftime(o.purchase_date, '%Y%m%d') AS INTEGER) AS order_date_key,
       o.order_status, i.shipping_limit_date, i.price AS item_price, i.freight_value, i.item_total_amount,
       o.delivery_days, o.is_delivered_late, 1 AS item_quantity
FROM s_order_items i
JOIN s_orders o ON i.order_id = o.order_id
JOIN dim_customers c ON o.customer_id = c.customer_id
JOIN dim_products p ON i.product_id = p.product_id
JOIN dim_sellers s ON i.seller_id = s.seller_id"""

_DELIVERED = "CASE WHEN o.order_status = 'delivered' THEN 1 ELSE 0 END"
_LATE = "CASE WHEN o.is_delivered_late = true THEN 1 ELSE 0 END"

# Marts, in the relational shape of the mart definitions.
CTES["mart_daily_sales"] = f"""
SELECT d.date_key, d.full_date, d.year_number, d.quarter_number, d.month_number, d.month_name, d.year_month,
       count(*) AS total_orders,
       sum({_DELIVERED}) AS delivered_orders,
       sum(o.item_count) AS total_items,
       sum(o.item_subtotal) AS item_subtotal,
       sum(o.freight_total) AS freight_total,
       sum(o.order_total) AS order_total,
       sum(o.payment_total) AS payment_total,
       {avg2_dec('o.payment_total')} AS average_order_value,
       sum({_LATE}) AS late_orders,
       {pct2(f'sum({_LATE})', f'sum({_DELIVERED})')} AS late_delivery_rate_pct,
       {avg2_cents('o.average_review_score')} AS average_review_score
FROM fct_orders o
JOIN dim_date d ON o.order_date_key = d.date_key
GROUP BY d.date_key, d.full_date, d.year_number, d.quarter_number, d.month_number, d.month_name, d.year_month"""
CTES["mart_product_performance"] = f"""
SELECT p.product_key, p.product_id, p.product_category_name,
       count(DISTINCT i.order_id) AS total_orders,
       sum(i.item_quantity) AS units_sold,
       sum(i.item_price) AS item_revenue,
       sum(i.freight_value) AS freight_total,
       sum(i.item_total_amount) AS gross_sales,
       {avg2_dec('i.item_price')} AS average_item_price,
       {avg2_int('i.delivery_days')} AS average_delivery_days,
       sum(CASE WHEN i.is_delivered_late = true THEN 1 ELSE 0 END) AS late_items
FROM fct_order_items i
JOIN dim_products p ON i.product_key = p.product_key
GROUP BY p.product_key, p.product_id, p.product_category_name"""
CTES["mart_customer_summary"] = f"""
SELECT c.customer_unique_id,
       first(c.customer_city ORDER BY o.order_purchase_timestamp DESC, o.order_id DESC) FILTER (o.order_purchase_timestamp IS NOT NULL) AS latest_customer_city,
       first(c.customer_state ORDER BY o.order_purchase_timestamp DESC, o.order_id DESC) FILTER (o.order_purchase_timestamp IS NOT NULL) AS latest_customer_state,
       count(DISTINCT o.order_id) AS total_orders,
       sum(o.item_count) AS total_items,
       sum(o.order_total) AS lifetime_order_value,
       sum(o.payment_total) AS lifetime_payment_value,
       {avg2_dec('o.payment_total')} AS average_order_value,
       min(o.order_purchase_timestamp) AS first_order_at,
       max(o.order_purchase_timestamp) AS latest_order_at,
       sum({_LATE}) AS late_orders,
       {avg2_cents('o.average_review_score')} AS average_review_score
FROM fct_orders o
JOIN dim_customers c ON o.customer_key = c.customer_key
GROUP BY c.customer_unique_id"""
CTES["mart_delivery_quality"] = f"""
SELECT concat(d.year_month, '||', coalesce(c.customer_state, 'UNKNOWN')) AS delivery_quality_key,
       d.year_month,
       coalesce(c.customer_state, 'UNKNOWN') AS customer_state,
       count(*) AS total_orders,
       sum({_DELIVERED}) AS delivered_orders,
       sum({_LATE}) AS late_orders,
       sum(CASE WHEN o.order_status = 'delivered' AND o.is_delivered_late = false THEN 1 ELSE 0 END) AS on_time_orders,
       {pct2(f'sum({_LATE})', f'sum({_DELIVERED})')} AS late_delivery_rate_pct,
       {avg2_int("CASE WHEN o.order_status = 'delivered' THEN o.delivery_days END")} AS average_delivery_days,
       {avg2_cents('o.average_review_score')} AS average_review_score,
       sum(o.payment_total) AS total_payment_value
FROM fct_orders o
JOIN dim_date d ON o.order_date_key = d.date_key
JOIN dim_customers c ON o.customer_key = c.customer_key
GROUP BY d.year_month, coalesce(c.customer_state, 'UNKNOWN')"""


# ------------------------------------------------------------ data quality


def _check(table, name, ctype, severity, details, total, failed, allowed="0") -> str:
    details = details.replace("'", "''")
    return (
        f"SELECT '{table}' AS table_name, '{name}' AS check_name, '{ctype}' AS check_type, "
        f"'{severity}' AS severity, CAST({total} AS BIGINT) AS total_rows, CAST({failed} AS BIGINT) AS failed_rows, "
        f"CAST({allowed} AS BIGINT) AS allowed_failures, '{details}' AS details"
    )


def _key_checks(table, src, required, unique) -> list[str]:
    nulls = " OR ".join(f"{c} IS NULL" for c in required)
    keys = ", ".join(unique)
    return [
        _check(table, f"not_null: {', '.join(required)}", "not_null", "CRITICAL", "Required columns must not contain NULL.",
               f"(SELECT count(*) FROM {src})", f"(SELECT count(*) FROM {src} WHERE {nulls})"),
        _check(table, f"unique: {keys}", "uniqueness", "CRITICAL", "Business-key columns must be unique.",
               f"(SELECT count(*) FROM {src})",
               f"(SELECT count(*) FROM {src}) - (SELECT count(*) FROM (SELECT DISTINCT {keys} FROM {src}) u)"),
    ]


def _reference_check(child, parent, key, child_src, parent_src) -> str:
    return _check(child, f"foreign_key: {child} → {parent}", "referential_integrity", "CRITICAL",
                  f"Keys ['{key}'] must exist in {parent}.", f"(SELECT count(*) FROM {child_src})",
                  f"(SELECT count(*) FROM {child_src} c WHERE c.{key} IS NOT NULL AND NOT EXISTS "
                  f"(SELECT 1 FROM {parent_src} p WHERE p.{key} = c.{key}))")


def _rule_check(table, src, name, details, cond) -> str:
    return _check(table, name, "business_rule", "CRITICAL", details, f"(SELECT count(*) FROM {src})",
                  f"(SELECT count(*) FROM {src} WHERE NOT coalesce(({cond}), false))")


def _results(layer: str, checks: list[str]) -> str:
    union = "\nUNION ALL\n".join(checks)
    return f"""
SELECT '{layer}' AS layer, table_name, check_name, check_type, severity,
       CASE WHEN failed_rows <= allowed_failures THEN 'PASS' ELSE 'FAIL' END AS status,
       total_rows, failed_rows,
       CASE WHEN total_rows > 0 THEN failed_rows / total_rows ELSE 0.0 END AS failure_rate,
       details
FROM ({union}) q"""


def _quality_sql() -> str:
    parts = []
    for table, (required, unique) in KEY_CHECKS.items():
        parts += _key_checks(table, f"s_{table}", required, unique)
    parts += [_reference_check(c, p, k, f"s_{c}", f"s_{p}") for c, p, k in REFERENCES]
    parts += [_rule_check(t, f"s_{t}", name, details, cond) for t, name, details, cond in RULES]
    surplus = "((SELECT count(*) FROM reviews_raw) - (SELECT count(*) FROM (SELECT DISTINCT review_id FROM reviews_raw) u))"
    parts.append(_check("reviews_raw", "duplicate_review_ids_in_source", "source_quality", "WARNING",
                     "The source contains repeated review_id values. Silver currently retains one record per review_id.",
                     "(SELECT count(*) FROM reviews_raw)", surplus, allowed=surplus))
    return _results("silver", parts)


def _raw_quality_sql() -> str:
    return _results("bronze", [
        *_key_checks("order_items_raw", "order_items_raw", ["order_id", "seller_id"], ["order_id", "order_item_id"]),
        *_key_checks("reviews_raw", "reviews_raw", ["review_id", "review_comment_title"], ["review_id"]),
        _rule_check("reviews_raw", "reviews_raw", "valid_review_score", "Review score must be between 1 and 5.",
                    "TRY_CAST(review_score AS INTEGER) BETWEEN 1 AND 5"),
        _reference_check("orders_raw", "reviews_raw", "order_id", "orders_raw", "reviews_raw"),
    ])


CTES["dq_results"] = _quality_sql()
CTES["dq_raw_results"] = _raw_quality_sql()


def _mart_tests_sql() -> str:
    parts = []
    for model, (cols, key) in MART_KEYS.items():
        for c in cols:
            parts.append(
                f"SELECT '{model}' AS model, 'not_null' AS test_name, '{c}' AS column_name, "
                f"(SELECT count(*) FROM {model} WHERE {c} IS NULL) AS failures"
            )
        parts.append(
            f"SELECT '{model}' AS model, 'unique' AS test_name, '{key}' AS column_name, "
            f"(SELECT count(*) FROM (SELECT {key} FROM {model} WHERE {key} IS NOT NULL "
            f"GROUP BY {key} HAVING count(*) > 1) d) AS failures"
        )
    return "\nUNION ALL\n".join(parts)


CTES["mart_tests"] = _mart_tests_sql()


def _layer_counts_sql() -> str:
    raw = ["customers", "orders", "order_items", "payments", "reviews", "products", "sellers"]
    gold = ["dim_customers", "dim_products", "dim_sellers", "dim_date", "fct_orders", "fct_order_items"]
    parts = [f"SELECT 'bronze' AS layer, '{t}_raw' AS table_name, (SELECT count(*) FROM {t}_raw) AS row_count" for t in raw]
    parts += [f"SELECT 'silver', '{t}', (SELECT count(*) FROM s_{t})" for t in raw]
    parts += [f"SELECT 'gold', '{t}', (SELECT count(*) FROM {t})" for t in gold]
    return "\nUNION ALL\n".join(parts)


CTES["layer_counts"] = _layer_counts_sql()

# Profiles: (table_name, metric, value).
_TYPED = {
    "customers": ["customer_zip_code_prefix:INTEGER"],
    "orders": [
        "order_purchase_timestamp:TIMESTAMP", "order_approved_at:TIMESTAMP", "order_delivered_carrier_date:TIMESTAMP",
        "order_delivered_customer_date:TIMESTAMP", "order_estimated_delivery_date:TIMESTAMP",
    ],
    "order_items": [
        "order_item_id:INTEGER", "shipping_limit_date:TIMESTAMP", "price:DECIMAL(12,2)", "freight_value:DECIMAL(12,2)",
    ],
    "payments": ["payment_sequential:INTEGER", "payment_installments:INTEGER", "payment_value:DECIMAL(12,2)"],
    "reviews": ["review_score:INTEGER", "review_creation_date:TIMESTAMP", "review_answer_timestamp:TIMESTAMP"],
    "products": [
        f"{c}:INTEGER" for c in (
            "product_name_lenght", "product_description_lenght", "product_photos_qty", "product_weight_g",
            "product_length_cm", "product_height_cm", "product_width_cm")
    ],
    "sellers": ["seller_zip_code_prefix:INTEGER"],
}
_KEYS = {
    "customers": ["customer_id"], "orders": ["order_id"], "order_items": ["order_id", "order_item_id"],
    "payments": ["order_id", "payment_sequential"], "reviews": ["review_id"], "products": ["product_id"],
    "sellers": ["seller_id"],
}
_ORPHANS = {
    "orders": [("customers", "customer_id")],
    "order_items": [("orders", "order_id"), ("products", "product_id"), ("sellers", "seller_id")],
    "payments": [("orders", "order_id")],
    "reviews": [("orders", "order_id")],
}
_EXTRA = {
    "orders": [("negative_delivery_days", "delivery_days < 0")],
    "reviews": [("invalid_review_scores", "NOT (review_score BETWEEN 1 AND 5)")],
}


def _profile_sql(table: str) -> str:
    src = f"s_{table}"
    keys = _KEYS[table]
    lost = " + ".join(
        f"CASE WHEN {c} IS NOT NULL AND try_cast({c} AS {t}) IS NULL THEN 1 ELSE 0 END"
        for c, t in (item.split(":", 1) for item in _TYPED[table])
    )
    metrics = [
        ("raw_rows", f"(SELECT count(*) FROM {table}_raw)"),
        ("failed_casts", f"(SELECT coalesce(sum({lost}), 0) FROM {table}_raw)"),
        ("silver_rows", f"(SELECT count(*) FROM {src})"),
        ("null_keys", f"(SELECT count(*) FROM {src} WHERE {' OR '.join(k + ' IS NULL' for k in keys)})"),
        ("duplicate_keys", f"(SELECT count(*) FROM (SELECT {', '.join(keys)} FROM {src} GROUP BY ALL HAVING count(*) > 1) d)"),
    ]
    metrics += [(name, f"(SELECT count(*) FROM {src} WHERE {cond})") for name, cond in _EXTRA.get(table, [])]
    metrics += [
        (f"orphans_{parent}",
         f"(SELECT count(*) FROM {src} c WHERE NOT EXISTS (SELECT 1 FROM s_{parent} p WHERE p.{k} = c.{k}))")
        for parent, k in _ORPHANS.get(table, [])
    ]
    return "\nUNION ALL\n".join(
        f"SELECT '{table}' AS table_name, '{m}' AS metric, CAST({v} AS DOUBLE) AS value" for m, v in metrics
    )


# ------------------------------------------------------------- query SQL

SILVER_SPECS = {
    "customers": "customer_id:s customer_unique_id:s customer_zip_code_prefix:i customer_city:s customer_state:s",
    "orders": "order_id:s customer_id:s order_status:s order_purchase_timestamp:t order_approved_at:t "
              "order_delivered_carrier_date:t order_delivered_customer_date:t order_estimated_delivery_date:t "
              "delivery_days:i is_delivered_late:b purchase_date:d",
    "order_items": "order_id:s order_item_id:i product_id:s seller_id:s shipping_limit_date:t price:f "
                   "freight_value:f item_total_amount:f",
    "payments": "order_id:s payment_sequential:i payment_type:s payment_installments:i payment_value:f",
    "reviews": "review_id:s order_id:s review_score:i review_comment_title:s review_comment_message:s "
               "review_creation_date:t review_answer_timestamp:t has_comment:b",
    "products": "product_id:s product_category_name:s product_name_length:i product_description_length:i "
                "product_photos_qty:i product_weight_g:i product_length_cm:i product_height_cm:i product_width_cm:i "
                "product_volume_cm3:i",
    "sellers": "seller_id:s seller_zip_code_prefix:i seller_city:s seller_state:s",
}

GOLD_SPECS = {
    "dim_customers": "customer_key:s customer_id:s customer_unique_id:s customer_zip_code_prefix:i customer_city:s "
                     "customer_state:s",
    "dim_products": "product_key:s product_id:s product_category_name:s product_name_length:i "
                    "product_description_length:i product_photos_qty:i product_weight_g:i product_length_cm:i "
                    "product_height_cm:i product_width_cm:i product_volume_cm3:i",
    "dim_sellers": "seller_key:s seller_id:s seller_zip_code_prefix:i seller_city:s seller_state:s",
    "dim_date": "date_key:i full_date:d day_of_month:i day_of_week:i day_name:s week_of_year:i month_number:i "
                "month_name:s quarter_number:i year_number:i year_month:s is_weekend:b",
    "items_per_order": "order_id:s item_count:i distinct_product_count:i distinct_seller_count:i item_subtotal:f "
                       "freight_total:f order_total:f",
    "payments_per_order": "order_id:s payment_record_count:i payment_type_count:i payment_types:s "
                          "maximum_installments:i payment_total:f",
    "reviews_per_order": "order_id:s review_count:i average_review_score:f has_review_comment:b",
    "fct_orders": "order_key:s order_id:s customer_key:s order_date_key:i order_status:s order_purchase_timestamp:t "
                  "order_approved_at:t order_delivered_carrier_date:t order_delivered_customer_date:t "
                  "order_estimated_delivery_date:t delivery_days:i is_delivered_late:b item_count:i "
                  "distinct_product_count:i distinct_seller_count:i item_subtotal:f freight_total:f order_total:f "
                  "payment_record_count:i payment_type_count:i payment_types:s maximum_installments:i "
                  "payment_total:f review_count:i average_review_score:f has_review_comment:b order_count:i "
                  "payment_difference:f",
    "fct_order_items": "order_item_key:s order_id:s order_item_id:i customer_key:s product_key:s seller_key:s "
                       "order_date_key:i order_status:s shipping_limit_date:t item_price:f freight_value:f "
                       "item_total_amount:f delivery_days:i is_delivered_late:b item_quantity:i",
    "mart_daily_sales": "date_key:i full_date:d year_number:i quarter_number:i month_number:i month_name:s "
                        "year_month:s total_orders:i delivered_orders:i total_items:i item_subtotal:f "
                        "freight_total:f order_total:f payment_total:f average_order_value:f late_orders:i "
                        "late_delivery_rate_pct:f average_review_score:f",
    "mart_product_performance": "product_key:s product_id:s product_category_name:s total_orders:i units_sold:i "
                                "item_revenue:f freight_total:f gross_sales:f average_item_price:f "
                                "average_delivery_days:f late_items:i",
    "mart_customer_summary": "customer_unique_id:s latest_customer_city:s latest_customer_state:s total_orders:i "
                             "total_items:i lifetime_order_value:f lifetime_payment_value:f average_order_value:f "
                             "first_order_at:t latest_order_at:t late_orders:i average_review_score:f",
    "mart_delivery_quality": "delivery_quality_key:s year_month:s customer_state:s total_orders:i "
                             "delivered_orders:i late_orders:i on_time_orders:i late_delivery_rate_pct:f "
                             "average_delivery_days:f average_review_score:f total_payment_value:f",
}

ORPHAN_QUERIES = {
    "orphans_orders_customers": ("orders", "customers", "customer_id"),
    "orphans_order_items_orders": ("order_items", "orders", "order_id"),
    "orphans_payments_orders": ("payments", "orders", "order_id"),
    "orphans_reviews_orders": ("reviews", "orders", "order_id"),
    "orphans_order_items_products": ("order_items", "products", "product_id"),
    "orphans_order_items_sellers": ("order_items", "sellers", "seller_id"),
    "orders_without_items": ("orders", "order_items", "order_id"),
    "orders_without_reviews": ("orders", "reviews", "order_id"),
    "customers_without_orders": ("customers", "orders", "customer_id"),
    "products_without_items": ("products", "order_items", "product_id"),
}


# The sources' file names and the facts' keys.
_FILES = {
    "customers": "olist_customers_dataset.csv", "orders": "olist_orders_dataset.csv",
    "order_items": "olist_order_items_dataset.csv", "payments": "olist_order_payments_dataset.csv",
    "reviews": "olist_order_reviews_dataset.csv", "products": "olist_products_dataset.csv",
    "sellers": "olist_sellers_dataset.csv",
}
_FACTS = {
    "fct_orders": ("orders", ["order_id"], ["order_key", "customer_key", "order_date_key"]),
    "fct_order_items": (
        "order_items", ["order_id", "order_item_id"],
        ["order_item_key", "customer_key", "product_key", "seller_key", "order_date_key"],
    ),
}


# The raw tables' columns.
_RAW = {
    "customers": ["customer_id", "customer_unique_id", "customer_zip_code_prefix", "customer_city", "customer_state"],
    "orders": [
        "order_id", "customer_id", "order_status", "order_purchase_timestamp", "order_approved_at",
        "order_delivered_carrier_date", "order_delivered_customer_date", "order_estimated_delivery_date",
    ],
    "order_items": [
        "order_id", "order_item_id", "product_id", "seller_id", "shipping_limit_date", "price", "freight_value",
    ],
    "payments": ["order_id", "payment_sequential", "payment_type", "payment_installments", "payment_value"],
    "reviews": [
        "review_id", "order_id", "review_score", "review_comment_title", "review_comment_message",
        "review_creation_date", "review_answer_timestamp",
    ],
    "products": [
        "product_id", "product_category_name", "product_name_lenght", "product_description_lenght",
        "product_photos_qty", "product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm",
    ],
    "sellers": ["seller_id", "seller_zip_code_prefix", "seller_city", "seller_state"],
}


def _reconciliation_sql(fact: str, source: str) -> str:
    table, natural, keys = _FACTS[fact]
    key = " || '|' || ".join(f"coalesce(CAST({c} AS VARCHAR), '')" for c in natural)
    number = f"sum(CAST(('0x' || substr(md5({key}), 1, 15)) AS HUGEINT))"
    nulls = " || ', ' || ".join(f"'{k}=' || CAST(count(*) FILTER ({k} IS NULL) AS VARCHAR)" for k in keys)
    any_null = " OR ".join(f"{k} IS NULL" for k in keys)
    return (
        f"SELECT '{fact}' AS fact_name, CAST(n AS DOUBLE) AS source_rows, CAST(f AS DOUBLE) AS fact_rows, "
        "CAST(a AS VARCHAR) AS source_checksum, CAST(b AS VARCHAR) AS fact_checksum, "
        "CAST(bad AS DOUBLE) AS null_key_rows, nulls_by_key, "
        "CASE WHEN n = f AND a = b AND bad = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM "
        f"(SELECT count(*) AS n, coalesce({number}, 0) AS a FROM {source.format(table)}), "
        f"(SELECT count(*) AS f, coalesce({number}, 0) AS b, count(*) FILTER ({any_null}) AS bad, "
        f"{nulls} AS nulls_by_key FROM {fact})"
    )


def _bodies() -> dict[str, str]:
    q: dict[str, str] = {}
    for t, spec in SILVER_SPECS.items():
        q[f"silver_{t}"] = typed(f"s_{t}", spec)
    q["dedup_items"] = (
        "SELECT CAST(order_id AS VARCHAR) AS order_id, CAST(order_item_id AS DOUBLE) AS order_item_id, "
        "CAST(count(*) AS DOUBLE) AS row_count FROM f_order_items GROUP BY order_id, order_item_id HAVING count(*) > 1"
    )
    q["dedup_reviews"] = (
        "SELECT CAST(review_id AS VARCHAR) AS review_id, CAST(count(*) AS DOUBLE) AS row_count FROM c_reviews "
        "WHERE review_id IS NOT NULL AND order_id IS NOT NULL AND review_score BETWEEN 1 AND 5 "
        "GROUP BY review_id HAVING count(*) > 1"
    )
    for name, (child, parent, key) in ORPHAN_QUERIES.items():
        q[name] = typed(
            f"s_{child} c", SILVER_SPECS[child],
            where=f"NOT EXISTS (SELECT 1 FROM s_{parent} p WHERE p.{key} = c.{key})",
        )
    for t in SILVER_SPECS:
        q[f"profile_{t}"] = _profile_sql(t)
    for name, spec in GOLD_SPECS.items():
        q[name] = typed(name, spec)
    for name in ("fct_orders", "fct_order_items"):
        q[f"{name}_gated"] = q[name]
    q["gold_order_count"] = "SELECT CAST(count(*) AS DOUBLE) AS order_count FROM fct_orders"
    q["tile_total_orders"] = "SELECT CAST(sum(total_orders) AS DOUBLE) AS total_orders FROM mart_daily_sales"
    q["tile_delivered_orders"] = "SELECT CAST(sum(delivered_orders) AS DOUBLE) AS delivered_orders FROM mart_daily_sales"
    q["tile_total_revenue"] = "SELECT CAST(sum(payment_total) AS DOUBLE) AS total_revenue FROM mart_daily_sales"
    q["tile_monthly_orders"] = (
        "SELECT year_month, CAST(sum(total_orders) AS DOUBLE) AS total_orders FROM mart_daily_sales GROUP BY year_month"
    )
    q["tile_monthly_revenue"] = (
        "SELECT year_month, CAST(sum(payment_total) AS DOUBLE) AS revenue FROM mart_daily_sales GROUP BY year_month"
    )
    q["tile_top_categories_revenue"] = (
        "SELECT product_category_name, CAST(sum(item_revenue) AS DOUBLE) AS revenue FROM mart_product_performance "
        "GROUP BY product_category_name ORDER BY sum(item_revenue) DESC, product_category_name ASC LIMIT 10"
    )
    q["tile_top_categories_units"] = (
        "SELECT product_category_name, CAST(sum(units_sold) AS DOUBLE) AS units_sold FROM mart_product_performance "
        "GROUP BY product_category_name ORDER BY sum(units_sold) DESC, product_category_name ASC LIMIT 10"
    )
    q["tile_average_delivery_days"] = (
        f"SELECT CAST({avg2_int('delivery_days')} AS DOUBLE) AS average_delivery_days FROM fct_orders "
        "WHERE order_status = 'delivered'"
    )
    q["tile_late_orders"] = "SELECT CAST(sum(late_orders) AS DOUBLE) AS late_orders FROM mart_delivery_quality"
    q["tile_late_orders_trend"] = (
        "SELECT year_month, CAST(sum(late_orders) AS DOUBLE) AS late_orders, "
        "CAST(sum(delivered_orders) AS DOUBLE) AS delivered_orders, "
        f"CAST({pct2('sum(late_orders)', 'sum(delivered_orders)')} AS DOUBLE) AS late_delivery_rate_pct "
        "FROM mart_delivery_quality GROUP BY year_month"
    )
    results = (
        "layer:s table_name:s check_name:s check_type:s severity:s status:s total_rows:i failed_rows:i "
        "failure_rate:f details:s"
    )
    q["dq_results"] = typed("dq_results", results)
    q["dq_raw_results"] = typed("dq_raw_results", results)
    q["dq_raw_critical_failures"] = typed(
        "dq_raw_results", results, where="severity = 'CRITICAL' AND status = 'FAIL'"
    )
    # of two recorded runs, the raw tables' and silver's, the latter is the latest
    q["dq_history"] = typed("dq_results", results) + " UNION ALL " + typed("dq_raw_results", results)
    q["dq_summary"] = (
        "SELECT severity, status, CAST(count(*) AS DOUBLE) AS check_count, CAST(sum(failed_rows) AS DOUBLE) AS failed_rows "
        "FROM dq_results GROUP BY severity, status"
    )
    q["dq_failures"] = typed(
        "dq_results", "table_name:s check_name:s severity:s failed_rows:i failure_rate:f details:s",
        where="status = 'FAIL'",
    )
    for name, source in (("dq_gate", "dq_raw_results"), ("dq_gate_silver", "dq_results")):
        q[name] = (
            "SELECT CASE WHEN count(*) = 0 THEN 'PASS' ELSE 'FAIL' END AS verdict, "
            "CAST(count(*) AS DOUBLE) AS critical_failures, "
            "string_agg(line, '; ' ORDER BY line) AS error FROM ("
            "SELECT table_name || ': ' || check_name || ' (' || CAST(CAST(failed_rows AS BIGINT) AS VARCHAR) || ' rows)' AS line "
            f"FROM {source} WHERE severity = 'CRITICAL' AND status = 'FAIL')"
        )
    q["ingestion_summary"] = " UNION ALL ".join(
        f"SELECT '{t}' AS dataset_name, '{_FILES[t]}' AS source_file, '{t}_raw' AS table_name, "
        f"CAST(count(*) AS DOUBLE) AS row_count, CAST({len(_RAW[t]) + 3} AS DOUBLE) AS column_count, "
        f"'success' AS status FROM {t}_raw" for t in SILVER_SPECS
    )
    for t, spec in SILVER_SPECS.items():
        q[f"staged_silver_{t}"] = typed(f"s_{t}", spec)
        first = _RAW[t][0]
        columns = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in _RAW[t])
        q[f"bronze_{t}"] = (
            f"SELECT {columns}, CASE WHEN substr(md5(coalesce(CAST({first} AS VARCHAR), '')), 1, 1) >= '8' THEN '2' END "
            f"AS feed_version FROM {t}_raw"
        )
    for name, prefix in (("fact_reconciliation", "s_{}"), ("fact_reconciliation_raw", "{}_raw")):
        q[name] = " UNION ALL ".join(_reconciliation_sql(fact, prefix) for fact in _FACTS)
    q["mart_tests"] = (
        "SELECT model, test_name, column_name, CAST(failures AS DOUBLE) AS failures, "
        "CASE WHEN failures = 0 THEN 'pass' ELSE 'fail' END AS status FROM mart_tests"
    )
    q["layer_counts"] = "SELECT layer, table_name, CAST(row_count AS DOUBLE) AS row_count FROM layer_counts"
    q["tax_projection"] = (
        "SELECT order_id, order_status, CAST(order_total AS DOUBLE) AS total_amount, "
        "CAST(round(order_total * 0.15, 2) AS DOUBLE) AS tax_amount, "
        "CAST(round(order_total + round(order_total * 0.15, 2), 2) AS DOUBLE) AS amount_with_tax "
        "FROM fct_orders WHERE order_status = 'delivered'"
    )
    return q


def _digit(*columns: str) -> str:
    text = " || '|' || ".join(f"CAST({c} AS VARCHAR)" for c in columns)
    return f"substr(md5({text}), 1, 1)"


def _seeded() -> dict[str, str]:
    """The raw tables with planted defects."""
    changes = {
        "customers": f"* REPLACE (CASE WHEN {_digit('customer_id')} = '0' THEN '   ' ELSE customer_id END AS customer_id)",
        "sellers": f"* REPLACE (CASE WHEN {_digit('seller_id')} = '5' THEN '   ' ELSE seller_id END AS seller_id)",
        "orders": (
            f"* REPLACE (CASE WHEN {_digit('order_id')} = '1' AND order_delivered_customer_date IS NOT NULL "
            "THEN '1990-01-01 00:00:00' ELSE order_delivered_customer_date END AS order_delivered_customer_date)"
        ),
        "order_items": (
            f"* REPLACE (CASE WHEN {_digit('order_id', 'order_item_id')} = '2' THEN '-5.00' ELSE price END AS price)"
        ),
        "products": f"* REPLACE (product_category_name || ' ' || {_digit('product_id')} AS product_category_name)",
    }
    where = {"products": f" WHERE {_digit('product_id')} <> '3'"}
    return {
        f"{t}_raw": f"SELECT {change} FROM ({CTES[f'{t}_raw']}) raw_{t[:4]}{where.get(t, '')}"
        for t, change in changes.items()
    }


def _defective() -> dict[str, str]:
    """The marts with repeated and missing keys and values."""
    out = {}
    for mart, (not_null, key) in MART_KEYS.items():
        nulls = ", ".join(
            f"CASE WHEN digit <> '{2 if c == key else 1}' THEN {c} END AS {c}" for c in not_null
        )
        out[mart] = (
            f"SELECT * EXCLUDE (digit, copy_no) REPLACE ({nulls}) FROM (SELECT *, {_digit(key)} AS digit, "
            f"unnest(CASE WHEN {_digit(key)} = '0' THEN [1, 2] ELSE [1] END) AS copy_no FROM ({CTES[mart]}) m)"
        )
    return out


_RULES_OF = {
    # table: (keys, not null, not blank, not negative, in range)
    "customers": (["customer_id"], ["customer_id"], ["customer_id"], [], []),
    "orders": (["order_id"], ["order_id"], ["order_id"], [], []),
    "order_items": (
        ["order_id", "order_item_id"], ["order_id", "order_item_id", "product_id", "seller_id"], [],
        ["price", "freight_value"], [],
    ),
    "payments": (
        ["order_id", "payment_sequential"], ["order_id", "payment_sequential"], [], ["payment_value"], [],
    ),
    "reviews": (["review_id"], ["review_id", "order_id"], [], [], [("review_score", 1, 5)]),
    "products": (["product_id"], ["product_id"], [], [], []),
    "sellers": (["seller_id"], ["seller_id"], ["seller_id"], [], []),
}


def _rejections_sql(table: str) -> str:
    keys, not_null, not_blank, not_negative, ranges = _RULES_OF[table]
    broken = {f"null_{c}": f"{c} IS NULL" for c in not_null}
    broken |= {f"blank_{c}": f"length({c}) = 0" for c in not_blank}
    broken |= {f"negative_{c}": f"({c} < 0 OR {c} IS NULL)" for c in not_negative}
    broken |= {f"out_of_range_{c}": f"({c} NOT BETWEEN {lo} AND {hi} OR {c} IS NULL)" for c, lo, hi in ranges}
    bad = " OR ".join(f"coalesce({c}, false)" for c in broken.values())
    groups = f"(SELECT count(*) AS n FROM c_{table} WHERE NOT ({bad}) GROUP BY {', '.join(keys)} HAVING count(*) > 1)"
    metrics = {name: f"(SELECT count(*) FROM c_{table} WHERE {c})" for name, c in broken.items()} | {
        "rejected_rows": f"(SELECT count(*) FROM c_{table} WHERE {bad})",
        "repeated_keys": f"(SELECT count(*) FROM {groups} g)",
        "surplus_rows": f"(SELECT coalesce(sum(n - 1), 0) FROM {groups} g)",
    }
    return "\nUNION ALL\n".join(
        f"SELECT '{table}' AS table_name, '{m}' AS metric, CAST({v} AS DOUBLE) AS value" for m, v in metrics.items()
    )


def _seeded_bodies() -> dict[str, tuple[str, dict[str, str]]]:
    """Query SQL with the CTEs it puts in the place of others."""
    own, seeds = _bodies(), _seeded()
    every = "\nUNION ALL\n".join(_rejections_sql(t) for t in SILVER_SPECS)
    q = {"rejections": (every, {}), "seeded_rejections": (every, seeds)}
    q["seeded_dq_results"] = (own["dq_results"], seeds)
    q["seeded_dq_gate"] = (own["dq_gate_silver"], seeds)
    q["seeded_profiles"] = ("\nUNION ALL\n".join(_profile_sql(t) for t in SILVER_SPECS), seeds)
    for name in ("orphans_orders_customers", "orphans_order_items_products", "orphans_order_items_sellers",
                 "fct_orders", "fct_order_items"):
        q[f"seeded_{name}"] = (own[name], seeds)
    for by in ("revenue", "units"):
        q[f"seeded_top_categories_{by}"] = (own[f"tile_top_categories_{by}"], seeds)
    q["defective_mart_tests"] = (own["mart_tests"], _defective())
    return q


def _with_ctes(body: str, instead: dict[str, str] | None = None) -> str:
    """Prefix the CTEs the body needs, in dependency order; ``instead`` has
    CTEs that take the place of others of their name."""
    ctes = CTES | (instead or {})
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in ctes:
            if name not in needed and re.search(rf"\b{re.escape(name)}\b", text):
                visit(ctes[name])
                if name not in needed:
                    needed.append(name)

    visit(body)
    if not needed:
        return body
    text = ",\n".join(f"{n} AS ({ctes[n].strip()})" for n in needed)
    return f"WITH {text}\n{body}"


def oracle_queries() -> dict[str, str]:
    found = {name: _with_ctes(body) for name, body in _bodies().items()}
    return found | {name: _with_ctes(body, instead) for name, (body, instead) in _seeded_bodies().items()}
