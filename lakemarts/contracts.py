"""Declarative table contracts for the bronze → silver cleansing step.

A contract lists, per silver table, which raw column feeds which typed
column and how it is cleaned, which rows are rejected, the business key, and
how the surviving row of a duplicated key is chosen.  ``operators.cleanse``
turns a contract into one DataFrame plan; nothing here touches data.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from lakemarts.functions import (
    INT,
    LOWER,
    MONEY,
    TIMESTAMP,
    TRIM,
    UPPER,
    delivery_days,
    has_comment,
    is_delivered_late,
    item_total_amount,
    product_volume,
    purchase_date,
)



@dataclass(frozen=True)
class Col:
    source: str
    target: str
    rule: str


@dataclass(frozen=True)
class TableContract:
    name: str                      # silver table name
    raw: str                       # bronze table name
    columns: tuple[Col, ...]
    key: tuple[str, ...]           # business key (deduplicated on)
    not_null: tuple[str, ...] = ()
    non_blank: tuple[str, ...] = ()      # length(x) > 0 after trim
    non_negative: tuple[str, ...] = ()   # x >= 0; NULL fails
    ranges: tuple[tuple[str, int, int], ...] = ()  # between; NULL fails
    # Survivor preference for duplicated keys: (column, "asc"|"desc").  All
    # remaining non-key columns follow ascending, so the survivor is fixed.
    prefer: tuple[tuple[str, str], ...] = ()
    # Whether quoted fields of the source may hold line ends.
    multiline: bool = False
    # Derived columns added after deduplication: name -> builder of a Column.
    derived: tuple[tuple[str, Callable], ...] = field(default=())

    @property
    def targets(self) -> tuple[str, ...]:
        return tuple(c.target for c in self.columns)

    def survivor_order(self) -> list[tuple[str, str]]:
        chosen = [c for c, _ in self.prefer]
        rest = [t for t in self.targets if t not in self.key and t not in chosen]
        return list(self.prefer) + [(c, "asc") for c in rest]


# ---------------------------------------------------------------------------
# The raw column names (including the source's own spelling
# "lenght"), silver names, cleaning rules, row filters and business keys of
# the seven retail datasets.  They must equal the source layout.
# ---------------------------------------------------------------------------
CUSTOMERS = TableContract(
    name="customers",
    raw="customers_raw",
    columns=(
        Col("customer_id", "customer_id", TRIM),
        Col("customer_unique_id", "customer_unique_id", TRIM),
        Col("customer_zip_code_prefix", "customer_zip_code_prefix", INT),
        Col("customer_city", "customer_city", LOWER),
        Col("customer_state", "customer_state", UPPER),
    ),
    key=("customer_id",),
    not_null=("customer_id",),
    non_blank=("customer_id",),
)

ORDERS = TableContract(
    name="orders",
    raw="orders_raw",
    columns=(
        Col("order_id", "order_id", TRIM),
        Col("customer_id", "customer_id", TRIM),
        Col("order_status", "order_status", LOWER),
        Col("order_purchase_timestamp", "order_purchase_timestamp", TIMESTAMP),
        Col("order_approved_at", "order_approved_at", TIMESTAMP),
        Col("order_delivered_carrier_date", "order_delivered_carrier_date", TIMESTAMP),
        Col("order_delivered_customer_date", "order_delivered_customer_date", TIMESTAMP),
        Col("order_estimated_delivery_date", "order_estimated_delivery_date", TIMESTAMP),
    ),
    key=("order_id",),
    not_null=("order_id",),
    non_blank=("order_id",),
    derived=(
        ("delivery_days", delivery_days),
        ("is_delivered_late", is_delivered_late),
        ("purchase_date", purchase_date),
    ),
)

ORDER_ITEMS = TableContract(
    name="order_items",
    raw="order_items_raw",
    columns=(
        Col("order_id", "order_id", TRIM),
        Col("order_item_id", "order_item_id", INT),
        Col("product_id", "product_id", TRIM),
        Col("seller_id", "seller_id", TRIM),
        Col("shipping_limit_date", "shipping_limit_date", TIMESTAMP),
        Col("price", "price", MONEY),
        Col("freight_value", "freight_value", MONEY),
    ),
    key=("order_id", "order_item_id"),
    not_null=("order_id", "order_item_id", "product_id", "seller_id"),
    non_negative=("price", "freight_value"),
    derived=(("item_total_amount", item_total_amount),),
)

PAYMENTS = TableContract(
    name="payments",
    raw="payments_raw",
    columns=(
        Col("order_id", "order_id", TRIM),
        Col("payment_sequential", "payment_sequential", INT),
        Col("payment_type", "payment_type", LOWER),
        Col("payment_installments", "payment_installments", INT),
        Col("payment_value", "payment_value", MONEY),
    ),
    key=("order_id", "payment_sequential"),
    not_null=("order_id", "payment_sequential"),
    non_negative=("payment_value",),
)

REVIEWS = TableContract(
    name="reviews",
    raw="reviews_raw",
    multiline=True,  # free text
    columns=(
        Col("review_id", "review_id", TRIM),
        Col("order_id", "order_id", TRIM),
        Col("review_score", "review_score", INT),
        Col("review_comment_title", "review_comment_title", TRIM),
        Col("review_comment_message", "review_comment_message", TRIM),
        Col("review_creation_date", "review_creation_date", TIMESTAMP),
        Col("review_answer_timestamp", "review_answer_timestamp", TIMESTAMP),
    ),
    key=("review_id",),
    not_null=("review_id", "order_id"),
    ranges=(("review_score", 1, 5),),
    # A review id repeated over orders keeps its latest version.
    prefer=(
        ("review_creation_date", "desc"),
        ("review_answer_timestamp", "desc"),
        ("order_id", "asc"),
    ),
    derived=(("has_comment", has_comment),),
)

PRODUCTS = TableContract(
    name="products",
    raw="products_raw",
    columns=(
        Col("product_id", "product_id", TRIM),
        Col("product_category_name", "product_category_name", LOWER),
        Col("product_name_lenght", "product_name_length", INT),
        Col("product_description_lenght", "product_description_length", INT),
        Col("product_photos_qty", "product_photos_qty", INT),
        Col("product_weight_g", "product_weight_g", INT),
        Col("product_length_cm", "product_length_cm", INT),
        Col("product_height_cm", "product_height_cm", INT),
        Col("product_width_cm", "product_width_cm", INT),
    ),
    key=("product_id",),
    not_null=("product_id",),
    derived=(("product_volume_cm3", product_volume),),
)

SELLERS = TableContract(
    name="sellers",
    raw="sellers_raw",
    columns=(
        Col("seller_id", "seller_id", TRIM),
        Col("seller_zip_code_prefix", "seller_zip_code_prefix", INT),
        Col("seller_city", "seller_city", LOWER),
        Col("seller_state", "seller_state", UPPER),
    ),
    key=("seller_id",),
    not_null=("seller_id",),
    non_blank=("seller_id",),
)

CONTRACTS: dict[str, TableContract] = {
    c.name: c for c in (CUSTOMERS, ORDERS, ORDER_ITEMS, PAYMENTS, REVIEWS, PRODUCTS, SELLERS)
}

# Dataset name -> source file, in the source's own naming.
SOURCE_FILES: dict[str, str] = {
    "customers": "olist_customers_dataset.csv",
    "orders": "olist_orders_dataset.csv",
    "order_items": "olist_order_items_dataset.csv",
    "payments": "olist_order_payments_dataset.csv",
    "reviews": "olist_order_reviews_dataset.csv",
    "products": "olist_products_dataset.csv",
    "sellers": "olist_sellers_dataset.csv",
}
