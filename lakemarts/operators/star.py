"""Gold star schema: four dimensions and two facts.

Surrogate keys are ``sha2(natural key)``, a pure function of columns the
facts already carry.  A fact therefore never needs the key column *from* the
dimension: the dimension join only decides which fact rows survive, so it is
written as a left-semi join on the natural key and the key is recomputed
locally, and the rows of a fact (``order_rows``, ``order_item_rows``) carry
natural ids until ``with_keys`` derives its keys.  Because silver guarantees key-unique dimensions (the quality gate
checks it before gold runs), this is the same result as the inner join, but
the join ships one id column instead of id plus a 64-character key.

The fact joins are shaped around the largest table, whose keys may be skewed:

* the item rows are shuffled once, by order, for the join with their order;
* whether products, sellers and customers exist is asked of the *distinct*
  child keys, which partial aggregation reduces map-side; the few that are
  missing are then anti-joined by broadcast (see ``with_parent``), so neither
  items nor orders are ever shuffled by a product, seller or customer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakemarts.functions import date_key, surrogate_key
from lakemarts.session import ensure_checkpoint_dir

#: Missing keys up to which they are broadcast; beyond, the parents are joined.
MISSING_LIMIT = 100_000
#: What a sum of money columns has, however many levels it is summed in.
MONEY_SUM = "decimal(22,2)"


def _zero_money():
    return F.lit(0).cast("decimal(18,2)")


def _stamp(df: DataFrame) -> DataFrame:
    return df.withColumn("_gold_processed_at", F.current_timestamp())


# The output columns of the dimensions and facts below, their
# names and order included.

# ------------------------------------------------------------------ dims


def dim_customers(customers: DataFrame) -> DataFrame:
    return _stamp(
        customers.select(
            surrogate_key("customer_id").alias("customer_key"),
            "customer_id",
            "customer_unique_id",
            "customer_zip_code_prefix",
            "customer_city",
            "customer_state",
        )
    )


def dim_products(products: DataFrame) -> DataFrame:
    return _stamp(
        products.select(
            surrogate_key("product_id").alias("product_key"),
            "product_id",
            F.coalesce(F.col("product_category_name"), F.lit("unknown")).alias("product_category_name"),
            "product_name_length",
            "product_description_length",
            "product_photos_qty",
            "product_weight_g",
            "product_length_cm",
            "product_height_cm",
            "product_width_cm",
            "product_volume_cm3",
        )
    )


def dim_sellers(sellers: DataFrame) -> DataFrame:
    return _stamp(
        sellers.select(
            surrogate_key("seller_id").alias("seller_key"),
            "seller_id",
            "seller_zip_code_prefix",
            "seller_city",
            "seller_state",
        )
    )


def dim_date(orders: DataFrame) -> DataFrame:
    """One row per *observed* purchase date (gaps are not filled), so its
    size is bounded by the days that occur, whatever the order volume."""
    d = F.col("full_date")
    dates = orders.select(F.col("purchase_date").alias("full_date")).where(d.isNotNull()).distinct()
    return _stamp(
        dates.select(
            date_key(d).alias("date_key"),
            d,
            F.dayofmonth(d).alias("day_of_month"),
            F.dayofweek(d).alias("day_of_week"),
            F.date_format(d, "EEEE").alias("day_name"),
            F.weekofyear(d).alias("week_of_year"),
            F.month(d).alias("month_number"),
            F.date_format(d, "MMMM").alias("month_name"),
            F.quarter(d).alias("quarter_number"),
            F.year(d).alias("year_number"),
            F.date_format(d, "yyyy-MM").alias("year_month"),
            F.dayofweek(d).isin(1, 7).alias("is_weekend"),
        )
    )


# ------------------------------------------------------------ order facts

# The natural ids that a fact's rows carry in place of its
# surrogate keys, and the key columns with what they are digests of, each
# before the column it precedes in the fact.
FACT_IDS = {
    "fct_orders": ("customer_id",),
    "fct_order_items": ("customer_id", "product_id", "seller_id"),
}
FACT_KEYS = {
    "fct_orders": {"order_id": (("order_key", "order_id"),),
                   "order_date_key": (("customer_key", "customer_id"),)},
    "fct_order_items": {"order_id": (("order_item_key", "order_id", "order_item_id"),),
                        "order_date_key": (("customer_key", "customer_id"), ("product_key", "product_id"),
                                           ("seller_key", "seller_id"))},
}


def with_keys(rows: DataFrame, fact: str, ids: bool = False) -> DataFrame:
    """The fact from its rows by natural ids: digests are recomputed, as they
    are far larger than what they are digests of.  With ``ids`` the natural
    ids follow, by which a reader can group narrower rows than by digests."""
    columns = []
    for c in rows.columns:
        if c not in FACT_IDS[fact]:
            columns += [surrogate_key(*parts).alias(key) for key, *parts in FACT_KEYS[fact].get(c, ())] + [F.col(c)]
    return rows.select(*columns, *(FACT_IDS[fact] if ids else ()))


def with_parent(rows: DataFrame, parent: DataFrame, key: str, limit: int = MISSING_LIMIT) -> DataFrame:
    """The rows whose ``key`` is in ``parent``: a left semi join that does not
    shuffle the rows.  The distinct keys of the rows are joined instead, and
    those without a parent are kept (checkpointed).  As they are counted
    before they are broadcast, their size is known; more than ``limit`` of
    them fall back to the plain semi join."""
    ensure_checkpoint_dir(rows.sparkSession)
    present = F.col(key).isNotNull()
    keys = rows.select(key).where(present).distinct()
    missing = keys.join(parent.select(key), key, "left_anti").checkpoint()
    n = missing.limit(limit + 1).count()
    if n > limit:
        return rows.join(parent.select(key), key, "left_semi")
    rows = rows.where(present)
    return rows.join(F.broadcast(missing), key, "left_anti") if n else rows


def orders_with_customer(orders: DataFrame, dim_customers_df: DataFrame | None) -> DataFrame:
    """Orders whose customer exists in the dimension (the facts' inner join).

    ``None`` means referential integrity is already proven (the quality gate
    passed its NOT NULL and foreign-key checks), so the join would drop
    nothing and is skipped."""
    if dim_customers_df is None:
        return orders
    return with_parent(orders, dim_customers_df, "customer_id")


def order_context(orders: DataFrame) -> DataFrame:
    """The order columns carried onto every item."""
    return orders.select(
        "order_id",
        "customer_id",
        "purchase_date",
        "order_status",
        "order_purchase_timestamp",
        "delivery_days",
        "is_delivered_late",
    )


def order_item_rows(
    order_items: DataFrame,
    orders: DataFrame,
    dim_customers_df: DataFrame | None,
    dim_products_df: DataFrame | None,
    dim_sellers_df: DataFrame | None,
) -> DataFrame:
    """G06 by natural ids: one row per (order, item) with matching order,
    customer, product and seller.  A ``None`` dimension is one whose foreign key the quality
    gate has already proven, so it is not asked.  Either way the item rows are
    shuffled once, for the join with their order."""
    context = order_context(orders_with_customer(orders, dim_customers_df)).drop("order_purchase_timestamp")
    items = order_items
    if dim_products_df is not None:
        items = with_parent(items, dim_products_df, "product_id")
    if dim_sellers_df is not None:
        items = with_parent(items, dim_sellers_df, "seller_id")
    items = items.join(context, "order_id", "inner")
    return _stamp(
        items.select(
            "order_id",
            "order_item_id",
            *FACT_IDS["fct_order_items"],
            date_key("purchase_date").alias("order_date_key"),
            "order_status",
            "shipping_limit_date",
            F.col("price").alias("item_price"),
            "freight_value",
            "item_total_amount",
            "delivery_days",
            "is_delivered_late",
            F.lit(1).alias("item_quantity"),
        )
    )


def fct_order_items(
    order_items: DataFrame,
    orders: DataFrame,
    dim_customers_df: DataFrame | None,
    dim_products_df: DataFrame | None,
    dim_sellers_df: DataFrame | None,
) -> DataFrame:
    """G06 with its surrogate keys."""
    return with_keys(
        order_item_rows(order_items, orders, dim_customers_df, dim_products_df, dim_sellers_df), "fct_order_items")


def items_per_order(order_items: DataFrame) -> DataFrame:
    """G07.  The items are shuffled once, by order; the first row of each
    (order, product) and (order, seller) is then marked in place, so that
    distinct counts neither multiply rows nor shuffle them by finer keys.
    Both windows and the grouping stream over sorted rows or spill; an order
    is the work of one task.  Items without an order_id, which silver does
    not have, belong to no order."""
    items = order_items.where(F.col("order_id").isNotNull()).select(
        "order_id", "product_id", "seller_id", "price", "freight_value", "item_total_amount"
    ).repartition("order_id")

    def first(column: str):
        w = Window.partitionBy("order_id", column).orderBy(column)
        return F.when(F.col(column).isNotNull() & (F.row_number().over(w) == 1), 1)

    return items.withColumn("new_product", first("product_id")).withColumn("new_seller", first("seller_id")).groupBy(
        "order_id"
    ).agg(
        F.count(F.lit(1)).alias("item_count"),
        F.count("new_product").alias("distinct_product_count"),
        F.count("new_seller").alias("distinct_seller_count"),
        F.sum("price").cast(MONEY_SUM).alias("item_subtotal"),
        F.sum("freight_value").cast(MONEY_SUM).alias("freight_total"),
        F.sum("item_total_amount").cast(MONEY_SUM).alias("order_total"),
    )


def payments_per_order(payments: DataFrame) -> DataFrame:
    """G08, in two levels behind one shuffle by order: payments are reduced to
    one row per (order, type) before the sorted list of an order's types is
    built."""
    per_type = payments.select(
        "order_id", "payment_type", "payment_installments", "payment_value"
    ).repartition("order_id").groupBy("order_id", "payment_type").agg(
        F.count(F.lit(1)).alias("n"),
        F.max("payment_installments").alias("installments"),
        F.sum("payment_value").alias("value"),
    )
    return per_type.groupBy("order_id").agg(
        F.sum("n").alias("payment_record_count"),
        F.count("payment_type").alias("payment_type_count"),
        F.concat_ws(", ", F.sort_array(F.collect_list("payment_type"))).alias("payment_types"),
        F.max("installments").alias("maximum_installments"),
        F.sum("value").cast(MONEY_SUM).alias("payment_total"),
    )


def reviews_per_order(reviews: DataFrame) -> DataFrame:
    """G09.  ``bool_or`` is the max of the 0/1 cast: NULL only when every
    input is NULL.  Silver reviews are unique by review_id, so the distinct
    review count is a plain count (no distinct-aggregation stage)."""
    return reviews.groupBy("order_id").agg(
        F.count("review_id").alias("review_count"),
        F.round(F.avg("review_score"), 2).alias("average_review_score"),
        F.bool_or("has_comment").alias("has_review_comment"),
    )


def order_rows(
    orders: DataFrame,
    dim_customers_df: DataFrame | None,
    items_agg: DataFrame,
    payments_agg: DataFrame,
    reviews_agg: DataFrame,
) -> DataFrame:
    """G10 by natural ids: one row per order with a known customer.

    The three per-order aggregates are all hash-partitioned on ``order_id``,
    so the left joins reuse that partitioning: the orders side is exchanged
    once, by order, and the aggregates are not exchanged again.
    """
    joined = (
        orders_with_customer(orders, dim_customers_df)
        .join(items_agg, "order_id", "left")
        .join(payments_agg, "order_id", "left")
        .join(reviews_agg, "order_id", "left")
    )
    zero = F.lit(0)
    zero_money = _zero_money()
    fact = joined.select(
        "order_id",
        *FACT_IDS["fct_orders"],
        date_key("purchase_date").alias("order_date_key"),
        "order_status",
        "order_purchase_timestamp",
        "order_approved_at",
        "order_delivered_carrier_date",
        "order_delivered_customer_date",
        "order_estimated_delivery_date",
        "delivery_days",
        "is_delivered_late",
        F.coalesce("item_count", zero).alias("item_count"),
        F.coalesce("distinct_product_count", zero).alias("distinct_product_count"),
        F.coalesce("distinct_seller_count", zero).alias("distinct_seller_count"),
        F.coalesce("item_subtotal", zero_money).alias("item_subtotal"),
        F.coalesce("freight_total", zero_money).alias("freight_total"),
        F.coalesce("order_total", zero_money).alias("order_total"),
        F.coalesce("payment_record_count", zero).alias("payment_record_count"),
        F.coalesce("payment_type_count", zero).alias("payment_type_count"),
        "payment_types",
        F.coalesce("maximum_installments", zero).alias("maximum_installments"),
        F.coalesce("payment_total", zero_money).alias("payment_total"),
        "review_count",
        "average_review_score",
        "has_review_comment",
        F.lit(1).alias("order_count"),
    )
    fact = _stamp(fact)
    return fact.withColumn("payment_difference", F.round(F.col("payment_total") - F.col("order_total"), 2))


def fct_orders(
    orders: DataFrame,
    dim_customers_df: DataFrame | None,
    items_agg: DataFrame,
    payments_agg: DataFrame,
    reviews_agg: DataFrame,
) -> DataFrame:
    """G10 with its surrogate keys."""
    return with_keys(order_rows(orders, dim_customers_df, items_agg, payments_agg, reviews_agg), "fct_orders")
