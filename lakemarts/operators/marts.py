"""Marts (M01-M05).

Each mart pre-aggregates the fact on the narrowest key it can before any
join, so the join and the final aggregation see one row per key instead of
one row per order or item:

* daily sales: aggregate orders per ``order_date_key`` (final, not partial:
  a date key maps to exactly one ``dim_date`` row), then attach the date
  attributes;
* product performance: aggregate items per order and product, then per
  product, and attach the product attributes;
* customer summary: aggregate orders per ``customer_key``, join the customer
  dimension one-to-one, then roll up to ``customer_unique_id``; the latest
  order is a ranked window, of which every map task hands on one row a key;
* delivery quality: attach ``year_month`` by a join with ``dim_date`` (one row
  per day), aggregate per (``customer_key``, month), join the customer
  dimension, then roll up to (month, state).

A customer holding a third of all orders is thus reduced map-side to one row
per month before any shuffle that is keyed by customer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemarts.functions import count_when, mean2, pct
from lakemarts.operators.dedup import keep_first

DATE_ATTRIBUTES = ("date_key", "full_date", "year_number", "quarter_number", "month_number", "month_name", "year_month")


def _delivered():
    return F.col("order_status") == "delivered"


def _score():
    """The orders' rounded scores as exact decimals, so that sums do not
    depend on the order of tasks."""
    return F.col("average_review_score").cast("decimal(12,2)")


def _late():
    return F.col("is_delivered_late") == F.lit(True)


def mart_daily_sales(fct_orders: DataFrame, dim_date: DataFrame) -> DataFrame:
    per_day = fct_orders.groupBy("order_date_key").agg(
        F.count(F.lit(1)).alias("total_orders"),
        count_when(_delivered()).alias("delivered_orders"),
        F.sum("item_count").alias("total_items"),
        F.round(F.sum("item_subtotal"), 2).alias("item_subtotal"),
        F.round(F.sum("freight_total"), 2).alias("freight_total"),
        F.round(F.sum("order_total"), 2).alias("order_total"),
        F.round(F.sum("payment_total"), 2).alias("payment_total"),
        F.round(F.avg("payment_total"), 2).alias("average_order_value"),
        count_when(_late()).alias("late_orders"),
        mean2(F.sum(_score()), F.count("average_review_score")).alias("average_review_score"),
    )
    dates = dim_date.select(*DATE_ATTRIBUTES)
    joined = per_day.join(dates, per_day["order_date_key"] == dates["date_key"], "inner")
    return joined.select(
        *DATE_ATTRIBUTES,
        "total_orders",
        "delivered_orders",
        "total_items",
        "item_subtotal",
        "freight_total",
        "order_total",
        "payment_total",
        "average_order_value",
        "late_orders",
        pct(F.col("late_orders"), F.col("delivered_orders")).alias("late_delivery_rate_pct"),
        "average_review_score",
    )


def _by(fact: DataFrame, entity: str) -> str:
    """The column to group a fact by customer or product: the natural id,
    where the fact carries it, is an eighth of its digest."""
    return f"{entity}_id" if f"{entity}_id" in fact.columns else f"{entity}_key"


def mart_product_performance(fct_order_items: DataFrame, dim_products: DataFrame) -> DataFrame:
    """In two levels: a product's items of one order first, where the fact is
    partitioned by order without a shuffle, so that its orders are a count."""
    by = _by(fct_order_items, "product")
    per_order = fct_order_items.groupBy("order_id", by).agg(
        F.sum("item_quantity").alias("units"),
        F.sum("item_price").alias("price_sum"),
        F.count("item_price").alias("prices"),
        F.sum("freight_value").alias("freight"),
        F.sum("item_total_amount").alias("gross"),
        F.sum("delivery_days").alias("days_sum"),
        F.count("delivery_days").alias("days"),
        count_when(_late()).alias("late"),
    )

    def total(c: str):
        """The sum with the type that one level of summing gives."""
        return F.sum(c).cast(per_order.schema[c].dataType)

    per_product = per_order.groupBy(by).agg(
        F.count("order_id").alias("total_orders"),
        F.sum("units").alias("units_sold"),
        F.round(total("price_sum"), 2).alias("item_revenue"),
        F.round(total("freight"), 2).alias("freight_total"),
        F.round(total("gross"), 2).alias("gross_sales"),
        # as avg does: 6 decimals before the final rounding, doubles of days
        F.round(F.try_divide(total("price_sum"), F.sum("prices")).cast("decimal(16,6)"), 2).alias("average_item_price"),
        F.round(F.try_divide(F.sum("days_sum").cast("double"), F.sum("days")), 2).alias("average_delivery_days"),
        F.sum("late").alias("late_items"),
    )
    products = dim_products.select("product_key", "product_id", "product_category_name")
    return per_product.join(products, by, "inner").select(
        "product_key",
        "product_id",
        "product_category_name",
        "total_orders",
        "units_sold",
        "item_revenue",
        "freight_total",
        "gross_sales",
        "average_item_price",
        "average_delivery_days",
        "late_items",
    )


def mart_customer_summary(fct_orders: DataFrame, dim_customers: DataFrame) -> DataFrame:
    by = _by(fct_orders, "customer")
    per_key = fct_orders.groupBy(by).agg(
        # fct_orders holds one row per order (reconciled against silver), so
        # the distinct order count per customer is a plain count.
        F.count("order_id").alias("orders"),
        F.sum("item_count").alias("items"),
        F.sum("order_total").alias("order_value"),
        F.sum("payment_total").alias("payment_value"),
        F.count("payment_total").alias("payments"),
        F.min("order_purchase_timestamp").alias("first_order_at"),
        F.max("order_purchase_timestamp").alias("latest_order_at"),
        count_when(_late()).alias("late"),
        F.sum(_score()).alias("review_sum"),
        F.count("average_review_score").alias("reviews"),
    )
    customers = dim_customers.select(by, "customer_unique_id", "customer_city", "customer_state")
    joined = per_key.join(customers, by, "inner")
    payment_sum = F.sum("payment_value")
    rolled = joined.groupBy("customer_unique_id").agg(
        F.sum("orders").alias("total_orders"),
        F.sum("items").alias("total_items"),
        F.round(F.sum("order_value"), 2).alias("lifetime_order_value"),
        F.round(payment_sum, 2).alias("lifetime_payment_value"),
        # avg(decimal) keeps 6 decimals before the final rounding.
        F.round(F.try_divide(payment_sum, F.sum("payments")).cast("decimal(38,6)"), 2).alias("average_order_value"),
        F.min("first_order_at").alias("first_order_at"),
        F.max("latest_order_at").alias("latest_order_at"),
        F.sum("late").alias("late_orders"),
        mean2(F.sum("review_sum"), F.sum("reviews")).alias("average_review_score"),
    )
    # Ties on the purchase time are broken by order_id, so the latest city and
    # state are repeatable; orders without a purchase time are never the latest.
    timed = fct_orders.select(by, "order_purchase_timestamp", "order_id").where(
        F.col("order_purchase_timestamp").isNotNull()
    )
    newest = [("order_purchase_timestamp", "desc"), ("order_id", "desc")]
    latest = keep_first(
        keep_first(timed, [by], newest).join(customers, by), ["customer_unique_id"], newest
    ).select(
        F.col("customer_unique_id").alias("of"), F.col("customer_city").alias("latest_customer_city"),
        F.col("customer_state").alias("latest_customer_state"),
    )
    same = F.col("customer_unique_id").eqNullSafe(F.col("of"))
    return rolled.join(latest, same, "left").select(
        "customer_unique_id", "latest_customer_city", "latest_customer_state",
        *[c for c in rolled.columns if c != "customer_unique_id"],
    )


def mart_delivery_quality(fct_orders: DataFrame, dim_date: DataFrame, dim_customers: DataFrame) -> DataFrame:
    dates = dim_date.select("date_key", "year_month")
    dated = fct_orders.join(dates, fct_orders["order_date_key"] == dates["date_key"], "inner")
    delivered = _delivered()
    by = _by(fct_orders, "customer")
    per_key_month = dated.groupBy(by, "year_month").agg(
        F.count(F.lit(1)).alias("orders"),
        count_when(delivered).alias("delivered"),
        count_when(_late()).alias("late"),
        count_when(delivered & (F.col("is_delivered_late") == F.lit(False))).alias("on_time"),
        F.sum(F.when(delivered, F.col("delivery_days"))).alias("days_sum"),
        F.count(F.when(delivered, F.col("delivery_days"))).alias("days_n"),
        F.sum(_score()).alias("review_sum"),
        F.count("average_review_score").alias("reviews"),
        F.sum("payment_total").alias("payment_sum"),
    )
    customers = dim_customers.select(by, "customer_state")
    joined = per_key_month.join(customers, by, "inner")
    state = F.coalesce(F.col("customer_state"), F.lit("UNKNOWN"))
    rolled = joined.groupBy("year_month", state.alias("customer_state")).agg(
        F.sum("orders").alias("total_orders"),
        F.sum("delivered").alias("delivered_orders"),
        F.sum("late").alias("late_orders"),
        F.sum("on_time").alias("on_time_orders"),
        F.try_divide(F.sum("days_sum").cast("double"), F.sum("days_n")).alias("avg_days"),
        mean2(F.sum("review_sum"), F.sum("reviews")).alias("average_review_score"),
        F.round(F.sum("payment_sum"), 2).alias("total_payment_value"),
    )
    return rolled.select(
        F.concat(F.col("year_month"), F.lit("||"), F.col("customer_state")).alias("delivery_quality_key"),
        "year_month",
        "customer_state",
        "total_orders",
        "delivered_orders",
        "late_orders",
        "on_time_orders",
        pct(F.col("late_orders"), F.col("delivered_orders")).alias("late_delivery_rate_pct"),
        F.round("avg_days", 2).alias("average_delivery_days"),
        "average_review_score",
        "total_payment_value",
    )


def gold_order_count(fct_orders: DataFrame) -> DataFrame:
    """The one-row connection check over the order fact."""
    return fct_orders.agg(F.count(F.lit(1)).alias("order_count"))
