"""Dashboard tiles (B01-B10) and the tax projection.

Tiles read the marts (a few thousand rows per day, product or month), so
their aggregations are small; the top-k tiles sort by the measure with the
category as a tie-break, so the ten rows are repeatable.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemarts.functions import pct


def total_orders(daily: DataFrame) -> DataFrame:
    return daily.agg(F.sum("total_orders").alias("total_orders"))


def delivered_orders(daily: DataFrame) -> DataFrame:
    return daily.agg(F.sum("delivered_orders").alias("delivered_orders"))


def total_revenue(daily: DataFrame) -> DataFrame:
    return daily.agg(F.sum("payment_total").alias("total_revenue"))


def monthly_orders(daily: DataFrame) -> DataFrame:
    return daily.groupBy("year_month").agg(F.sum("total_orders").alias("total_orders")).orderBy("year_month")


def monthly_revenue(daily: DataFrame) -> DataFrame:
    return daily.groupBy("year_month").agg(F.sum("payment_total").alias("revenue")).orderBy("year_month")


def _top_categories(products: DataFrame, measure: str, alias: str, k: int) -> DataFrame:
    return (
        products.groupBy("product_category_name")
        .agg(F.sum(measure).alias(alias))
        .orderBy(F.col(alias).desc(), F.col("product_category_name").asc())
        .limit(k)
    )


def top_categories_by_revenue(products: DataFrame, k: int = 10) -> DataFrame:
    return _top_categories(products, "item_revenue", "revenue", k)


def top_categories_by_units(products: DataFrame, k: int = 10) -> DataFrame:
    return _top_categories(products, "units_sold", "units_sold", k)


def average_delivery_days(fct_orders: DataFrame) -> DataFrame:
    """Mean over delivered orders (not a mean of monthly means)."""
    delivered = fct_orders.filter(F.col("order_status") == "delivered")
    return delivered.agg(F.round(F.avg("delivery_days"), 2).alias("average_delivery_days"))


def late_orders(delivery: DataFrame) -> DataFrame:
    return delivery.agg(F.sum("late_orders").alias("late_orders"))


def late_orders_trend(delivery: DataFrame) -> DataFrame:
    return (
        delivery.groupBy("year_month")
        .agg(F.sum("late_orders").alias("late_orders"), F.sum("delivered_orders").alias("delivered_orders"))
        .withColumn("late_delivery_rate_pct", pct(F.col("late_orders"), F.col("delivered_orders")))
        .orderBy("year_month")
    )


def tax_projection(fct_orders: DataFrame, status: str = "delivered", rate: str = "0.15") -> DataFrame:
    """15% tax on completed orders, rounded to cents (exact decimals)."""
    total = F.col("order_total")
    tax = F.round(total * F.lit(rate).cast("decimal(3,2)"), 2)
    return fct_orders.filter(F.col("order_status") == status).select(
        "order_id",
        "order_status",
        total.alias("total_amount"),
        tax.alias("tax_amount"),
        F.round(total + tax, 2).alias("amount_with_tax"),
    ).orderBy(F.desc("amount_with_tax"), "order_id")
