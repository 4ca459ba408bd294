"""Hot keys (one key holding a third of all rows) and cross-layer properties."""

from decimal import Decimal

from pyspark.sql import functions as F

from support import SF_SMALL
from lakemarts.operators import marts as M
from lakemarts.operators import quality as Q
from lakemarts.operators import star as S
from lakemarts.plans.queries import lake


def _skewed_orders(spark, n=3000):
    """Every third order belongs to customer c0 and is delivered late."""
    return spark.range(n).select(
        F.concat(F.lit("o"), F.col("id").cast("string")).alias("order_id"),
        F.when(F.col("id") % 3 == 0, F.lit("c0")).otherwise(F.concat(F.lit("c"), (F.col("id") % 50 + 1).cast("string")))
        .alias("customer_id"),
        F.lit("delivered").alias("order_status"),
        F.expr("timestamp_ntz'2018-01-01 00:00:00' + make_dt_interval(cast(id % 60 as int))").alias("order_purchase_timestamp"),
        F.lit(None).cast("timestamp_ntz").alias("order_approved_at"),
        F.lit(None).cast("timestamp_ntz").alias("order_delivered_carrier_date"),
        F.lit(None).cast("timestamp_ntz").alias("order_delivered_customer_date"),
        F.lit(None).cast("timestamp_ntz").alias("order_estimated_delivery_date"),
        (F.col("id") % 7).cast("int").alias("delivery_days"),
        (F.col("id") % 3 == 0).alias("is_delivered_late"),
    ).withColumn("purchase_date", F.to_date("order_purchase_timestamp"))


def _customers(spark):
    return spark.range(0, 51).select(
        F.concat(F.lit("c"), F.col("id").cast("string")).alias("customer_id"),
        F.concat(F.lit("u"), (F.col("id") % 10).cast("string")).alias("customer_unique_id"),
        F.lit(1).alias("customer_zip_code_prefix"),
        F.concat(F.lit("city"), F.col("id").cast("string")).alias("customer_city"),
        F.when(F.col("id") % 2 == 0, "SP").otherwise(None).alias("customer_state"),
    )


def _fact(spark):
    orders = _skewed_orders(spark)
    payments = orders.select("order_id", F.lit("card").alias("payment_type"), F.lit(1).alias("payment_installments"),
                             F.lit(Decimal("2.50")).cast("decimal(12,2)").alias("payment_value"))
    items = orders.select("order_id", F.lit("p0").alias("product_id"), F.lit("s0").alias("seller_id"),
                          F.lit(Decimal("1.00")).cast("decimal(12,2)").alias("price"),
                          F.lit(Decimal("0.50")).cast("decimal(12,2)").alias("freight_value"),
                          F.lit(Decimal("1.50")).cast("decimal(12,2)").alias("item_total_amount"))
    reviews = spark.createDataFrame([], "review_id string, order_id string, review_score int, has_comment boolean")
    dim_c = S.dim_customers(_customers(spark))
    fact = S.fct_orders(orders, dim_c, S.items_per_order(items), S.payments_per_order(payments),
                        S.reviews_per_order(reviews))
    return orders, fact, dim_c


def test_hot_customer_marts_equal_naive_grouping(spark):
    orders, fact, dim_c = _fact(spark)
    summary = {r.customer_unique_id: r for r in M.mart_customer_summary(fact, dim_c).collect()}
    naive = {
        r.customer_unique_id: r
        for r in fact.join(dim_c.select("customer_key", "customer_unique_id"), "customer_key")
        .groupBy("customer_unique_id")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("payment_total").alias("p"),
             F.sum(F.col("is_delivered_late").cast("int")).alias("late"))
        .collect()
    }
    assert summary.keys() == naive.keys()
    for k, row in summary.items():
        assert (row.total_orders, row.lifetime_payment_value, row.late_orders) == (naive[k].n, naive[k].p, naive[k].late)
    assert summary["u0"].total_orders >= 1000  # the hot person

    dates = S.dim_date(orders)
    quality = M.mart_delivery_quality(fact, dates, dim_c)
    assert quality.agg(F.sum("total_orders")).first()[0] == fact.count()
    assert quality.agg(F.sum("total_payment_value")).first()[0] == fact.agg(F.sum("payment_total")).first()[0]


def test_hot_key_marts_aggregate_partially_before_the_shuffle(spark):
    _, fact, dim_c = _fact(spark)
    plan = M.mart_customer_summary(fact, dim_c)._jdf.queryExecution().executedPlan().toString()
    assert "partial_max(" in plan and "partial_count(" in plan  # map-side combine before the exchange


def test_hot_foreign_key_and_uniqueness(spark):
    orders = _skewed_orders(spark)
    customers = _customers(spark).filter("customer_id <> 'c0'")  # the hot parent is missing
    row = Q.foreign_key_check(orders, customers, "orders", "customers", ["customer_id"]).first()
    assert row.failed_rows == orders.filter("customer_id = 'c0'").count() == 1000
    dup = Q.table_checks(orders, "orders", ["order_id"], ["customer_id"]).filter("check_type = 'uniqueness'").first()
    assert dup.failed_rows == orders.count() - orders.select("customer_id").distinct().count()


def test_layer_totals_agree(spark):
    lk = lake(spark, SF_SMALL)
    fact = lk.gold.stored("fct_orders")
    items = lk.gold.stored("fct_order_items")
    silver_items = lk.silver.stored("order_items")
    pay = fact.filter(F.col("order_date_key").isNotNull()).agg(F.sum("payment_total")).first()[0]
    assert lk.marts.mart_daily_sales.agg(F.sum("payment_total")).first()[0] == pay
    assert lk.marts.mart_customer_summary.agg(F.sum("lifetime_payment_value")).first()[0] == \
        fact.agg(F.sum("payment_total")).first()[0]
    assert lk.marts.mart_product_performance.agg(F.sum("units_sold")).first()[0] == items.count() == silver_items.count()
    assert fact.count() == lk.silver.stored("orders").count()
    assert fact.agg(F.sum("item_count")).first()[0] == silver_items.count()
