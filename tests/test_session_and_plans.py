"""Session settings, stored layers and the broadcast policy."""

import os
import time

import pytest
from pyspark.sql import functions as F

from support import SF_SMALL
from lakemarts import build_session
from lakemarts.operators import marts as M
from lakemarts.operators import star as S
from lakemarts.plans.layers import Lake
from lakemarts.session import ensure_checkpoint_dir, require_local, shuffles_freed
from test_star_marts import _customers, _orders


def test_defaults_fill_only_what_is_unset(spark):
    """An active session keeps its own settings."""
    own = {"spark.sql.session.timeZone": "Europe/Paris", "spark.sql.adaptive.autoBroadcastJoinThreshold": "10m"}
    before = {k: spark.conf.get(k) for k in own}
    try:
        for k, v in own.items():
            spark.conf.set(k, v)
        again = build_session()
        assert again is spark and {k: again.conf.get(k) for k in own} == own
        assert build_session(conf={"spark.sql.session.timeZone": "UTC"}).conf.get("spark.sql.session.timeZone") == "UTC"
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_no_scratch_folder_off_a_local_master():
    require_local("local[8]")
    for master in ("yarn", "spark://host:7077", "local-cluster[3,2,1024]", "k8s://https://host"):
        with pytest.raises(RuntimeError):
            require_local(master)


def test_stored_layers_go_with_the_lake(spark):
    lake = Lake.from_driver_tables(spark, SF_SMALL)
    assert lake.silver.stored("sellers").count() > 0 and os.path.isdir(lake.store.removeprefix("file:"))
    lake.close()
    assert not os.path.exists(lake.store.removeprefix("file:"))
    with pytest.raises(ValueError):
        Lake(lake.raw).silver.stored("sellers")


def test_checkpoint_dir_is_reused(spark):
    first = ensure_checkpoint_dir(spark)
    assert ensure_checkpoint_dir(spark) == first == spark.sparkContext.getCheckpointDir()


def test_no_broadcast_without_a_bound(spark):
    """Static auto-broadcast is off: neither the fact nor the daily mart
    broadcasts anything before a size was measured, but for the counted
    customers that are missing."""
    orders = _orders(spark)
    dim_c = S.dim_customers(_customers(spark))
    empty_items = spark.createDataFrame([], "order_id string, product_id string, seller_id string, "
                                             "price decimal(12,2), freight_value decimal(12,2), "
                                             "item_total_amount decimal(12,2)")
    empty_pay = spark.createDataFrame([], "order_id string, payment_type string, payment_installments int, "
                                          "payment_value decimal(12,2)")
    empty_rev = spark.createDataFrame([], "review_id string, order_id string, review_score int, has_comment boolean")
    per_order = S.items_per_order(empty_items), S.payments_per_order(empty_pay), S.reviews_per_order(empty_rev)
    known = S.fct_orders(orders.where("customer_id <> 'c9'"), dim_c, *per_order)
    assert "BroadcastExchange" not in known._jdf.queryExecution().executedPlan().toString()
    daily = M.mart_daily_sales(known, S.dim_date(orders))
    plan = daily._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastExchange" not in plan
    fact = S.fct_orders(orders, dim_c, *per_order)
    plan = fact._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastExchange") == 1 and "LeftAnti, BuildRight" in plan
    daily = M.mart_daily_sales(fact, S.dim_date(orders))
    assert daily.agg(F.sum("total_orders")).first()[0] == 3


def test_customer_without_purchase_times_has_no_latest_city(spark):
    orders = _orders(spark).withColumn("order_purchase_timestamp", F.lit(None).cast("timestamp_ntz"))
    dim_c = S.dim_customers(_customers(spark))
    empty = {
        "items": "order_id string, product_id string, seller_id string, price decimal(12,2), "
                 "freight_value decimal(12,2), item_total_amount decimal(12,2)",
        "payments": "order_id string, payment_type string, payment_installments int, payment_value decimal(12,2)",
        "reviews": "review_id string, order_id string, review_score int, has_comment boolean",
    }
    frames = {k: spark.createDataFrame([], v) for k, v in empty.items()}
    fact = S.fct_orders(orders, dim_c, S.items_per_order(frames["items"]), S.payments_per_order(frames["payments"]),
                        S.reviews_per_order(frames["reviews"]))
    rows = M.mart_customer_summary(fact, dim_c).collect()
    assert rows and all(r.latest_customer_city is None and r.latest_customer_state is None for r in rows)


def _shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for name in (files.apply(i).getName() for i in range(files.size())) if name.startswith("shuffle_")}


def test_stored_tables_leave_no_shuffle_files(spark):
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = _shuffle_files(spark)
    lake = Lake.from_driver_tables(spark, SF_SMALL, seeded=True)
    lake.prefetch_silver(["orders", "order_items"])
    rows = lake.silver.stored("order_items").count()
    until = time.time() + 10  # they go in the background
    while _shuffle_files(spark) - before and time.time() < until:
        time.sleep(0.1)
    left = {name for name in _shuffle_files(spark) - before if name.endswith(".data")}
    assert len(left) <= 1 and rows > 0  # the count's own
    with shuffles_freed(spark), shuffles_freed(spark):
        assert spark.conf.get(setting) == "true"
    assert setting not in spark.conf.getAll or spark.conf.get(setting) == "false"
    lake.close()
