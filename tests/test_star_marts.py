from decimal import Decimal

from pyspark.sql import functions as F

from lakemarts.operators import marts as M
from lakemarts.operators import star as S
from lakemarts.plans.layers import Lake
from support import SF_SMALL


def _orders(spark):
    return spark.sql("""
        select * from values
          ('o1', 'c1', 'delivered', timestamp_ntz'2018-01-01 00:00:00', 3, false, date'2018-01-01'),
          ('o2', 'c1', 'delivered', timestamp_ntz'2018-01-01 00:00:00', 40, true, date'2018-01-01'),
          ('o3', 'c2', 'shipped', timestamp_ntz'2018-01-02 00:00:00', null, null, date'2018-01-02'),
          ('o4', 'c9', 'shipped', timestamp_ntz'2018-01-02 00:00:00', null, null, date'2018-01-02')
        as t(order_id, customer_id, order_status, order_purchase_timestamp, delivery_days, is_delivered_late,
             purchase_date)
    """).select("*", *[F.lit(None).cast("timestamp_ntz").alias(c) for c in (
        "order_approved_at", "order_delivered_carrier_date", "order_delivered_customer_date",
        "order_estimated_delivery_date")])


def _customers(spark):
    return spark.createDataFrame(
        [("c1", "u1", 1, "city_a", "SP"), ("c2", "u1", 2, "city_b", None)],
        "customer_id string, customer_unique_id string, customer_zip_code_prefix int, customer_city string, "
        "customer_state string",
    )


def _fact(spark):
    items = spark.sql("select 'o1' order_id, 'p1' product_id, 's1' seller_id, 10.00bd price, "
                      "1.00bd freight_value, 11.00bd item_total_amount")
    payments = spark.sql("""select * from values ('o1', 'b', 1, 5.00bd), ('o1', 'a', 2, 5.00bd), ('o1', 'b', 1, 1.00bd)
                            as t(order_id, payment_type, payment_installments, payment_value)""")
    reviews = spark.sql("select 'r1' review_id, 'o1' order_id, 4 review_score, false has_comment")
    dim_c = S.dim_customers(_customers(spark))
    return S.fct_orders(_orders(spark), dim_c, S.items_per_order(items), S.payments_per_order(payments),
                        S.reviews_per_order(reviews)), dim_c


def test_fct_orders_defaults_and_payment_types(spark):
    fact, _ = _fact(spark)
    rows = {r.order_id: r for r in fact.collect()}
    assert set(rows) == {"o1", "o2", "o3"}  # o4 has no customer
    o1, o2 = rows["o1"], rows["o2"]
    assert o1.payment_types == "a, b" and o1.payment_type_count == 2 and o1.payment_record_count == 3
    assert o1.payment_total == Decimal("11.00") and o1.payment_difference == Decimal("0.00")
    assert o1.has_review_comment is False and o1.average_review_score == 4.0
    assert (o2.item_count, o2.order_total, o2.payment_total) == (0, Decimal("0.00"), Decimal("0.00"))
    assert o2.payment_types is None and o2.review_count is None and o2.has_review_comment is None
    assert o1.customer_key == fact.sparkSession.sql("select sha2('c1', 256)").first()[0]
    assert o1.order_date_key == 20180101


def test_dim_date_attributes(spark):
    d = S.dim_date(_orders(spark)).filter("date_key = 20180101").first()
    assert (d.day_name, d.month_name, d.year_month, d.day_of_week, d.is_weekend) == (
        "Monday", "January", "2018-01", 2, False)


def test_delivery_quality_semantics(spark):
    fact, dim_c = _fact(spark)
    dates = S.dim_date(_orders(spark))
    rows = {r.delivery_quality_key: r for r in M.mart_delivery_quality(fact, dates, dim_c).collect()}
    sp, unknown = rows["2018-01||SP"], rows["2018-01||UNKNOWN"]
    assert (sp.total_orders, sp.delivered_orders, sp.late_orders, sp.on_time_orders) == (2, 2, 1, 1)
    assert sp.late_delivery_rate_pct == Decimal("50.00") and sp.average_delivery_days == 21.5
    assert unknown.delivered_orders == 0 and unknown.late_delivery_rate_pct is None


def test_customer_summary_latest_city_tie_break(spark):
    fact, dim_c = _fact(spark)
    row = M.mart_customer_summary(fact, dim_c).first()
    # o1 and o2 (city_a) tie with ... o3 (city_b) is a day later → latest
    assert row.latest_customer_city == "city_b" and row.total_orders == 3
    assert row.lifetime_payment_value == Decimal("11.00")
    assert row.average_order_value == Decimal("3.67")  # 11.00 / 3, HALF_UP


def test_semi_join_equals_inner_join(spark):
    orders = _orders(spark)
    dim_c = S.dim_customers(_customers(spark))
    semi = {r.order_id for r in S.orders_with_customer(orders, dim_c).collect()}
    inner = {r.order_id for r in orders.join(dim_c, "customer_id").collect()}
    assert semi == inner == {"o1", "o2", "o3"}


def test_fact_without_dimension_joins_after_the_gate(spark):
    items = spark.sql("select 'o1' order_id, 1 order_item_id, 'p1' product_id, 's1' seller_id, "
                      "timestamp_ntz'2018-01-02 00:00:00' shipping_limit_date, 10.00bd price, 1.00bd freight_value, "
                      "11.00bd item_total_amount")
    orders = _orders(spark)
    dim_c = S.dim_customers(_customers(spark))
    dim_p = S.dim_products(spark.sql(
        "select 'p1' product_id, 'x' product_category_name, 1 product_name_length, 1 product_description_length, "
        "1 product_photos_qty, 1 product_weight_g, 1 product_length_cm, 1 product_height_cm, 1 product_width_cm, "
        "1 product_volume_cm3"))
    dim_s = S.dim_sellers(spark.sql("select 's1' seller_id, 1 seller_zip_code_prefix, 'c' seller_city, 'SP' seller_state"))
    checked = S.fct_order_items(items, orders, dim_c, dim_p, dim_s)
    proven = S.fct_order_items(items, orders, None, None, None)
    assert checked.drop("_gold_processed_at").collect() == proven.drop("_gold_processed_at").collect()
    plan = proven._jdf.queryExecution().executedPlan().toString()
    assert "LeftSemi" not in plan


def _tree(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _hot_items(spark, n=3000):
    """A third of the items has one product, and some products, sellers and
    orders have no parent or no key."""
    money = "cast(1 as decimal(12,2))"
    return spark.range(n).selectExpr(
        "concat('o', id % 700) order_id", "cast(id as int) order_item_id",
        "case when id % 3 = 0 then 'p0' when id % 41 = 1 then null else concat('p', id % 90) end product_id",
        "concat('s', id % 17) seller_id", "timestamp_ntz'2018-01-02 00:00:00' shipping_limit_date",
        f"{money} price", f"{money} freight_value", f"{money} item_total_amount")


def _keys(spark, prefix, n):
    return spark.range(n).selectExpr(f"concat('{prefix}', id) k")


def test_with_parent_equals_semi_join_on_both_sides_of_the_limit(spark):
    items = _hot_items(spark)
    for parents in (_keys(spark, "p", 80), _keys(spark, "p", 90), _keys(spark, "p", 0)):
        parent = parents.withColumnRenamed("k", "product_id")
        expected = sorted(r.order_item_id for r in items.join(parent, "product_id", "left_semi").collect())
        for limit in (100_000, 10, 1):
            got = S.with_parent(items, parent, "product_id", limit)
            assert sorted(r.order_item_id for r in got.collect()) == expected
    parent = _keys(spark, "p", 80).withColumnRenamed("k", "product_id")
    # no row of the items is shuffled where the missing keys are few
    assert "Exchange hashpartitioning" not in _tree(S.with_parent(items, parent, "product_id"))
    assert "LeftSemi" in _tree(S.with_parent(items, parent, "product_id", 3))


def test_item_rows_are_shuffled_once(spark):
    items = _hot_items(spark)
    orders = spark.range(650).selectExpr(
        "concat('o', id) order_id", "concat('c', id % 60) customer_id", "'delivered' order_status",
        "timestamp_ntz'2018-01-01 00:00:00' order_purchase_timestamp", "3 delivery_days", "false is_delivered_late",
        "date'2018-01-01' purchase_date")
    dims = [_keys(spark, p, n).withColumnRenamed("k", f"{name}_id")
            for p, n, name in (("c", 50, "customer"), ("p", 85, "product"), ("s", 16, "seller"))]
    fact = S.fct_order_items(items, orders, *dims)
    expected = (items.join(orders, "order_id").join(dims[0], "customer_id").join(dims[1], "product_id")
                .join(dims[2], "seller_id"))
    assert sorted(r.order_item_id for r in fact.collect()) == sorted(r.order_item_id for r in expected.collect())
    plan = _tree(fact)
    initial = plan[plan.rindex("== Initial Plan =="):] if "== Initial Plan ==" in plan else plan
    # items and orders, each by order
    assert initial.count("Exchange hashpartitioning(order_id") == initial.count("Exchange hashpartitioning") == 2


def test_per_order_aggregates_equal_plain_sql_without_expand(spark):
    _hot_items(spark).createOrReplaceTempView("hot_items")
    got = S.items_per_order(spark.table("hot_items"))
    assert "Expand" not in _tree(got)
    plain = spark.sql("""select order_id, count(*), count(distinct product_id), count(distinct seller_id), sum(price),
                         sum(freight_value), sum(item_total_amount) from hot_items group by order_id""")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, plain.collect()))
    assert [t for _, t in got.dtypes] == [t for _, t in plain.dtypes]


def test_customer_summary_sorts_no_aggregate(spark):
    fact, dim_c = _fact(spark)
    untimed = fact.withColumn("order_purchase_timestamp", F.lit(None).cast("timestamp_ntz"))
    assert "SortAggregate" not in _tree(M.mart_customer_summary(fact, dim_c))
    row = M.mart_customer_summary(untimed, dim_c).first()
    assert row.total_orders == 3 and row.latest_customer_city is None and row.latest_order_at is None


def test_per_order_aggregates_shuffle_once(spark):
    """One exchange, by order, before any grouping."""
    items = _hot_items(spark)
    payments = items.selectExpr("order_id", "case when order_item_id % 5 = 0 then null else product_id end payment_type",
                                "order_item_id payment_installments", "price payment_value")
    for df in (S.items_per_order(items), S.payments_per_order(payments)):
        plan = _tree(df)
        assert plan.count("Exchange hashpartitioning") == plan.count("Exchange hashpartitioning(order_id") == 1
    payments.createOrReplaceTempView("hot_payments")
    plain = spark.sql("""select order_id, count(*), count(distinct payment_type),
                         concat_ws(', ', sort_array(collect_set(payment_type))), max(payment_installments),
                         sum(payment_value) from hot_payments group by order_id""")
    assert sorted(map(tuple, S.payments_per_order(payments).collect())) == sorted(map(tuple, plain.collect()))


def test_product_mart_counts_orders_where_the_fact_is_joined(spark):
    """behind the join by order only the products are shuffled,
    by id where the fact has it, and the result is that of one plain grouping."""
    items = _hot_items(spark)
    money = "cast(id % 7 as decimal(12,2))"
    items = items.drop("price").join(spark.range(3000).selectExpr(
        "cast(id as int) order_item_id", f"case when id % 11 > 0 then {money} end price"), "order_item_id").localCheckpoint()
    orders = spark.range(650).selectExpr(
        "concat('o', id) order_id", "concat('c', id % 60) customer_id", "'delivered' order_status",
        "timestamp_ntz'2018-01-01 00:00:00' order_purchase_timestamp",
        "case when id % 3 > 0 then cast(id % 9 as int) end delivery_days", "id % 2 = 0 is_delivered_late",
        "date'2018-01-01' purchase_date")
    dim_p = S.dim_products(spark.range(85).selectExpr(
        "concat('p', id) product_id", "'x' product_category_name", "1 product_name_length",
        "1 product_description_length", "1 product_photos_qty", "1 product_weight_g", "1 product_length_cm",
        "1 product_height_cm", "1 product_width_cm", "1 product_volume_cm3"))
    rows = S.order_item_rows(items, orders, None, None, None)
    narrow = M.mart_product_performance(S.with_keys(rows, "fct_order_items", ids=True), dim_p)
    initial = _tree(narrow)
    assert initial.count("Exchange hashpartitioning(order_id") == 2
    assert initial.count("Exchange hashpartitioning(product_id") == initial.count("Exchange hashpartitioning") - 2 == 2
    fact = S.fct_order_items(items, orders, None, None, None)
    fact.createOrReplaceTempView("plain_items")
    dim_p.createOrReplaceTempView("plain_products")
    plain = spark.sql("""select product_key, product_id, product_category_name, count(distinct order_id),
        sum(item_quantity), round(sum(item_price), 2), round(sum(freight_value), 2), round(sum(item_total_amount), 2),
        round(avg(item_price), 2), round(avg(delivery_days), 2), sum(case when is_delivered_late then 1 else 0 end)
        from plain_items join plain_products using (product_key) group by all""")
    expected = sorted(map(tuple, plain.collect()))
    for df in (narrow, M.mart_product_performance(fact, dim_p)):
        assert sorted(map(tuple, df.collect())) == expected
        assert [t for _, t in df.dtypes] == [t for _, t in plain.dtypes]


def test_stored_facts_hold_ids_and_read_as_the_facts(spark):
    """the copy of a fact has no digests; what is read has."""
    own = Lake.from_driver_tables(spark, SF_SMALL)
    try:
        for name, ids in S.FACT_IDS.items():
            written = spark.read.parquet(own.gold.folder(name))
            assert set(ids) <= set(written.columns) and not [c for c in written.columns if c.endswith("_key") and c != "order_date_key"]
            read, built = own.gold.stored(name), own.gold.table(name)
            assert read.columns == built.columns and read.dtypes == built.dtypes
            stamp = "_gold_processed_at"
            assert read.drop(stamp).exceptAll(built.drop(stamp)).count() == 0 and read.count() == built.count()
    finally:
        own.close()
