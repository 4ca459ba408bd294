import pytest
from pyspark.sql import functions as F

from lakemarts.operators import quality as Q


def results_of(df):
    return {r.check_name: r for r in df.collect()}


def finish(df):
    run_id, at = Q.new_run()
    return Q.finish_results(df, run_id, at)


def test_not_null_unique_and_rules_in_one_pass(spark):
    df = spark.createDataFrame(
        [("a", 1, 5), ("a", None, 3), (None, None, 0), (None, 2, None)], "k string, v int, score int"
    )
    rule = Q.Rule("score_ok", lambda: F.col("score").between(1, 5), "d")
    out = results_of(finish(Q.table_checks(df, "t", ["k", "v"], ["k"], [rule])))
    nn, uq, r = out["not_null: k, v"], out["unique: k"], out["score_ok"]
    assert (nn.total_rows, nn.failed_rows, nn.status) == (4, 3, "FAIL")  # several NULLs count once
    assert (uq.failed_rows, uq.status) == (2, "FAIL")  # NULL keys are equal values
    assert (r.failed_rows, r.check_type) == (2, "business_rule")  # NULL condition fails
    assert nn.failure_rate == pytest.approx(0.75)


def test_empty_table_passes_with_zero_rate(spark):
    df = spark.createDataFrame([], "k string")
    out = results_of(finish(Q.table_checks(df, "t", ["k"], ["k"])))
    row = out["not_null: k"]
    assert (row.total_rows, row.failed_rows, row.failure_rate, row.status) == (0, 0, 0.0, "PASS")


def test_foreign_key_ignores_null_child_keys(spark):
    child = spark.createDataFrame([("a",), ("a",), ("x",), (None,)], "k string")
    parent = spark.createDataFrame([("a",), ("b",)], "k string")
    row = Q.foreign_key_check(child, parent, "c", "p", ["k"]).first()
    assert (row.total_rows, row.failed_rows) == (4, 1)
    assert row.check_name == "foreign_key: c → p"
    assert row.details == "Keys ['k'] must exist in p."


def test_source_duplicates_are_a_warning_that_passes(spark):
    raw = spark.createDataFrame([("r1",), ("r1",), ("r2",)], "review_id string")
    row = finish(Q.source_duplicate_check(raw)).first()
    assert (row.failed_rows, row.severity, row.status) == (1, "WARNING", "PASS")


def _silver(spark, customers_unique=("u1", "u2")):
    tables = {
        "customers": spark.createDataFrame([("c1", customers_unique[0]), ("c2", customers_unique[1])],
                                           "customer_id string, customer_unique_id string"),
        "orders": spark.sql(
            "select 'o1' order_id, 'c1' customer_id, timestamp_ntz'2018-01-01 00:00:00' order_purchase_timestamp, "
            "cast(null as timestamp_ntz) order_delivered_customer_date"),
        "order_items": spark.sql(
            "select 'o1' order_id, 1 order_item_id, 'p1' product_id, 's1' seller_id, 1.00bd price, "
            "1.00bd freight_value, 2.00bd item_total_amount"),
        "payments": spark.sql("select 'o1' order_id, 1 payment_sequential, 5.00bd payment_value"),
        "reviews": spark.sql("select 'r1' review_id, 'o1' order_id, 5 review_score"),
        "products": spark.sql("select 'p1' product_id"),
        "sellers": spark.sql("select 's1' seller_id"),
    }
    return tables.__getitem__


def test_twenty_five_checks_and_gate(spark, tmp_path):
    raw_reviews = spark.createDataFrame([("r1",), ("r1",)], "review_id string")
    ok = finish(Q.quality_checks(_silver(spark), raw_reviews))
    assert ok.count() == 25
    assert ok.filter("status = 'FAIL'").count() == 0

    bad = finish(Q.quality_checks(_silver(spark, ("u1", None)), raw_reviews))
    verdict = Q.gate(bad).first()
    assert verdict.verdict == "FAIL" and "not_null: customer_id, customer_unique_id" in verdict.error


def test_checks_share_groupings(spark):
    """One grouping per key: 12 scans and fewer than 20 exchanges for all 25."""
    checks = Q.quality_checks(_silver(spark), spark.createDataFrame([("r1",)], "review_id string"))
    plan = checks._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") + plan.count("Exchange SinglePartition") < 20
    assert "Join" not in plan and plan.count("Scan") <= 12


def test_families_on_nulls_duplicates_and_orphans(spark):
    """NULL keys are equal for uniqueness and no failure of a foreign key."""
    def table(rows, schema):
        return spark.createDataFrame(rows, schema)

    silver = {
        "orders": spark.sql(
            "select * from values ('o1','c1'), ('o1','c9'), (null,'c1'), (null,null) as t(order_id, customer_id)"
        ).selectExpr("*", "timestamp_ntz'2018-01-02' order_purchase_timestamp",
                     "if(customer_id = 'c9', timestamp_ntz'2018-01-01', null) order_delivered_customer_date"),
        "customers": table([("c1", "u")], "customer_id string, customer_unique_id string"),
        "order_items": table(
            [("o1", 1, "p1", "s1", -1.0, 0.0, 0.0), ("o1", 1, "p2", None, 1.0, None, 1.0), ("o7", 1, "p1", "s1", 1.0, 0.0, 1.0),
             (None, None, "p1", "s1", 1.0, 0.0, 1.0), (None, None, "p1", "s1", 1.0, 0.0, 1.0)],
            "order_id string, order_item_id int, product_id string, seller_id string, price double, freight_value double, item_total_amount double"),
        "payments": table([], "order_id string, payment_sequential int, payment_value double"),
        "reviews": table([("r1", "o8", 9), ("r1", None, None)], "review_id string, order_id string, review_score int"),
        "products": table([("p1",)], "product_id string"),
        "sellers": table([("s1",)], "seller_id string"),
    }
    raw = table([("r1",), ("r1",), (None,), (None,)], "review_id string")
    got = {(r.table_name, r.check_name.split(":")[0] + (r.check_name.split("→")[1] if "→" in r.check_name else "")):
           (r.total_rows, r.failed_rows) for r in Q.quality_checks(silver.get, raw).collect()}
    assert len(got) == 25
    expected = {
        ("orders", "not_null"): (4, 2), ("orders", "unique"): (4, 2), ("orders", "valid_delivery_sequence"): (4, 1),
        ("orders", "foreign_key customers"): (4, 1), ("customers", "unique"): (1, 0),
        ("order_items", "not_null"): (5, 3), ("order_items", "unique"): (5, 2),
        ("order_items", "non_negative_item_amounts"): (5, 2), ("order_items", "foreign_key orders"): (5, 1),
        ("order_items", "foreign_key products"): (5, 1), ("order_items", "foreign_key sellers"): (5, 0),
        ("payments", "not_null"): (0, 0), ("payments", "unique"): (0, 0), ("payments", "foreign_key orders"): (0, 0),
        ("reviews", "not_null"): (2, 1), ("reviews", "unique"): (2, 1), ("reviews", "valid_review_score"): (2, 2),
        ("reviews", "foreign_key orders"): (2, 1), ("reviews_raw", "duplicate_review_ids_in_source"): (4, 2),
    }
    assert {k: got[k] for k in expected} == expected


def test_reports_use_latest_run(spark):
    raw_reviews = spark.createDataFrame([("r1",)], "review_id string")
    older = Q.finish_results(Q.quality_checks(_silver(spark, ("u1", None)), raw_reviews), "run-a", "2020-01-01 00:00:00")
    newer = Q.finish_results(Q.quality_checks(_silver(spark), raw_reviews), "run-b", "2021-01-01 00:00:00")
    history = older.unionByName(newer)
    summary = {(r.severity, r.status): r.check_count for r in Q.summary_report(history).collect()}
    assert summary == {("CRITICAL", "PASS"): 24, ("WARNING", "PASS"): 1}
    assert Q.failure_report(history).count() == 0
    assert Q.failure_report(older).count() == 1


def test_mart_tests(spark):
    df = spark.createDataFrame([("a", 1, 1.0), ("a", None, 2.0), (None, 3, 3.0)], "k string, n int, m double")
    out = {(r.test_name, r.column_name): r for r in Q.mart_test(df, "m1", ["k", "n"], "k").collect()}
    assert out[("unique", "k")].failures == 1  # NULL keys ignored
    assert out[("not_null", "k")].failures == 1 and out[("not_null", "n")].status == "fail"
