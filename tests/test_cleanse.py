from decimal import Decimal
import datetime as dt

from support import frame

from lakemarts.contracts import CONTRACTS
from lakemarts.operators.cleanse import cleanse

CUSTOMER_COLS = ["customer_id", "customer_unique_id", "customer_zip_code_prefix", "customer_city", "customer_state"]
ORDER_COLS = [c.source for c in CONTRACTS["orders"].columns]
ITEM_COLS = [c.source for c in CONTRACTS["order_items"].columns]
REVIEW_COLS = [c.source for c in CONTRACTS["reviews"].columns]
PRODUCT_COLS = [c.source for c in CONTRACTS["products"].columns]


def by_key(df, key):
    return {r[key]: r for r in df.collect()}


def test_customers_blank_ids_tabs_and_case(spark):
    raw = frame(spark, [
        ("  ", "u1", "01234", "X", "sp"),
        ("\tA ", "u2", "00001", " Sao Paulo ", " sp "),
        (None, "u3", "1", "c", "s"),
        ("B", None, "abc", "c", "s"),
    ], CUSTOMER_COLS)
    out = by_key(cleanse(raw, CONTRACTS["customers"]), "customer_id")
    assert set(out) == {"\tA", "B"}  # blank and NULL ids dropped; tab survives trim
    assert out["\tA"].customer_zip_code_prefix == 1  # leading zeros lost in the int cast
    assert out["\tA"].customer_city == "sao paulo" and out["\tA"].customer_state == "SP"
    assert out["B"].customer_unique_id is None  # kept: the quality gate catches it
    assert out["B"].customer_zip_code_prefix is None  # malformed number → NULL, not a failed job


def test_customer_duplicate_survivor_is_fixed(spark):
    rows = [("A", "u", "1", "zeta", "s"), ("A", "u", "1", "alpha", "s")]
    first = cleanse(frame(spark, rows, CUSTOMER_COLS), CONTRACTS["customers"]).collect()
    second = cleanse(frame(spark, rows[::-1], CUSTOMER_COLS).repartition(3), CONTRACTS["customers"]).collect()
    assert len(first) == 1 and first[0].customer_city == "alpha"
    assert [r.customer_city for r in second] == ["alpha"]


def test_orders_derived_columns(spark):
    rows = [
        ("o1", "c", "x", "2018-01-01 10:00:00", None, None, None, "2018-01-10 00:00:00"),
        ("o2", "c", "x", "2018-01-01 10:00:00", None, None, "2018-01-10 00:00:00", "2018-01-10 00:00:00"),
        ("o3", "c", "x", "2018-01-01 10:00:00", None, None, "2018-01-10 00:00:01", "2018-01-10 00:00:00"),
        ("o4", "c", "x", "2018-01-01 23:59:00", None, None, "2018-01-02 00:01:00", "2018-01-10 00:00:00"),
        ("o5", "c", "x", "bad", None, None, None, None),
        ("o6", "c", " Delivered", None, None, None, None, None),
    ]
    out = by_key(cleanse(frame(spark, rows, ORDER_COLS), CONTRACTS["orders"]), "order_id")
    assert out["o1"].is_delivered_late is None and out["o1"].delivery_days is None
    assert out["o2"].is_delivered_late is False
    assert out["o3"].is_delivered_late is True
    assert out["o4"].delivery_days == 1
    assert out["o5"].order_purchase_timestamp is None and out["o5"].purchase_date is None
    assert out["o6"].order_status == "delivered"
    assert out["o2"].purchase_date == dt.date(2018, 1, 1)


def test_order_items_amount_filters_and_rounding(spark):
    rows = [
        ("o", "1", "p", "s", "2018-01-01", None, "1"),
        ("o", "2", "p", "s", "2018-01-01", "-0.01", "1"),
        ("o", "3", "p", "s", "2018-01-01", "1.005", "2.50"),
        ("o", "4", "", "s", "2018-01-01", "1", "1"),
        ("o", "x", "p", "s", "2018-01-01", "1", "1"),
    ]
    out = by_key(cleanse(frame(spark, rows, ITEM_COLS), CONTRACTS["order_items"]), "order_item_id")
    assert set(out) == {3, 4}  # NULL/negative price and malformed item number dropped
    assert out[3].price == Decimal("1.01") and out[3].item_total_amount == Decimal("3.51")
    assert out[4].product_id == ""  # no blank filter on this table


def test_reviews_filter_before_dedup_and_comment_flag(spark):
    rows = [
        ("r1", "o1", "0", None, "good", "2018-01-02 00:00:00", None),
        ("r1", "o2", "4", None, "   ", "2018-01-01 00:00:00", None),
        ("r2", "o3", "6", None, "x", None, None),
        ("r3", "o4", None, None, "x", None, None),
        ("r4", "o5", "5", None, "fine", None, None),
    ]
    out = by_key(cleanse(frame(spark, rows, REVIEW_COLS), CONTRACTS["reviews"]), "review_id")
    assert set(out) == {"r1", "r4"}
    assert out["r1"].order_id == "o2"  # the valid row survives, not the newer score-0 row
    assert out["r1"].has_comment is False and out["r4"].has_comment is True


def test_reviews_latest_version_survives(spark):
    rows = [
        ("r1", "o1", "3", None, None, "2018-01-01 00:00:00", None),
        ("r1", "o2", "4", None, None, "2018-01-05 00:00:00", None),
    ]
    out = cleanse(frame(spark, rows, REVIEW_COLS), CONTRACTS["reviews"]).collect()
    assert [(r.order_id, r.review_score) for r in out] == [("o2", 4)]


def test_products_volume_overflow_and_casts(spark):
    rows = [
        ("p1", None, "10", "12.5", "1", "2", "2000", "2000", "2000"),
        ("p2", "Moveis", "1", "2", "3", "4", "2", "3", "4"),
    ]
    out = by_key(cleanse(frame(spark, rows, PRODUCT_COLS), CONTRACTS["products"]), "product_id")
    assert out["p1"].product_volume_cm3 is None  # int overflow → NULL under ANSI
    assert out["p1"].product_description_length is None  # '12.5' is not an int
    assert out["p2"].product_volume_cm3 == 24 and out["p2"].product_category_name == "moveis"
    assert "product_name_length" in out["p2"].asDict()  # source spelling fixed
