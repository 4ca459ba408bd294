"""The benchmark's parquet tables presented as the seven raw retail datasets.

The mapping is the one fixed in FIXTURES.md §2: every raw column is a string,
exactly as a CSV read with schema inference off would produce, and the data
carries the defects the cleansing step is built for (padded ids, mixed case,
duplicate item keys, repeated review ids, out-of-range scores, blank
comments, NULL categories, missing delivery dates).

Only ``nation`` and ``region`` are broadcast: their sizes are fixed by the
TPC-H schema (25 and 5 rows) whatever the scale factor.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

BASE_TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


def _s(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def _plus_days(ts: str, days: Column | int) -> Column:
    return F.timestamp_add("DAY", days if isinstance(days, Column) else F.lit(days), F.col(ts))


class DriverTables:
    """Lazily built raw DataFrames over one scale-factor directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def _geo(self, nation_col: str) -> DataFrame:
        geo = self.table("nation").join(
            F.broadcast(self.table("region")), F.col("n_regionkey") == F.col("r_regionkey")
        )
        return F.broadcast(geo.select("n_nationkey", "n_name", "r_name"))

    @cached_property
    def customers_raw(self) -> DataFrame:
        c = self.table("customer")
        return c.join(self._geo("c_nationkey"), F.col("c_nationkey") == F.col("n_nationkey")).select(
            F.concat(F.lit(" C"), _s("c_custkey"), F.lit(" ")).alias("customer_id"),
            F.concat(F.lit("U"), _s(F.col("c_custkey") - F.col("c_custkey") % 3)).alias("customer_unique_id"),
            F.lpad(_s(F.col("c_nationkey") * 137), 5, "0").alias("customer_zip_code_prefix"),
            F.col("n_name").alias("customer_city"),
            F.lower(F.substring("r_name", 1, 2)).alias("customer_state"),
        )

    @cached_property
    def orders_raw(self) -> DataFrame:
        o = self.table("orders")
        status = F.col("o_orderstatus")
        return o.select(
            F.concat(F.lit("O"), _s("o_orderkey")).alias("order_id"),
            F.concat(F.lit("C"), _s("o_custkey")).alias("customer_id"),
            F.when(status == "F", " Delivered").when(status == "O", "shipped").otherwise("processing").alias("order_status"),
            _s("o_orderdate").alias("order_purchase_timestamp"),
            F.when(status != "P", _s(_plus_days("o_orderdate", 1))).alias("order_approved_at"),
            F.when(status == "F", _s(_plus_days("o_orderdate", 2))).alias("order_delivered_carrier_date"),
            F.when(
                (status == "F") & (F.col("o_orderkey") % 20 != 19),
                _s(_plus_days("o_orderdate", F.col("o_orderkey") % 45)),
            ).alias("order_delivered_customer_date"),
            _s(_plus_days("o_orderdate", 30)).alias("order_estimated_delivery_date"),
        )

    @cached_property
    def order_items_raw(self) -> DataFrame:
        li = self.table("lineitem")
        return li.select(
            F.concat(F.lit("O"), _s("l_orderkey")).alias("order_id"),
            _s("l_linenumber").alias("order_item_id"),
            F.concat(F.lit("P"), _s("l_partkey")).alias("product_id"),
            F.concat(F.lit("S"), _s("l_suppkey")).alias("seller_id"),
            _s("l_shipdate").alias("shipping_limit_date"),
            _s(F.col("l_extendedprice").cast("decimal(12,2)")).alias("price"),
            _s(F.col("l_quantity").cast("decimal(12,2)")).alias("freight_value"),
        )

    @cached_property
    def payments_raw(self) -> DataFrame:
        # One payment per (order, return flag); the aggregate is partial
        # map-side, and the window sees at most three rows per order.
        g = (
            self.table("lineitem")
            .groupBy("l_orderkey", "l_returnflag")
            .agg(
                F.count(F.lit(1)).alias("n"),
                F.sum(F.col("l_extendedprice").cast("decimal(12,2)")).alias("v"),
            )
        )
        seq = F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_returnflag"))
        flag = F.col("l_returnflag")
        return g.select(
            F.concat(F.lit("O"), _s("l_orderkey")).alias("order_id"),
            _s(seq).alias("payment_sequential"),
            F.when(flag == "A", "Credit_Card ").when(flag == "N", "boleto").otherwise("voucher").alias("payment_type"),
            _s("n").alias("payment_installments"),
            _s("v").alias("payment_value"),
        )

    @cached_property
    def reviews_raw(self) -> DataFrame:
        e = self.table("events")
        event_type = F.col("event_type")
        review_no = F.col("event_id") - F.when(F.col("event_id") % 10 == 9, 1).otherwise(0)
        return e.select(
            F.concat(F.lit("R"), _s(review_no)).alias("review_id"),
            F.concat(F.lit("O"), _s("event_id")).alias("order_id"),
            F.when(event_type == "signup", "5")
            .when(event_type == "purchase", "4")
            .when(event_type == "view", "3")
            .when(event_type == "click", "2")
            .otherwise("0")
            .alias("review_score"),
            F.lit(None).cast("string").alias("review_comment_title"),
            F.when(F.col("value") > 50, event_type).otherwise("  ").alias("review_comment_message"),
            _s("ts").alias("review_creation_date"),
            _s(_plus_days("ts", 1)).alias("review_answer_timestamp"),
        )

    @cached_property
    def products_raw(self) -> DataFrame:
        p = self.table("part")
        size = F.col("p_size")
        return p.select(
            F.concat(F.lit("P"), _s("p_partkey")).alias("product_id"),
            F.when(F.col("p_type") != "STANDARD", F.col("p_type")).alias("product_category_name"),
            _s(F.length("p_name")).alias("product_name_lenght"),
            _s(size * 10).alias("product_description_lenght"),
            _s(size % 5).alias("product_photos_qty"),
            _s(size * 100).alias("product_weight_g"),
            _s(size).alias("product_length_cm"),
            _s(size + 1).alias("product_height_cm"),
            _s(size + 2).alias("product_width_cm"),
        )

    @cached_property
    def sellers_raw(self) -> DataFrame:
        s = self.table("supplier")
        return s.join(self._geo("s_nationkey"), F.col("s_nationkey") == F.col("n_nationkey")).select(
            F.concat(F.lit("S"), _s("s_suppkey")).alias("seller_id"),
            F.lpad(_s(F.col("s_nationkey") * 137), 5, "0").alias("seller_zip_code_prefix"),
            F.col("n_name").alias("seller_city"),
            F.lower(F.substring("r_name", 1, 2)).alias("seller_state"),
        )

    def raw(self, name: str) -> DataFrame:
        """Raw table by silver name (``orders``) or bronze name (``orders_raw``)."""
        attr = name if name.endswith("_raw") else f"{name}_raw"
        return getattr(self, attr)


def _first_hex(*columns: str) -> Column:
    """The first hex digit of the columns' MD5: picks a sixteenth of the rows."""
    return F.substring(F.md5(F.concat_ws("|", *columns)), 1, 1)


class SeededTables(DriverTables):
    """The raw tables with defects that the benchmark data lacks, each in a
    sixteenth of the rows: blank customer and seller ids (so orders and items
    lose their parents), products that are gone, deliveries before the
    purchase, negative prices; and sixteen times as many categories."""

    def raw(self, name: str) -> DataFrame:
        df = super().raw(name)
        table = name.removesuffix("_raw")
        if table == "customers":
            return df.withColumn("customer_id", F.when(_first_hex("customer_id") == "0", "   ").otherwise(F.col("customer_id")))
        if table == "sellers":
            return df.withColumn("seller_id", F.when(_first_hex("seller_id") == "5", "   ").otherwise(F.col("seller_id")))
        if table == "orders":
            delivered = F.col("order_delivered_customer_date")
            early = (_first_hex("order_id") == "1") & delivered.isNotNull()
            return df.withColumn("order_delivered_customer_date", F.when(early, "1990-01-01 00:00:00").otherwise(delivered))
        if table == "order_items":
            negative = _first_hex("order_id", "order_item_id") == "2"
            return df.withColumn("price", F.when(negative, "-5.00").otherwise(F.col("price")))
        if table == "products":
            finer = F.concat("product_category_name", F.lit(" "), _first_hex("product_id"))
            return df.where(_first_hex("product_id") != "3").withColumn("product_category_name", finer)
        return df


def defective_mart(df: DataFrame, key: str, not_null: list[str]) -> DataFrame:
    """A mart as a faulty build might leave it: a sixteenth of its keys twice,
    a sixteenth NULL, and a sixteenth of the other columns NULL."""
    digit = F.substring(F.md5(F.col(key).cast("string")), 1, 1)
    marked = df.withColumn("_digit", digit)
    rows = marked.unionByName(marked.where("_digit = '0'"))
    for c in not_null:
        rows = rows.withColumn(c, F.when(F.col("_digit") != ("2" if c == key else "1"), F.col(c)))
    return rows.drop("_digit")
