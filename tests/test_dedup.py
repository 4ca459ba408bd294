from pyspark.sql import functions as F

from lakemarts.operators.dedup import duplicate_keys, keep_first


def test_keep_first_is_idempotent_and_partition_independent(spark):
    df = spark.range(0, 2000).select(
        (F.col("id") % 37).alias("k"), (F.col("id") * 7 % 101).alias("v"), F.col("id").alias("w")
    )
    order = [("v", "desc"), ("w", "asc")]
    a = {tuple(r) for r in keep_first(df, ["k"], order).collect()}
    b = {tuple(r) for r in keep_first(df.repartition(7), ["k"], order).collect()}
    c = {tuple(r) for r in keep_first(keep_first(df, ["k"], order), ["k"], order).collect()}
    assert a == b == c
    assert len(a) == 37


def test_hot_key_is_reduced_before_the_shuffle(spark):
    # one key holds a third of the rows; the partial WindowGroupLimit keeps
    # one row per key per map task before the exchange
    df = spark.range(0, 3000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"), F.col("id").alias("v")
    )
    out = keep_first(df, ["k"], [("v", "asc")])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
    assert out.filter("k = 0").collect()[0].v == 0


def test_duplicate_keys(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2), (None, 3), (None, 4)], "k string, v int")
    dup = {r.k: r["count"] for r in duplicate_keys(df, ["k"]).collect()}
    assert dup == {"a": 2, None: 2}
