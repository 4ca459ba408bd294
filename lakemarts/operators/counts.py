"""Row counts of tables (U01, A01), from the files' own statistics where the
table is a folder of Parquet files."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def statistics_session(spark: SparkSession) -> SparkSession:
    """A session beside the caller's whose Parquet reader answers counts from
    the file footers; the caller's settings stay as they are."""
    own = spark.newSession()
    v1 = [s for s in own.conf.get("spark.sql.sources.useV1SourceList").split(",") if s.strip().lower() != "parquet"]
    own.conf.set("spark.sql.sources.useV1SourceList", ",".join(v1))
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return own


def layer_counts(spark: SparkSession, tables: list[tuple[str, str, DataFrame | str]]) -> DataFrame:
    """``layer, table_name, row_count`` of named tables, ordered by both.  A
    table is a DataFrame or the folder of a stored table."""
    own = statistics_session(spark)
    counts = [
        (own.read.parquet(df) if isinstance(df, str) else df).agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(layer).alias("layer"), F.lit(name).alias("table_name"), "row_count"
        )
        for layer, name, df in tables
    ]
    return reduce(DataFrame.unionByName, counts).orderBy("layer", "table_name")
