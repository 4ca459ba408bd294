"""Deduplication.

``keep_first`` keeps one row per key, chosen by a total order, so reruns and
repartitioned inputs agree on the survivor.  Spark plans
``row_number() == 1`` as a WindowGroupLimit *before* the shuffle as well as
after it: every map task forwards at most one row per key, so a key holding a
third of all rows costs one row per map partition in the exchange, not a
third of the data in one reduce task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def order_column(name: str, direction: str) -> Column:
    """NULLs always sort last, so a non-NULL value is preferred."""
    c = F.col(name)
    return c.desc_nulls_last() if direction == "desc" else c.asc_nulls_last()


def keep_first(df: DataFrame, key: list[str] | tuple[str, ...], order: list[tuple[str, str]]) -> DataFrame:
    """One row per ``key``: the first by ``order`` (D01 single key, D02 composite)."""
    ordering = [order_column(c, d) for c, d in order] or [F.lit(1)]
    w = Window.partitionBy(*key).orderBy(*ordering)
    return df.withColumn("_survivor_rank", F.row_number().over(w)).filter("_survivor_rank = 1").drop("_survivor_rank")


def duplicate_keys(df: DataFrame, key: list[str] | tuple[str, ...]) -> DataFrame:
    """Key values occurring more than once, with their row count."""
    return df.groupBy(*key).count().filter(F.col("count") > 1)
