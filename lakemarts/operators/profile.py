"""Cleansing profiles, rejection and orphan reports.

A profile is a long table (table_name, metric, value) so every silver table
shares one schema.  Each metric family is one aggregate: the raw scan counts
rows and failed casts together, the silver scan counts rows, NULL keys and
table-specific conditions together, duplicates are one grouped pass, and an
orphan count joins distinct child keys (not child rows) to the parent.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemarts.contracts import CONTRACTS
from lakemarts.functions import LOWER, TRIM, UPPER, Ref, any_null, clean, count_when, null_as_false, stack_rows
from lakemarts.operators.cleanse import row_filter
from lakemarts.operators.quality import key_presence

# Orphan relations (child, parent, key) that the cleansing
# profile reports, and the extra per-table conditions it counts.
ORPHAN_RELATIONS = (
    ("orders", "customers", "customer_id"),
    ("order_items", "orders", "order_id"),
    ("payments", "orders", "order_id"),
    ("reviews", "orders", "order_id"),
    ("order_items", "products", "product_id"),
    ("order_items", "sellers", "seller_id"),
)

EXTRA_METRICS = {
    "orders": {"negative_delivery_days": lambda: F.col("delivery_days") < 0},
    "reviews": {"invalid_review_scores": lambda: ~F.col("review_score").between(1, 5)},
}


def orphans(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Child rows without a parent row; a NULL key has no parent."""
    return child.join(parent.select(key).distinct(), key, "left_anti")


def _metrics(one_row: DataFrame, table: str, metrics: list[str]) -> DataFrame:
    """(table_name, metric, value) rows from the named one-row aggregates."""
    filled = one_row.select(*[F.coalesce(F.col(m), F.lit(0)).cast("bigint").alias(m) for m in metrics])
    return stack_rows(filled, [(table, m, Ref(m)) for m in metrics], ["table_name", "metric", "value"],
                      {"value": "BIGINT"})


def failed_casts(raw: DataFrame, table: str) -> Column | None:
    """Raw rows where a non-NULL value became NULL in a typed column."""
    typed = [c for c in CONTRACTS[table].columns if c.rule not in (TRIM, LOWER, UPPER)]
    if not typed:
        return None
    lost = [F.when(F.col(c.source).isNotNull() & clean(c.rule, c.source).isNull(), 1).otherwise(0) for c in typed]
    return F.sum(reduce(add, lost))


def profile(table: str, raw: DataFrame, silver) -> DataFrame:
    """Profile of one silver table; ``silver`` is a provider name -> DataFrame."""
    contract = CONTRACTS[table]
    df = silver(table)
    raw_metrics = {"raw_rows": F.count(F.lit(1))}
    casts = failed_casts(raw, table)
    if casts is not None:
        raw_metrics["failed_casts"] = casts
    parts = [_metrics(raw.agg(*[v.alias(k) for k, v in raw_metrics.items()]), table, list(raw_metrics))]

    # One pass grouped by the business key yields rows, NULL keys, duplicate
    # keys and the table's extra conditions (partial aggregation map-side).
    extras = EXTRA_METRICS.get(table, {})
    per_key = df.groupBy(*contract.key).agg(
        F.count(F.lit(1)).alias("n"),
        *[count_when(condition()).alias(name) for name, condition in extras.items()],
    )
    n = F.col("n")
    silver_metrics = {
        "silver_rows": F.sum(n),
        "null_keys": F.sum(F.when(any_null(contract.key), n).otherwise(0)),
        **{name: F.sum(name) for name in extras},
        "duplicate_keys": count_when(n > 1),
    }
    parts.append(_metrics(per_key.agg(*[v.alias(k) for k, v in silver_metrics.items()]), table, list(silver_metrics)))

    for child, parent, key in ORPHAN_RELATIONS:
        if child != table:
            continue
        keyed = key_presence(df, silver(parent), [key])
        metric = f"orphans_{parent}"
        counted = keyed.agg(F.sum(F.when(F.col("found").isNull(), F.col("n")).otherwise(0)).alias(metric))
        parts.append(_metrics(counted, table, [metric]))
    return reduce(DataFrame.unionByName, parts)


def rejections(table: str, raw: DataFrame) -> DataFrame:
    """Why raw rows do not reach silver, in one grouped pass: rows that each
    rule of the contract rejects (a row may break several), rows rejected at
    all, and surplus rows of repeated keys among the others (A02, A03, P07-P11)."""
    contract = CONTRACTS[table]
    rules = {f"null_{c}": F.col(c).isNull() for c in contract.not_null}
    rules |= {f"blank_{c}": ~null_as_false(F.length(c) > 0) & F.col(c).isNotNull() for c in contract.non_blank}
    rules |= {f"negative_{c}": ~null_as_false(F.col(c) >= 0) for c in contract.non_negative}
    rules |= {f"out_of_range_{c}": ~null_as_false(F.col(c).between(lo, hi)) for c, lo, hi in contract.ranges}
    kept = null_as_false(row_filter(contract))
    cleaned = raw.select(*[clean(c.rule, c.source).alias(c.target) for c in contract.columns])
    per_key = cleaned.groupBy(*contract.key).agg(
        count_when(kept).alias("n"), count_when(~kept).alias("rejected_rows"),
        *[count_when(c).alias(name) for name, c in rules.items()],
    )
    totals = {name: F.sum(name) for name in rules} | {
        "rejected_rows": F.sum("rejected_rows"),
        "repeated_keys": count_when(F.col("n") > 1),
        "surplus_rows": F.sum(F.greatest(F.col("n") - 1, F.lit(0))),
    }
    return _metrics(per_key.agg(*[v.alias(k) for k, v in totals.items()]), table, list(totals))
