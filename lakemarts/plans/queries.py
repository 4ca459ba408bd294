"""Registered queries: one per operator family of the blueprint, each over
the whole benchmark tables of one scale-factor directory.

Each query is one stage of work: a silver query is the cleansing plan over
the raw tables, a gold query reads stored silver, a mart reads stored gold,
checks and profiles read stored silver (see ``layers.Stored``).

Every query returns ``comparable(df)``: the library result with audit
columns (processing times, run ids, source files) dropped and types
normalised the same way as the DuckDB oracle (numbers → double; dates,
timestamps and booleans → strings).  The library functions themselves keep the
reference types (decimal money, int keys, dates).
"""

from __future__ import annotations

import atexit
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemarts.contracts import CONTRACTS
from lakemarts.operators import profile as P
from lakemarts.operators import quality as Q
from lakemarts.operators import counts, tiles
from lakemarts.operators.cleanse import clean_columns, row_filter
from lakemarts.operators.dedup import duplicate_keys
from lakemarts.plans.layers import FACTS, GOLD_DIMS, GOLD_INPUTS, GOLD_TABLES, SILVER_TABLES, Gold, Lake
from lakemarts.plans.staged import Staged
from lakemarts.sources.driver_tables import defective_mart

#: The benchmark tables that the raw tables come from.
LAKE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")
AUDIT = {"_silver_processed_at", "_gold_processed_at", "_source_file", "_ingested_at", "run_id", "checked_at"}

Query = Callable[[SparkSession, str], DataFrame]


def comparable(df: DataFrame) -> DataFrame:
    """The check-facing projection: numbers → double, dates, timestamps and
    booleans → their SQL string form, strings unchanged; audit columns
    dropped.  These types come out identical from Spark and DuckDB however
    the results are fetched (Python tuples or pandas, with or without
    NULLs); a nullable integer, for one, would otherwise arrive as float64
    from Spark and as Int64 from DuckDB."""
    cols = []
    for field in df.schema.fields:
        if field.name in AUDIT:
            continue
        c = F.col(field.name)
        t = field.dataType
        if isinstance(t, T.NumericType):
            c = c.cast("double")
        elif isinstance(t, T.TimestampType):
            c = c.cast("timestamp_ntz").cast("string")
        elif isinstance(t, (T.DateType, T.TimestampNTZType, T.BooleanType)):
            c = c.cast("string")
        cols.append(c.alias(field.name))
    return df.select(*cols)


def _stamp(spark: SparkSession, sf_dir: str) -> tuple:
    """Sizes and times of the tables a lake reads, by which a change shows."""
    sc = spark.sparkContext
    found = []
    for name in LAKE_TABLES:
        path = sc._jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/{name}.parquet")
        status = path.getFileSystem(sc._jsc.hadoopConfiguration()).getFileStatus(path)
        found.append((name, status.getLen(), status.getModificationTime()))
    return tuple(found)


def lake(spark: SparkSession, sf_dir: str, seeded: bool = False) -> Lake:
    """The layered plans over one directory, built once per session and state
    of its tables.

    DataFrames are immutable plans, so queries of the same session share the
    raw, silver and gold DataFrames instead of re-reading Parquet footers and
    re-analysing the same plans for every query.  The session itself holds
    its lakes, so they go with it."""
    held = vars(spark).setdefault("_lakemarts_lakes", {})
    key = (sf_dir.rstrip("/"), seeded, _stamp(spark, sf_dir.rstrip("/")))
    if key not in held:
        held[key] = Lake.from_driver_tables(spark, key[0], seeded)
        atexit.register(held[key].close)
    return held[key]


def staged(lk: Lake) -> Staged:
    if "staged" not in lk.parts:
        lk.parts["staged"] = Staged(lk)
    return lk.parts["staged"]


def quality_results(lk: Lake) -> DataFrame:
    lk.prefetch_silver(SILVER_TABLES)
    run_id, checked_at = Q.new_run()
    checks = Q.quality_checks(lk.silver.stored, lk.raw("reviews"))
    return Q.finish_results(checks, run_id, checked_at)


def gated_fact(lk: Lake, name: str) -> DataFrame:
    """The fact as the staged run builds it: over silver that the gate lets
    through, verdict of the recorded silver run, and without joins to the
    dimensions."""
    verdict = Q.gate(staged(lk).history().where("layer = 'silver'"))
    return Gold(lambda t: Q.gated(lk.silver.stored(t), verdict), integrity_proven=True).table(name)


def fact_reconciliation(lk: Lake, sources: Callable[[str], DataFrame]) -> DataFrame:
    lk.prefetch_gold(FACTS)
    return Q.reconciliation(lk.gold.stored, sources)


def layer_counts(lk: Lake) -> DataFrame:
    lk.prefetch_silver(SILVER_TABLES)
    lk.prefetch_gold(GOLD_TABLES)
    tables = [("bronze", f"{t}_raw", lk.raw(t)) for t in SILVER_TABLES]
    tables += [("silver", t, lk.silver.folder(t)) for t in SILVER_TABLES]
    tables += [("gold", t, lk.gold.folder(t)) for t in GOLD_TABLES]
    return counts.layer_counts(lk.spark, tables)


def _registry() -> dict[str, Query]:
    q: dict[str, Query] = {}

    for t in SILVER_TABLES:
        q[f"silver_{t}"] = lambda s, d, t=t: lake(s, d).silver.table(t)

    def dedup_items(s, d):
        contract = CONTRACTS["order_items"]
        cleaned = clean_columns(lake(s, d).raw("order_items"), contract).filter(row_filter(contract))
        return duplicate_keys(cleaned, contract.key).withColumnRenamed("count", "row_count")

    q["dedup_items"] = dedup_items

    def dedup_reviews(s, d):
        contract = CONTRACTS["reviews"]
        cleaned = clean_columns(lake(s, d).raw("reviews"), contract).filter(row_filter(contract))
        return duplicate_keys(cleaned, contract.key).withColumnRenamed("count", "row_count")

    q["dedup_reviews"] = dedup_reviews

    relations = {f"orphans_{child}_{parent}": (child, parent, key) for child, parent, key in P.ORPHAN_RELATIONS}
    # parents without children; customers and products without any are few
    relations |= {
        "orders_without_items": ("orders", "order_items", "order_id"),
        "orders_without_reviews": ("orders", "reviews", "order_id"),
        "customers_without_orders": ("customers", "orders", "customer_id"),
        "products_without_items": ("products", "order_items", "product_id"),
    }
    for name, (child, parent, key) in relations.items():
        def orphans(s, d, child=child, parent=parent, key=key):
            lk = lake(s, d)
            lk.prefetch_silver([child, parent])
            return P.orphans(lk.silver.stored(child), lk.silver.stored(parent), key)

        q[name] = orphans

    for name in FACTS:
        q[f"{name}_gated"] = lambda s, d, name=name: gated_fact(lake(s, d), name)

    def raw_results(s, d):
        return Q.finish_results(Q.raw_checks(lake(s, d).raw), *Q.new_run(), layer="bronze")

    q["dq_raw_results"] = raw_results
    q["dq_raw_critical_failures"] = lambda s, d: Q.critical_failures(raw_results(s, d))

    # the catalog path: CSV part files, bronze and silver tables, history
    q["ingestion_summary"] = lambda s, d: staged(lake(s, d)).ingestion_summary()
    for t in SILVER_TABLES:
        q[f"bronze_{t}"] = lambda s, d, t=t: staged(lake(s, d)).bronze(t)
        q[f"staged_silver_{t}"] = lambda s, d, t=t: staged(lake(s, d)).silver(t)
    q["dq_history"] = lambda s, d: staged(lake(s, d)).history().drop("run_date")
    q["dq_gate"] = lambda s, d: Q.gate(raw_results(s, d))
    q["dq_gate_silver"] = lambda s, d: Q.gate(staged(lake(s, d)).history().where("layer = 'silver'"))
    q["fact_reconciliation"] = lambda s, d: fact_reconciliation(lake(s, d), lake(s, d).silver.stored)
    # the facts against the raw tables, from which they do differ
    q["fact_reconciliation_raw"] = lambda s, d: fact_reconciliation(lake(s, d), lake(s, d).raw)

    for t in SILVER_TABLES:
        def prof(s, d, t=t):
            lk = lake(s, d)
            lk.prefetch_silver([t] + [p for c, p, _ in P.ORPHAN_RELATIONS if c == t])
            return P.profile(t, lk.raw(t), lk.silver.stored)

        q[f"profile_{t}"] = prof

    for name in ("dim_customers", "dim_products", "dim_sellers", "dim_date",
                 "items_per_order", "payments_per_order", "reviews_per_order", "fct_orders", "fct_order_items"):
        def gold(s, d, name=name):
            lk = lake(s, d)
            lk.prefetch_silver(GOLD_INPUTS[name])
            lk.gold.prefetch(GOLD_DIMS.get(name, ()))
            return lk.gold.table(name)

        q[name] = gold

    for name in ("mart_daily_sales", "mart_product_performance", "mart_customer_summary",
                 "mart_delivery_quality", "gold_order_count"):
        def mart(s, d, name=name):
            lk = lake(s, d)
            lk.prefetch_mart_inputs([name])
            return lk.marts.table(name)

        q[name] = mart

    def stored_mart(s, d, name):
        lk = lake(s, d)
        lk.prefetch_marts([name])
        return lk.marts.stored(name)

    daily = lambda s, d: stored_mart(s, d, "mart_daily_sales")
    products = lambda s, d: stored_mart(s, d, "mart_product_performance")
    delivery = lambda s, d: stored_mart(s, d, "mart_delivery_quality")
    q["tile_total_orders"] = lambda s, d: tiles.total_orders(daily(s, d))
    q["tile_delivered_orders"] = lambda s, d: tiles.delivered_orders(daily(s, d))
    q["tile_total_revenue"] = lambda s, d: tiles.total_revenue(daily(s, d))
    q["tile_monthly_orders"] = lambda s, d: tiles.monthly_orders(daily(s, d))
    q["tile_monthly_revenue"] = lambda s, d: tiles.monthly_revenue(daily(s, d))
    q["tile_top_categories_revenue"] = lambda s, d: tiles.top_categories_by_revenue(products(s, d))
    q["tile_top_categories_units"] = lambda s, d: tiles.top_categories_by_units(products(s, d))
    q["tile_average_delivery_days"] = lambda s, d: tiles.average_delivery_days(lake(s, d).gold.stored("fct_orders"))
    q["tile_late_orders"] = lambda s, d: tiles.late_orders(delivery(s, d))
    q["tile_late_orders_trend"] = lambda s, d: tiles.late_orders_trend(delivery(s, d))

    q["dq_results"] = lambda s, d: quality_results(lake(s, d))
    q["dq_summary"] = lambda s, d: Q.summary_report(staged(lake(s, d)).history())
    q["dq_failures"] = lambda s, d: Q.failure_report(staged(lake(s, d)).history())

    def mart_tests(s, d):
        lk = lake(s, d)
        lk.prefetch_marts(Q.MART_TESTS)
        return Q.mart_tests(lk.marts.stored)

    q["mart_tests"] = mart_tests
    # checks, profiles and reports over raw tables with planted defects
    def rejections(s, d, seeded):
        raw = lake(s, d, seeded).raw
        return reduce(DataFrame.unionByName, [P.rejections(t, raw(t)) for t in SILVER_TABLES])

    q["rejections"] = lambda s, d: rejections(s, d, False)
    q["seeded_rejections"] = lambda s, d: rejections(s, d, True)
    q["seeded_dq_results"] = lambda s, d: quality_results(lake(s, d, True))
    q["seeded_dq_gate"] = lambda s, d: Q.gate(quality_results(lake(s, d, True)))

    def seeded_profiles(s, d):
        lk = lake(s, d, True)
        lk.prefetch_silver(SILVER_TABLES)
        return reduce(DataFrame.unionByName, [P.profile(t, lk.raw(t), lk.silver.stored) for t in SILVER_TABLES])

    q["seeded_profiles"] = seeded_profiles
    for child, parent, key in P.ORPHAN_RELATIONS:
        if parent in ("customers", "products", "sellers"):
            def seeded_orphans(s, d, child=child, parent=parent, key=key):
                lk = lake(s, d, True)
                lk.prefetch_silver([child, parent])
                return P.orphans(lk.silver.stored(child), lk.silver.stored(parent), key)

            q[f"seeded_orphans_{child}_{parent}"] = seeded_orphans
    for name in FACTS:
        def seeded_fact(s, d, name=name):
            lk = lake(s, d, True)
            lk.prefetch_silver(GOLD_INPUTS[name])
            lk.gold.prefetch(GOLD_DIMS.get(name, ()))
            return lk.gold.table(name)

        q[f"seeded_{name}"] = seeded_fact

    def seeded_products(s, d):
        lk = lake(s, d, True)
        lk.prefetch_marts(["mart_product_performance"])
        return lk.marts.stored("mart_product_performance")

    q["seeded_top_categories_revenue"] = lambda s, d: tiles.top_categories_by_revenue(seeded_products(s, d))
    q["seeded_top_categories_units"] = lambda s, d: tiles.top_categories_by_units(seeded_products(s, d))

    def defective_mart_tests(s, d):
        lk = lake(s, d)
        lk.prefetch_marts(Q.MART_TESTS)
        return Q.mart_tests(
            lambda m: defective_mart(lk.marts.stored(m), Q.MART_TESTS[m][1], Q.MART_TESTS[m][0])
        )

    q["defective_mart_tests"] = defective_mart_tests
    q["layer_counts"] = lambda s, d: layer_counts(lake(s, d))
    q["tax_projection"] = lambda s, d: tiles.tax_projection(lake(s, d).gold.stored("fct_orders"))
    return q


def queries() -> dict[str, Query]:
    return {name: (lambda s, d, f=f: comparable(f(s, d))) for name, f in _registry().items()}
