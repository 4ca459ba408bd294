"""The staged batch run: bronze → silver → quality gate → gold → marts.

Each stage writes tables and the next stage reads them, so every layer is a
lineage cut (a lost executor costs at most the current stage) and later
stages scan compact Parquet instead of re-parsing CSV.  A stage starts only
after the previous one succeeded.  The quality gate is part of gold's plans:
gold reads silver through the recorded verdict, and its jobs fail where the
verdict does.  Facts are staged as versions no reader sees, reconciled (Q16)
and key-checked (Q17) in one job, and only then published.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce

from pyspark.errors import SparkRuntimeException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemarts.contracts import CONTRACTS
from lakemarts.operators import counts
from lakemarts.operators import profile as P
from lakemarts.operators import quality as Q
from lakemarts.operators.cleanse import cleanse
from lakemarts.plans.layers import DIMENSIONS, FACTS, MART_TABLES, SILVER_TABLES, Gold, Marts
from lakemarts.sources.catalog import Catalog
from lakemarts.sources.csv_ingest import ingest_all, refuse_missing

INGEST_TABLE = "ingestion_summary"
QUALITY_TABLE = "data_quality_results"
SUMMARY_TABLE = "data_quality_summary"
FAILURE_TABLE = "data_quality_failures"
PROFILE_TABLE = "cleansing_profile"
MART_TEST_TABLE = "mart_test_results"
GATE_TABLE = "quality_gate"
RECONCILIATION_TABLE = "fact_reconciliation"
ORDER_COUNT_VIEW = "check_gold_connection"


class ReconciliationError(AssertionError):
    pass


class MartTestError(AssertionError):
    pass


@dataclass
class RunReport:
    run_id: str = ""
    bronze: dict[str, int] = field(default_factory=dict)
    silver: dict[str, int] = field(default_factory=dict)
    gold: dict[str, int] = field(default_factory=dict)
    marts: dict[str, int] = field(default_factory=dict)


def concurrently(tasks: dict[str, Callable[[], int]]) -> dict[str, int]:
    """Run independent table writes as concurrent Spark jobs; the first
    failure is re-raised after all have finished."""
    with ThreadPoolExecutor(max_workers=min(len(tasks), 8)) as pool:
        futures = {name: pool.submit(task) for name, task in tasks.items()}
        return {name: future.result() for name, future in futures.items()}


def bronze_stage(catalog: Catalog, raw_dir: str, report: RunReport) -> DataFrame:
    summary = ingest_all(catalog, raw_dir)
    catalog.overwrite(summary, "monitoring", INGEST_TABLE)
    rows = summary.collect()  # one per dataset
    report.bronze = {r.dataset_name: r.row_count for r in rows}
    refuse_missing(rows)
    return summary


def write_silver(catalog: Catalog, names: tuple[str, ...] = SILVER_TABLES) -> dict[str, int]:
    """Cleanse bronze tables into silver ones; their row counts."""
    bronze = catalog.provider("bronze")
    return concurrently({
        name: (lambda contract=CONTRACTS[name]: catalog.overwrite(
            cleanse(bronze(contract.raw), contract), "silver", contract.name))
        for name in names
    })


def silver_stage(catalog: Catalog, report: RunReport) -> None:
    report.silver = write_silver(catalog)
    # Profiles read the written tables, not the cleansing plans again.
    bronze, silver = catalog.provider("bronze"), catalog.provider("silver")
    profiles = reduce(
        DataFrame.unionByName,
        [P.profile(name, bronze(CONTRACTS[name].raw), silver) for name in CONTRACTS],
    )
    catalog.overwrite(profiles, "monitoring", PROFILE_TABLE)


def record_results(catalog: Catalog, checks: DataFrame, layer: str) -> tuple[str, DataFrame]:
    """Q07: run the checks once into the history; the run and its rows."""
    run_id, checked_at = Q.new_run()
    results = Q.dated(Q.finish_results(checks, run_id, checked_at, layer))
    catalog.record(results, "monitoring", QUALITY_TABLE, Q.HISTORY_SCHEMA, run_id)
    return run_id, catalog.table("monitoring", QUALITY_TABLE).filter(F.col("run_id") == run_id)


def quality_stage(catalog: Catalog, report: RunReport) -> DataFrame:
    checks = Q.quality_checks(catalog.provider("silver"), catalog.table("bronze", CONTRACTS["reviews"].raw))
    report.run_id, results = record_results(catalog, checks, "silver")
    # Both reports read the stored history, so no check runs twice.
    history = catalog.table("monitoring", QUALITY_TABLE)
    catalog.overwrite(Q.summary_report(history), "monitoring", SUMMARY_TABLE)
    catalog.overwrite(Q.failure_report(history), "monitoring", FAILURE_TABLE)
    catalog.overwrite(Q.gate(results), "monitoring", GATE_TABLE)
    return results


def gated_silver(catalog: Catalog) -> Callable[[str], DataFrame]:
    """Silver tables that only a passed gate lets through."""
    verdict = catalog.table("monitoring", GATE_TABLE)
    return lambda name: Q.gated(catalog.table("silver", name), verdict)


def gold_stage(catalog: Catalog, report: RunReport) -> None:
    silver = gated_silver(catalog)
    builder = Gold(silver)
    report.gold.update(concurrently({
        dim: (lambda dim=dim: catalog.overwrite(builder.table(dim), "gold", dim)) for dim in DIMENSIONS
    }))
    # The gate passed on these silver tables (not-null, uniqueness and the
    # six foreign keys are CRITICAL), so the facts need no dimension joins.
    facts = Gold(silver, dims=catalog.provider("gold"), integrity_proven=True)
    # Both facts are staged and validated before either is published.
    staged = concurrently({
        fact: (lambda fact=fact: catalog.stage(facts.table(fact), "gold", fact)) for fact in FACTS
    })
    found = Q.reconciliation(lambda fact: catalog.table("gold", staged[fact][0]), catalog.provider("silver"))
    catalog.overwrite(found, "monitoring", RECONCILIATION_TABLE)
    failed = catalog.table("monitoring", RECONCILIATION_TABLE).filter("status = 'FAIL'").collect()  # two rows at most
    if failed:
        raise ReconciliationError("; ".join(
            f"{r.fact_name}: {r.fact_rows} of {r.source_rows} rows, {r.null_key_rows} with a NULL key" for r in failed
        ))
    for fact in FACTS:
        catalog.publish(staged[fact][0], "gold", fact)
        report.gold[fact] = staged[fact][1]


def mart_stage(catalog: Catalog, report: RunReport) -> DataFrame:
    marts = Marts(catalog.provider("gold"))
    report.marts = concurrently({
        mart: (lambda mart=mart: catalog.overwrite(marts.table(mart), "marts", mart)) for mart in MART_TABLES
    })
    catalog.create_view(
        "marts", ORDER_COUNT_VIEW, f"SELECT count(*) AS order_count FROM {catalog.name('gold', 'fct_orders')}"
    )
    tests = Q.mart_tests(catalog.provider("marts"))
    catalog.overwrite(tests, "monitoring", MART_TEST_TABLE)
    written = catalog.table("monitoring", MART_TEST_TABLE)
    failed = written.filter(F.col("status") == "fail").collect()
    if failed:
        raise MartTestError("; ".join(f"{r.model}.{r.column_name} {r.test_name}: {r.failures}" for r in failed))
    return written


def run_all(spark: SparkSession, raw_dir: str, prefix: str = "lake", location: str | None = None) -> RunReport:
    catalog = Catalog(spark, prefix, location)
    catalog.create_databases()
    report = RunReport()
    bronze_stage(catalog, raw_dir, report)
    silver_stage(catalog, report)
    quality_stage(catalog, report)
    try:
        gold_stage(catalog, report)
    except SparkRuntimeException as e:
        if Q.GATE_FAILED not in str(e):
            raise
        raise Q.QualityGateError(str(e)) from e
    mart_stage(catalog, report)
    return report


def layer_counts(catalog: Catalog) -> DataFrame:
    """U01 over the written tables, ordered by layer and name."""
    names = [("bronze", CONTRACTS[t].raw) for t in SILVER_TABLES]
    names += [("silver", t) for t in SILVER_TABLES] + [("gold", t) for t in DIMENSIONS + FACTS]
    return counts.layer_counts(catalog.spark, [(layer, t, catalog.table(layer, t)) for layer, t in names])
