import os
import tempfile
import threading

import pytest
from pyspark.errors import SparkRuntimeException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from support import SF_SMALL
from lakemarts.contracts import CONTRACTS, SOURCE_FILES
from lakemarts.operators import counts
from lakemarts.operators import quality as Q
from lakemarts.plans import pipeline
from lakemarts.plans.layers import Lake
from lakemarts.plans.queries import comparable, lake, queries, staged
from lakemarts.plans.staged import Staged
from lakemarts.sources.catalog import Catalog
from lakemarts.sources.csv_ingest import MissingColumnsError, MissingSourcesError, ingest_all, open_sources, read_raw_csv, refuse_missing
from lakemarts.sources.driver_tables import DriverTables


def write_csv(df, path):
    (df.coalesce(1).write.mode("overwrite")
     .options(header=True, escape='"', quote='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
     .csv(path))


@pytest.fixture(scope="module")
def raw_dir(spark):
    d = tempfile.mkdtemp(prefix="lakemarts-raw-")
    tables = DriverTables(spark, SF_SMALL)
    for dataset, name in SOURCE_FILES.items():
        write_csv(tables.raw(dataset), os.path.join(d, name))
    return d


@pytest.fixture(scope="module")
def run(spark, raw_dir):
    return pipeline.run_all(spark, raw_dir, prefix="ptest")


def test_csv_scan_quotes_newlines_and_blanks(spark, tmp_path):
    p = tmp_path / "f.csv"
    p.write_text('a,b,c\n"x\ny","say ""hi""", v \n,"",z\n')
    rows = read_raw_csv(spark, str(p)).collect()
    assert rows[0].a == "x\ny" and rows[0].b == 'say "hi"' and rows[0].c == " v "
    assert rows[1].a is None
    assert rows[0]._source_file.endswith("f.csv") and rows[0]._ingested_at is not None


def test_missing_sources_are_listed(spark, tmp_path):
    with pytest.raises(MissingSourcesError, match="olist_orders_dataset.csv"):
        open_sources(spark, str(tmp_path), {"orders": "olist_orders_dataset.csv"})
    (tmp_path / "olist_sellers_dataset.csv").write_text("seller_id,seller_zip_code_prefix,seller_city,seller_state\n")
    catalog = Catalog(spark, "emptysource")
    catalog.create_databases()
    summary = ingest_all(catalog, str(tmp_path), {"sellers": "olist_sellers_dataset.csv"}).collect()
    assert [(r.row_count, r.column_count, r.status) for r in summary] == [(0, 6, "missing")]
    with pytest.raises(MissingSourcesError, match="olist_sellers_dataset.csv"):
        refuse_missing(summary)


def test_part_files_of_different_headers(spark, tmp_path):
    """Every column of every part file is kept, by name, whatever its place."""
    folder = tmp_path / "s.csv" / "day=1"
    folder.mkdir(parents=True)
    (folder / "a.csv").write_text("id,x\n1,a\n2,\n")
    (folder / "b.csv").write_text('y,id,"x"\n"p\nq",3,c\n')
    (folder / "c.csv").write_text("x,id\nd,4\n")
    (folder / "d.csv").write_text("")
    (folder / "_SUCCESS").write_text("no,data\n")
    df = read_raw_csv(spark, str(tmp_path / "s.csv"), required=["id", "x"])
    assert df.columns == ["id", "x", "y", "_source_file", "_ingested_at"]
    rows = sorted((r.id, r.x, r.y, r._source_file[-5:]) for r in df.collect())
    assert rows == [("1", "a", None, "a.csv"), ("2", None, None, "a.csv"), ("3", "c", "p\nq", "b.csv"), ("4", "d", None, "c.csv")]
    with pytest.raises(MissingColumnsError, match="z"):
        read_raw_csv(spark, str(tmp_path / "s.csv"), required=["id", "z"])
    (folder / "e.csv").write_text("id,ID\n1,2\n")
    with pytest.raises(ValueError, match="repeats a column"):
        read_raw_csv(spark, str(tmp_path / "s.csv"))


def test_part_files_with_more_fields_than_their_header_fail(spark, tmp_path):
    (tmp_path / "f.csv").write_text("id,x\n1,a,surplus\n")
    with pytest.raises(Exception, match="MALFORMED|Malformed"):
        read_raw_csv(spark, str(tmp_path / "f.csv"), multiline=False).collect()


def test_one_write_job_per_source(spark, raw_dir):
    """The write counts rows; nothing is read back."""
    catalog = Catalog(spark, "onejob")
    catalog.create_databases()
    df = read_raw_csv(spark, os.path.join(raw_dir, SOURCE_FILES["orders"]), multiline=False)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("one-write", "one write")
    try:
        assert catalog.overwrite(df, "bronze", "orders_raw") == 1500
        assert len(tracker.getJobIdsForGroup("one-write")) == 1
    finally:
        spark.sparkContext.setJobGroup("tests", "tests")


def test_run_counts(run):
    assert run.bronze["order_items"] == 6000
    assert run.silver["order_items"] == 4599 and run.silver["reviews"] == 734
    assert run.gold["fct_orders"] == 1500 and run.gold["dim_date"] == 1094
    assert run.marts["mart_delivery_quality"] == 388


def test_csv_path_equals_direct_path(spark, run):
    catalog = Catalog(spark, "ptest")
    direct = Lake.from_driver_tables(spark, SF_SMALL)
    for name in CONTRACTS:
        a = comparable(catalog.table("silver", name))
        b = comparable(direct.silver.table(name))
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, name
    for mart in ("mart_daily_sales", "mart_customer_summary"):
        a = comparable(catalog.table("marts", mart))
        b = comparable(direct.marts.table(mart))
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, mart


def test_quality_history_and_reports(spark, run):
    catalog = Catalog(spark, "ptest")
    history = catalog.table("monitoring", pipeline.QUALITY_TABLE)
    this_run = history.filter(F.col("run_id") == run.run_id)
    assert this_run.count() == 25 and this_run.filter("status = 'FAIL'").count() == 0
    assert Q.failure_report(history).count() == 0
    assert catalog.table("marts", pipeline.ORDER_COUNT_VIEW).first().order_count == 1500
    assert catalog.table("monitoring", pipeline.MART_TEST_TABLE).count() == 16
    summary = catalog.table("monitoring", pipeline.INGEST_TABLE).orderBy("dataset_name").collect()
    assert [r.dataset_name for r in summary] == sorted(SOURCE_FILES) and summary[0].status == "success"
    counts = {(r.layer, r.table_name): r.row_count for r in pipeline.layer_counts(catalog).collect()}
    assert counts[("gold", "fct_order_items")] == 4599 and len(counts) == 20


def test_gate_stops_run_with_seeded_failure(spark, raw_dir):
    bad_dir = tempfile.mkdtemp(prefix="lakemarts-bad-")
    tables = DriverTables(spark, SF_SMALL)
    for dataset, name in SOURCE_FILES.items():
        df = tables.raw(dataset)
        if dataset == "customers":
            df = df.withColumn("customer_unique_id", F.when(F.col("customer_id") == " C7 ", None)
                               .otherwise(F.col("customer_unique_id")))
        write_csv(df, os.path.join(bad_dir, name))
    with pytest.raises(Q.QualityGateError):
        pipeline.run_all(spark, bad_dir, prefix="pbad")
    catalog = Catalog(spark, "pbad")
    failed = catalog.table("monitoring", pipeline.QUALITY_TABLE).filter("status = 'FAIL'").collect()
    assert [(r.table_name, r.failed_rows) for r in failed] == [("customers", 1)]
    assert catalog.table("monitoring", pipeline.GATE_TABLE).first().verdict == "FAIL"
    assert not catalog.exists("gold", "fct_orders")  # gold's jobs stopped


def test_overwrite_keeps_schema_or_refuses(spark):
    catalog = Catalog(spark, "ktest")
    catalog.create_databases()
    catalog.overwrite_same_schema(spark.createDataFrame([(1, "a")], "id int, s string"), "bronze", "t")
    catalog.overwrite_same_schema(spark.createDataFrame([(2, "b")], "id int, s string"), "bronze", "t")
    assert [tuple(r) for r in catalog.table("bronze", "t").collect()] == [(2, "b")]
    with pytest.raises(ValueError):
        catalog.overwrite_same_schema(spark.createDataFrame([(3,)], "id int"), "bronze", "t")
    catalog.overwrite(spark.createDataFrame([(3,)], "id int"), "bronze", "t")  # K01 replaces the schema
    assert catalog.table("bronze", "t").columns == ["id"]


def test_readers_find_a_whole_version_during_publishing(spark):
    catalog = Catalog(spark, "pubtest")
    catalog.create_databases()
    rows = 50

    def version(i):
        return spark.range(rows).select(F.lit(i).alias("version"))

    catalog.overwrite(version(0), "gold", "t")
    seen, errors, done = [], [], threading.Event()

    def read():
        while not done.is_set():
            try:
                seen.append([(r.version, r.n) for r in catalog.table("gold", "t").groupBy("version").agg(F.count("*").alias("n")).collect()])
            except Exception as e:  # noqa: BLE001
                errors.append(e)

    readers = [threading.Thread(target=read) for _ in range(3)]
    for r in readers:
        r.start()
    for i in range(1, 9):
        assert catalog.overwrite(version(i), "gold", "t") == rows
    done.set()
    for r in readers:
        r.join()
    assert not errors and len(seen) > 3
    assert all(len(found) == 1 and found[0][1] == rows for found in seen)
    assert len(catalog.versions("gold", "t")) == 2  # the one before stays for its readers


HISTORY = T.StructType([
    T.StructField("x", T.LongType(), False), T.StructField("run_date", T.DateType(), False),
    T.StructField("run_id", T.StringType(), False),
])


def test_repeated_runs_do_not_add_rows_and_nulls_are_refused(spark):
    catalog = Catalog(spark, "histtest")
    catalog.create_databases()

    def run(n, run_id):
        return spark.range(n).select(F.col("id").alias("x"), F.expr("date'2024-05-06'").alias("run_date"), F.lit(run_id).alias("run_id"))

    for n, run_id in ((3, "a"), (4, "b"), (2, "a")):
        catalog.record(run(n, run_id), "monitoring", "h", HISTORY, run_id)
    counts = {r.run_id: r["count"] for r in catalog.table("monitoring", "h").groupBy("run_id").count().collect()}
    assert counts == {"a": 2, "b": 4}
    with pytest.raises(SparkRuntimeException, match="NULL in column x"):
        catalog.record(run(3, "c").withColumn("x", F.nullif("x", F.lit(1))), "monitoring", "h", HISTORY, "c")
    assert catalog.table("monitoring", "h").count() == 6


def test_plans_behind_a_failed_gate_raise(spark):
    results = spark.createDataFrame(
        [("orders", "c1", "CRITICAL", "FAIL", 3), ("orders", "c2", "CRITICAL", "PASS", 0), ("x", "c3", "WARNING", "FAIL", 1)],
        "table_name string, check_name string, severity string, status string, failed_rows long",
    )
    verdict = Q.gate(results)
    assert verdict.collect() == [("FAIL", 1, "orders: c1 (3 rows)")]
    with pytest.raises(SparkRuntimeException, match="orders: c1"):
        Q.gated(spark.range(5), verdict).collect()
    passed = Q.gate(results.where("check_name <> 'c1'"))
    assert passed.collect() == [("PASS", 0, None)]
    assert Q.gated(spark.range(5), passed).count() == 5


def test_reconciliation_tells_facts_that_differ(spark):
    direct = Lake.from_driver_tables(spark, SF_SMALL)
    facts = {f: direct.gold.stored(f) for f in ("fct_orders", "fct_order_items")}
    assert [r.status for r in Q.reconciliation(facts.get, direct.silver.stored).collect()] == ["PASS", "PASS"]
    # as many rows, but one of them twice and one lost
    orders = facts["fct_orders"]
    first, second = [r.order_id for r in orders.select("order_id").orderBy("order_id").limit(2).collect()]
    swapped = orders.where(F.col("order_id") != first).unionByName(orders.where(F.col("order_id") == second))
    nulls = facts["fct_order_items"].withColumn("seller_key", F.nullif("seller_key", F.lit(None)))
    nulls = nulls.withColumn("seller_key", F.when(F.col("order_item_id") > 1, F.col("seller_key")))
    found = {r.fact_name: r for r in Q.reconciliation({"fct_orders": swapped, "fct_order_items": nulls}.get, direct.silver.stored).collect()}
    o, i = found["fct_orders"], found["fct_order_items"]
    assert o.status == "FAIL" and o.fact_rows == o.source_rows and o.source_checksum != o.fact_checksum
    assert i.status == "FAIL" and i.source_checksum == i.fact_checksum and i.null_key_rows > 0
    assert f"seller_key={i.null_key_rows}" in i.nulls_by_key and "product_key=0" in i.nulls_by_key


def test_reports_built_together_can_both_be_read(spark):
    own = queries()
    built = [own[name](spark, SF_SMALL) for name in ("dq_summary", "dq_failures", "fct_orders_gated", "dq_history", "dq_summary")]
    counts = [df.count() for df in built]
    assert counts[0] == counts[4] == 2 and counts[1] == 0 and counts[2] == 1500 and counts[3] == 31


def test_reports_tell_of_all_silver_checks(spark):
    own = queries()
    summary = own["dq_summary"](spark, SF_SMALL).collect()
    assert sum(r.check_count for r in summary) == 25
    # over planted defects: every failed check of silver, none of the raw run
    history = staged(lake(spark, SF_SMALL, True)).history()
    failed = {(r.table_name, r.check_name) for r in own["seeded_dq_results"](spark, SF_SMALL).collect() if r.status == "FAIL"}
    assert failed and {(r.table_name, r.check_name) for r in Q.failure_report(history).collect()} == failed


def test_tables_are_staged_one_by_one(spark):
    own = Staged(Lake.from_driver_tables(spark, SF_SMALL))
    assert own.silver("customers").count() == 150
    assert own.catalog.exists("bronze", "customers_raw") and not own.catalog.exists("bronze", "order_items_raw")
    assert not own.catalog.exists("silver", "orders")
    assert [r.dataset_name for r in own.ingestion_summary().collect()] == sorted(CONTRACTS)
    assert own.bronze("order_items").count() == own.lake.raw("order_items").count()
    assert len(own.catalog.versions("bronze", "customers_raw")) == 1  # not ingested again
    own.close()


def test_layers_read_small_splits_and_write_dense_files(spark, tmp_path):
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    try:
        spark.conf.unset(key)
        own = Lake.from_driver_tables(spark, SF_SMALL)
        assert spark.conf.get(key) == "16m"
        spark.conf.set(key, "3m")
        assert any(f.endswith(".zstd.parquet") for f in os.listdir(own.silver.folder("sellers").removeprefix("file:")))
        Lake.from_driver_tables(spark, SF_SMALL)
        assert spark.conf.get(key) == "3m"
    finally:
        spark.conf.set(key, before)


def test_counts_come_from_file_statistics(spark, tmp_path):
    folder = str(tmp_path / "t")
    spark.range(1000).selectExpr("id", "id * 2 as b").write.parquet(folder)
    before = {k: spark.conf.get(k) for k in ("spark.sql.sources.useV1SourceList", "spark.sql.parquet.aggregatePushdown")}
    found = counts.layer_counts(spark, [("x", "files", folder), ("x", "rows", spark.range(7))])
    assert "PushedAggregation: [COUNT(*)]" in found._jdf.queryExecution().executedPlan().toString()
    assert [tuple(r) for r in found.collect()] == [("x", "files", 1000), ("x", "rows", 7)]
    assert before == {k: spark.conf.get(k) for k in before}
