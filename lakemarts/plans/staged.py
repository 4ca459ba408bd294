"""The catalog path over benchmark tables: CSV part files → bronze tables →
silver tables, with the quality history beside them (S01-S05, K01-K07, Q07).

The raw tables are written once as CSV under the lake's store.  Every source
is a folder of part files of two layouts, as a feed that gained a column:
rows whose key's MD5 begins with 0-7 have the contract's columns, the others
one more, ``feed_version``.  Ingestion then reads these files and nothing
else.
"""

from __future__ import annotations

import threading
import uuid
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemarts.contracts import CONTRACTS, SOURCE_FILES
from lakemarts.operators import quality as Q
from lakemarts.plans.layers import SILVER_TABLES, Lake
from lakemarts.plans.pipeline import INGEST_TABLE, QUALITY_TABLE, concurrently, record_results, write_silver
from lakemarts.sources.catalog import Catalog
from lakemarts.sources.csv_ingest import ingest_all

ADDED = "feed_version"


def newer_layout(key: str) -> Column:
    return F.substring(F.md5(F.coalesce(F.col(key), F.lit(""))), 1, 1) >= "8"


def write_parts(raw: DataFrame, key: str, path: str) -> int:
    """A source's part files in both layouts, blanks and quotes kept."""
    options = dict(header=True, escape='"', quote='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    newer = newer_layout(key)
    raw.where(~newer).write.mode("overwrite").options(**options).csv(f"{path}/layout=1")
    raw.where(newer).withColumn(ADDED, F.lit("2")).write.mode("overwrite").options(**options).csv(f"{path}/layout=2")
    return 2


class Staged:
    """Each stage is run once, when first asked for; bronze and silver tables
    one by one, so that no table waits for, or pays for, the others."""

    def __init__(self, lake: Lake):
        self.lake = lake
        self.raw_dir = f"{lake.store}/csv"
        self.catalog = Catalog(lake.spark, f"staged_{uuid.uuid4().hex[:12]}", f"{lake.store}/catalog")
        self._lock = threading.RLock()
        self._ingested: dict[str, DataFrame] = {}  # summary rows by table
        self._cleansed: set[str] = set()

    def close(self) -> None:
        self.catalog.drop_databases()

    @cached_property
    def _databases(self) -> bool:
        self.catalog.create_databases()
        return True

    def _ingest(self, *names: str) -> None:
        """The named sources as part files and bronze tables, those that are
        not there yet."""
        with self._lock:
            assert self._databases
            todo = [n for n in names if n not in self._ingested]
            if not todo:
                return
            concurrently({
                name: (lambda name=name: write_parts(
                    self.lake.raw(name), CONTRACTS[name].columns[0].source, f"{self.raw_dir}/{SOURCE_FILES[name]}"))
                for name in todo
            })
            summary = ingest_all(self.catalog, self.raw_dir, {n: SOURCE_FILES[n] for n in todo})
            self._ingested |= {n: summary.where(F.col("dataset_name") == n) for n in todo}

    @cached_property
    def _summary(self) -> bool:
        self._ingest(*SILVER_TABLES)
        rows = reduce(DataFrame.unionByName, self._ingested.values()).orderBy("dataset_name")
        self.catalog.overwrite(rows, "monitoring", INGEST_TABLE)
        return True

    @cached_property
    def _history(self) -> bool:
        assert self._databases
        self.lake.prefetch_silver(SILVER_TABLES)
        record_results(self.catalog, Q.raw_checks(self.lake.raw), "bronze")
        silver = Q.quality_checks(self.lake.silver.stored, self.lake.raw("reviews"))
        record_results(self.catalog, silver, "silver")
        return True

    def _after(self, stage: str) -> None:
        with self._lock:
            getattr(self, stage)

    def ingestion_summary(self) -> DataFrame:
        """K07; table names without this session's prefix."""
        self._after("_summary")
        summary = self.catalog.table("monitoring", INGEST_TABLE)
        return summary.withColumn("table_name", F.substring_index("table_name", ".", -1)).orderBy("dataset_name")

    def bronze(self, name: str) -> DataFrame:
        self._ingest(name)
        return self.catalog.table("bronze", CONTRACTS[name].raw)

    def silver(self, name: str) -> DataFrame:
        with self._lock:
            self._ingest(name)
            if name not in self._cleansed:
                write_silver(self.catalog, (name,))
                self._cleansed.add(name)
        return self.catalog.table("silver", name)

    def history(self) -> DataFrame:
        """Two recorded runs: the checks of raw tables, then all checks of
        silver, which are the latest run that the reports tell of."""
        self._after("_history")
        return self.catalog.table("monitoring", QUALITY_TABLE)
