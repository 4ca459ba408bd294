"""Catalog tables: layer databases, writes and reads.

A published table is a view over a *version*: a managed Parquet table of its
own, written whole before the view is switched to it.  ``ALTER VIEW`` replaces
the view's definition in one catalog change, so a reader finds the version
before or the one after, never none.  The version before stays until the next
write, for readers that have resolved it; older ones are dropped.

Writing a layer to tables is also where lineage is cut: the next stage reads
the table, so a lost executor never forces recomputation across stages.  Rows
are counted by the write job itself (``Observation``); nothing is read back.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemarts.session import TABLE_OPTIONS

LAYERS = ("bronze", "silver", "gold", "monitoring", "marts")


def declared(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` in the schema's columns, order and types.  A NULL in a column
    declared NOT NULL fails the job that writes or reads the result."""
    columns = []
    for field in schema:
        c = F.col(field.name).cast(field.dataType)
        if not field.nullable:
            c = F.coalesce(c, F.raise_error(F.lit(f"NULL in column {field.name}")).cast(field.dataType))
        columns.append(c.alias(field.name))
    return df.select(*columns)


class Catalog:
    """Per-layer databases ``<prefix>_<layer>``; ``location`` (optional) is a
    shared folder to hold them instead of the warehouse directory."""

    def __init__(self, spark: SparkSession, prefix: str = "lake", location: str | None = None):
        self.spark = spark
        self.prefix = prefix
        self.location = location.rstrip("/") if location else None

    def database(self, layer: str) -> str:
        return f"{self.prefix}_{layer}"

    def name(self, layer: str, table: str) -> str:
        return f"{self.database(layer)}.{table}"

    def create_databases(self) -> None:
        for layer in LAYERS:
            where = f" LOCATION '{self.location}/{self.database(layer)}.db'" if self.location else ""
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.database(layer)}{where}")

    def drop_databases(self) -> None:
        for layer in LAYERS:
            self.spark.sql(f"DROP DATABASE IF EXISTS {self.database(layer)} CASCADE")

    def table(self, layer: str, table: str) -> DataFrame:
        """S05."""
        return self.spark.table(self.name(layer, table))

    def provider(self, layer: str):
        return lambda table: self.table(layer, table)

    def exists(self, layer: str, table: str) -> bool:
        return self.spark.catalog.tableExists(self.name(layer, table))

    # ---------------------------------------------------------- versions

    def versions(self, layer: str, table: str) -> list[str]:
        """Names of the table's versions, oldest first."""
        found = self.spark.sql(f"SHOW TABLES IN {self.database(layer)} LIKE '{table}__v*'").collect()
        return sorted(r.tableName for r in found if r.tableName.startswith(f"{table}__v"))

    def stage(self, df: DataFrame, layer: str, table: str) -> tuple[str, int]:
        """Write a new version that no reader sees yet; its name and its
        number of rows, counted by the write."""
        version = f"{table}__v{time.time_ns():020d}_{uuid.uuid4().hex[:8]}"
        counted = Observation()
        rows = df.observe(counted, F.count(F.lit(1)).alias("rows"))
        rows.write.format("parquet").mode("error").options(**TABLE_OPTIONS).saveAsTable(self.name(layer, version))
        return version, counted.get["rows"]

    def publish(self, version: str, layer: str, table: str) -> None:
        """Readers of ``table`` see ``version`` from here on."""
        target = self.name(layer, table)
        select = f"SELECT * FROM {self.name(layer, version)}"
        before = [v for v in self.versions(layer, table) if v < version]
        verb = "ALTER VIEW" if self.exists(layer, table) else "CREATE VIEW"
        self.spark.sql(f"{verb} {target} AS {select}")
        for old in before[:-1]:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.name(layer, old)}")

    # ------------------------------------------------------------ writes

    def overwrite(self, df: DataFrame, layer: str, table: str) -> int:
        """Full overwrite, schema included; the rows written."""
        version, rows = self.stage(df, layer, table)
        self.publish(version, layer, table)
        return rows

    def overwrite_same_schema(self, df: DataFrame, layer: str, table: str) -> int:
        """Full overwrite that refuses to change an existing schema."""
        if self.exists(layer, table):
            current = self.table(layer, table).schema
            if [(f.name, f.dataType) for f in current] != [(f.name, f.dataType) for f in df.schema]:
                raise ValueError(f"schema of {self.name(layer, table)} would change")
        return self.overwrite(df, layer, table)

    # ----------------------------------------------------------- history

    def record(self, df: DataFrame, layer: str, table: str, schema: T.StructType, run_id: str) -> None:
        """Add a run to a history table of the declared schema, one
        partition per run date and run.  A repeated run replaces its own
        partition, so it does not add rows twice.  ``schema`` has a date
        ``run_date`` and a string ``run_id`` as its last columns, and all rows
        of ``df`` carry the given ``run_id`` and one date."""
        self.create_history(layer, table, schema)
        rows = declared(df.where(F.col("run_id") == run_id), schema)
        # written as files of the partition first: one job, whatever its plan
        path = f"{self._path(layer, table)}"
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_date", "run_id").parquet(path)
        self.spark.sql(f"MSCK REPAIR TABLE {self.name(layer, table)}")

    def _path(self, layer: str, table: str) -> str:
        home = self.spark.catalog.getDatabase(self.database(layer)).locationUri
        return f"{home.rstrip('/')}/{table}"

    def create_history(self, layer: str, table: str, schema: T.StructType) -> None:
        columns = ", ".join(
            f"{f.name} {f.dataType.simpleString()}{'' if f.nullable else ' NOT NULL'}" for f in schema
        )
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name(layer, table)} ({columns}) USING parquet "
            f"PARTITIONED BY (run_date, run_id) LOCATION '{self._path(layer, table)}'"
        )

    def create_view(self, layer: str, view: str, select_sql: str) -> None:
        """Materialise a SELECT as a view."""
        verb = "ALTER VIEW" if self.exists(layer, view) else "CREATE VIEW"
        self.spark.sql(f"{verb} {self.name(layer, view)} AS {select_sql}")
