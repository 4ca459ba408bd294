"""CSV files → bronze tables.

Every raw column is read as a string (no inference, so no extra pass over the
data), quoted fields may contain newlines and a doubled quote escapes a quote.
A source is one file or a folder of part files, and part files may differ:
their headers are read first (one line each), files of the same header are one
scan, and the scans are united by column name.  So bronze has every column of
every part file, NULL where a file lacks it; a contract column that no file
has is an error.  Only a dataset whose contract says so (``multiline``) is
parsed across line ends, which cannot split a file: its parallelism is its
number of files.  The others are split by Spark; a quoted line end or any
other malformed row in them fails the job, none is dropped.
"""

from __future__ import annotations

import csv
import os
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemarts.contracts import CONTRACTS, SOURCE_FILES
from lakemarts.sources.catalog import Catalog

LINEAGE = ("_source_file", "_ingested_at")


class MissingSourcesError(FileNotFoundError):
    pass


class MissingColumnsError(ValueError):
    pass


def required_columns(dataset: str) -> list[str]:
    return [c.source for c in CONTRACTS[dataset].columns]


def part_files(spark: SparkSession, path: str) -> list[str]:
    """The files of a source, in order of their names: the path itself, or
    the files in and below a folder; hidden ones are left out as Spark does."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return []
    if fs.getFileStatus(root).isFile():
        return [fs.getFileStatus(root).getPath().toString()]
    found, entries = [], fs.listFiles(root, True)
    while entries.hasNext():
        name = entries.next().getPath().toString()
        below = name[name.index(root.getName()) + len(root.getName()):].split("/")
        if not any(part.startswith(("_", ".")) for part in below):
            found.append(name)
    return sorted(found)


def header(spark: SparkSession, file: str) -> tuple[str, ...] | None:
    """The column names in the first line of a file; None if it is empty."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(file)
    stream = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(path)
    reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
    try:
        line = reader.readLine()
    finally:
        reader.close()
    if line is None:
        return None
    names = [n.strip() or f"_c{i}" for i, n in enumerate(next(csv.reader([line.lstrip("\ufeff")]), []))]
    taken = [n.lower() for n in (*names, *LINEAGE)]
    if len(set(taken)) < len(taken):
        raise ValueError(f"{file}: the header repeats a column or has one of {', '.join(LINEAGE)}")
    return tuple(names)


def read_raw_csv(spark: SparkSession, path: str, multiline: bool = True, required: list[str] = ()) -> DataFrame:
    """The CSV scan of a source with lineage columns.  Columns stand
    in the order of their first appearance over the part files."""
    files = part_files(spark, path)
    if not files:
        raise MissingSourcesError(f"no file at {path}")
    with ThreadPoolExecutor(max_workers=8) as pool:
        headers = list(pool.map(lambda f: header(spark, f), files))
    by_header: dict[tuple[str, ...], list[str]] = {}
    for file, names in zip(files, headers):
        if names is not None:
            by_header.setdefault(names, []).append(file)
    if not by_header:
        raise MissingSourcesError(f"no header in {path}")
    known = {n for names in by_header for n in names}
    lacking = [c for c in required if c not in known]
    if lacking:
        raise MissingColumnsError(f"{path}: no part file has {', '.join(lacking)}")

    def scan(names: tuple[str, ...], own: list[str]) -> DataFrame:
        # the files' own header is the schema, so position and name agree
        schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
        reader = spark.read.schema(schema).options(
            header=True, multiLine=multiline, escape='"', quote='"', mode="FAILFAST"
        )
        return reader.csv(own).select("*", F.col("_metadata.file_path").alias("_source_file"))

    united = reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=True), (scan(n, own) for n, own in by_header.items())
    )
    columns = [c for c in united.columns if c != "_source_file"]
    return united.select(*columns, "_source_file", F.current_timestamp().alias("_ingested_at"))


def source_paths(raw_dir: str, files: dict[str, str] = SOURCE_FILES) -> dict[str, str]:
    return {dataset: os.path.join(raw_dir, name) for dataset, name in files.items()}


def open_sources(spark: SparkSession, raw_dir: str, files: dict[str, str] = SOURCE_FILES) -> dict[str, DataFrame]:
    """S04 pre-flight: open every expected source; fail once, naming all
    that are missing."""
    frames, missing = {}, []
    for dataset, path in source_paths(raw_dir, files).items():
        try:
            frames[dataset] = read_raw_csv(spark, path, CONTRACTS[dataset].multiline, required_columns(dataset))
        except MissingSourcesError:
            missing.append(files[dataset])
    if missing:
        raise MissingSourcesError(f"Missing source files: {', '.join(sorted(missing))}")
    return frames


def ingest(catalog: Catalog, dataset: str, df: DataFrame, source_file: str) -> tuple:
    """Write one bronze table in one job, which counts its rows, and
    return its summary tuple.  S04 after the scan: a source without a row
    (header only) is as missing as an absent one."""
    table = CONTRACTS[dataset].raw
    rows = catalog.overwrite(df, "bronze", table)
    status = "success" if rows else "missing"
    return (dataset, source_file, catalog.name("bronze", table), rows, len(df.columns), status)


SUMMARY_SCHEMA = T.StructType(
    [
        T.StructField("dataset_name", T.StringType(), False),
        T.StructField("source_file", T.StringType(), False),
        T.StructField("table_name", T.StringType(), False),
        T.StructField("row_count", T.LongType(), False),
        T.StructField("column_count", T.IntegerType(), False),
        T.StructField("status", T.StringType(), False),
    ]
)


def ingest_all(catalog: Catalog, raw_dir: str, files: dict[str, str] = SOURCE_FILES) -> DataFrame:
    """Ingest every dataset; summary ordered by dataset name.

    The summary holds one row per dataset (seven), built from the counts of
    the write jobs."""
    frames = open_sources(catalog.spark, raw_dir, files)
    # Datasets are independent: their parse-and-write jobs run concurrently.
    with ThreadPoolExecutor(max_workers=min(len(frames), 8) or 1) as pool:
        rows = list(pool.map(lambda item: ingest(catalog, item[0], item[1], files[item[0]]), frames.items()))
    if not rows:
        raise ValueError("no dataset was ingested")
    return catalog.spark.createDataFrame(rows, SUMMARY_SCHEMA).orderBy("dataset_name")


def refuse_missing(summary: list) -> None:
    """Stop on the summary's rows of sources without data."""
    missing = sorted(r.source_file for r in summary if r.status == "missing")
    if missing:
        raise MissingSourcesError(f"Sources without rows: {', '.join(missing)}")
