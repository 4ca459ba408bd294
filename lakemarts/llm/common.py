"""Helpers shared by the operators: shipping the package to the executors,
lineage cuts in the shared folder, connected components, table reading."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid
import zipfile
from functools import reduce
from pathlib import Path

from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_PACKAGE = Path(__file__).resolve().parent.parent


_BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def ship(spark: SparkSession) -> None:
    """Give the executors' Python workers this package (once a session), and
    let them take whole texts in batches that fit their memory: 1000 rows
    where the session or its platform has set no number."""
    sc = spark.sparkContext
    if _BATCH_ROWS not in spark.conf.getAll:
        spark.conf.set(_BATCH_ROWS, "1000")
    if getattr(sc, "_lakemarts_shipped", False):
        return
    folder = tempfile.mkdtemp(prefix="lakemarts-")  # on the driver only; Spark serves the file
    path = os.path.join(folder, "lakemarts_src.zip")
    with zipfile.ZipFile(path, "w") as z:
        for source in sorted(_PACKAGE.rglob("*.py")):
            z.write(source, Path(_PACKAGE.name) / source.relative_to(_PACKAGE))
    sc.addPyFile(path)
    sc._lakemarts_shipped = True


def shared_dir(spark: SparkSession) -> str:
    """The shared folder of ``spark.checkpoint.dir``.  Where it is unset, a
    scratch folder serves a local master; any other master is an error, as
    its executors would not see the driver's folders."""
    sc = spark.sparkContext
    found = (
        spark.conf.get("spark.checkpoint.dir", None)
        or sc.getConf().get("spark.checkpoint.dir", None)
        or sc.getCheckpointDir()
    )
    if found:
        return found.rstrip("/")
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if not getattr(sc, "_lakemarts_scratch", None):
        sc._lakemarts_scratch = tempfile.mkdtemp(prefix="lakemarts-llm-")
    return sc._lakemarts_scratch


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows of ``df`` as a table in the shared folder: computed once, and
    readable whatever executors are lost afterwards.  Results may still read
    it until the driver ends, which then removes it."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/llm/{label}-{uuid.uuid4().hex}"
    atexit.register(_removed, spark.sparkContext, path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _removed(sc: SparkContext, path: str) -> None:
    """Delete a stored table if its application still runs."""
    if sc._jsc is not None:
        at = sc._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(sc._jsc.hadoopConfiguration()).delete(at, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """``name``, lengthened until ``df`` has no column of that name."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def components(edges: DataFrame) -> DataFrame:
    """Connected components: ``edges(a long, b long)`` to ``(node, label)``,
    the label being the smallest node reachable.  Nodes without an edge are
    not in the result; self loops and nulls are ignored.

    Alternating large and small stars: each round hangs the larger neighbours
    of every node on its smallest one, then its smaller ones.  Both steps are a
    grouped minimum and a join, so a hub is pre-aggregated and its join
    partition can be split; each round is stored, which also cuts lineage.
    """
    cur = stored(
        edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
        "edges",
    )
    before = None
    while True:
        both = cur.unionByName(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(low.select("u", F.col("m").alias("v"))).distinct()
        )
        cur = stored(small, "small")
        now = cur.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == before:
            break
        before = now
    # converged: stars whose centres are the smallest nodes
    return cur.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(
        cur.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
    )
