"""Spark session settings for the pipeline.

On a cluster the session is normally created by the platform; ``build_session``
only fills in settings that are still unset, so cluster-provided values (for
example ``spark.checkpoint.dir`` or the shuffle partition count) always win.
"""

from __future__ import annotations

import tempfile
import threading
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import SparkConf, SparkContext
from pyspark.sql import SparkSession

#: What the layers' jobs need to sort and group their partitions in memory: a
#: scan of 16 MB of Parquet is some 0.5 GB of sorted string rows, a shuffle
#: partition of 16 MB some 0.3 GB in the hash tables of a grouping.  With
#: Spark's own 128 and 64 MB the tasks grow with the tables until they spill.
TASK_CONF = {
    "spark.sql.files.maxPartitionBytes": "16m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
}
#: How tables between the stages are written: keys that are digests are half
#: as large as with snappy, and a row group is no larger than a scan's split.
TABLE_OPTIONS = {"compression": "zstd", "parquet.block.size": str(16 << 20)}

# Settings the plans rely on.  AQE re-plans joins from measured shuffle sizes
# (a join side is broadcast only when its real size is under the threshold),
# coalesces small shuffle partitions and splits skewed ones.
DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # No broadcast from static estimates: a Parquet size estimate is the
    # compressed file size and can under-count memory many times over.  AQE
    # broadcasts a join side only after its shuffle has run and its real
    # size is known to be under the threshold; otherwise the join stays a
    # sort-merge join.  Explicit broadcasts in the plans are of counted rows
    # (missing keys) or bounded by construction (the 25 nations).
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    **TASK_CONF,
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def fill_task_conf(spark: SparkSession) -> None:
    """``TASK_CONF`` for keys that neither session nor platform has set."""
    present = spark.conf.getAll
    for key, value in TASK_CONF.items():
        if key not in present:
            spark.conf.set(key, value)


_FREES_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_writers_guard = threading.Lock()


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """While it lasts, the shuffle files of a query go when the query ends: for
    writes of tables that are read back from their copy.  Otherwise they stay
    on the executors' disks beside the copy, for as long as the driver keeps
    the plan.  Writers may overlap in several threads; the last one leaves the
    setting as the first one found it."""
    with _writers_guard:
        held = vars(spark).setdefault("_lakemarts_writers", [0, None])
        if not held[0]:
            held[1] = spark.conf.get(_FREES_SHUFFLES, None) if _FREES_SHUFFLES in spark.conf.getAll else None
            spark.conf.set(_FREES_SHUFFLES, "true")
        held[0] += 1
    try:
        yield
    finally:
        with _writers_guard:
            held[0] -= 1
            if not held[0]:
                if held[1] is None:
                    spark.conf.unset(_FREES_SHUFFLES)
                else:
                    spark.conf.set(_FREES_SHUFFLES, held[1])


def build_session(
    master: str | None = None,
    app_name: str = "lakemarts",
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """A session with ``conf`` and, for keys that neither ``conf`` nor the
    platform sets, the defaults above.  An active session keeps whatever it
    has set, its time zone included."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    given = dict(conf or {})
    active = SparkSession.getActiveSession()
    if active is not None:
        present = set(active.conf.getAll)
    else:
        # starts the JVM, which knows spark-defaults.conf and submit options
        SparkContext._ensure_initialized(conf=SparkConf(loadDefaults=False).setAll(given.items()))
        present = {key for key, _ in SparkConf().getAll()}
    for key, value in {**{k: v for k, v in DEFAULT_CONF.items() if k not in present}, **given}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint directory, creating a scratch one only for tests.

    A cluster names a shared folder in ``spark.checkpoint.dir``; that value is
    used as is.  Only a local master gets a temporary folder when it is unset:
    executors of any other master would each write to a disk of their own.
    """
    sc = spark.sparkContext
    active = sc.getCheckpointDir()
    if active:
        return active
    current = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not current:
        require_local(sc.master)
        current = tempfile.mkdtemp(prefix="lakemarts-ckpt-")
    sc.setCheckpointDir(current)
    return current


def require_local(master: str) -> None:
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError(f"master {master}: set spark.checkpoint.dir to a folder that all executors share")
