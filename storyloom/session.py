"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession

# Settings every job here relies on; all are runtime SQL settings, so they can
# be put on a session that somebody else built.
JOB_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A table hashed on the article id alone also serves joins and groupings on
    # (id, term) and (id, sent_idx): no second shuffle of the term tables.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    # Small enough build sides (known at run time) are hashed instead of sorted.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
    # Sides up to this size, measured at run time, are broadcast instead of shuffling pair vectors.
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    # Vector sums aggregate in object hash maps; the default of 128 groups
    # would send nearly every task to the sort-based path, which spills whole vectors.
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "32768",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
}


def tune(spark: SparkSession) -> SparkSession:
    for key, value in JOB_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "storyloom") -> SparkSession:
    """Session for one machine: tests, bench, trying things out."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


def at_once(calls: list[Callable], most: int = 4) -> list:
    """Results of calls that do not need each other; their jobs share the cluster. A call that fails fails all."""
    with ThreadPoolExecutor(max(1, min(most, len(calls)))) as threads:
        return [done.result() for done in [threads.submit(call) for call in calls]]


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; a temporary one only on a local master.

    The folder must be visible to every executor, so a machine-local folder is
    refused as soon as the master is not local.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        folder = tempfile.mkdtemp(prefix="storyloom-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def new_workspace(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared one for the tables of one run."""
    return f"{shared_folder(spark).rstrip('/')}/storyloom/{name}-{uuid.uuid4().hex[:12]}"


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(jvm_path)
