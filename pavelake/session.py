"""One session builder for every job, and the shared folder jobs may write scratch tables to."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Applied only where spark-submit or the cluster has not said otherwise.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Dedup state holds a watermark's worth of keys; it has to live off-heap at scale.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

DELTA = {
    "spark.sql.extensions": "io.delta.sql.DeltaSparkSessionExtension",
    "spark.sql.catalog.spark_catalog": "org.apache.spark.sql.delta.catalog.DeltaCatalog",
}


def build_session(
    app_name: str,
    master: str | None = None,
    *,
    delta: bool = False,
    hive: bool = False,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    if hive:
        builder = builder.enableHiveSupport()
    for key, value in {**(DELTA if delta else {}), **(conf or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    submitted = dict(spark.sparkContext.getConf().getAll())
    for key, value in DEFAULTS.items():
        if key not in submitted and key not in (conf or {}):
            spark.conf.set(key, value)
    return spark


@contextmanager
def setting(spark: SparkSession, name: str, value: str | None) -> Iterator[None]:
    """A setting for what is planned or started inside; None leaves it as it is. A streaming query keeps it."""
    before = spark.conf.get(name)
    try:
        if value is not None:
            spark.conf.set(name, value)
        yield
    finally:
        if value is not None:
            spark.conf.set(name, before)


@contextmanager
def few_listing_tasks(spark: SparkSession) -> Iterator[None]:
    """Folders are listed by a few tasks a core. Left alone, Spark starts a task for each folder or file, up to 10,000
    at a time, and a stream over a table with many dates lists them again and again."""
    name = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    tasks = min(int(spark.conf.get(name)), 4 * spark.sparkContext.defaultParallelism)
    with setting(spark, name, str(tasks)):
        yield


def shared_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder below the one the cluster names in ``spark.checkpoint.dir``.

    Only a local session without that setting (a test on one machine) gets a temporary folder.
    """
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not base:
        base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder all executors can reach")
    return tempfile.mkdtemp(prefix=f"{label}-")


def use_checkpoints(spark: SparkSession) -> None:
    """Give iterative fits a checkpoint folder, keeping one that is already set."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark, "checkpoints"))
