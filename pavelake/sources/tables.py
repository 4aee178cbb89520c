"""Tables by path: as a batch, as a stream, or as the newest complete version."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from pavelake.config import LakeConfig
from pavelake.schemas import VALIDATED
from pavelake.session import few_listing_tasks

VERSION = "version="
BATCH = "batch_id="

# A table that is written batch by batch has the batch's number as a column.
BATCHED = StructType([*VALIDATED, StructField(BATCH.rstrip("="), LongType())])


def _hadoop_path(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def ensure_folder(spark: SparkSession, path: str) -> str:
    fs, folder = _hadoop_path(spark, path)
    fs.mkdirs(folder)
    return path


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, target = _hadoop_path(spark, path)
    return fs.exists(target)


def read_table(spark: SparkSession, path: str, fmt: str = "parquet", schema: StructType | None = None) -> DataFrame:
    """Snapshot. Goes through the table's commit log where there is one, never over loose files."""
    reader = spark.read.format(fmt)
    if schema is not None and fmt != "delta":
        reader = reader.schema(schema)
    return reader.load(path)


def stream_table(
    spark: SparkSession,
    path: str,
    schema: StructType,
    fmt: str = "parquet",
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """What the table holds now, then what is appended. The folder may still be empty."""
    reader = spark.readStream.format(fmt)
    if fmt != "delta":
        ensure_folder(spark, path)
        reader = reader.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    with few_listing_tasks(spark):
        return reader.load(path)


def list_versions(spark: SparkSession, path: str, prefix: str = VERSION) -> list[int]:
    """Versions, or other numbered folders, whose write was committed, oldest first."""
    fs, folder = _hadoop_path(spark, path)
    if not fs.exists(folder):
        return []
    found = []
    for status in fs.listStatus(folder):
        name = status.getPath().getName()
        if name.startswith(prefix) and path_exists(spark, f"{path}/{name}/_SUCCESS"):
            found.append(int(name[len(prefix):]))
    return sorted(found)


def subfolders(spark: SparkSession, path: str, prefix: str) -> list[str]:
    """Names of the folders below a path that start so, in order."""
    fs, folder = _hadoop_path(spark, path)
    if not fs.exists(folder):
        return []
    found = (s.getPath().getName() for s in fs.listStatus(folder) if s.isDirectory())
    return sorted(name for name in found if name.startswith(prefix))


def has_files(spark: SparkSession, path: str) -> bool:
    fs, folder = _hadoop_path(spark, path)
    return fs.exists(folder) and len(fs.listStatus(folder)) > 0


def drop_versions(spark: SparkSession, path: str, older_than_seconds: float) -> None:
    """Delete versions that were replaced longer ago than that; the newest one always stays."""
    versions = list_versions(spark, path)
    for version, following in zip(versions, versions[1:]):
        fs, replaced = _hadoop_path(spark, f"{path}/{VERSION}{following}/_SUCCESS")
        if time.time() - fs.getFileStatus(replaced).getModificationTime() / 1000 >= older_than_seconds:
            fs.delete(_hadoop_path(spark, f"{path}/{VERSION}{version}")[1], True)


def drop_folder(spark: SparkSession, path: str) -> None:
    fs, folder = _hadoop_path(spark, path)
    if fs.exists(folder):
        fs.delete(folder, True)


def read_batches(spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet") -> DataFrame:
    """Committed batches of a table that is written batch by batch; none that is being written or was left half done."""
    if fmt == "delta":
        return spark.read.format(fmt).load(path)
    batches = [f"{path}/{BATCH}{n}" for n in list_versions(spark, path, BATCH)]
    if not batches:
        return spark.createDataFrame([], schema)
    return spark.read.format(fmt).schema(schema).option("basePath", path).load(batches)


def read_latest(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Newest committed version of a table that is replaced as a whole."""
    if fmt == "delta":
        return spark.read.format(fmt).load(path)
    versions = list_versions(spark, path)
    if not versions:
        raise FileNotFoundError(f"no committed version of a table under {path}")
    return spark.read.format(fmt).load(f"{path}/{VERSION}{versions[-1]}")


def read_validated(spark: SparkSession, cfg: LakeConfig, outcome: str | None = None) -> DataFrame:
    """Validated table; ``outcome`` picks one of its two partitions, "OK" or "REJECTED"."""
    if cfg.route_late:
        table = read_batches(spark, cfg.table("silver_routed"), BATCHED, cfg.table_format)
    else:
        table = read_table(spark, cfg.table("silver_validated"), cfg.table_format, VALIDATED)
    if outcome is not None:
        table = table.filter(F.col("dq_flag") == outcome)
    return table.select(*VALIDATED.fieldNames())


def read_rejected(spark: SparkSession, cfg: LakeConfig) -> DataFrame:
    return read_validated(spark, cfg, "REJECTED")
