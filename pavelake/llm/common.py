"""What several operators share: checked inputs, checkpoints, broadcast only below a proven size, folds."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

BROADCAST_ROWS = 200_000  # a side is broadcast only when it was counted and has no more rows than this


def ready(spark: SparkSession) -> None:
    """Checkpoints go to spark.checkpoint.dir; a folder of our own serves only where that is unset on a local master."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not context.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
            folder = tempfile.mkdtemp(prefix="checkpoints-")
        context.setCheckpointDir(folder)


def kept(frame: DataFrame) -> DataFrame:
    """The rows, computed once and written to the shared checkpoint folder; no lineage is left to redo."""
    ready(frame.sparkSession)
    return frame.checkpoint(eager=True)


def written(frame: DataFrame, label: str) -> DataFrame:
    """The rows as a Parquet table of their own in the shared folder, read again."""
    spark = frame.sparkSession
    ready(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/{label}-{uuid.uuid4().hex}"
    frame.write.parquet(path)
    return spark.read.parquet(path)


@contextmanager
def narrow_batches(spark: SparkSession, rows: int = 1_000) -> Iterator[None]:
    """Fewer rows per Arrow batch for the jobs run inside, where a row is a whole text."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def small(frame: DataFrame, rows: int, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Mark a side whose rows were counted for broadcasting if there are few; else Spark joins it by shuffling."""
    return F.broadcast(frame) if rows <= limit else frame


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def fold(key: str, parts: int) -> Column:
    """crc32 of the key as text, modulo parts; a null key gives null."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % parts


def outside(key: str, parts: int, part: int) -> Column:
    """Is the row outside the named part? Rows without a key are outside of none and never learned from."""
    return F.coalesce(fold(key, parts) != part, F.lit(False))


def held(key: str, parts: int, part: int) -> Column:
    return F.coalesce(fold(key, parts) == part, F.lit(False))


def pieces(frame: DataFrame, column: str, each: int) -> int:
    """How many pieces of about `each` bytes the column makes: at least one, growing with the data."""
    total = frame.agg(F.sum(F.octet_length(column)).alias("n")).first()["n"] or 0
    return max(1, -(-total // each))


def in_order(frame: DataFrame, *order: str) -> DataFrame:
    """The rows in a global order, nulls first, as written by one sort: with `part`, the range a row fell into, and
    `row`, its place there. No range is gathered anywhere; equal rows may stand in any order."""
    at = F.monotonically_increasing_id()
    rows = kept(frame.orderBy(*order).withColumn("_at", at))
    return rows.withColumns({"part": F.shiftright("_at", 33), "row": F.col("_at").bitwiseAND((1 << 33) - 1)}).drop("_at")


def ranked(frame: DataFrame, *order: str) -> DataFrame:
    """The rows with `pos`, their place from 0 in the global order. What is summed and broadcast for it has one row a
    range, which the number of partitions bounds."""
    rows = in_order(frame, *order)
    sizes = rows.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    return rows.join(F.broadcast(starts), "part").withColumn("pos", F.col("start") + F.col("row")).drop("part", "row", "start")


def together(frames: list[DataFrame]) -> DataFrame:
    """All rows of frames with the same columns, in no more partitions than a shuffle would make."""
    limit = int(frames[0].sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return reduce(DataFrame.unionByName, frames).coalesce(limit)
