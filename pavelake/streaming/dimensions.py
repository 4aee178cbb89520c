"""Dimension tables kept up to date by a stream, without any streaming state.

``dropDuplicates`` on a handful of keys would send every clean row to a handful of tasks. Here each
micro-batch is first reduced to its distinct keys, which combines before the shuffle, and only keys
the table does not hold yet are appended. The table itself is the memory.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from pavelake.operators.star import DIMENSIONS
from pavelake.schemas import DIM_ROAD, DIM_WEATHER, DIM_ZONE
from pavelake.sources.tables import BATCH, path_exists, read_batches
from pavelake.streaming.sinks import Trigger, batch_sink, write_batch


BATCH_COLUMN = BATCH.rstrip("=")
SCHEMAS = {"dim_zone": DIM_ZONE, "dim_road": DIM_ROAD, "dim_weather": DIM_WEATHER}


def _stored(spark: SparkSession, name: str, path: str, fmt: str) -> DataFrame:
    """What is committed. A batch that is being written, or was left half written, is not read."""
    return read_batches(spark, path, StructType([*SCHEMAS[name], StructField(BATCH_COLUMN, LongType())]), fmt)


def add_new_keys(keys: DataFrame, batch_id: int, name: str, path: str, fmt: str = "parquet") -> None:
    """Append the dimension rows of keys not stored by an earlier batch."""
    key, attributes = DIMENSIONS[name]
    spark = keys.sparkSession
    new = keys.select(key).distinct()
    if path_exists(spark, path):
        known = _stored(spark, name, path, fmt)
        if fmt != "delta":
            # A repeated batch must not take its own first attempt for something known.
            known = known.filter(F.col(BATCH_COLUMN) < batch_id)
        new = new.join(known.select(key), key, "left_anti")
    rows = attributes(new).persist()
    try:
        if not rows.isEmpty():
            write_batch(rows, batch_id, path, fmt, name)
    finally:
        rows.unpersist()


def dimension_sink(
    silver: DataFrame,
    paths: dict[str, str],
    checkpoint: str,
    *,
    names: Sequence[str] | None = None,
    fmt: str = "parquet",
    query: str = "dimensions",
    trigger: Trigger = None,
) -> StreamingQuery:
    """Maintain the dimensions in ``paths`` from one scan of the clean table."""
    wanted = list(names or paths)
    columns = [DIMENSIONS[name][0] for name in wanted]

    def maintain(batch: DataFrame, batch_id: int) -> None:
        combinations = batch.select(*columns).distinct().persist()
        try:
            for name in wanted:
                add_new_keys(combinations, batch_id, name, paths[name], fmt)
        finally:
            combinations.unpersist()

    return batch_sink(silver.select(*columns), checkpoint, maintain, name=query, trigger=trigger)


def read_dimension(spark: SparkSession, name: str, path: str, fmt: str = "parquet") -> DataFrame:
    return _stored(spark, name, path, fmt).select(*SCHEMAS[name].fieldNames())
