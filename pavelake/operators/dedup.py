"""One row per event, however often the event was delivered."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pavelake.config import EVENT_KEY, WATERMARK

ARRIVAL = ("kafka_timestamp", "raw_json")


def dedup_batch(df: DataFrame, keys: Sequence[str] = EVENT_KEY, order: Sequence[str] = ARRIVAL) -> DataFrame:
    """Keep the first arrival per key, by a total order, so that reruns keep the same row.

    The ``= 1`` filter lets Spark cut every map task's share of a key to one row before the
    shuffle, so a key with very many copies does not fill one reducer.
    """
    first = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_arrival", F.row_number().over(first)).filter("_arrival = 1").drop("_arrival")


def bounded_by_arrival(event_time: str = "event_ts", arrival: str = "kafka_timestamp") -> Column:
    """Time of an event as far as the watermark is concerned: no later than its arrival."""
    return F.least(event_time, arrival)


def copy_slices(spark: SparkSession, wanted: int | None = None) -> int:
    """Slices that a hot key's copies are thinned in: as many as there are shuffle partitions, unless said."""
    return int(spark.conf.get("spark.sql.shuffle.partitions")) if wanted is None else wanted


def dedup_stream(
    df: DataFrame,
    keys: Sequence[str] = EVENT_KEY,
    event_time: str = "event_ts",
    watermark: str = WATERMARK,
    slices: int = 0,
    seen: Column | None = None,
) -> DataFrame:
    """Keep the first arrival per key within the watermark; state is evicted as it advances.

    With ``slices`` the copies of a key are first thinned per slice of input partitions and only
    the survivors meet under the bare key. No task then sees more than a slice of a hot key, at
    the price of a second, equally short-lived state.

    ``seen`` is another time that the watermark follows, while keys stay as they are. Copies of a key are then told
    apart for as long as the watermark has not passed the first one's time and the allowed lateness.
    """
    if seen is not None:
        rows = df.withColumn("_seen", seen).withWatermark("_seen", watermark)
        if slices > 1:
            sliced = rows.withColumn("_slice", F.pmod(F.spark_partition_id(), F.lit(slices)))
            rows = sliced.dropDuplicatesWithinWatermark([*keys, "_slice"]).drop("_slice")
        return rows.dropDuplicatesWithinWatermark(list(keys)).drop("_seen")
    rows = df.withWatermark(event_time, watermark)
    if slices > 1:
        sliced = rows.withColumn("_slice", F.pmod(F.spark_partition_id(), F.lit(slices)))
        rows = sliced.dropDuplicates([*keys, "_slice"]).drop("_slice")
    return rows.dropDuplicates(list(keys))


def dedup(df: DataFrame, watermark: str = WATERMARK, slices: int = 0) -> DataFrame:
    if df.isStreaming:
        return dedup_stream(df, watermark=watermark, slices=slices)
    return dedup_batch(df)
