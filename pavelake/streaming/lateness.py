"""Late rows, told apart before the watermark would drop them without a word.

A stateful query drops rows that are behind the watermark and only counts them. Here each micro-batch of the validating
query is split by the watermark that holds for it, which is kept with the batch's number: the latest event time of the
batches before the previous one, less the allowed lateness. That is the lag the stateful queries of Spark have, so a row
that is late by a single micro-batch still gets in. Late rows are written as rejected ones, with the reason LATE_EVENT,
in the same commit as all other rows of the batch. No history is read: a batch needs one earlier number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pavelake.config import WATERMARK
from pavelake.operators.quality import OK, REJECTED
from pavelake.sources.tables import drop_folder, path_exists
from pavelake.streaming.audit import LATE_EVENT
from pavelake.streaming.sinks import BATCH, Trigger, batch_sink, write_batch

LAG = 2  # the watermark of a batch comes from the batches up to the one before the previous
KEPT = 4  # so many batches' numbers are kept, the ones a repeated batch may ask for among them


def _clock(path: str, batch_id: int) -> str:
    return f"{path}/{BATCH}{batch_id}"


def latest_seen(spark: SparkSession, path: str, batch_id: int) -> int | None:
    """Latest event time (microseconds) of all batches up to the one given, as it was written down; None before the first."""
    if batch_id < 0 or not path_exists(spark, f"{_clock(path, batch_id)}/_SUCCESS"):
        return None
    return spark.read.schema("latest long").json(_clock(path, batch_id)).first()["latest"]


def write_down(spark: SparkSession, path: str, batch_id: int, latest: int | None) -> None:
    """Keep the later of what the batches so far and this one have seen. A repeated batch writes the same again."""
    seen = [t for t in (latest, latest_seen(spark, path, batch_id - 1)) if t is not None]
    row = spark.createDataFrame([(max(seen, default=None),)], "latest long")
    row.coalesce(1).write.mode("overwrite").json(_clock(path, batch_id))
    drop_folder(spark, _clock(path, batch_id - KEPT))


def with_late_verdict(judged: DataFrame, latest: int | None, watermark: str = WATERMARK, seen: Column | None = None) -> DataFrame:
    """Judged rows; clean ones at or behind the watermark are rejected as late. Times count in whole milliseconds, as
    watermarks do."""
    if latest is None:
        return judged
    behind = F.timestamp_millis(F.lit(latest // 1000)) - F.expr(f"interval {watermark}")
    late = (F.col("dq_flag") == OK) & ((F.col("event_ts") if seen is None else seen) <= behind)
    return judged.withColumns({
        "invalid_reason": F.when(late, LATE_EVENT).otherwise(F.col("invalid_reason")),
        "dq_flag": F.when(late, REJECTED).otherwise(F.col("dq_flag")),
    })


def routing_sink(
    judged: DataFrame,
    path: str,
    checkpoint: str,
    clock: str,
    *,
    watermark: str = WATERMARK,
    seen: Column | None = None,
    name: str | None = None,
    fmt: str = "parquet",
    trigger: Trigger = None,
) -> StreamingQuery:
    """Write every judged row, late ones as rejected, to one table by verdict; one folder or transaction a batch.

    ``clock`` names the folder of the batches' latest event times. Only clean rows move the watermark. ``seen`` is the
    time that counts, the event time if it is not given.
    """
    time = F.col("event_ts") if seen is None else seen

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        told = Observation()
        clean = F.col("dq_flag") == OK
        watched = batch.observe(told, F.max(F.when(clean, F.unix_micros(time))).alias("latest"))
        rows = with_late_verdict(watched, latest_seen(spark, clock, batch_id - LAG), watermark, seen)
        write_batch(rows.hint("rebalance", "dq_flag"), batch_id, path, fmt, name or "judged", partition_by=["dq_flag"])
        write_down(spark, clock, batch_id, told.get["latest"])

    return batch_sink(judged, checkpoint, write, name=name, trigger=trigger)
