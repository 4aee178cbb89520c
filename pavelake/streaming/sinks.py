"""Streaming sinks. Each takes a streaming frame and gives back the running query.

``trigger`` is what ``DataStreamWriter.trigger`` takes, for example ``{"processingTime": "10
seconds"}`` or ``{"availableNow": True}``; None leaves Spark's default.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from pavelake.session import few_listing_tasks
from pavelake.sources.tables import BATCH, VERSION, drop_versions

Trigger = dict[str, object] | None


def _writer(df: DataFrame, checkpoint: str, name: str | None, trigger: Trigger) -> DataStreamWriter:
    writer = df.writeStream.option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    return writer.trigger(**trigger) if trigger else writer


def append_sink(
    df: DataFrame,
    path: str,
    checkpoint: str,
    *,
    name: str | None = None,
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
    trigger: Trigger = None,
    options: dict[str, str] | None = None,
    balance: Sequence[str] | None = None,
) -> StreamingQuery:
    """Append exactly once. Readers go through the sink's commit log and never see half a batch.

    With ``balance`` a stateless micro-batch is dealt out by those columns (or evenly, if there are none) into files of
    the size that ``spark.sql.adaptive.advisoryPartitionSizeInBytes`` names: a value with many rows fills several
    files, those with few share a task, and there is not one file for every task and value.
    """
    if balance is not None:
        df = df.hint("rebalance", *balance)
    writer = _writer(df, checkpoint, name, trigger).format(fmt).outputMode("append").options(**(options or {}))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    with few_listing_tasks(df.sparkSession):
        return writer.start(path)


def batch_sink(
    df: DataFrame,
    checkpoint: str,
    write: Callable[[DataFrame, int], None],
    *,
    name: str | None = None,
    trigger: Trigger = None,
    output_mode: str = "append",
) -> StreamingQuery:
    """Hand each micro-batch to ``write``, which must give the same result when a batch is repeated."""
    return _writer(df, checkpoint, name, trigger).outputMode(output_mode).foreachBatch(write).start()


def write_batch(
    batch: DataFrame,
    batch_id: int,
    path: str,
    fmt: str = "parquet",
    name: str = "batch",
    options: dict[str, str] | None = None,
    partition_by: Sequence[str] = (),
) -> None:
    """Add one batch to a table so that repeating the batch does not add it twice."""
    writer = batch.write.format(fmt).options(**(options or {}))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "delta":
        writer.mode("append").option("txnAppId", name).option("txnVersion", batch_id).save(path)
    else:
        writer.mode("overwrite").save(f"{path}/{BATCH}{batch_id}")


def rewrite_sink(
    df: DataFrame,
    path: str,
    checkpoint: str,
    *,
    name: str | None = None,
    fmt: str = "parquet",
    trigger: Trigger = None,
    keep_seconds: float = 3600,
) -> StreamingQuery:
    """Replace the whole table with every micro-batch (output mode ``complete``).

    Delta does this itself. Other formats get one folder per batch; ``read_latest`` picks the
    newest committed one, so readers keep a complete table while the next is being written.
    Replaced versions stay ``keep_seconds`` for readers that are still busy with them.
    """
    if fmt == "delta":
        return _writer(df, checkpoint, name, trigger).format(fmt).outputMode("complete").start(path)

    def replace(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").format(fmt).save(f"{path}/{VERSION}{batch_id}")
        drop_versions(batch.sparkSession, path, keep_seconds)

    return batch_sink(df, checkpoint, replace, name=name, trigger=trigger, output_mode="complete")


def partition_sink(
    df: DataFrame,
    path: str,
    checkpoint: str,
    partition: str,
    rebuild: Callable[[list], DataFrame],
    *,
    name: str | None = None,
    fmt: str = "parquet",
    trigger: Trigger = None,
) -> StreamingQuery:
    """Replace those partitions of a table that a micro-batch touches, and no others.

    ``rebuild`` makes the rows of some values of ``partition`` anew from committed tables. A repeated batch therefore
    gives the same rows, and a write that died is mended by its repetition. There is no streaming state. The distinct
    values of a batch come to the driver, so ``partition`` is a column of few values, such as a date.

    Delta replaces the partitions in one commit. Of other formats a reader may meet a partition between its old and
    its new files; readers that cannot have that read after the batch, or use output mode ``complete``.
    """

    def replace(batch: DataFrame, batch_id: int) -> None:
        touched = sorted(row[0] for row in batch.select(partition).distinct().collect() if row[0] is not None)
        if touched:
            writer = rebuild(touched).write.format(fmt).mode("overwrite").partitionBy(partition)
            writer.option("partitionOverwriteMode", "dynamic").save(path)

    return batch_sink(df, checkpoint, replace, name=name, trigger=trigger)


def message_sink(
    messages: DataFrame,
    checkpoint: str,
    *,
    fmt: str = "kafka",
    name: str | None = None,
    trigger: Trigger = None,
    options: dict[str, str] | None = None,
) -> StreamingQuery:
    """Publish (value, timestamp) messages to a topic, or to a folder given as option ``path``."""
    if fmt == "kafka":
        # The broker stamps the time. Wait for all replicas and send again what was not confirmed.
        messages = messages.select("value")
        options = {"kafka.acks": "all", "kafka.retries": "3", **(options or {})}
    writer = _writer(messages, checkpoint, name, trigger).format(fmt).outputMode("append")
    return writer.options(**(options or {})).start()
