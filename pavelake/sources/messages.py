"""Message streams: (value BINARY, timestamp TIMESTAMP) in, raw table out, and the way back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pavelake.config import LakeConfig
from pavelake.schemas import MESSAGE, PAYLOAD

# Kafka defaults; ``message_options`` overrides any of them. ``minPartitions`` makes the connector
# cut a busy topic partition into several tasks, so one hot partition does not set the pace.
KAFKA_DEFAULTS = {"startingOffsets": "latest", "failOnDataLoss": "true"}


def message_stream(spark: SparkSession, cfg: LakeConfig) -> DataFrame:
    """Kafka topic, or a folder of files with the same two columns."""
    if cfg.message_source == "kafka":
        reader = spark.readStream.format("kafka").options(**{**KAFKA_DEFAULTS, **cfg.message_options})
        return reader.load().select("value", "timestamp")
    options = dict(cfg.message_options)
    path = options.pop("path")
    if cfg.max_files_per_trigger:
        options.setdefault("maxFilesPerTrigger", str(cfg.max_files_per_trigger))
    return spark.readStream.format(cfg.message_source).schema(MESSAGE).options(**options).load(path)


def decode_messages(messages: DataFrame) -> DataFrame:
    """Raw table: the payload text as received, its arrival time, and the fields found in it.

    Text that is no JSON object gives NULL fields; keys outside the schema stay in ``raw_json``.
    The fields leave through a generator because filters are not pushed below one: with a plain
    projection a filter on nine of them would parse the text once for each of its tests.
    """
    text = messages.select(
        F.col("value").cast("string").alias("raw_json"),
        F.col("timestamp").alias("kafka_timestamp"),
    )
    return text.select("*", F.inline(F.array(F.from_json("raw_json", PAYLOAD))))


def iso_utc(ts: Column) -> Column:
    """ISO-8601 text with microseconds. The session runs in UTC, hence the fixed offset."""
    return F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00"))


def encode_messages(rows: DataFrame, timestamp: Column | None = None, *, with_nulls: bool = False) -> DataFrame:
    """One UTF-8 JSON object per row. Timestamp columns are written by ``iso_utc``; NULLs are left out or, with
    ``with_nulls``, written as ``null``. A single column of text or bytes is passed on as it is."""
    stamp = F.current_timestamp() if timestamp is None else timestamp
    if len(rows.columns) == 1 and rows.dtypes[0][1] in ("string", "binary"):
        return rows.select(F.col(rows.columns[0]).cast("binary").alias("value"), stamp.alias("timestamp"))
    fields = [
        iso_utc(F.col(name)).alias(name) if dtype == "timestamp" else F.col(name) for name, dtype in rows.dtypes
    ]
    text = F.to_json(F.struct(*fields), {"ignoreNullFields": str(not with_nulls).lower()})
    return rows.select(text.cast("binary").alias("value"), stamp.alias("timestamp"))
