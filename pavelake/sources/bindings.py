"""The ``events`` table read as a feed of traffic messages, clean and dirty.

Each message is a pure function of its row, so batch, stream and SQL agree on it. Faults are set
by arithmetic on ``event_id``: missing roads, text or missing or negative speeds, bad incident
flags, weather and times, far-future times, truncated payloads, and messages delivered twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

from pavelake.functions.lookup import lookup
from pavelake.schemas import PAYLOAD
from pavelake.sources.messages import encode_messages, iso_utc

EVENTS = StructType([
    StructField("event_id", LongType()),
    StructField("ts", TimestampNTZType()),
    StructField("user_id", LongType()),
    StructField("event_type", StringType()),
    StructField("value", DoubleType()),
    StructField("props", StringType()),
])

# Zones by road number, and weather by event type.
ZONES = ("CBD", "AIRPORT", "TECHPARK", "SUBURB", "TRAINSTATION")
WEATHER_OF = {"click": "CLEAR", "view": "RAIN", "purchase": "FOG", "signup": "STORM", "error": "CLEAR"}
TRUNCATED = '{"road_id": "R300", "vehicle_id": '


def events_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet")


def events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.readStream.schema(EVENTS).option("pathGlobFilter", "events.parquet").parquet(sf_dir)


def _every(n: int) -> Column:
    return F.col("event_id") % n == 0


def payload(events: DataFrame) -> DataFrame:
    """Payload columns next to ``event_id`` and the arrival time ``sent_at``."""
    road = F.col("user_id") % 5
    k = F.col("k")
    ts = F.col("ts").cast("timestamp")
    return events.withColumn("k", F.get_json_object("props", "$.k").cast("int")).select(
        "event_id",
        ts.alias("sent_at"),
        F.concat(F.lit("V"), F.col("user_id")).alias("vehicle_id"),
        F.when(~_every(97), F.concat(F.lit("R"), road + 1, F.lit("00"))).alias("road_id"),
        F.element_at(F.array(*map(F.lit, ZONES)), (road + 1).cast("int")).alias("city_zone"),
        F.when(_every(53), F.lit("FAST"))
        .when(_every(59), F.lit(None))
        .when(_every(61), F.lit("-40"))
        .otherwise(F.col("value").cast("string"))
        .alias("speed"),
        (k % 6).alias("congestion_level"),
        (k * 11).alias("traffic_volume"),
        F.when(F.col("event_type") == "error", 1).when(_every(71), 2).otherwise(0).alias("incident_flag"),
        F.when((F.col("event_type") == "error") & _every(3), F.lit("HAIL"))
        .otherwise(lookup(F.col("event_type"), WEATHER_OF, None))
        .alias("weather"),
        F.when(_every(89), F.lit("not-a-time"))
        .when(_every(83), F.lit("2099-01-01T00:00:00+00:00"))
        .otherwise(iso_utc(ts))
        .alias("event_time"),
    )


def _built_once(text: Column) -> Column:
    """The message's bytes as column ``value``. They leave through a generator because a filter on the text (is it
    there?) would otherwise be pushed below and write the JSON a second time, only to test it."""
    return F.inline(F.array(F.struct(text.cast("binary").alias("value"))))


def messages(events: DataFrame, redeliver: bool = False) -> DataFrame:
    """(value, timestamp) per event; with ``redeliver`` every 20th is sent again a minute later."""
    rows = payload(events)
    fields = F.struct(*PAYLOAD.fieldNames())
    text = F.when(_every(101), F.lit(TRUNCATED)).otherwise(F.to_json(fields))
    rows = rows.select("event_id", F.col("sent_at").alias("timestamp"), _built_once(text))
    if redeliver:
        delays = F.when(_every(20), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
        rows = rows.withColumn("delay", F.explode(delays)).withColumn(
            "timestamp", F.col("timestamp") + F.make_dt_interval(mins=F.col("delay"))
        )
    return rows.select("value", "timestamp")


def drifting_messages(events: DataFrame) -> DataFrame:
    """Messages of producers that have changed: integers sent as text or with a fraction, a key ``lane`` that is a
    number or a text, and a key ``unit`` that is an object."""
    feed = payload(events)
    text = F.to_json(F.struct(*PAYLOAD.fieldNames()))
    text = F.when(_every(43), F.regexp_replace(text, r'"congestion_level":(\d+)', '"congestion_level":"$1"')).otherwise(text)
    text = F.when(_every(47), F.regexp_replace(text, r'"traffic_volume":(\d+)', '"traffic_volume":$1.5')).otherwise(text)
    lane = F.when(_every(58), F.concat(F.lit(',"lane":'), F.col("event_id") % 4, F.lit("}"))).otherwise(F.lit(',"lane":"left"}'))
    text = F.when(_every(29), F.concat(F.regexp_replace(text, r"\}$", ""), lane)).otherwise(text)
    text = F.when(_every(31), F.concat(F.regexp_replace(text, r"\}$", ""), F.lit(',"unit":{"speed":"kmh"}}'))).otherwise(text)
    text = F.when(_every(101), F.lit(TRUNCATED)).otherwise(text)
    return feed.select(text.cast("binary").alias("value"), F.col("sent_at").alias("timestamp"))


def payload_messages(events: DataFrame) -> DataFrame:
    """Payload columns encoded by the publish operator alone, without truncation."""
    rows = payload(events)
    return encode_messages(rows.select(*PAYLOAD.fieldNames(), "sent_at"), F.col("sent_at"))
