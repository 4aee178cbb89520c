"""Tumbling-window metrics. Sums, counts and extremes combine before the shuffle, whatever the skew."""

from __future__ import annotations

import math
from collections.abc import Iterable
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pavelake.config import WATERMARK, WINDOW
from pavelake.schemas import ROAD_HOURLY, ZONE_HOURLY


def _metrics() -> dict:
    return {
        "event_count": F.count(F.lit(1)),
        "avg_speed": F.avg("speed_int"),
        "avg_traffic_volume": F.avg("traffic_volume_int"),
        "avg_congestion_level": F.avg("congestion_level_int"),
        "incident_count": F.sum("incident_flag_int"),
        "min_speed": F.min("speed_int"),
        "max_speed": F.max("speed_int"),
    }


def _windowed(df: DataFrame, keys: list[str], out: list[str], window: str, watermark: str | None) -> DataFrame:
    if df.isStreaming and watermark:
        df = df.withWatermark("event_ts", watermark)
    metrics = [value.alias(name) for name, value in _metrics().items() if name in out]
    grouped = df.groupBy(F.window("event_ts", window).alias("w"), *keys).agg(*metrics)
    return grouped.withColumns({"window_start": F.col("w.start"), "window_end": F.col("w.end")}).select(*out)


def window_date(event_ts: Column, window: str = WINDOW) -> Column:
    """Date on which the window of an event starts."""
    return F.to_date(F.window(event_ts, window)["start"])


def days_read(dates: Iterable[date], window_seconds: float) -> list[date]:
    """Dates whose events lie in windows that start on one of the dates. Windows that divide a day stay within it."""
    beyond = 0 if 86_400 % window_seconds == 0 else math.ceil(window_seconds / 86_400)
    return sorted({day + timedelta(days=k) for day in dates for k in range(beyond + 1)})


def zone_hourly(silver: DataFrame, window: str = WINDOW, watermark: str | None = WATERMARK) -> DataFrame:
    return _windowed(silver, ["city_zone", "weather", "peak_flag"], ZONE_HOURLY.fieldNames(), window, watermark)


def road_hourly(silver: DataFrame, window: str = WINDOW, watermark: str | None = WATERMARK) -> DataFrame:
    return _windowed(silver, ["road_id", "weather"], ROAD_HOURLY.fieldNames(), window, watermark)
