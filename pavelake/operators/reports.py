"""Inspection reports and dashboard queries over the published tables.

All of them aggregate before they join or sort: joins meet one row per key, and what is sorted is
an aggregate or, with ``limit``, only the k best rows of each task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pavelake.operators.features import SPEED_BANDS


def table_profile(df: DataFrame, table: str) -> DataFrame:
    """One row per column: its place, name and type, and the table's row count from a single scan."""
    columns = F.array(*[
        F.struct(F.lit(i).alias("position"), F.lit(name).alias("column_name"), F.lit(dtype).alias("column_type"))
        for i, (name, dtype) in enumerate(df.dtypes)
    ])
    counted = df.agg(F.count(F.lit(1)).alias("row_count"))
    return counted.select(F.lit(table).alias("table_name"), F.inline(columns), "row_count")


def sample_rows(df: DataFrame, n: int = 20) -> DataFrame:
    return df.limit(n)


def rejected_summary(rejected: DataFrame, n: int = 20) -> DataFrame:
    """The ``n`` most frequent reason strings; equal counts are listed by reason."""
    counts = rejected.groupBy("invalid_reason").agg(F.count(F.lit(1)).alias("row_count"))
    return counts.orderBy(F.desc("row_count"), "invalid_reason").limit(n)


def speed_by_congestion(fact: DataFrame) -> DataFrame:
    return _speed_by(fact, "congestion_level_int").orderBy("congestion_level_int")


def speed_by_zone(fact: DataFrame) -> DataFrame:
    return _speed_by(fact, "city_zone").orderBy(F.desc("row_count"), "city_zone")


def _speed_by(fact: DataFrame, key: str) -> DataFrame:
    return fact.groupBy(key).agg(F.avg("speed_int").alias("avg_speed"), F.count(F.lit(1)).alias("row_count"))


def incidents_by_zone(fact: DataFrame) -> DataFrame:
    totals = fact.groupBy("city_zone").agg(F.sum("incident_flag_int").alias("incident_count"))
    return totals.orderBy(F.desc("incident_count"), "city_zone")


def top_zone_windows(zone_metrics: DataFrame, n: int = 10) -> DataFrame:
    """Most congested zone windows. The remaining keys break ties."""
    ranked = zone_metrics.orderBy(
        F.desc("avg_congestion_level"), F.desc("event_count"), "window_start", "city_zone", "weather", "peak_flag"
    )
    return ranked.limit(n).select(
        "window_start", "window_end", "city_zone", "weather", "event_count", "avg_congestion_level", "avg_speed"
    )


def top_road_windows(road_metrics: DataFrame, n: int = 10) -> DataFrame:
    """Busiest road windows. The remaining keys break ties."""
    ranked = road_metrics.orderBy(
        F.desc("avg_traffic_volume"), F.desc("event_count"), "window_start", "road_id", "weather"
    )
    return ranked.limit(n).select(
        "window_start", "window_end", "road_id", "weather", "event_count", "avg_traffic_volume", "avg_speed"
    )


def zone_risk(fact: DataFrame, dim_zone: DataFrame) -> DataFrame:
    """Which zones are most congested, next to the risk the zone table gives them."""
    per_zone = fact.groupBy("city_zone").agg(
        F.avg("congestion_level_int").alias("avg_congestion_level"),
        F.sum("incident_flag_int").alias("incident_count"),
        F.count(F.lit(1)).alias("row_count"),
    )
    joined = per_zone.join(dim_zone, "city_zone")
    return joined.select(
        "city_zone", "zone_type", "traffic_risk", "avg_congestion_level", "incident_count", "row_count"
    ).orderBy(F.desc("avg_congestion_level"), "city_zone")


def speed_drop(fact: DataFrame) -> DataFrame:
    """How speed changes from one congestion level to the next one seen.

    The window spans all rows, of which there are as many as there are valid levels.
    """
    previous = F.lag("avg_speed").over(Window.orderBy("congestion_level_int"))
    return _speed_by(fact, "congestion_level_int").withColumn("speed_change", F.col("avg_speed") - previous)


def weather_impact(fact: DataFrame, dim_weather: DataFrame) -> DataFrame:
    """Speed, volume and incident rate by weather severity."""
    per_weather = fact.groupBy("weather").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("speed_int").alias("speed"),
        F.sum("traffic_volume_int").alias("volume"),
        F.sum("incident_flag_int").alias("incidents"),
    )
    rows = F.sum("n")
    return (
        per_weather.join(dim_weather, "weather")
        .groupBy("weather_severity")
        .agg(
            rows.alias("row_count"),
            (F.sum("speed") / rows).alias("avg_speed"),
            (F.sum("volume") / rows).alias("avg_traffic_volume"),
            (F.sum("incidents") / rows).alias("incident_rate"),
        )
    )


def slow_zones(fact: DataFrame, window: str = "1 hour", slow_below: int = SPEED_BANDS[0][0]) -> DataFrame:
    """Share of each zone's windows whose mean speed lies in the lowest band."""
    windows = fact.groupBy("city_zone", F.window("event_ts", window)).agg(F.avg("speed_int").alias("avg_speed"))
    slow = F.count_if(F.col("avg_speed") < slow_below)
    total = F.count(F.lit(1))
    return windows.groupBy("city_zone").agg(
        slow.alias("slow_windows"), total.alias("windows"), (slow / total).alias("slow_share")
    )
