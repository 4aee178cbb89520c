"""Fact table and dimension tables over the clean table."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pavelake.functions.lookup import lookup
from pavelake.schemas import FACT

# Attributes by key, and what a key outside the table gets.
ZONE_TYPE = {
    "CBD": "Commercial",
    "TECHPARK": "IT Hub",
    "AIRPORT": "Transit Hub",
    "TRAINSTATION": "Transit Hub",
}
OTHER_ZONE_TYPE = "Residential"
TRAFFIC_RISK = {"CBD": "HIGH", "AIRPORT": "HIGH", "TRAINSTATION": "HIGH", "TECHPARK": "MEDIUM"}
OTHER_TRAFFIC_RISK = "LOW"
ROAD_TYPE = {"R100": "Highway", "R200": "Highway"}
OTHER_ROAD_TYPE = "City Road"
SPEED_LIMIT = {"R100": 100, "R200": 100}
OTHER_SPEED_LIMIT = 60
WEATHER_SEVERITY = {"CLEAR": "LOW", "RAIN": "MEDIUM", "FOG": "HIGH", "STORM": "HIGH"}
OTHER_WEATHER_SEVERITY = "UNKNOWN"


def zone_attributes(zones: DataFrame) -> DataFrame:
    return zones.select(
        "city_zone",
        lookup(F.col("city_zone"), ZONE_TYPE, OTHER_ZONE_TYPE).alias("zone_type"),
        lookup(F.col("city_zone"), TRAFFIC_RISK, OTHER_TRAFFIC_RISK).alias("traffic_risk"),
    )


def road_attributes(roads: DataFrame) -> DataFrame:
    return roads.select(
        "road_id",
        lookup(F.col("road_id"), ROAD_TYPE, OTHER_ROAD_TYPE).alias("road_type"),
        lookup(F.col("road_id"), SPEED_LIMIT, OTHER_SPEED_LIMIT).alias("speed_limit"),
    )


def weather_attributes(weathers: DataFrame) -> DataFrame:
    return weathers.select(
        "weather",
        lookup(F.col("weather"), WEATHER_SEVERITY, OTHER_WEATHER_SEVERITY).alias("weather_severity"),
    )


# Dimension table -> (natural key, attributes of a frame of keys).
DIMENSIONS = {
    "dim_zone": ("city_zone", zone_attributes),
    "dim_road": ("road_id", road_attributes),
    "dim_weather": ("weather", weather_attributes),
}


def dimension(silver: DataFrame, name: str) -> DataFrame:
    """One row per key found. Keys are made distinct before attributes are added."""
    key, attributes = DIMENSIONS[name]
    return attributes(silver.select(key).distinct())


def fact_rows(silver: DataFrame) -> DataFrame:
    """Analytic columns of a clean row, its date, and the time of this (micro-)batch."""
    stamped = silver.withColumns({"event_date": F.to_date("event_ts"), "ingested_at": F.current_timestamp()})
    return stamped.select(*FACT.fieldNames())
