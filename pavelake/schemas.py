"""Table contracts. Every column is nullable; data that breaks a rule is flagged, not refused."""

from pyspark.sql.types import (
    BinaryType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _struct(*fields) -> StructType:
    return StructType([StructField(name, dtype, True) for name, dtype in fields])


_text, _int, _ts = StringType(), IntegerType(), TimestampType()

MESSAGE = _struct(("value", BinaryType()), ("timestamp", _ts))

PAYLOAD = _struct(
    ("vehicle_id", _text),
    ("road_id", _text),
    ("city_zone", _text),
    ("speed", _text),
    ("congestion_level", _int),
    ("traffic_volume", _int),
    ("incident_flag", _int),
    ("weather", _text),
    ("event_time", _text),
)

BRONZE = _struct(("raw_json", _text), ("kafka_timestamp", _ts), *((f.name, f.dataType) for f in PAYLOAD))

FLAGS = (
    "parse_ok",
    "required_fields_ok",
    "speed_valid",
    "traffic_volume_valid",
    "incident_flag_valid",
    "congestion_level_valid",
    "weather_valid",
    "location_valid",
    "time_valid",
)

VALIDATED = _struct(
    *((f.name, f.dataType) for f in BRONZE),
    ("speed_int", _int),
    ("traffic_volume_int", _int),
    ("incident_flag_int", _int),
    ("congestion_level_int", _int),
    ("event_ts", _ts),
    *((flag, _int) for flag in FLAGS),
    ("invalid_reason", _text),
    ("dq_flag", _text),
)

SILVER = _struct(
    *((f.name, f.dataType) for f in VALIDATED),
    ("hour", _int),
    ("peak_flag", _int),
    ("speed_band", _text),
    ("traffic_band", _text),
)

FACT = _struct(
    ("vehicle_id", _text),
    ("road_id", _text),
    ("city_zone", _text),
    ("weather", _text),
    ("event_ts", _ts),
    ("hour", _int),
    ("peak_flag", _int),
    ("speed_int", _int),
    ("speed_band", _text),
    ("traffic_volume_int", _int),
    ("traffic_band", _text),
    ("congestion_level_int", _int),
    ("incident_flag_int", _int),
    ("event_date", DateType()),
    ("ingested_at", _ts),
)

DIM_ZONE = _struct(("city_zone", _text), ("zone_type", _text), ("traffic_risk", _text))
DIM_ROAD = _struct(("road_id", _text), ("road_type", _text), ("speed_limit", _int))
DIM_WEATHER = _struct(("weather", _text), ("weather_severity", _text))

_averages = (("avg_speed", DoubleType()), ("avg_traffic_volume", DoubleType()), ("avg_congestion_level", DoubleType()))

ZONE_HOURLY = _struct(
    ("window_start", _ts),
    ("window_end", _ts),
    ("city_zone", _text),
    ("weather", _text),
    ("peak_flag", _int),
    ("event_count", LongType()),
    *_averages,
    ("incident_count", LongType()),
    ("min_speed", _int),
    ("max_speed", _int),
)

ROAD_HOURLY = _struct(
    ("window_start", _ts),
    ("window_end", _ts),
    ("road_id", _text),
    ("weather", _text),
    ("event_count", LongType()),
    *_averages,
    ("incident_count", LongType()),
)

PREDICTIONS = _struct(
    ("vehicle_id", _text),
    ("road_id", _text),
    ("city_zone", _text),
    ("weather", _text),
    ("event_ts", _ts),
    ("traffic_volume_int", _int),
    ("congestion_level_int", _int),
    ("speed_int", _int),
    ("predicted_speed", DoubleType()),
    ("prediction_error", DoubleType()),
    ("prediction_ts", _ts),
)

LEADERBOARD = _struct(
    ("model_name", _text),
    ("train_r2", DoubleType()),
    ("test_r2", DoubleType()),
    ("test_rmse", DoubleType()),
    ("test_mae", DoubleType()),
)
