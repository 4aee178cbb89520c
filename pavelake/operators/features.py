"""Derived columns of the clean table."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Busy hours (inclusive) and the upper edges (exclusive) of the bands.
PEAK_HOURS = ((8, 11), (17, 20))
SPEED_BANDS = ((30, "LOW"), (70, "MEDIUM"))
TRAFFIC_BANDS = ((80, "LOW"), (140, "MEDIUM"))
TOP_BAND = "HIGH"


def band(value: Column, edges: tuple[tuple[int, str], ...], top: str = TOP_BAND) -> Column:
    choice = F
    for edge, label in edges:
        choice = choice.when(value < edge, F.lit(label))
    return choice.otherwise(F.lit(top))


def is_peak(hour: Column) -> Column:
    busy = F.lit(False)
    for first, last in PEAK_HOURS:
        busy = busy | hour.between(first, last)
    return F.when(busy, 1).otherwise(0)


def with_features(clean: DataFrame) -> DataFrame:
    """Hours are those of the session time zone, which the jobs pin to UTC."""
    hour = F.hour("event_ts")
    return clean.withColumns({
        "hour": hour,
        "peak_flag": is_peak(hour),
        "speed_band": band(F.col("speed_int"), SPEED_BANDS),
        "traffic_band": band(F.col("traffic_volume_int"), TRAFFIC_BANDS),
    })
