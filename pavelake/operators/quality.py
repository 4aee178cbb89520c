"""Typing and validation: nine declared rules, a flag per rule, a readable reason, and the split."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pavelake.config import QualityLimits
from pavelake.functions.casting import lenient_int, lenient_timestamp
from pavelake.schemas import FLAGS, VALIDATED

OK = "OK"
REJECTED = "REJECTED"


@dataclass(frozen=True)
class Rule:
    """``check`` is true for a row that passes; NULL counts as a failure."""

    flag: str
    reason: str
    check: Column


def quality_rules(limits: QualityLimits = QualityLimits(), now: Column | datetime | None = None) -> list[Rule]:
    """Rules in the order their reasons are listed. ``now`` defaults to the start of the (micro-)batch."""
    if now is None:
        now = F.current_timestamp()
    elif isinstance(now, datetime):
        now = F.lit(now)
    latest = now + F.expr(f"interval {limits.max_clock_ahead}")

    def present(*names: str) -> Column:
        return reduce(and_, (F.col(name).isNotNull() for name in names))

    any_field = F.coalesce("vehicle_id", "road_id", "city_zone", "event_time")
    return [
        Rule("parse_ok", "PARSE_FAILURE", present("raw_json") & any_field.isNotNull()),
        Rule(
            "required_fields_ok",
            "MISSING_REQUIRED_FIELDS",
            present("vehicle_id", "road_id", "city_zone", "event_time"),
        ),
        Rule("speed_valid", "INVALID_SPEED", F.col("speed_int").between(*limits.speed)),
        Rule(
            "traffic_volume_valid",
            "INVALID_TRAFFIC_VOLUME",
            F.col("traffic_volume_int").between(*limits.traffic_volume),
        ),
        Rule("incident_flag_valid", "INVALID_INCIDENT_FLAG", F.col("incident_flag_int").isin(*limits.incident)),
        Rule(
            "congestion_level_valid",
            "INVALID_CONGESTION_LEVEL",
            F.col("congestion_level_int").between(*limits.congestion),
        ),
        Rule("weather_valid", "INVALID_WEATHER", F.col("weather").isin(*limits.weather)),
        Rule("location_valid", "INVALID_LOCATION", present("road_id", "city_zone")),
        Rule("time_valid", "INVALID_EVENT_TIME", F.col("event_ts") <= latest),
    ]


def with_types(bronze: DataFrame) -> DataFrame:
    """The four integers and the event time, NULL where the text does not hold one.

    The two values read from text pass through a generator. Filters on them then stay above it and
    find them ready, instead of being rewritten into tests that each read the text again. Filters on
    the stored columns still reach the scan.
    """
    parsed = F.struct(
        lenient_int(F.col("speed")).alias("speed_int"),
        lenient_timestamp(F.col("event_time")).alias("event_ts"),
    )
    return bronze.select("*", F.inline(F.array(parsed))).select(
        *bronze.columns,
        "speed_int",
        F.col("traffic_volume").cast("int").alias("traffic_volume_int"),
        F.col("incident_flag").cast("int").alias("incident_flag_int"),
        F.col("congestion_level").cast("int").alias("congestion_level_int"),
        "event_ts",
    )


def validate(
    bronze: DataFrame,
    limits: QualityLimits = QualityLimits(),
    now: Column | datetime | None = None,
) -> DataFrame:
    """Every row with its flags, its reasons joined by ``|`` (empty for a clean row), and the verdict."""
    rules = quality_rules(limits, now)
    flagged = with_types(bronze).withColumns({r.flag: F.when(r.check, 1).otherwise(0) for r in rules})
    reasons = [F.when(F.col(r.flag) == 0, F.lit(r.reason)) for r in rules]
    return flagged.withColumn("invalid_reason", F.concat_ws("|", *reasons)).withColumn(
        "dq_flag", F.when(F.col("invalid_reason") == "", OK).otherwise(REJECTED)
    )


def reason_list(invalid_reason: Column) -> Column:
    """Reasons as an array, empty for a clean row."""
    return F.when(invalid_reason == "", F.array().cast("array<string>")).otherwise(F.split(invalid_reason, r"\|"))


def passing_rows(
    bronze: DataFrame,
    limits: QualityLimits = QualityLimits(),
    now: Column | datetime | None = None,
) -> DataFrame:
    """Typed rows that pass every rule, without flags.

    The filter is the rules themselves, so null, range and set tests reach the Parquet scan.
    """
    return with_types(bronze).filter(reduce(and_, (r.check for r in quality_rules(limits, now))))


def with_clean_verdict(passing: DataFrame) -> DataFrame:
    """Flags, reason and verdict of rows known to be clean. Added after a shuffle, they cost nothing in it."""
    constants = {**{flag: F.lit(1) for flag in FLAGS}, "invalid_reason": F.lit(""), "dq_flag": F.lit(OK)}
    return passing.withColumns(constants).select(*VALIDATED.fieldNames())


def without_verdict(validated: DataFrame) -> DataFrame:
    return validated.drop(*FLAGS, "invalid_reason", "dq_flag")


def clean_rows(
    bronze: DataFrame,
    limits: QualityLimits = QualityLimits(),
    now: Column | datetime | None = None,
) -> DataFrame:
    """Same rows as ``validate`` followed by ``dq_flag = OK``, straight from the raw table."""
    return with_clean_verdict(passing_rows(bronze, limits, now))


def rejected_rows(
    bronze: DataFrame,
    limits: QualityLimits = QualityLimits(),
    now: Column | datetime | None = None,
) -> DataFrame:
    """Exact complement of ``clean_rows``, with reasons."""
    return validate(bronze, limits, now).filter(F.col("dq_flag") == REJECTED)
