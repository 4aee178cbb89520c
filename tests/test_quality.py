"""Parsing and validation, one hand-written payload per trap."""

import json
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from pavelake.operators.features import with_features
from pavelake.operators.quality import clean_rows, quality_rules, reason_list, rejected_rows, validate
from pavelake.schemas import BRONZE, VALIDATED
from pavelake.sources.messages import decode_messages, encode_messages

NOW = datetime(2024, 1, 1, 8, 0, tzinfo=timezone.utc)
BASE = {
    "vehicle_id": "v", "road_id": "R100", "city_zone": "CBD", "speed": 45, "congestion_level": 3,
    "traffic_volume": 120, "incident_flag": 0, "weather": "CLEAR", "event_time": "2024-01-01T08:00:00.123456+00:00",
}
ALL = "|".join(rule for rule in (
    "PARSE_FAILURE", "MISSING_REQUIRED_FIELDS", "INVALID_SPEED", "INVALID_TRAFFIC_VOLUME", "INVALID_INCIDENT_FLAG",
    "INVALID_CONGESTION_LEVEL", "INVALID_WEATHER", "INVALID_LOCATION", "INVALID_EVENT_TIME"))


def text(**changes):
    return json.dumps({**BASE, **changes})


def at(minutes):
    return (NOW + timedelta(minutes=minutes)).isoformat()


CASES = {
    "clean": (text(), ""),
    "null speed": (text(speed=None), "INVALID_SPEED"),
    "negative speed": (text(speed=-40), "INVALID_SPEED"),
    "extreme speed": (text(speed=420), "INVALID_SPEED"),
    "text speed": (text(speed="FAST"), "INVALID_SPEED"),
    "fraction": (text(speed=60.5), ""),
    "object speed": (text(speed={"a": 1}), "INVALID_SPEED"),
    "boolean speed": (text(speed=True), "INVALID_SPEED"),
    "speed 0": (text(speed=0), ""),
    "speed 160": (text(speed=160), ""),
    "speed 161": (text(speed=161), "INVALID_SPEED"),
    "volume 0": (text(traffic_volume=0), ""),
    "volume 1000": (text(traffic_volume=1000), ""),
    "volume 1001": (text(traffic_volume=1001), "INVALID_TRAFFIC_VOLUME"),
    "congestion 0": (text(congestion_level=0), "INVALID_CONGESTION_LEVEL"),
    "congestion 1": (text(congestion_level=1), ""),
    "congestion 5": (text(congestion_level=5), ""),
    "congestion 6": (text(congestion_level=6), "INVALID_CONGESTION_LEVEL"),
    "quoted int": (text(congestion_level="3"), "INVALID_CONGESTION_LEVEL"),
    "3.0": (text(congestion_level=3.0), "INVALID_CONGESTION_LEVEL"),
    "3.5": (text(congestion_level=3.5), "INVALID_CONGESTION_LEVEL"),
    "overflow": (text(congestion_level=99999999999), "INVALID_CONGESTION_LEVEL"),
    "incident 2": (text(incident_flag=2), "INVALID_INCIDENT_FLAG"),
    "weather": (text(weather="HAIL"), "INVALID_WEATHER"),
    "null weather": (text(weather=None), "INVALID_WEATHER"),
    "no road": (text(road_id=None), "MISSING_REQUIRED_FIELDS|INVALID_LOCATION"),
    "extra key": (text(road_condition="BAD"), ""),
    "bad time": (text(event_time="bad"), "INVALID_EVENT_TIME"),
    "10 minutes ahead": (text(event_time=at(10)), ""),
    "11 minutes ahead": (text(event_time=at(11)), "INVALID_EVENT_TIME"),
    "trailing text": (text() + " xx", ""),
    "truncated": ('{"vehicle_id": "broken-payload", "speed": ', ALL),
    "no json": ("abc", ALL),
    "null": ("null", ALL),
    "empty object": ("{}", ALL),
    "array": (f"[{text()}]", ALL),
    "empty": ("", ALL),
    "no payload": (None, ALL),
    "vehicle only": ('{"vehicle_id":"v"}', ALL.removeprefix("PARSE_FAILURE|")),
}


@pytest.fixture(scope="module")
def bronze(spark):
    rows = [(None if t is None else bytearray(t.encode()), NOW) for t, _ in CASES.values()]
    return decode_messages(spark.createDataFrame(rows, "value binary, timestamp timestamp")).cache()


def test_reasons(bronze):
    got = {r.raw_json: r.invalid_reason for r in validate(bronze, now=NOW).collect()}
    assert got == dict(CASES.values())


def test_split_is_a_partition(bronze):
    clean, rejected = clean_rows(bronze, now=NOW), rejected_rows(bronze, now=NOW)
    assert clean.count() == sum(reason == "" for _, reason in CASES.values())
    assert clean.count() + rejected.count() == bronze.count()
    judged = validate(bronze, now=NOW)
    assert clean.exceptAll(judged.filter("dq_flag = 'OK'")).isEmpty()
    assert clean.columns == judged.columns == VALIDATED.fieldNames()


def test_schema(bronze):
    assert [(f.name, f.dataType) for f in bronze.schema] == [(f.name, f.dataType) for f in BRONZE]
    judged = validate(bronze, now=NOW).schema
    assert [(f.name, f.dataType) for f in judged] == [(f.name, f.dataType) for f in VALIDATED]


def test_values_kept(bronze):
    values = {r.raw_json: r for r in bronze.collect()}
    assert values[CASES["object speed"][0]].speed == '{"a":1}'
    assert values[CASES["boolean speed"][0]].speed == "true"
    assert "road_condition" in CASES["extra key"][0]
    typed = {r.raw_json: r.speed_int for r in validate(bronze, now=NOW).collect()}
    assert typed[CASES["fraction"][0]] == 60


def test_reason_list(bronze):
    judged = validate(bronze, now=NOW).withColumn("n", F.size(reason_list(F.col("invalid_reason"))))
    got = {r.raw_json: r.n for r in judged.collect()}
    assert got == {t: len(reason.split("|")) if reason else 0 for t, reason in CASES.values()}


def test_rules_are_in_flag_order():
    from pavelake.schemas import FLAGS

    assert tuple(rule.flag for rule in quality_rules()) == FLAGS


@pytest.mark.parametrize("hour, peak", [(7, 0), (8, 1), (11, 1), (12, 0), (16, 0), (17, 1), (20, 1), (21, 0)])
def test_peak_hours(spark, hour, peak):
    df = spark.createDataFrame([(datetime(2024, 1, 1, hour, 59, tzinfo=timezone.utc), 0, 0)],
                               "event_ts timestamp, speed_int int, traffic_volume_int int")
    row = with_features(df).first()
    assert (row.hour, row.peak_flag) == (hour, peak)


def test_bands(spark):
    speeds, volumes = [29, 30, 69, 70], [79, 80, 139, 140]
    df = spark.createDataFrame([(NOW, s, v) for s, v in zip(speeds, volumes)],
                               "event_ts timestamp, speed_int int, traffic_volume_int int")
    rows = with_features(df).orderBy("speed_int").collect()
    assert [r.speed_band for r in rows] == [r.traffic_band for r in rows] == ["LOW", "MEDIUM", "MEDIUM", "HIGH"]


def test_encode_writes_microseconds_and_leaves_out_nulls(spark):
    stamp = datetime(2024, 1, 1, 8, 0, 0, 500, tzinfo=timezone.utc)
    df = spark.createDataFrame([("v", None, stamp)], "vehicle_id string, weather string, event_time timestamp")
    value = encode_messages(df).first().value
    assert json.loads(bytes(value)) == {"vehicle_id": "v", "event_time": "2024-01-01T08:00:00.000500+00:00"}
