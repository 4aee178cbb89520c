"""Values and keys that the raw table's schema loses, read again from the payload text."""

import json
from datetime import datetime, timezone

from pavelake.operators.quality import rejected_rows
from pavelake.operators.recovery import drift, recovered_values, rejudged
from pavelake.schemas import BRONZE, MESSAGE
from pavelake.sources.messages import decode_messages

NOW = datetime(2024, 1, 2, tzinfo=timezone.utc)
GOOD = {"vehicle_id": "V1", "road_id": "R1", "city_zone": "CBD", "speed": "30", "congestion_level": 2, "traffic_volume": 10,
        "incident_flag": 0, "weather": "CLEAR", "event_time": "2024-01-01T08:00:00+00:00"}


def bronze(spark, *payloads):
    rows = [(bytearray((p if isinstance(p, str) else json.dumps(p)).encode()), datetime(2024, 1, 1, 8, i, tzinfo=timezone.utc))
            for i, p in enumerate(payloads)]
    return decode_messages(spark.createDataFrame(rows, MESSAGE))


def test_numbers_of_another_type_are_recovered_and_judged_again(spark):
    table = bronze(
        spark, GOOD, GOOD | {"congestion_level": "3"}, GOOD | {"traffic_volume": 12.9, "congestion_level": " 4 "},
        GOOD | {"incident_flag": True}, GOOD | {"congestion_level": "99"}, GOOD | {"congestion_level": "2", "weather": "HAIL"},
        {k: v for k, v in GOOD.items() if k != "congestion_level"}, '{"congestion_level": "2", ', "[1]", "")
    found = {r.kafka_timestamp.minute: r for r in rejudged(rejected_rows(table, now=NOW), now=NOW).collect()}
    assert sorted(found) == [1, 2, 4, 5]  # a boolean holds no number, a missing or cut-off payload nothing at all
    assert (found[1].recovered, found[1].congestion_level_int, found[1].passes) == (["congestion_level"], 3, True)
    assert found[2].recovered == ["congestion_level", "traffic_volume"] and (found[2].traffic_volume, found[2].passes) == (12, True)
    assert found[1].former_reason == "INVALID_CONGESTION_LEVEL" and found[1].invalid_reason == ""
    assert (found[4].passes, found[4].invalid_reason) == (False, "INVALID_CONGESTION_LEVEL")
    assert found[5].former_reason == "INVALID_CONGESTION_LEVEL|INVALID_WEATHER" and found[5].invalid_reason == "INVALID_WEATHER"


def test_values_that_are_there_stay(spark):
    row = recovered_values(bronze(spark, GOOD)).first()
    assert (row.congestion_level, row.traffic_volume, row.incident_flag, row.recovered) == (2, 10, 0, [])
    assert recovered_values(spark.createDataFrame([], BRONZE)).count() == 0


def test_drift_names_unknown_keys_and_wrong_kinds(spark):
    table = bronze(
        spark, GOOD | {"lane": 1}, GOOD | {"lane": "left"}, GOOD | {"lane": 2, "unit": {"speed": "kmh"}}, GOOD | {"congestion_level": "3"},
        GOOD | {"congestion_level": None, "speed": 30, "new": None}, GOOD | {"traffic_volume": 1.5, "tags": [1]}, GOOD | {"vehicle_id": True},
        "not json", "[1, 2]", '"text"', "", "{}")
    found = {(r.key, r.kind): (r.expected, r.row_count, r.first_arrival.minute, r.last_arrival.minute) for r in drift(table).collect()}
    assert found == {
        ("lane", "whole"): (None, 2, 0, 2), ("lane", "text"): (None, 1, 1, 1), ("unit", "object"): (None, 1, 2, 2), ("new", "null"): (None, 1, 4, 4),
        ("congestion_level", "text"): ("whole", 1, 3, 3), ("traffic_volume", "fraction"): ("whole", 1, 5, 5), ("tags", "list"): (None, 1, 5, 5),
        ("vehicle_id", "boolean"): ("text", 1, 6, 6)}
    assert drift(spark.createDataFrame([], BRONZE)).count() == 0


def test_drift_has_one_shuffle_and_counts_before_it(spark):
    plan = drift(bronze(spark, GOOD | {"lane": 1}))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(key") == 1 and "partial_count" in plan and "CartesianProduct" not in plan
