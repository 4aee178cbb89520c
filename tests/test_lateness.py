"""Late rows routed to the rejected table by the watermark that holds for their batch."""

import dataclasses
import json
from datetime import datetime, timezone
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from pavelake.config import LakeConfig
from pavelake.operators.dedup import bounded_by_arrival, dedup_stream
from pavelake.plans import refine
from pavelake.schemas import BRONZE, SILVER
from pavelake.sources.tables import list_versions, read_rejected, read_table, read_validated, stream_table
from pavelake.streaming.lateness import latest_seen, with_late_verdict, write_down
from pavelake.streaming.sinks import append_sink

ONCE = {"availableNow": True}


def at(hour, minute):
    return datetime(2024, 1, 1, hour, minute, tzinfo=timezone.utc)


# Vehicle, event time, arrival; one batch each. The script of known lateness, with its known outcome.
SCRIPT = [
    [("a", at(8, 0)), ("a", at(8, 0)), ("b", at(9, 0))],
    [("late", at(8, 30)), ("ok", at(8, 50))],
    [("late2", at(8, 30)), ("c", at(9, 1))],
]


def bronze(spark, rows):
    made = []
    for i, (vehicle, event, *arrival) in enumerate(rows):
        made.append((json.dumps({"v": vehicle, "i": i}), arrival[0] if arrival else event, vehicle, "R100", "CBD", "30", 2, 100, 0, "CLEAR",
                     event.strftime("%Y-%m-%dT%H:%M:%S+00:00")))
    return spark.createDataFrame(made, BRONZE)


def run(spark, cfg, script, steps=None):
    """All batches in one run, or one run a batch."""
    for rows in script:
        bronze(spark, rows).coalesce(1).write.mode("append").parquet(cfg.table("bronze"))
        if steps:
            refine.run(spark, cfg, ONCE)
    if not steps:
        refine.run(spark, cfg, ONCE)


def vehicles(df):
    return sorted(r.vehicle_id for r in df.collect())


def outcome(spark, cfg):
    rejected = read_rejected(spark, cfg)
    return vehicles(read_table(spark, cfg.table("silver"), schema=SILVER)), [(r.vehicle_id, r.invalid_reason) for r in rejected.collect()]


@pytest.fixture
def routed(lake):
    return LakeConfig(lake, route_late=True, copy_slices=2, max_files_per_trigger=1)


@pytest.mark.parametrize("steps", [False, True])
def test_the_script_of_known_lateness(spark, routed, steps):
    run(spark, routed, SCRIPT, steps)
    assert outcome(spark, routed) == (["a", "b", "c", "late", "ok"], [("late2", "LATE_EVENT")])
    everything = read_validated(spark, routed)
    assert everything.count() == 7 and everything.columns == read_rejected(spark, routed).columns


def test_nothing_is_late_twice_or_lost_when_a_batch_is_repeated(spark, routed):
    run(spark, routed, SCRIPT[:2], steps=True)
    # the next batch writes its rows and dies before its commit
    bronze(spark, SCRIPT[2]).coalesce(1).write.mode("append").parquet(routed.table("bronze"))
    refine.start_validated(spark, routed, ONCE).awaitTermination()
    for log in ("commits",):
        last = max(Path(routed.checkpoint("silver_routed"), log).glob("[0-9]*"), key=lambda p: int(p.name))
        last.unlink()
        Path(last.parent, f".{last.name}.crc").unlink(missing_ok=True)
    refine.run(spark, routed, ONCE)
    assert outcome(spark, routed) == (["a", "b", "c", "late", "ok"], [("late2", "LATE_EVENT")])
    assert list_versions(spark, routed.table("silver_routed"), "batch_id=") == [0, 1, 2]


def test_without_routing_nothing_changes(spark, lake):
    cfg = LakeConfig(lake, copy_slices=2, max_files_per_trigger=1)
    run(spark, cfg, SCRIPT)
    silver, rejected = outcome(spark, cfg)
    assert rejected == [] and set(silver) <= {"a", "b", "c", "late", "ok", "late2"}


def test_the_clock_is_one_number_a_batch_and_old_ones_go(spark, lake):
    for n in range(8):
        write_down(spark, lake, n, None if n == 3 else 100 + n)
    assert latest_seen(spark, lake, 7) == 107 and latest_seen(spark, lake, -1) is None
    assert list_versions(spark, lake, "batch_id=") == [4, 5, 6, 7]
    write_down(spark, lake, 8, 50)  # an older one does not turn the clock back
    assert latest_seen(spark, lake, 8) == 107


def test_only_clean_rows_are_late(spark):
    rows = spark.createDataFrame([("x", at(8, 0), "", "OK"), ("y", at(8, 0), "INVALID_SPEED", "REJECTED"), ("z", None, "", "OK")],
                                 "vehicle_id string, event_ts timestamp, invalid_reason string, dq_flag string")
    got = {r.vehicle_id: (r.invalid_reason, r.dq_flag) for r in with_late_verdict(rows, int(at(9, 0).timestamp()) * 1_000_000).collect()}
    assert got == {"x": ("LATE_EVENT", "REJECTED"), "y": ("INVALID_SPEED", "REJECTED"), "z": ("", "OK")}


AHEAD = [
    [("a", at(8, 0), at(8, 0)), ("fast", at(8, 10), at(8, 0))],  # a clock ten minutes ahead
    [("b", at(8, 1), at(8, 1))],
    [("slow", at(7, 50), at(8, 2)), ("late", at(7, 44), at(8, 2))],
]


@pytest.mark.parametrize("bounded, late", [(False, ["late", "slow"]), (True, ["late"])])
def test_a_clock_that_runs_ahead(spark, routed, bounded, late):
    """Fifteen minutes before the latest arrival are allowed, not five."""
    cfg = dataclasses.replace(routed, arrival_bounds_clock=bounded)
    run(spark, cfg, AHEAD)
    silver, rejected = outcome(spark, cfg)
    assert sorted(v for v, _ in rejected) == late and sorted(silver + late) == ["a", "b", "fast", "late", "slow"]


@pytest.mark.parametrize("slices", [0, 3])
def test_copies_are_dropped_whatever_time_the_watermark_follows(spark, lake, slices):
    rows = [("a", at(8, 0), at(8, 0)), ("a", at(8, 0), at(8, 1)), ("b", at(8, 0), at(8, 1)), ("a", at(8, 3), at(8, 3))]
    frame = spark.createDataFrame(rows, "vehicle_id string, event_ts timestamp, kafka_timestamp timestamp")
    frame.write.parquet(f"{lake}/in")
    stream = stream_table(spark, f"{lake}/in", frame.schema)
    unique = dedup_stream(stream, slices=slices, seen=bounded_by_arrival())
    append_sink(unique, f"{lake}/out", f"{lake}/chk", trigger=ONCE).awaitTermination()
    got = read_table(spark, f"{lake}/out")
    assert got.columns == frame.columns and sorted((r.vehicle_id, r.event_ts.minute) for r in got.collect()) == [("a", 0), ("a", 3), ("b", 0)]
