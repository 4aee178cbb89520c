"""Hourly metrics kept by the dates a micro-batch touches, and append tables with a bounded number of files."""

import dataclasses
from datetime import date, datetime, timezone
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from pavelake.config import LakeConfig
from pavelake.operators.hourly import days_read, road_hourly, zone_hourly
from pavelake.plans import publish
from pavelake.schemas import FACT
from pavelake.sources.tables import stream_table
from pavelake.streaming.sinks import append_sink, batch_sink

ONCE = {"availableNow": True}


def facts(spark, rows):
    """rows: (day, hour, zone, speed)"""
    made = [(f"V{i}", f"R{i % 3}", zone, "RAIN" if i % 2 else "CLEAR", datetime(2024, 1, day, hour, 10, tzinfo=timezone.utc), hour, 0, speed,
             "LOW", 100 + i, "LOW", 2, i % 2, date(2024, 1, day), None) for i, (day, hour, zone, speed) in enumerate(rows)]
    return spark.createDataFrame(made, FACT)


def deliver(spark, cfg, rows):
    facts(spark, rows).coalesce(1).write.mode("append").partitionBy("event_date").parquet(cfg.table("fact"))


def work_off(spark, cfg, name="zone_hourly"):
    query = publish.start_hourly(spark, cfg, name, ONCE)
    query.awaitTermination()
    return query


def files(cfg, name="zone_hourly"):
    folder = Path(cfg.table(publish.hourly_table(cfg, name)))
    return {p: p.stat().st_mtime_ns for p in folder.rglob("part-*")}


def expected(spark, cfg, name="zone_hourly"):
    made = {"zone_hourly": zone_hourly, "road_hourly": road_hourly}[name](spark.read.schema(FACT).parquet(cfg.table("fact")), cfg.window)
    return sorted(made.collect())


FIRST = [(1, 8, "CBD", 30), (1, 8, "CBD", 50), (1, 9, "AIRPORT", 20), (2, 8, "CBD", 10), (3, 23, "CBD", 70)]


@pytest.mark.parametrize("name", ["zone_hourly", "road_hourly"])
def test_a_batch_rewrites_its_own_dates_only_and_keeps_no_state(spark, lake, name):
    cfg = LakeConfig(lake)
    deliver(spark, cfg, FIRST)
    work_off(spark, cfg, name)
    assert sorted(publish.read_hourly(spark, cfg, name).collect()) == expected(spark, cfg, name)
    before = files(cfg, name)
    deliver(spark, cfg, [(2, 8, "CBD", 90), (2, 10, "CBD", 5)])  # late for the third, on time for none
    query = work_off(spark, cfg, name)
    after = files(cfg, name)
    touched = {p for p in before.keys() | after.keys() if before.get(p) != after.get(p)}
    assert touched and all("window_date=2024-01-02" in str(p) for p in touched)
    assert sorted(publish.read_hourly(spark, cfg, name).collect()) == expected(spark, cfg, name)
    assert all(not p.stateOperators for p in query.recentProgress)


def test_a_repeated_batch_changes_nothing(spark, lake):
    """A write that died after some dates, or a commit that was lost, is repeated with the same outcome."""
    cfg = LakeConfig(lake)
    deliver(spark, cfg, FIRST)
    work_off(spark, cfg)
    rebuild = publish.hourly_of_dates(spark, cfg, "zone_hourly")
    for _ in range(2):
        rows = rebuild([date(2024, 1, 1), date(2024, 1, 3)])
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("window_date").parquet(cfg.table("zone_hourly_dates"))
    assert sorted(publish.read_hourly(spark, cfg, "zone_hourly").collect()) == expected(spark, cfg)


def test_dates_in_many_batches_equal_one_batch(spark, lake):
    cfg = dataclasses.replace(LakeConfig(lake), max_files_per_trigger=1)
    for part in range(4):
        deliver(spark, cfg, [(1 + (part + k) % 3, 6 + k, "CBD" if k % 2 else "SUBURB", 10 * k + part) for k in range(6)])
    query = work_off(spark, cfg)
    assert len({p.batchId for p in query.recentProgress if p.numInputRows}) > 4
    assert sorted(publish.read_hourly(spark, cfg, "zone_hourly").collect()) == expected(spark, cfg)


def test_windows_that_reach_into_the_next_date(spark, lake):
    cfg = dataclasses.replace(LakeConfig(lake), window="7 hours")
    deliver(spark, cfg, [(day, hour, "CBD", day + hour) for day in (1, 2, 3) for hour in range(24)])
    work_off(spark, cfg)
    deliver(spark, cfg, [(3, 1, "CBD", 99)])
    work_off(spark, cfg)
    assert sorted(publish.read_hourly(spark, cfg, "zone_hourly").collect()) == expected(spark, cfg)
    assert days_read([date(2024, 1, 1)], 3600) == [date(2024, 1, 1)]
    assert days_read([date(2024, 1, 1)], 7 * 3600) == [date(2024, 1, 1), date(2024, 1, 2)]


def test_only_the_touched_dates_of_the_fact_table_are_read(spark, lake):
    cfg = LakeConfig(lake)
    deliver(spark, cfg, FIRST)
    plan = publish.hourly_of_dates(spark, cfg, "zone_hourly")([date(2024, 1, 2)])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan or "PartitionFilters: [event_date" in plan
    assert "ingested_at" not in plan.split("ReadSchema")[1].split("\n")[0]


def test_a_balanced_append_writes_few_files(spark, lake):
    """Sixteen input files of four dates make one file a date, not one for each task and date."""
    path = f"{lake}/in"
    rows = spark.range(0, 1600, 1, 16).select("id", (F.col("id") % 4).alias("day"))
    rows.write.parquet(path)
    stream = stream_table(spark, path, rows.schema)
    counts = {}
    for name, balance in (("plain", None), ("balanced", ["day"])):
        append_sink(stream, f"{lake}/{name}", f"{lake}/chk-{name}", partition_by=["day"], trigger=ONCE, balance=balance).awaitTermination()
        counts[name] = len(list(Path(f"{lake}/{name}").rglob("part-*")))
        assert spark.read.parquet(f"{lake}/{name}").count() == 1600
    assert counts["balanced"] == 4 < counts["plain"]


def test_the_balance_of_a_micro_batch_is_adaptive(spark, lake):
    rows = spark.range(100).withColumn("day", F.col("id") % 2)
    rows.write.parquet(f"{lake}/in")
    plans = []

    def keep(batch, _):
        frame = batch.hint("rebalance", "day")
        frame.write.format("noop").mode("overwrite").save()
        plans.append(frame._jdf.queryExecution().executedPlan().toString())

    batch_sink(stream_table(spark, f"{lake}/in", rows.schema), f"{lake}/chk", keep, trigger=ONCE).awaitTermination()
    assert "REBALANCE_PARTITIONS_BY_COL" in plans[0] and "AdaptiveSparkPlan" in plans[0]
