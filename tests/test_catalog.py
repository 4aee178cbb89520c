"""Tables of a lake by name: the dashboard's questions as SQL text, and names that follow what is committed."""

import dataclasses

import pytest
from pyspark.sql import functions as F

from pavelake.config import LakeConfig
from pavelake.operators import reports
from pavelake.plans import catalog, ingest, inspect, publish, refine
from pavelake.schemas import FACT
from pavelake.sources import bindings
from pavelake.sources.tables import BATCH, read_rejected, read_table, read_validated

ONCE = {"availableNow": True}
SF_DIR = "/root/testdata/sf0.001"

ZONE_RISK = """
    SELECT city_zone, first(zone_type) AS zone_type, first(traffic_risk) AS traffic_risk,
           avg(congestion_level_int) AS avg_congestion_level, sum(incident_flag_int) AS incident_count, count(*) AS row_count
    FROM {db}.fact JOIN {db}.dim_zone USING (city_zone) GROUP BY city_zone"""
SPEED_DROP = """
    SELECT *, avg_speed - lag(avg_speed) OVER (ORDER BY congestion_level_int) AS speed_change
    FROM (SELECT congestion_level_int, avg(speed_int) AS avg_speed, count(*) AS row_count FROM {db}.fact GROUP BY 1)"""
WEATHER_IMPACT = """
    SELECT weather_severity, count(*) AS row_count, avg(speed_int) AS avg_speed,
           avg(traffic_volume_int) AS avg_traffic_volume, avg(incident_flag_int) AS incident_rate
    FROM {db}.fact JOIN {db}.dim_weather USING (weather) GROUP BY 1"""
SLOW_ZONES = """
    SELECT city_zone, count_if(avg_speed < 30) AS slow_windows, count(*) AS windows, count_if(avg_speed < 30) / count(*) AS slow_share
    FROM (SELECT city_zone, date_trunc('HOUR', event_ts) AS w, avg(speed_int) AS avg_speed FROM {db}.fact GROUP BY 1, 2)
    GROUP BY 1"""


def deliver(spark, cfg, part):
    events = bindings.events_batch(spark, SF_DIR)
    half = F.col("event_id") < 500
    bindings.messages(events.filter(half if part == 0 else ~half)).coalesce(2).write.mode("append").parquet(
        cfg.message_options["path"])


def run_all(spark, cfg):
    ingest.run(spark, cfg, ONCE)
    refine.run(spark, cfg, ONCE)
    publish.run(spark, cfg, ONCE)


def lake_of(root, **settings):
    return LakeConfig(root, message_source="parquet", message_options={"path": f"{root}/messages"}, copy_slices=0, **settings)


@pytest.fixture(scope="module")
def cfg(spark, tmp_path_factory):
    cfg = lake_of(str(tmp_path_factory.mktemp("it's a lake")))
    catalog.register(spark, cfg, "roads")  # before anything is there
    deliver(spark, cfg, 0)
    run_all(spark, cfg)
    catalog.register(spark, cfg, "roads")
    return cfg


def same(spark, sql, want):
    got = spark.sql(sql).select(*want.columns)
    rounded = [F.round(c, 9).alias(c) if t == "double" else F.col(c) for c, t in want.dtypes]
    assert want.count() and sorted(map(str, got.select(rounded).collect())) == sorted(map(str, want.select(rounded).collect()))


def test_dashboard_questions_in_sql(spark, cfg):
    gold = inspect.gold_tables(spark, cfg)
    fact = gold["fact"]
    same(spark, ZONE_RISK.format(db="roads"), reports.zone_risk(fact, gold["dim_zone"]))
    same(spark, SPEED_DROP.format(db="roads"), reports.speed_drop(fact))
    same(spark, WEATHER_IMPACT.format(db="roads"), reports.weather_impact(fact, gold["dim_weather"]))
    same(spark, SLOW_ZONES.format(db="roads"), reports.slow_zones(fact))


def test_all_tables_have_names(spark, cfg):
    found = catalog.register(spark, cfg, "roads")
    assert {"bronze", "silver", "silver_validated", "silver_rejected", "fact", "dim_zone", "dim_road", "dim_weather",
            "zone_hourly", "road_hourly", "predictions"} <= set(found)
    assert spark.table("roads.fact").count() == read_table(spark, cfg.table("fact"), schema=FACT).count() > 0
    assert spark.table("roads.silver_rejected").count() == read_rejected(spark, cfg).count() > 0
    assert spark.table("roads.predictions").count() == 0
    for name, want in inspect.gold_tables(spark, cfg).items():
        assert sorted(spark.table(f"roads.{name}").columns) == sorted(want.columns)
        assert spark.table(f"roads.{name}").select(*want.columns).exceptAll(want).isEmpty()
        assert spark.table(f"roads.{name}").count() == want.count()


def test_partitions_are_pruned_by_name(spark, cfg):
    text = spark.sql("SELECT vehicle_id FROM roads.fact WHERE event_date = DATE'2024-01-02'")
    assert "PartitionFilters: [isnotnull(event_date" in text._jdf.queryExecution().executedPlan().toString()
    one = spark.sql("SELECT * FROM roads.zone_hourly_files WHERE window_date = DATE'2024-01-02'")
    assert spark.sql("SHOW PARTITIONS roads.zone_hourly_files").count() > 1
    assert {name.split("window_date=")[1][:10] for name in one.inputFiles()} == {"2024-01-02"}


def test_names_follow_the_jobs(spark, cfg, tmp_path):
    """The listener shows later commits; a batch without a commit mark stays unseen."""
    other = lake_of(str(tmp_path / "lake"), route_late=True)
    catalog.register(spark, other, "followed")
    listener = catalog.Names(spark, other, "followed")
    spark.streams.addListener(listener)
    try:
        for part in (0, 1):
            deliver(spark, other, part)
            run_all(spark, other)
            spark._jsparkSession.sparkContext().listenerBus().waitUntilEmpty()
            gold = inspect.gold_tables(spark, other)
            assert {n: spark.table(f"followed.{n}").count() for n in gold} == {n: t.count() for n, t in gold.items()}
            routed = spark.table("followed.silver_validated")
            assert routed.count() == read_validated(spark, other).count() > 0
            assert routed.where("dq_flag = 'REJECTED'").count() == spark.table("followed.silver_rejected").count() > 0
    finally:
        spark.streams.removeListener(listener)
    before = spark.table("followed.dim_zone").count()
    spark.sql("SELECT 'x' AS city_zone, 'y' AS zone_type, 'z' AS traffic_risk").write.option(
        "mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{other.table('dim_zone')}/{BATCH}99")
    catalog.register(spark, other, "followed")
    assert spark.table("followed.dim_zone").count() == before


def test_versions_and_final_windows(spark, cfg, tmp_path):
    for mode, database in (("complete", "whole"), ("append", "final")):
        other = dataclasses.replace(lake_of(str(tmp_path / mode)), hourly_mode=mode)
        assert "zone_hourly_files" not in catalog.register(spark, other, database)
        deliver(spark, other, 0)
        run_all(spark, other)
        catalog.register(spark, other, database)
        want = publish.read_hourly(spark, other, "zone_hourly")
        assert spark.table(f"{database}.zone_hourly").count() == want.count() > 0
