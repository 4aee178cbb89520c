"""Deduplication, lateness, windows, sinks and restarts, on small scripts with known outcomes."""

from datetime import datetime, timezone

import time

import pytest
from pyspark.sql import functions as F

from pavelake.operators.dedup import dedup_batch, dedup_stream
from pavelake.operators.hourly import road_hourly, zone_hourly
from pavelake.sources.tables import drop_versions, list_versions, read_latest, read_table, stream_table
from pavelake.streaming.audit import LateRows, late_rows, read_late_rows
from pavelake.streaming.dimensions import add_new_keys, dimension_sink, read_dimension
from pavelake.streaming.sinks import append_sink, rewrite_sink, write_batch
from pavelake.streaming.supervise import run_to_end, run_until_first_stops

ONCE = {"availableNow": True}
SCHEMA = "v string, event_ts timestamp, z string, sp int"


def at(hour, minute):
    return datetime(2024, 1, 1, hour, minute, tzinfo=timezone.utc)


FILES = [
    [("a", at(8, 0), "CBD", 10), ("a", at(8, 0), "CBD", 99), ("b", at(9, 0), "CBD", 20)],
    [("late", at(8, 30), "CBD", 30), ("ok", at(8, 50), "AIR", 40)],
    [("late2", at(8, 30), "CBD", 50), ("c", at(9, 1), "CBD", 60)],
]


@pytest.fixture
def feed(spark, lake):
    """Three files in order of arrival, read one per micro-batch."""
    path = f"{lake}/feed"
    for rows in FILES:
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)
    schema = spark.read.parquet(path).schema
    return stream_table(spark, path, schema, max_files_per_trigger=1)


def run(start):
    query = start()
    query.awaitTermination()
    return query


@pytest.mark.parametrize("slices", [0, 4])
def test_late_rows_follow_the_watermark(spark, lake, feed, slices):
    unique = dedup_stream(feed, ["v", "event_ts"], slices=slices)
    listener = LateRows(spark, f"{lake}/late_rows")
    spark.streams.addListener(listener)
    try:
        query = run(lambda: append_sink(unique, f"{lake}/out", f"{lake}/chk", trigger=ONCE))
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
        for _ in range(100):  # reports reach Python listeners a little later
            if listener.of(query):
                break
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(listener)
    kept = read_table(spark, f"{lake}/out")
    assert sorted(r.v for r in kept.collect()) == ["a", "b", "c", "late", "ok"]
    assert listener.of(query) == 1
    assert [r.late_rows for r in read_late_rows(spark, f"{lake}/late_rows").collect()] == [1]
    everything = read_table(spark, f"{lake}/feed")
    assert [r.v for r in late_rows(everything, kept, ["v", "event_ts"]).collect()] == ["late2"]


def hourly(df):
    windowed = df.withWatermark("event_ts", "15 minutes").groupBy(F.window("event_ts", "1 hour"), "z")
    return windowed.agg(F.count("*").alias("n"), F.avg("sp").alias("avg_sp"))


def test_complete_mode_drops_nothing(spark, lake, feed):
    run(lambda: rewrite_sink(hourly(feed), f"{lake}/out", f"{lake}/chk", trigger=ONCE))
    got = {(r.window.start.hour, r.z): (r.n, r.avg_sp) for r in read_latest(spark, f"{lake}/out").collect()}
    assert got == {(8, "CBD"): (4, 47.25), (8, "AIR"): (1, 40.0), (9, "CBD"): (2, 40.0)}
    assert len(list_versions(spark, f"{lake}/out")) == 3  # readers may be busy with any of them
    drop_versions(spark, f"{lake}/out", 3600)
    assert len(list_versions(spark, f"{lake}/out")) == 3
    drop_versions(spark, f"{lake}/out", 0)
    assert list_versions(spark, f"{lake}/out") == [2]


def test_append_mode_publishes_closed_windows_only(spark, lake, feed):
    run(lambda: append_sink(hourly(feed), f"{lake}/out", f"{lake}/chk", trigger=ONCE))
    assert read_table(spark, f"{lake}/out").count() == 0


def test_latest_version_needs_a_commit(spark, lake):
    df = spark.range(3)
    df.write.parquet(f"{lake}/t/version=1")
    df.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{lake}/t/version=2")
    assert list_versions(spark, f"{lake}/t") == [1]
    with pytest.raises(FileNotFoundError):
        read_latest(spark, f"{lake}/nothing")


def test_restart_neither_loses_nor_repeats(spark, lake, feed):
    def once():
        unique = dedup_stream(feed, ["v", "event_ts"])
        return run(lambda: append_sink(unique, f"{lake}/out", f"{lake}/chk", trigger=ONCE))

    once()
    again = [("b", at(9, 0), "CBD", 21), ("d", at(9, 2), "CBD", 1)]
    spark.createDataFrame(again, SCHEMA).coalesce(1).write.mode("append").parquet(f"{lake}/feed")
    once()
    once()
    rows = [r.v for r in read_table(spark, f"{lake}/out").collect()]
    assert sorted(rows) == ["a", "b", "c", "d", "late", "ok"]


def copies(spark, n, hot_share=3):
    """A third of all rows are copies of one event."""
    hot = F.col("id") % hot_share == 0
    return spark.range(0, n, 1, 8).select(
        F.when(hot, "hot").otherwise(F.concat(F.lit("v"), F.col("id"))).alias("vehicle_id"),
        F.when(hot, F.lit(at(8, 0))).otherwise(F.lit(at(8, 1))).alias("event_ts"),
        F.timestamp_seconds(F.lit(1704096000) + F.col("id")).alias("kafka_timestamp"),
        F.lit("{}").alias("raw_json"),
    )


def test_batch_dedup_keeps_the_first_arrival_of_a_hot_key(spark):
    kept = dedup_batch(copies(spark, 3000)).collect()
    assert len(kept) == 2001
    hot = next(r for r in kept if r.vehicle_id == "hot")
    assert hot.kafka_timestamp == datetime(2024, 1, 1, 8, 0)


def test_stream_dedup_thins_a_hot_key_before_its_reducer(spark, lake):
    copies(spark, 3000).write.parquet(f"{lake}/feed")
    schema = spark.read.parquet(f"{lake}/feed").schema
    unique = dedup_stream(stream_table(spark, f"{lake}/feed", schema), slices=4)
    query = run(lambda: append_sink(unique, f"{lake}/out", f"{lake}/chk", trigger=ONCE))
    assert read_table(spark, f"{lake}/out").count() == 2001
    first = next(p for p in query.recentProgress if p.numInputRows)
    # Operators are listed from the sink down: the last step receives at most one copy per slice.
    dropped = [op.customMetrics.get("numDroppedDuplicateRows", 0) for op in first.stateOperators]
    assert len(dropped) == 2 and sum(dropped) == 999 and min(dropped) <= 3


def silver_like(spark, zones):
    rows = [(z, f"R{i}", "CLEAR", at(8, i)) for i, z in enumerate(zones)]
    return spark.createDataFrame(rows, "city_zone string, road_id string, weather string, event_ts timestamp")


def test_dimensions_gain_new_keys_only(spark, lake):
    path = f"{lake}/dim_zone"
    add_new_keys(silver_like(spark, ["CBD", "CBD", "SUBURB"]), 0, "dim_zone", path)
    add_new_keys(silver_like(spark, ["CBD", "TECHPARK"]), 1, "dim_zone", path)
    add_new_keys(silver_like(spark, ["CBD", "TECHPARK"]), 1, "dim_zone", path)  # the same batch once more
    add_new_keys(silver_like(spark, ["CBD"]), 2, "dim_zone", path)
    got = {tuple(r) for r in read_dimension(spark, "dim_zone", path).collect()}
    assert got == {
        ("CBD", "Commercial", "HIGH"), ("SUBURB", "Residential", "LOW"), ("TECHPARK", "IT Hub", "MEDIUM")
    }
    assert read_dimension(spark, "dim_zone", path).count() == 3


def test_dimension_sink_over_several_batches(spark, lake):
    path = f"{lake}/silver"
    for zones in (["CBD"], ["CBD", "AIRPORT"], ["SUBURB"]):
        silver_like(spark, zones).coalesce(1).write.mode("append").parquet(path)
    silver = stream_table(spark, path, spark.read.parquet(path).schema, max_files_per_trigger=1)
    paths = {name: f"{lake}/{name}" for name in ("dim_zone", "dim_road", "dim_weather")}
    run(lambda: dimension_sink(silver, paths, f"{lake}/chk", trigger=ONCE))
    counts = {name: read_dimension(spark, name, path).count() for name, path in paths.items()}
    assert counts == {"dim_zone": 3, "dim_road": 2, "dim_weather": 1}


def test_repeated_batch_replaces_itself(spark, lake):
    for _ in range(2):
        write_batch(spark.range(5), 7, f"{lake}/t")
    assert spark.read.parquet(f"{lake}/t").count() == 5


def test_one_stopping_query_stops_the_others(spark, lake, feed):
    forever = []

    def endless():
        forever.append(append_sink(feed, f"{lake}/a", f"{lake}/chk/a"))
        return forever[0]

    run_until_first_stops(spark, [endless, lambda: append_sink(feed, f"{lake}/b", f"{lake}/chk/b", trigger=ONCE)])
    assert not forever[0].isActive


def test_failing_query_is_reported(spark, lake, feed):
    broken = feed.withColumn("x", F.raise_error(F.lit("boom")))
    with pytest.raises(Exception, match="boom"):
        run_to_end([lambda: append_sink(broken, f"{lake}/a", f"{lake}/chk", trigger=ONCE)])


def test_hourly_metrics_against_brute_force(spark):
    n = 500
    df = spark.range(n).select(
        F.timestamp_seconds(F.lit(1704096000) + F.col("id") * 97).alias("event_ts"),
        F.when(F.col("id") % 3 == 0, "CBD").otherwise("SUBURB").alias("city_zone"),
        F.concat(F.lit("R"), F.col("id") % 2).alias("road_id"),
        F.lit("RAIN").alias("weather"),
        (F.col("id") % 2).cast("int").alias("peak_flag"),
        (F.col("id") % 160).cast("int").alias("speed_int"),
        (F.col("id") % 900).cast("int").alias("traffic_volume_int"),
        (F.col("id") % 5 + 1).cast("int").alias("congestion_level_int"),
        (F.col("id") % 7 == 0).cast("int").alias("incident_flag_int"),
    )
    pdf = df.toPandas()
    pdf["w"] = pdf.event_ts.dt.floor("h")
    zones = pdf.groupby(["w", "city_zone", "weather", "peak_flag"]).agg(
        n=("speed_int", "size"), s=("speed_int", "mean"), v=("traffic_volume_int", "mean"),
        c=("congestion_level_int", "mean"), i=("incident_flag_int", "sum"), lo=("speed_int", "min"),
        hi=("speed_int", "max"))
    got = {
        (r.window_start, r.city_zone, r.weather, r.peak_flag): (
            r.event_count, r.avg_speed, r.avg_traffic_volume, r.avg_congestion_level, r.incident_count, r.min_speed,
            r.max_speed)
        for r in zone_hourly(df).collect()
    }
    assert got == {key: tuple(row) for key, row in zip(zones.index, zones.itertuples(index=False))}
    roads = pdf.groupby(["w", "road_id", "weather"]).size()
    assert {(r.window_start, r.road_id, r.weather): r.event_count for r in road_hourly(df).collect()} == dict(roads)


def test_stream_is_freed_of_scored_rows_by_a_static_table(spark, lake, feed):
    from pavelake.operators.regression import unscored

    done = spark.createDataFrame([("b", at(9, 0))], "v string, event_ts timestamp")
    run(lambda: append_sink(unscored(feed, done, ["v", "event_ts"]), f"{lake}/out", f"{lake}/chk", trigger=ONCE))
    assert sorted(r.v for r in read_table(spark, f"{lake}/out").collect()) == ["a", "a", "c", "late", "late2", "ok"]


@pytest.mark.parametrize("fmt", ["orc", "json"])
def test_other_table_formats(spark, lake, feed, fmt):
    run(lambda: append_sink(feed, f"{lake}/out", f"{lake}/chk", fmt=fmt, trigger=ONCE))
    assert read_table(spark, f"{lake}/out", fmt, feed.schema).count() == 7


def test_messages_are_published_and_read_back(spark, lake, feed):
    from pavelake.config import LakeConfig
    from pavelake.sources.messages import encode_messages, message_stream
    from pavelake.streaming.sinks import message_sink

    topic = f"{lake}/topic"
    run(lambda: message_sink(encode_messages(feed), f"{lake}/chk", fmt="parquet", trigger=ONCE,
                             options={"path": topic}))
    cfg = LakeConfig(lake, message_source="parquet", message_options={"path": topic})
    run(lambda: append_sink(message_stream(spark, cfg), f"{lake}/copy", f"{lake}/chk2", trigger=ONCE))
    texts = [bytes(r.value).decode() for r in read_table(spark, f"{lake}/copy").collect()]
    assert len(texts) == 7 and '{"v":"c","event_ts":"2024-01-01T09:01:00.000000+00:00","z":"CBD","sp":60}' in texts


def test_scratch_tables_go_where_the_cluster_says():
    from types import SimpleNamespace

    from pavelake.session import shared_folder

    def session(settings, master):
        context = SimpleNamespace(getConf=lambda: settings, master=master)
        return SimpleNamespace(sparkContext=context, conf=settings)

    named = session({"spark.checkpoint.dir": "hdfs:///shared/"}, "yarn")
    first, second = shared_folder(named, "x"), shared_folder(named, "x")
    assert first.startswith("hdfs:///shared/x-") and first != second
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(session({}, "yarn"), "x")
