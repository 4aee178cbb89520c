"""The jobs end to end, in two deliveries, over a folder of message files."""

import dataclasses
import threading
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from pavelake.__main__ import arguments
from pavelake.config import LakeConfig
from pavelake.operators import regression
from pavelake.plans import ingest, inspect, publish, refine, score, train
from pavelake.schemas import BRONZE, DIM_ROAD, FACT, LEADERBOARD, PREDICTIONS, ROAD_HOURLY, SILVER, ZONE_HOURLY
from pavelake.sources import bindings
from pavelake.sources.tables import read_rejected, read_table, read_validated
from pavelake.streaming.audit import as_rejected, late_rows

ONCE = {"availableNow": True}
SF_DIR = "/root/testdata/sf0.001"


def deliver(spark, cfg, part):
    """The messages of one half of the events, in time."""
    events = bindings.events_batch(spark, SF_DIR)
    half = F.col("event_id") < 500
    feed = bindings.messages(events.filter(half if part == 0 else ~half), redeliver=True)
    feed.repartitionByRange(2, "timestamp").write.mode("append").parquet(cfg.message_options["path"])


def run_all(spark, cfg):
    ingest.run(spark, cfg, ONCE)
    refine.run(spark, cfg, ONCE)
    publish.run(spark, cfg, ONCE)


@pytest.fixture(scope="module")
def cfg(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("lake"))
    cfg = LakeConfig(root, message_source="parquet", message_options={"path": f"{root}/messages"}, copy_slices=2)
    deliver(spark, cfg, 0)
    run_all(spark, cfg)
    train.run(spark, cfg, regression.regressors(forest_trees=3, boosting_rounds=3))
    score.skip_existing(spark, cfg)
    deliver(spark, cfg, 1)
    run_all(spark, cfg)
    score.run(spark, cfg, ONCE)
    return cfg


def table(spark, cfg, name, schema=None):
    return read_table(spark, cfg.table(name), cfg.table_format, schema)


def test_every_message_is_accounted_for(spark, cfg):
    sent = spark.read.parquet(cfg.message_options["path"]).count()
    assert table(spark, cfg, "bronze", BRONZE).count() == sent == 1050
    passed, rejected, silver = read_validated(spark, cfg, "OK"), read_rejected(spark, cfg), table(spark, cfg, "silver")
    assert passed.count() + rejected.count() == sent
    late = late_rows(passed, silver)
    distinct = passed.select("vehicle_id", "event_ts").distinct().count()
    assert silver.count() + late.select("vehicle_id", "event_ts").distinct().count() == distinct
    assert silver.select("vehicle_id", "event_ts").distinct().count() == silver.count()
    assert as_rejected(late).columns == rejected.columns


def test_table_contracts(spark, cfg):
    for name, schema in {"silver": SILVER, "fact": FACT}.items():
        assert table(spark, cfg, name, schema).schema == schema
    for name, schema in {"zone_hourly": ZONE_HOURLY, "road_hourly": ROAD_HOURLY}.items():
        assert publish.read_hourly(spark, cfg, name).dtypes == [(f.name, f.dataType.simpleString()) for f in schema]
    assert inspect.gold_tables(spark, cfg)["dim_road"].columns == DIM_ROAD.fieldNames()


def test_gold_follows_silver(spark, cfg):
    silver = table(spark, cfg, "silver", SILVER)
    n = silver.count()
    assert table(spark, cfg, "fact", FACT).count() == n
    for name in ("zone_hourly", "road_hourly"):
        hourly = publish.read_hourly(spark, cfg, name)
        assert hourly.agg(F.sum("event_count")).first()[0] == n
        assert hourly.filter("min_speed > avg_speed or avg_speed > max_speed").isEmpty() if "zone" in name else True
    gold = inspect.gold_tables(spark, cfg)
    for name, key in (("dim_zone", "city_zone"), ("dim_road", "road_id"), ("dim_weather", "weather")):
        keys = [r[0] for r in gold[name].select(key).collect()]
        assert sorted(keys) == sorted(r[0] for r in silver.select(key).distinct().collect())


def test_fact_is_partitioned_by_date(spark, cfg):
    plan = table(spark, cfg, "fact", FACT).filter("event_date = date'2024-01-02'")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in text


def test_rejected_reads_its_own_partition_only(spark, cfg):
    text = read_rejected(spark, cfg)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dq_flag" in text


def test_jobs_can_be_repeated_without_change(spark, cfg):
    before = {n: table(spark, cfg, n).count() for n in ("bronze", "silver", "fact")}
    run_all(spark, cfg)
    assert before == {n: table(spark, cfg, n).count() for n in before}


def test_training_leaves_its_artifacts(spark, cfg):
    board = train.read_leaderboard(spark, cfg)
    assert board.columns == LEADERBOARD.fieldNames()
    rows = board.collect()
    assert sorted(r.model_name for r in rows) == sorted(regression.regressors())
    assert [r.test_r2 for r in rows] == sorted((r.test_r2 for r in rows), reverse=True)
    metadata = spark.read.json(cfg.table("training_metadata")).first()
    assert metadata.best_model_name == rows[0].model_name
    assert tuple(metadata.feature_columns) == regression.FEATURES
    runs = table(spark, cfg, "model_runs")
    assert runs.count() == 4 and set(runs.first().metrics) == set(train.METRICS)


def test_scoring_passes_over_what_was_there(spark, cfg):
    predictions = score.read_predictions(spark, cfg)
    fact = table(spark, cfg, "fact", FACT)
    assert predictions.columns == PREDICTIONS.fieldNames()
    first_scored = predictions.agg(F.min("event_ts")).first()[0]
    new = fact.filter(F.col("event_ts") >= F.lit(first_scored))
    assert predictions.count() == new.count() and 0 < predictions.count() < fact.count()
    assert regression.unscored(new, predictions).isEmpty()
    wrong = predictions.filter("abs(prediction_error - (speed_int - predicted_speed)) > 0.0051")
    assert wrong.isEmpty()


def test_scoring_to_csv(spark, cfg, tmp_path):
    other = dataclasses.replace(cfg, root=str(tmp_path))
    train.save(spark, other, train.fit_all(
        table(spark, cfg, "fact", FACT), {"Linear Regression": regression.regressors()["Linear Regression"]}))
    table(spark, cfg, "fact", FACT).write.partitionBy("event_date").parquet(other.table("fact"))
    score.start_scoring(spark, other, ONCE, fmt="csv").awaitTermination()
    assert score.read_predictions(spark, other, "csv").count() == table(spark, cfg, "fact", FACT).count()


def test_scoring_goes_on_until_stopped(spark, cfg, tmp_path):
    """A first start passes over what is stored and then scores what comes in, whatever ended in this session before."""
    other = dataclasses.replace(cfg, root=str(tmp_path))
    fact = table(spark, cfg, "fact", FACT)
    train.save(spark, other, train.fit_all(fact, {"Linear Regression": regression.regressors()["Linear Regression"]}))
    first = F.col("event_ts") < fact.select(F.expr("percentile(unix_seconds(event_ts), 0.5)").cast("timestamp")).first()[0]
    fact.where(first).write.partitionBy("event_date").parquet(other.table("fact"))
    # a start that died before its first commit leaves this behind
    Path(other.checkpoint("predictions"), "offsets").mkdir(parents=True)
    job = threading.Thread(target=score.run, args=(spark, other, {"processingTime": "1 second"}), daemon=True)
    job.start()
    wait_for(lambda: any(q.name == "predictions" and q.isActive and q.lastProgress for q in spark.streams.active))
    fact.where(~first).write.mode("append").partitionBy("event_date").parquet(other.table("fact"))
    new = fact.where(~first).count()

    def scored():
        try:
            return score.read_predictions(spark, other).count()
        except Exception:  # nothing committed so far
            return 0

    wait_for(lambda: scored() >= new)
    assert job.is_alive() and scored() == new
    for query in spark.streams.active:
        query.stop()
    job.join(30)
    assert not job.is_alive()


def wait_for(done, seconds=120):
    end = time.time() + seconds
    while not done():
        assert time.time() < end
        time.sleep(0.5)


def test_scoring_without_a_model(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="training"):
        score.load_model(spark, LakeConfig(str(tmp_path)))


def test_inspection(spark, cfg):
    found = inspect.inspect_silver(spark, cfg) | inspect.inspect_gold(spark, cfg)
    assert found["silver sample"].count() == 20 and found["fact sample"].count() == 10
    summary = found["rejected rows by reason"].collect()
    assert 0 < len(summary) <= 20
    assert [r.row_count for r in summary] == sorted((r.row_count for r in summary), reverse=True)
    profile = found["silver profile"].collect()
    assert [r.column_name for r in profile] == SILVER.fieldNames()
    for title in ("zones and their risk", "weather impact", "slow zones", "speed drop by congestion level"):
        assert found[title].count() > 0


def test_append_mode_hourly(spark, cfg):
    other = dataclasses.replace(cfg, hourly_mode="append")
    other_root = cfg.root + "/append"
    query = publish.HOURLY["zone_hourly"](publish.silver_stream(spark, other), other.window, other.watermark)
    from pavelake.streaming.sinks import append_sink

    append_sink(query, f"{other_root}/zone", f"{other_root}/chk", trigger=ONCE).awaitTermination()
    closed = read_table(spark, f"{other_root}/zone")
    everything = publish.read_hourly(spark, cfg, "zone_hourly")
    assert closed.exceptAll(everything).isEmpty() and 0 < closed.count() < everything.count()


def test_arguments():
    args = arguments(["bronze", "--root", "/lake", "--option", "subscribe=events", "--once"])
    assert (args.job, args.root, args.option, args.once) == ("bronze", "/lake", ["subscribe=events"], True)
