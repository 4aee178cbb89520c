"""The physical plans that make the operators scale."""

import re

import pytest
from pyspark.sql import functions as F

from pavelake.checks import queries
from pavelake.operators import regression, reports
from pavelake.operators.dedup import dedup_batch
from pavelake.operators.hourly import zone_hourly
from pavelake.operators.quality import clean_rows, passing_rows
from pavelake.operators.star import dimension, fact_rows
from pavelake.schemas import BRONZE, FACT, MESSAGE, SILVER
from pavelake.session import setting
from pavelake.sources import bindings
from pavelake.sources.messages import decode_messages
from pavelake.sources.tables import stream_table
from pavelake.streaming.dimensions import add_new_keys


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Empty tables are enough: plans do not depend on rows here."""
    root = tmp_path_factory.mktemp("tables")
    found = {}
    for name, schema in {"bronze": BRONZE, "silver": SILVER, "fact": FACT, "messages": MESSAGE}.items():
        path = str(root / name)
        spark.createDataFrame([], schema).write.parquet(path)
        found[name] = spark.read.schema(schema).parquet(path)
    return found


def test_rules_reach_the_scan_and_text_is_read_once(tables):
    text = plan(clean_rows(tables["bronze"]))
    pushed = re.search(r"PushedFilters: \[(.*?)\], ReadSchema", text).group(1)
    for test in ("IsNotNull(road_id)", "LessThanOrEqual(traffic_volume,1000)", "In(incident_flag, [0,1])", "In(weather"):
        assert test in pushed
    assert text.count("cast(event_time") == 1
    assert "Exchange" not in text


def test_messages_are_parsed_once_whatever_is_filtered(tables):
    assert plan(clean_rows(decode_messages(tables["messages"]))).count("from_json") == 1


def test_messages_are_written_once_whatever_is_filtered(spark, tmp_path):
    spark.createDataFrame([], bindings.EVENTS).write.parquet(str(tmp_path / "events.parquet"))
    text = plan(clean_rows(decode_messages(bindings.messages(bindings.events_batch(spark, str(tmp_path))))))
    assert text.count("StructsToJsonEvaluator") == 1


def test_one_row_group_is_parsed_by_many_tasks(spark, tmp_path):
    rows = [(i, None, i, "view", 50.0, '{"k": 7}') for i in range(4000)]
    spark.createDataFrame(rows, bindings.EVENTS).coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    with setting(spark, "spark.sql.adaptive.coalescePartitions.enabled", "false"):
        tasks = queries.bronze_parse(spark, str(tmp_path)).groupBy(F.spark_partition_id()).count().collect()
    assert len(tasks) > 1 and max(n for _, n in tasks) < 2000


def test_dedup_thins_copies_before_the_shuffle(tables):
    text = plan(dedup_batch(passing_rows(tables["bronze"])))
    before, after = text.index("WindowGroupLimit"), text.rindex("WindowGroupLimit")
    assert before < text.index("Exchange hashpartitioning") < after
    assert "Partial" in text[after:after + 200]
    assert "parse_ok" not in text


def test_hourly_combines_before_its_only_shuffle(tables):
    text = plan(zone_hourly(tables["silver"]))
    assert text.count("Exchange") == 1 and "partial_avg" in text[text.index("Exchange"):]
    assert "Expand" not in text and "raw_json" not in text.split("ReadSchema")[1]


def test_dimension_reads_one_column(tables):
    text = plan(dimension(tables["silver"], "dim_road"))
    assert "ReadSchema: struct<road_id:string>" in text and text.count("HashAggregate") == 2


def test_fact_and_clean_rows_do_not_shuffle(tables):
    assert "Exchange" not in plan(fact_rows(tables["silver"]))


def test_top_windows_keep_k_rows_per_task(tables):
    assert "TakeOrderedAndProject(limit=10" in plan(reports.top_zone_windows(zone_hourly(tables["silver"])))


def test_star_join_meets_one_row_per_zone(tables):
    text = plan(reports.zone_risk(tables["fact"], dimension(tables["silver"], "dim_zone")))
    join = text.index("Join")
    assert "HashAggregate" in text[join:] and "CartesianProduct" not in text and "NestedLoop" not in text


def test_late_and_unscored_joins_are_equi_joins(tables):
    text = plan(regression.unscored(tables["fact"], tables["fact"]))
    assert "LeftAnti" in text and "NestedLoop" not in text and "CartesianProduct" not in text


def test_nothing_leaves_the_jvm(tables):
    for df in (zone_hourly(tables["silver"]), clean_rows(tables["bronze"]), reports.slow_zones(tables["fact"])):
        assert "Python" not in plan(df) and "Pandas" not in plan(df)


def test_new_dimension_keys_are_distinct_before_the_join(spark, tables, lake):
    path = f"{lake}/dim_zone"
    keys = spark.createDataFrame([("CBD",)] * 50, "city_zone string")
    add_new_keys(keys, 0, "dim_zone", path)
    assert spark.read.parquet(path).count() == 1


def test_many_dates_are_listed_by_few_tasks(spark, lake):
    name = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before, sc = spark.conf.get(name), spark.sparkContext
    rows = spark.range(40).selectExpr("id", "id AS day")
    rows.write.partitionBy("day").parquet(lake)
    sc.setJobGroup("listing", "")
    try:
        stream_table(spark, lake, rows.schema)
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    tracker = sc.statusTracker()
    stages = [s for job in tracker.getJobIdsForGroup("listing") for s in tracker.getJobInfo(job).stageIds]
    assert [tracker.getStageInfo(s).numTasks for s in stages if tracker.getStageInfo(s).numTasks > 16] == []
    assert stages and spark.conf.get(name) == before
