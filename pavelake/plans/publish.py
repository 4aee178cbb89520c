"""Clean table to fact, dimensions and hourly metrics."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pavelake.config import LakeConfig
from pavelake.operators.hourly import days_read, road_hourly, window_date, zone_hourly
from pavelake.operators.star import DIMENSIONS, fact_rows
from pavelake.schemas import FACT, ROAD_HOURLY, SILVER, ZONE_HOURLY
from pavelake.sources.tables import read_latest, read_table, stream_table
from pavelake.streaming.dimensions import dimension_sink
from pavelake.streaming.sinks import Trigger, append_sink, partition_sink, rewrite_sink
from pavelake.streaming.supervise import is_finite, run_to_end, run_until_first_stops

WINDOW_DATE = "window_date"
SCHEMAS = {"zone_hourly": ZONE_HOURLY, "road_hourly": ROAD_HOURLY}
HOURLY: dict[str, Callable[..., DataFrame]] = {"zone_hourly": zone_hourly, "road_hourly": road_hourly}


def silver_stream(spark: SparkSession, cfg: LakeConfig) -> DataFrame:
    return stream_table(spark, cfg.table("silver"), SILVER, cfg.table_format, cfg.max_files_per_trigger)


def start_fact(spark: SparkSession, cfg: LakeConfig, trigger: Trigger = None) -> StreamingQuery:
    return append_sink(
        fact_rows(silver_stream(spark, cfg)),
        cfg.table("fact"),
        cfg.checkpoint("fact"),
        name="fact",
        fmt=cfg.table_format,
        partition_by=["event_date"],
        balance=["event_date"],
        trigger=trigger,
    )


def start_dimensions(spark: SparkSession, cfg: LakeConfig, trigger: Trigger = None) -> StreamingQuery:
    return dimension_sink(
        silver_stream(spark, cfg),
        {name: cfg.table(name) for name in DIMENSIONS},
        cfg.checkpoint("dimensions"),
        fmt=cfg.table_format,
        trigger=trigger,
    )


def hourly_table(cfg: LakeConfig, name: str) -> str:
    """Each mode has a table and a checkpoint of its own, so a lake can be switched without mixing them."""
    return {"dates": f"{name}_dates", "complete": name, "append": f"{name}_final"}[cfg.hourly_mode]


def hourly_of_dates(spark: SparkSession, cfg: LakeConfig, name: str) -> Callable[[list[date]], DataFrame]:
    """A function that makes the metrics of all windows starting on some dates, from those dates of the fact table."""
    width = spark.range(1).select((F.timestamp_seconds(F.lit(0)) + F.expr(f"interval {cfg.window}")).cast("double")).first()[0]

    def metrics(dates: list[date]) -> DataFrame:
        fact = read_table(spark, cfg.table("fact"), cfg.table_format, FACT)
        rows = fact.where(F.col("event_date").isin(days_read(dates, width)))
        made = HOURLY[name](rows, cfg.window, None).withColumn(WINDOW_DATE, F.to_date("window_start"))
        return made.where(F.col(WINDOW_DATE).isin(dates)).hint("rebalance", WINDOW_DATE)

    return metrics


def start_hourly_dates(spark: SparkSession, cfg: LakeConfig, name: str, trigger: Trigger = None) -> StreamingQuery:
    """Follow the fact table: each micro-batch rewrites the dates it has events of, late ones included."""
    fact = stream_table(spark, cfg.table("fact"), FACT, cfg.table_format, cfg.max_files_per_trigger)
    table = hourly_table(cfg, name)
    return partition_sink(
        fact.select(window_date(F.col("event_ts"), cfg.window).alias(WINDOW_DATE)), cfg.table(table), cfg.checkpoint(table),
        WINDOW_DATE, hourly_of_dates(spark, cfg, name), name=table, fmt=cfg.table_format, trigger=trigger)


def start_hourly(spark: SparkSession, cfg: LakeConfig, name: str, trigger: Trigger = None) -> StreamingQuery:
    if cfg.hourly_mode == "dates":
        return start_hourly_dates(spark, cfg, name, trigger)
    metrics = HOURLY[name](silver_stream(spark, cfg), cfg.window, cfg.watermark)
    table = hourly_table(cfg, name)
    options = {"name": table, "fmt": cfg.table_format, "trigger": trigger}
    if cfg.hourly_mode == "complete":
        return rewrite_sink(metrics, cfg.table(table), cfg.checkpoint(table), keep_seconds=cfg.keep_versions_seconds, **options)
    return append_sink(metrics, cfg.table(table), cfg.checkpoint(table), **options)


def read_hourly(spark: SparkSession, cfg: LakeConfig, name: str) -> DataFrame:
    read = read_latest if cfg.hourly_mode == "complete" else read_table
    found = read(spark, cfg.table(hourly_table(cfg, name)), cfg.table_format)
    return found.select(*SCHEMAS[name].fieldNames())


def run(spark: SparkSession, cfg: LakeConfig, trigger: Trigger = None) -> None:
    tables = [lambda: start_dimensions(spark, cfg, trigger), lambda: start_fact(spark, cfg, trigger)]
    hourly = [lambda name=name: start_hourly(spark, cfg, name, trigger) for name in HOURLY]
    if is_finite(trigger):
        # Metrics by date follow the fact table and can only pick up what it has committed.
        run_to_end(tables)
        run_to_end(hourly)
    else:
        run_until_first_stops(spark, [*tables, *hourly])
