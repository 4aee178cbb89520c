"""Profiles, samples and the validation reports over a lake's tables, as data frames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pavelake.config import LakeConfig
from pavelake.operators import reports
from pavelake.operators.star import DIMENSIONS
from pavelake.plans.publish import read_hourly
from pavelake.schemas import FACT, SILVER
from pavelake.sources.tables import read_rejected, read_table
from pavelake.streaming.dimensions import read_dimension


def inspect_silver(spark: SparkSession, cfg: LakeConfig, sample: int = 20) -> dict[str, DataFrame]:
    silver = read_table(spark, cfg.table("silver"), cfg.table_format, SILVER)
    rejected = read_rejected(spark, cfg)
    return {
        "silver profile": reports.table_profile(silver, "silver"),
        "silver sample": reports.sample_rows(silver, sample),
        "rejected profile": reports.table_profile(rejected, "silver_rejected"),
        "rejected sample": reports.sample_rows(rejected, sample),
        "rejected rows by reason": reports.rejected_summary(rejected),
    }


def gold_tables(spark: SparkSession, cfg: LakeConfig) -> dict[str, DataFrame]:
    return {
        **{name: read_dimension(spark, name, cfg.table(name), cfg.table_format) for name in DIMENSIONS},
        "fact": read_table(spark, cfg.table("fact"), cfg.table_format, FACT),
        "zone_hourly": read_hourly(spark, cfg, "zone_hourly"),
        "road_hourly": read_hourly(spark, cfg, "road_hourly"),
    }


def inspect_gold(spark: SparkSession, cfg: LakeConfig, sample: int = 10) -> dict[str, DataFrame]:
    tables = gold_tables(spark, cfg)
    fact = tables["fact"]
    found: dict[str, DataFrame] = {}
    for name, table in tables.items():
        found[f"{name} profile"] = reports.table_profile(table, name)
        found[f"{name} sample"] = reports.sample_rows(table, sample)
    return found | {
        "speed by congestion level": reports.speed_by_congestion(fact),
        "speed by zone": reports.speed_by_zone(fact),
        "incidents by zone": reports.incidents_by_zone(fact),
        "most congested zone windows": reports.top_zone_windows(tables["zone_hourly"]),
        "busiest road windows": reports.top_road_windows(tables["road_hourly"]),
        "zones and their risk": reports.zone_risk(fact, tables["dim_zone"]),
        "speed drop by congestion level": reports.speed_drop(fact),
        "weather impact": reports.weather_impact(fact, tables["dim_weather"]),
        "slow zones": reports.slow_zones(fact, cfg.window),
    }


def show(found: dict[str, DataFrame], rows: int = 100) -> None:
    """Print each table, of long ones the first rows, and say how many there are."""
    for title, df in found.items():
        print(f"\n{title} ({df.count()} rows, at most {rows} shown)")
        df.show(rows, truncate=False)
