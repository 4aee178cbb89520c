"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the data folder, BENCH_CPUS the number of local cores.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import SparkSession

from pavelake.checks.queries import registered
from pavelake.session import build_session

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 4))

HEADLINE = [
    "bronze_parse",
    "silver_clean",
    "silver_rejected",
    "silver_dedup",
    "zone_hourly",
    "road_hourly",
    "rejected_summary",
    "gold_fact",
    "dim_zone",
    "speed_by_congestion",
    "top_zone_windows",
    "dash_zone_risk",
    "dash_slow_zones",
    "unscored_rows",
    "regression_metrics",
    "bronze_stream",
    "silver_stream",
    "gold_fact_stream",
    "zone_hourly_stream",
    "dim_zone_stream",
    "ml_linear",
    "ml_decision_tree",
    "ml_random_forest",
    "ml_gbt",
    "ml_leaderboard",
    "score_new_rows",
    "late_drop_audit",
]


def session() -> SparkSession:
    spark = build_session("bench", f"local[{CPUS}]", conf={
        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="bench-"),
        "spark.sql.shuffle.partitions": CPUS,
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g",
    })
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def seconds(spark: SparkSession, name: str) -> float:
    """Whole query, streaming runs and fits included, down to the last result row."""
    started = time.perf_counter()
    registered()[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main(names: list[str]) -> None:
    spark = session()
    # The JVM compiles its hot paths on a first run that is not counted.
    for warm_up in ("zone_hourly", "silver_dedup"):
        seconds(spark, warm_up)
    times = {name: round(seconds(spark, name), 3) for name in names or HEADLINE}
    spark.stop()
    print(json.dumps({
        "metric": "total time of the headline queries",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1],
    }))


if __name__ == "__main__":
    main(sys.argv[1:])
