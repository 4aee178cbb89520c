"""Raw table to validated (clean and rejected) and to the deduplicated clean table.

The first query reads the raw table once and writes every row to one table partitioned by verdict,
so both outcomes are judged by the same clock and committed together. The second streams the clean
partition through watermark and deduplication. With ``route_late`` the first query also tells late rows apart, so that
the second drops none.
"""

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pavelake.config import LakeConfig
from pavelake.operators.dedup import bounded_by_arrival, copy_slices, dedup_stream
from pavelake.operators.features import with_features
from pavelake.operators.quality import OK, validate, with_clean_verdict, without_verdict
from pavelake.schemas import BRONZE, SILVER, VALIDATED
from pavelake.session import setting
from pavelake.sources.tables import BATCHED, stream_table
from pavelake.streaming.lateness import routing_sink
from pavelake.streaming.sinks import Trigger, append_sink
from pavelake.streaming.supervise import is_finite, run_to_end, run_until_first_stops


def seen_time(cfg: LakeConfig) -> Column | None:
    return bounded_by_arrival() if cfg.arrival_bounds_clock else None


def start_validated(spark: SparkSession, cfg: LakeConfig, trigger: Trigger = None) -> StreamingQuery:
    bronze = stream_table(spark, cfg.table("bronze"), BRONZE, cfg.table_format, cfg.max_files_per_trigger)
    if cfg.route_late:
        return routing_sink(
            validate(bronze, cfg.limits),
            cfg.table("silver_routed"),
            cfg.checkpoint("silver_routed"),
            cfg.checkpoint("silver_routed_clock"),
            watermark=cfg.watermark,
            seen=seen_time(cfg),
            name="silver_routed",
            fmt=cfg.table_format,
            trigger=trigger,
        )
    return append_sink(
        validate(bronze, cfg.limits),
        cfg.table("silver_validated"),
        cfg.checkpoint("silver_validated"),
        name="silver_validated",
        fmt=cfg.table_format,
        partition_by=["dq_flag"],
        balance=["dq_flag"],
        trigger=trigger,
    )


def start_silver(spark: SparkSession, cfg: LakeConfig, trigger: Trigger = None) -> StreamingQuery:
    if cfg.route_late:
        # Batches are taken whole and none without data comes between, so the watermark here is never ahead of the one
        # that rows were judged by: what was on time there is on time here.
        validated = stream_table(spark, cfg.table("silver_routed"), BATCHED, cfg.table_format).select(*VALIDATED.fieldNames())
    else:
        validated = stream_table(
            spark, cfg.table("silver_validated"), VALIDATED, cfg.table_format, cfg.max_files_per_trigger
        )
    passing = without_verdict(validated.filter(F.col("dq_flag") == OK))
    unique = dedup_stream(
        passing, watermark=cfg.watermark, slices=copy_slices(spark, cfg.copy_slices), seen=seen_time(cfg)
    )
    with setting(spark, "spark.sql.streaming.noDataMicroBatches.enabled", "false" if cfg.route_late else None):
        return append_sink(
            with_features(with_clean_verdict(unique)).select(*SILVER.fieldNames()),
            cfg.table("silver"),
            cfg.checkpoint("silver"),
            name="silver",
            fmt=cfg.table_format,
            trigger=trigger,
        )


def run(spark: SparkSession, cfg: LakeConfig, trigger: Trigger = None) -> None:
    starters = [lambda: start_validated(spark, cfg, trigger), lambda: start_silver(spark, cfg, trigger)]
    if is_finite(trigger):
        # The second query can only pick up what the first has committed.
        for starter in starters:
            run_to_end([starter])
    else:
        run_until_first_stops(spark, starters)
