"""Score fact rows as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import DateType, StructField, StructType

from pavelake.config import LakeConfig
from pavelake.operators.regression import score
from pavelake.schemas import FACT, PREDICTIONS
from pavelake.sources.tables import has_files, stream_table
from pavelake.plans.train import load_model
from pavelake.streaming.sinks import Trigger, append_sink
from pavelake.streaming.supervise import is_finite, run_to_end, run_until_first_stops

POLL = {"processingTime": "5 seconds"}
NAME = "predictions"


def _fact_stream(spark: SparkSession, cfg: LakeConfig, bounded: bool = True) -> DataFrame:
    limit = cfg.max_files_per_trigger if bounded else None
    return stream_table(spark, cfg.table("fact"), FACT, cfg.table_format, limit)


def skip_existing(spark: SparkSession, cfg: LakeConfig) -> None:
    """Move the scorer's checkpoint past all rows stored so far.

    Its filter lets no row pass, so no file is read. Does nothing once the scorer has committed a
    batch: rows that came in while it was down are then scored on restart. A start that died before its
    first commit is repeated.
    """
    if has_files(spark, f"{cfg.checkpoint(NAME)}/commits"):
        return
    run_to_end([lambda: _append(spark, cfg, _fact_stream(spark, cfg, bounded=False).where("false"), {"availableNow": True})])


def _append(spark: SparkSession, cfg: LakeConfig, fact: DataFrame, trigger: Trigger, fmt: str | None = None) -> StreamingQuery:
    fmt = fmt or cfg.table_format
    scored = score(fact, load_model(spark, cfg)).withColumn("event_date", F.to_date("event_ts"))
    return append_sink(
        scored, cfg.table(NAME), cfg.checkpoint(NAME), name=NAME, fmt=fmt, partition_by=["event_date"], trigger=trigger,
        options={"header": "true"} if fmt == "csv" else None, balance=["event_date"],
    )


def start_scoring(
    spark: SparkSession,
    cfg: LakeConfig,
    trigger: Trigger = None,
    fmt: str | None = None,
) -> StreamingQuery:
    """Append predictions by event date. Readers go through the sink's log and never see half a batch."""
    return _append(spark, cfg, _fact_stream(spark, cfg), trigger or POLL, fmt)


def read_predictions(spark: SparkSession, cfg: LakeConfig, fmt: str | None = None) -> DataFrame:
    fmt = fmt or cfg.table_format
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True)
    if fmt != "delta":
        reader = reader.schema(StructType([*PREDICTIONS, StructField("event_date", DateType())]))
    return reader.load(cfg.table(NAME)).select(*PREDICTIONS.fieldNames())


def run(spark: SparkSession, cfg: LakeConfig, trigger: Trigger = None) -> None:
    load_model(spark, cfg)
    skip_existing(spark, cfg)
    starters = [lambda: start_scoring(spark, cfg, trigger)]
    run_to_end(starters) if is_finite(trigger) else run_until_first_stops(spark, starters)
