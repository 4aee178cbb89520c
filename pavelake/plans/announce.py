"""Rows of a table as messages, to a topic or a folder."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from pavelake.config import LakeConfig
from pavelake.schemas import BRONZE, FACT, SILVER
from pavelake.sources.messages import encode_messages
from pavelake.sources.tables import stream_table
from pavelake.streaming.sinks import Trigger, message_sink
from pavelake.streaming.supervise import is_finite, run_to_end, run_until_first_stops

TABLES = {"bronze": BRONZE, "silver": SILVER, "fact": FACT}


def start_publish(
    spark: SparkSession, cfg: LakeConfig, table: str = "silver", trigger: Trigger = None, with_nulls: bool = False,
) -> StreamingQuery:
    """What the table holds and what is appended to it, to where ``message_source`` and its options say."""
    rows = stream_table(spark, cfg.table(table), TABLES[table], cfg.table_format, cfg.max_files_per_trigger)
    name = f"publish_{table}"
    return message_sink(
        encode_messages(rows, with_nulls=with_nulls), cfg.checkpoint(name), fmt=cfg.message_source, name=name,
        trigger=trigger, options=cfg.message_options,
    )


def run(
    spark: SparkSession, cfg: LakeConfig, trigger: Trigger = None, table: str = "silver", with_nulls: bool = False,
) -> None:
    starters = [lambda: start_publish(spark, cfg, table, trigger, with_nulls)]
    run_to_end(starters) if is_finite(trigger) else run_until_first_stops(spark, starters)
