"""Messages to the raw table."""

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from pavelake.config import LakeConfig
from pavelake.sources.messages import decode_messages, message_stream
from pavelake.streaming.sinks import Trigger, append_sink
from pavelake.streaming.supervise import is_finite, run_to_end, run_until_first_stops


def start_bronze(spark: SparkSession, cfg: LakeConfig, trigger: Trigger = None) -> StreamingQuery:
    return append_sink(
        decode_messages(message_stream(spark, cfg)),
        cfg.table("bronze"),
        cfg.checkpoint("bronze"),
        name="bronze",
        fmt=cfg.table_format,
        trigger=trigger,
    )


def run(spark: SparkSession, cfg: LakeConfig, trigger: Trigger = None) -> None:
    starters = [lambda: start_bronze(spark, cfg, trigger)]
    run_to_end(starters) if is_finite(trigger) else run_until_first_stops(spark, starters)
