"""Run several streaming queries as one application."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from pavelake.streaming.sinks import Trigger


POLL_SECONDS = 1


def is_finite(trigger: Trigger) -> bool:
    return bool(trigger and (trigger.get("availableNow") or trigger.get("once")))


def run_until_first_stops(spark: SparkSession, starters: Iterable[Callable[[], StreamingQuery]]) -> None:
    """Start all, wait until any of them ends or fails, then stop the others.

    Only the queries started here are waited for: others of the session may have ended before or may end meanwhile.
    """
    running: list[StreamingQuery] = []
    try:
        running.extend(start() for start in starters)
        while running and not any(query.awaitTermination(POLL_SECONDS) for query in running):
            pass
    finally:
        stop_all(running)


def run_to_end(starters: Iterable[Callable[[], StreamingQuery]]) -> list[StreamingQuery]:
    """Start queries with a finite trigger side by side and wait for every one; errors propagate."""
    running: list[StreamingQuery] = []
    try:
        running.extend(start() for start in starters)
        for query in running:
            query.awaitTermination()
    finally:
        stop_all(running)
    return running


def stop_all(queries: Iterable[StreamingQuery]) -> None:
    for query in queries:
        if query.isActive:
            query.stop()
