"""Settings of a lake: where tables live, how they are stored, and the limits rows are checked by."""

from __future__ import annotations

from dataclasses import dataclass, field

# The domains and ranges a valid event must lie in.
WEATHER = ("CLEAR", "RAIN", "FOG", "STORM")
SPEED_RANGE = (0, 160)
TRAFFIC_VOLUME_RANGE = (0, 1000)
CONGESTION_RANGE = (1, 5)
INCIDENT_VALUES = (0, 1)
MAX_CLOCK_AHEAD = "10 minutes"

# Event-time settings.
WATERMARK = "15 minutes"
WINDOW = "1 hour"

# Identity of an event: a message sent twice carries the same pair.
EVENT_KEY = ("vehicle_id", "event_ts")


@dataclass(frozen=True)
class QualityLimits:
    weather: tuple[str, ...] = WEATHER
    speed: tuple[int, int] = SPEED_RANGE
    traffic_volume: tuple[int, int] = TRAFFIC_VOLUME_RANGE
    congestion: tuple[int, int] = CONGESTION_RANGE
    incident: tuple[int, ...] = INCIDENT_VALUES
    max_clock_ahead: str = MAX_CLOCK_AHEAD


@dataclass(frozen=True)
class LakeConfig:
    """``root`` may be any file system Spark can write to; ``table_format`` any format it knows."""

    root: str
    table_format: str = "parquet"
    limits: QualityLimits = field(default_factory=QualityLimits)
    watermark: str = WATERMARK
    window: str = WINDOW
    # Stateful dedup first thins copies per slice of input, then per key. None: as many slices as shuffle
    # partitions. 0 turns the first step off.
    copy_slices: int | None = None
    # "dates" rewrites the dates a micro-batch has events of, from the fact table, and keeps no state; "complete" keeps
    # every window for ever; "append" publishes a window once it can no longer change.
    hourly_mode: str = "dates"
    # Rows behind the watermark are written as rejected ones, with the reason LATE_EVENT, instead of being dropped.
    route_late: bool = False
    # An event counts for the watermark at the lesser of its own time and its arrival, so a clock that runs ahead cannot
    # shorten what others are allowed.
    arrival_bounds_clock: bool = False
    # Upper bounds of one micro-batch, so that a backlog is worked off in equal steps.
    max_files_per_trigger: int | None = 1000
    # Replaced versions of a table stay this long for readers that are still busy with them.
    keep_versions_seconds: int = 3600
    message_source: str = "kafka"
    message_options: dict[str, str] = field(default_factory=dict)

    def table(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def checkpoint(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/chk/{name}"
