"""Settings of the feed, with defaults, passed to functions instead of being read globally."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, fields, replace

# The defaults a deployment starts from.
DEFAULT_BBOX = (-122.52, 37.70, -122.35, 37.83)
DEFAULT_BOOTSTRAP = "localhost:9093"
DEFAULT_TOPIC = "traffic_incidents"

# Environment variable -> setting it overrides.
ENV_SETTINGS = {
    "BBOX": "bbox",
    "KAFKA_BOOTSTRAP": "kafka_bootstrap",
    "KAFKA_TOPIC": "kafka_topic",
    "POLL_SECONDS": "poll_seconds",
    "SNAPSHOT_PATH": "snapshot_path",
    "WIRE_PATH": "wire_path",
    "BRONZE_PATH": "bronze_path",
    "SILVER_PATH": "silver_path",
    "GOLD_PATH": "gold_path",
    "METRICS_PATH": "metrics_path",
    "PUBLISH_CHECKPOINT": "publish_checkpoint",
    "BRONZE_CHECKPOINT": "bronze_checkpoint",
    "SILVER_CHECKPOINT": "silver_checkpoint",
    "GOLD_CHECKPOINT": "gold_checkpoint",
    "QUARANTINE_CHECKPOINT": "quarantine_checkpoint",
    "AHEAD_CHECKPOINT": "ahead_checkpoint",
    "SETTLE_CHECKPOINT": "settle_checkpoint",
}


@dataclass(frozen=True)
class FeedConfig:
    """Locations, formats and timing of the four stages.

    ``transport`` is where events travel between publish and bronze: ``kafka``, or ``files``
    (one JSON message per line under ``wire_path``) where no connector is on the classpath.
    ``table_format`` is ``parquet`` or ``delta``. ``quarantine`` keeps unreadable messages out
    of bronze; the stage of that name collects their text in a table of its own.
    ``poll_key`` names a top-level number of a snapshot document that tells when it was polled;
    without it the time of its file does, and only whole files have an order of their own.
    ``max_ahead`` keeps rows out of gold whose event time is so much later than their arrival: one of
    them would close every window until then. The stage ``ahead`` collects them; None lets them in.
    ``dedup_bound`` lets an incident pass again once files are so much newer than its last copy;
    by default it passes once for ever.
    """

    # snapshot feed
    snapshot_path: str = "./data/snapshots"
    whole_files: bool = True
    poll_key: str | None = None
    poll_seconds: int = 30
    bbox: tuple[float, float, float, float] = DEFAULT_BBOX
    apply_bbox: bool = False
    lon_key: str = "x"
    lat_key: str = "y"

    # wire
    transport: str = "kafka"
    kafka_bootstrap: str = DEFAULT_BOOTSTRAP
    kafka_topic: str = DEFAULT_TOPIC
    wire_path: str = "./data/wire"
    starting_offsets: str = "latest"
    fail_on_data_loss: bool = False

    # tables
    table_format: str = "parquet"
    bronze_path: str = "./data/bronze"
    silver_path: str = "./data/silver"
    gold_path: str = "./data/gold"

    # checkpoints, one directory per query
    publish_checkpoint: str = "./checkpoints/publish_incidents"
    bronze_checkpoint: str = "./checkpoints/bronze_incidents"
    silver_checkpoint: str = "./checkpoints/silver_incidents"
    gold_checkpoint: str = "./checkpoints/gold_incidents_10m"
    quarantine_checkpoint: str = "./checkpoints/bronze_malformed"
    ahead_checkpoint: str = "./checkpoints/silver_ahead"
    settle_checkpoint: str = "./checkpoints/gold_settle"

    # timing and state
    trigger_seconds: int = 10
    window: str = "10 minutes"
    watermark: str = "30 minutes"
    missing_time: str = "ingest"
    quarantine: bool = False
    # keep what each micro-batch reports in a table
    log_progress: bool = True
    metrics_path: str = "./data/metrics"
    max_ahead: str | None = "1 day"
    dedup_bound: str | None = None
    # tasks that one day's rows of a micro-batch are spread over; None goes by their size
    silver_buckets: int | None = None
    # rows of a micro-batch that the tail prints
    tail_rows: int = 20

    # size of one micro-batch; None reads everything that has arrived
    max_files_per_trigger: int | None = None
    max_bytes_per_trigger: str | None = None
    max_offsets_per_trigger: int | None = None
    # A landed file is skipped if it is so much older than the newest one; the default never
    # skips. Spark lists what it has read in the checkpoint for as long.
    max_file_age: str = "36500d"
    # folder that snapshots and messages are moved to once read, which bounds that list's folder
    archive_path: str | None = None
    # tasks to split the topic into, so that one full topic partition is not one task
    min_topic_splits: int | None = None

    def __post_init__(self) -> None:
        if self.transport not in ("kafka", "files"):
            raise ValueError(f"transport must be kafka or files, not {self.transport!r}")
        if self.table_format not in ("parquet", "delta"):
            raise ValueError(f"table_format must be parquet or delta, not {self.table_format!r}")

    @property
    def locations(self) -> dict[str, str]:
        """Setting -> folder, for every folder that tasks read or write."""
        used = {name: value for name, value in vars(self).items() if name.endswith(("_path", "_checkpoint"))}
        return {name: value for name, value in used.items() if value is not None}

    @property
    def first_copies_path(self) -> str:
        """Where publish keeps the first copies of a micro-batch until they are sent."""
        return f"{self.publish_checkpoint.rstrip('/')}_first_copies"

    @property
    def bronze_table(self) -> str:
        return f"{self.bronze_path.rstrip('/')}/incidents"

    @property
    def quarantine_table(self) -> str:
        return f"{self.bronze_path.rstrip('/')}/malformed"

    @property
    def ahead_table(self) -> str:
        return f"{self.silver_path.rstrip('/')}/ahead"

    @property
    def settled_table(self) -> str:
        """Days of the windowed table that were computed anew."""
        return f"{self.gold_path.rstrip('/')}/settled_incidents_10m"

    @property
    def touched_path(self) -> str:
        """Where settling keeps the windows that it has to look at."""
        return f"{self.settle_checkpoint.rstrip('/')}_touched"

    @property
    def silver_table(self) -> str:
        return f"{self.silver_path.rstrip('/')}/incidents"

    @property
    def gold_table(self) -> str:
        return f"{self.gold_path.rstrip('/')}/agg_incidents_10m"

    @classmethod
    def from_env(cls, env: Mapping[str, str] | None = None, **overrides) -> FeedConfig:
        """Defaults, then environment variables, then keyword overrides."""
        env = os.environ if env is None else env
        values: dict = {}
        for variable, name in ENV_SETTINGS.items():
            if variable in env:
                values[name] = env[variable]
        if "poll_seconds" in values:
            values["poll_seconds"] = int(values["poll_seconds"])
        if "bbox" in values:
            values["bbox"] = parse_bbox(values["bbox"])
        return cls(**{**values, **overrides})

    @classmethod
    def under(cls, root: str, **overrides) -> FeedConfig:
        """Put every location below one shared folder, with the file transport."""
        return cls(**{**locations_under(root), "transport": "files", **overrides})

    def with_(self, **overrides) -> FeedConfig:
        return replace(self, **overrides)


def locations_under(root: str) -> dict[str, str]:
    """Every setting that is a place by default, moved below ``root``."""
    base = root.rstrip("/")
    return {
        field.name: f"{base}/{str(field.default).removeprefix('./')}"
        for field in fields(FeedConfig)
        if isinstance(field.default, str) and field.default.startswith("./")
    }


def parse_bbox(text: str) -> tuple[float, float, float, float]:
    """``minLon,minLat,maxLon,maxLat`` as four numbers."""
    parts = [float(part) for part in text.split(",")]
    if len(parts) != 4:
        raise ValueError(f"a bounding box needs four numbers, got {text!r}")
    return parts[0], parts[1], parts[2], parts[3]
