"""Run the stages together in one session: start in order, watch, stop."""

from __future__ import annotations

import logging
import time
from collections.abc import Callable, Sequence

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from roadpulse import sinks
from roadpulse.config import FeedConfig
from roadpulse.schemas import BRONZE, SILVER
from roadpulse.session import require_shared
from roadpulse.streaming import stages as _stages
from roadpulse.streaming.progress import progress_log

# Upstream first. `quarantine` and `ahead` run beside them when they are asked for by name.
STAGES = ("publish", "bronze", "silver", "gold")
QUARANTINE, AHEAD = "quarantine", "ahead"
RETRIED = ("publish",)

log = logging.getLogger(__name__)

Running = list[tuple[str, StreamingQuery]]


def start_stages(
    spark: SparkSession, config: FeedConfig, stages: Sequence[str] = STAGES
) -> Running:
    """Start the chosen stages in order. If one fails to start, those before it are stopped."""
    _prepare(spark, config, stages)
    running: Running = []
    try:
        for name in _in_order(stages):
            running.append((name, _starter(name)(spark, config)))
    except Exception:
        stop_all(running)
        raise
    return running


def hold(
    running: Running,
    seconds: float | None,
    poll: float = 0.5,
    restart: Callable[[str], StreamingQuery] | None = None,
    pause: float = 0,
) -> None:
    """Wait, for ever if ``seconds`` is None, and fail as soon as a stage has ended by itself.

    With ``restart``, a publish stage that failed is logged and started again ``pause``
    seconds later, from its checkpoint: a bad poll must not end the feed.
    """
    deadline = float("inf") if seconds is None else time.monotonic() + seconds
    due: dict[str, float] = {}
    while True:
        now = time.monotonic()
        for place, (name, query) in enumerate(running):
            if query.isActive:
                continue
            if restart is None or name not in RETRIED:
                raise RuntimeError(f"stage {name} ended early: {query.exception()}")
            if name not in due:
                log.warning("stage %s failed and is tried again: %s", name, query.exception())
                due[name] = now + pause
            if now >= due[name]:
                del due[name]
                running[place] = (name, restart(name))
        left = deadline - time.monotonic()
        if left <= 0:
            return
        time.sleep(min(poll, left))


def stop_all(running: Running) -> None:
    """Stop every stage, downstream last; one that fails to stop does not keep the others up."""
    errors = []
    for name, query in running:
        try:
            query.stop()
        except Exception as error:  # noqa: BLE001 - the rest must still be stopped
            errors.append(f"{name}: {error}")
    if errors:
        raise RuntimeError("; ".join(errors))


def run_stages(
    spark: SparkSession,
    config: FeedConfig,
    stages: Sequence[str] = STAGES,
    keep_running_seconds: float | None = 0,
    drain: bool = False,
) -> None:
    """Start, hold for the given time (None: until one stage ends), and stop whatever happens.

    ``drain`` instead takes each stage in turn through everything its source holds now, and
    then returns. Started again, each stage goes on from its checkpoint.
    """
    if drain:
        _prepare(spark, config, stages)
        with progress_log(spark, config) as log:
            for name in _in_order(stages):
                query = _starter(name)(spark, config, available_now=True)
                query.awaitTermination()
                if log is not None:
                    log.wait_for(query)
        return
    with progress_log(spark, config) as log:
        running = start_stages(spark, config, stages)
        try:
            hold(
                running,
                keep_running_seconds,
                restart=lambda name: _starter(name)(spark, config),
                pause=config.poll_seconds,
            )
        finally:
            stop_all(running)
            for _, query in running:
                if log is not None:
                    log.wait_for(query)


def _starter(name: str):
    return getattr(_stages, f"start_{name}")


def _in_order(stages: Sequence[str]) -> list[str]:
    known = (*STAGES, QUARANTINE, AHEAD)
    unknown = set(stages) - set(known)
    if unknown:
        raise ValueError(f"unknown stages: {sorted(unknown)}")
    return [name for name in known if name in stages]


def _prepare(spark: SparkSession, config: FeedConfig, stages: Sequence[str]) -> None:
    """Check the places, and make the sources of the stages: a stream over a missing one would
    end at once."""
    require_shared(spark, config.locations)
    written = {
        "publish": config.wire_path if config.transport == "files" else None,
        "bronze": config.bronze_table,
        "silver": config.silver_table,
        "gold": config.gold_table,
        QUARANTINE: config.quarantine_table,
        AHEAD: config.ahead_table,
    }
    for name in stages:
        place = written.get(name)
        if place and (name == "publish" or config.table_format == "parquet"):
            sinks.refuse_stream_into_batch(spark, place)
    if "publish" in stages:
        sinks.ensure_dir(spark, config.snapshot_path)
        sinks.ensure_dir(spark, config.first_copies_path)
    if {"bronze", QUARANTINE} & set(stages) and config.transport == "files":
        sinks.ensure_dir(spark, config.wire_path)
    if "silver" in stages:
        sinks.ensure_table(spark, config.bronze_table, BRONZE, config)
    if {"gold", AHEAD} & set(stages):
        sinks.ensure_table(
            spark, config.silver_table, SILVER, config, partition_by=["event_date"]
        )
