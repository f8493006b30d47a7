from roadpulse.streaming.progress import ProgressLog, progress_log, read_progress
from roadpulse.streaming.runner import STAGES, hold, run_stages, start_stages, stop_all
from roadpulse.streaming.settle import closed_until, gold_complete, read_gold, settle_gold
from roadpulse.streaming.stages import (
    bronze_rows,
    gold_rows,
    in_time_rows,
    incident_rows,
    message_rows,
    silver_rows,
    start_ahead,
    start_bronze,
    start_first_copies,
    start_gold,
    start_publish,
    start_quarantine,
    start_silver,
    start_tail,
)

from roadpulse.streaming.state import reseed_publish, seen_keys, state_partitions

__all__ = [
    "ProgressLog",
    "STAGES",
    "bronze_rows",
    "closed_until",
    "gold_complete",
    "gold_rows",
    "hold",
    "in_time_rows",
    "incident_rows",
    "message_rows",
    "progress_log",
    "read_gold",
    "read_progress",
    "reseed_publish",
    "run_stages",
    "seen_keys",
    "settle_gold",
    "silver_rows",
    "start_ahead",
    "start_bronze",
    "start_first_copies",
    "start_gold",
    "start_publish",
    "start_quarantine",
    "start_silver",
    "start_stages",
    "start_tail",
    "state_partitions",
    "stop_all",
]
