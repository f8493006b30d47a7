from roadpulse.sources.readers import (
    backfill_path,
    exists,
    has_files,
    kafka_options,
    read_messages,
    read_snapshots,
    read_table,
    stream_messages,
    stream_snapshots,
    stream_table,
)

__all__ = [
    "backfill_path",
    "exists",
    "has_files",
    "kafka_options",
    "read_messages",
    "read_snapshots",
    "read_table",
    "stream_messages",
    "stream_snapshots",
    "stream_table",
]
