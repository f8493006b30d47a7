from roadpulse.sinks.writers import (
    backfill_table,
    console_writer,
    ensure_dir,
    ensure_table,
    has_sink_log,
    message_writer,
    named_stage,
    refuse_stream_into_batch,
    table_writer,
    trigger_options,
    write_messages,
    write_table,
)

__all__ = [
    "backfill_table",
    "console_writer",
    "ensure_dir",
    "ensure_table",
    "has_sink_log",
    "message_writer",
    "named_stage",
    "refuse_stream_into_batch",
    "table_writer",
    "trigger_options",
    "write_messages",
    "write_table",
]
