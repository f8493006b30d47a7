from roadpulse.plans.backfill import (
    clean_table,
    gold_table,
    new_incidents,
    publish_batch,
    snapshots_to_gold,
)

__all__ = [
    "clean_table",
    "gold_table",
    "new_incidents",
    "publish_batch",
    "snapshots_to_gold",
]
