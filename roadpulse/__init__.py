"""Incident-feed analytics on Spark: snapshots -> events -> bronze -> silver -> gold.

Every operator is a plain ``DataFrame -> DataFrame`` function. The same function runs on a
batch table and inside a Structured Streaming query; only ``sources``, ``sinks`` and
``streaming`` know which of the two it is.
"""

from roadpulse.config import FeedConfig
from roadpulse.session import get_spark, new_work_dir

__all__ = ["FeedConfig", "get_spark", "new_work_dir"]
