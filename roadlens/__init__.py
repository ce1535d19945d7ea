"""roadlens — road-traffic GPS analytics on Spark DataFrames.

Pings are decoded, validated, de-duplicated and enriched with time, light and
schedule dimensions; congestion verdicts per traffic light are computed over
batch snapshots and event-time windows. Every operator is a
``DataFrame -> DataFrame`` function so the same code serves batch jobs and
Structured Streaming queries through ``DataFrame.transform``.
"""

from roadlens.session import get_session, checkpoint_dir

__all__ = ["get_session", "checkpoint_dir"]
