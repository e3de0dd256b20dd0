"""Incremental (streaming) execution of costly per-row stages.

The reference has no streams, watermarks or event-time windows; what it has
is resume-after-failure and periodic checkpoints around model calls (A10,
A11).  ``kiln.streaming.incremental`` expresses exactly that with Structured
Streaming: a file source of work items, ``foreachBatch`` running the user's
batch function, an append-only result table, and Spark's checkpoint as the
resume point.
"""

from kiln.streaming.incremental import run_incremental

__all__ = ["run_incremental"]
