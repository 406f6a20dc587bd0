"""eventflow: event-stream analytics operators on the Spark DataFrame API.

Every operator is a function ``DataFrame -> DataFrame`` (or a tuple of
DataFrames for side outputs) parameterised by column names and durations, so
the same definition serves bounded tables and Structured Streaming where the
semantics allow it.
"""

from eventflow.session import build_session, checkpoint_root, scratch_path

__all__ = ["build_session", "checkpoint_root", "scratch_path"]
