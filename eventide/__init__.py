"""eventide: parameterised event-time analytics operators for PySpark.

Every operator takes DataFrames plus column names and durations and returns
DataFrames. Batch operators are plain DataFrame / SQL plans; the streaming
forms live in :mod:`eventide.streaming`.
"""

from eventide.session import build_session, shared_dir

__all__ = ["build_session", "shared_dir"]
