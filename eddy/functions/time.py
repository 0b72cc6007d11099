"""Time functions (F-h, F-i) as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed formats of the reference's output.
DATETIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
LOCAL_TIME_FORMAT = "HH:mm:ss.SSS"


def to_text(ts: Column) -> Column:
    """F-h: ``yyyy-MM-dd HH:mm:ss``."""
    return F.date_format(ts, DATETIME_FORMAT)


def local_time_text(ts: Column) -> Column:
    """F-i: the local time of day with milliseconds."""
    return F.date_format(ts, LOCAL_TIME_FORMAT)


def from_millis(ms: Column) -> Column:
    """F-i: epoch milliseconds to timestamp."""
    return F.timestamp_millis(ms)


def to_millis(ts: Column) -> Column:
    """F-i: timestamp to epoch milliseconds (``timestamp_ntz`` is read in
    the session zone)."""
    return F.unix_millis(ts.cast("timestamp"))
