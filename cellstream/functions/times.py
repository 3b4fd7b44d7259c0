"""Times of landing tables, independent of the session's zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def from_millis(ms: Column) -> Column:
    """Epoch milliseconds as TIMESTAMP_NTZ in UTC; null stays null."""
    return F.timestamp_add("MILLISECOND", ms, F.expr("timestamp_ntz'1970-01-01 00:00:00'"))


def to_millis(ts: Column) -> Column:
    return F.timestamp_diff("MILLISECOND", F.expr("timestamp_ntz'1970-01-01 00:00:00'"), ts)


def month(*times: Column) -> Column:
    """yyyymm of the first time that isn't null."""
    t = F.coalesce(*times)
    return (F.year(t) * 100 + F.month(t)).cast("int")
