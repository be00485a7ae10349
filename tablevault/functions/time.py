"""Time arithmetic. The current time is always a parameter, never read from the clock here."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

AsOf = datetime | str


def now() -> datetime:
    """The default for callers that do not pass a time."""
    return datetime.now(timezone.utc)


def instant(as_of: AsOf) -> Column:
    """A timestamp literal. Without an offset, the session's time zone applies."""
    if isinstance(as_of, datetime) and as_of.tzinfo is not None:
        return F.lit(as_of)
    return F.lit(str(as_of)).cast("timestamp")


def moment(spark: SparkSession, as_of: AsOf) -> datetime:
    """The same point in time as a Python value, for rows made on the driver."""
    if isinstance(as_of, datetime) and as_of.tzinfo is not None:
        return as_of
    return spark.range(1).select(instant(as_of)).first()[0]


def age_days(since: Column, as_of: AsOf) -> Column:
    """Whole days from `since` to `as_of`: 23 hours is 0, 24 hours is 1."""
    return F.timestamp_diff("DAY", since.cast("timestamp"), instant(as_of))
