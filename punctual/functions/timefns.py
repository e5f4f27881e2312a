"""Time-of-day helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def epoch_to_ts(epoch) -> Column:
    """Epoch seconds (string or number) -> timestamp (``to_timestamp(bigint)``)."""
    c = epoch if isinstance(epoch, Column) else F.col(epoch)
    return F.timestamp_seconds(c.try_cast("long"))


def local_ts(ts, agency_tz: str | None = None) -> Column:
    """Wall-clock time in the agency's zone (session zone when None)."""
    c = ts if isinstance(ts, Column) else F.col(ts)
    return F.from_utc_timestamp(c, agency_tz) if agency_tz else c


def second_of_day(ts, agency_tz: str | None = None, with_seconds: bool = True) -> Column:
    """hour*3600 + minute*60 [+ second] as an integer."""
    c = local_ts(ts, agency_tz)
    out = F.hour(c) * 3600 + F.minute(c) * 60
    if with_seconds:
        out = out + F.second(c)
    return out.cast("int")


def hms_to_seconds(hms, with_seconds: bool = True) -> Column:
    """'HH:MM:SS' (hours may exceed 23) -> seconds; NULL for malformed parts."""
    c = hms if isinstance(hms, Column) else F.col(hms)
    part = lambda i: F.split_part(c, F.lit(":"), F.lit(i)).try_cast("int")
    out = part(1) * 3600 + part(2) * 60
    if with_seconds:
        out = out + part(3)
    return out
