"""Scalar column helpers shared by the operators.

Timestamps are ``TIMESTAMP_NTZ`` end to end (the reference's ``TIMESTAMP`` has no zone),
so none of these depends on the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

_US_PER_HOUR = 3_600_000_000


def dec(value: str | int | float, p: int = 10, s: int = 4) -> Column:
    """Exact decimal literal (never a double)."""
    return F.lit(str(value)).cast(DecimalType(p, s))


def ntz_micros(ts: Column | str) -> Column:
    """Microseconds since 1970-01-01 00:00 of a TIMESTAMP_NTZ, computed from its calendar
    fields. ``timestampdiff`` would route NTZ values through the session zone (and a DST
    change would shift a duration by an hour); this never looks at a zone."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    days = F.unix_date(F.to_date(ts)).cast("long")
    hm = (F.hour(ts) * 60 + F.minute(ts)).cast("long")
    sec_us = (F.date_part(F.lit("SECOND"), ts) * 1_000_000).cast("long")
    return days * 86_400_000_000 + hm * 60_000_000 + sec_us


def hours_between(start: Column | str, end: Column | str, p: int, s: int) -> Column:
    """Fractional hours from start to end, as DECIMAL(p,s), rounded half-up.

    Microsecond difference divided exactly in decimal; ``timestampdiff(SECOND)`` would
    drop fractional seconds.
    """
    us = (ntz_micros(end) - ntz_micros(start)).cast(DecimalType(20, 0))
    return (us / F.lit(_US_PER_HOUR).cast(DecimalType(11, 0))).cast(DecimalType(p, s))


def trunc_hour(ts: Column | str) -> Column:
    """Start of the hour of a TIMESTAMP_NTZ, kept as TIMESTAMP_NTZ."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    return F.to_date(ts).cast("timestamp_ntz") + F.make_dt_interval(hours=F.hour(ts))


def monday_of(d: Column | str) -> Column:
    """ISO week start (Monday) of a date; same as DATE_TRUNC('WEEK', d)."""
    d = F.col(d) if isinstance(d, str) else d
    return F.date_sub(d, (F.dayofweek(d) + 5) % 7)


week_start = monday_of
