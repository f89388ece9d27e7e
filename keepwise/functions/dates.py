"""Clock and calendar helpers (F-1 .. F-9).

All helpers work on ``timestamp_ntz`` columns and are zone-free. Window bounds
are built from literals so Catalyst folds them to constants and the filters
reach the Parquet scan as ``PushedFilters``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_of_literal(as_of) -> Column:
    """F-1: the query clock as a ``timestamp_ntz`` literal.

    ``None`` means "now" (``localtimestamp()``); the reference used
    ``GETDATE()`` everywhere, which makes results change from day to day, so a
    fixed value is the normal case.
    """
    if as_of is None:
        return F.localtimestamp()
    if isinstance(as_of, Column):
        return as_of
    if isinstance(as_of, dt.datetime):
        text = as_of.strftime("%Y-%m-%d %H:%M:%S.%f")
    elif isinstance(as_of, dt.date):
        text = as_of.strftime("%Y-%m-%d 00:00:00")
    else:
        text = str(as_of)
    return F.lit(text).cast("timestamp_ntz")


def shift(ts: Column, unit: str, amount: int) -> Column:
    """F-2: ``DATEADD(unit, amount, ts)``.

    Keeps the time of day and clamps to month end (May 31 minus one month is
    April 30), unlike ``add_months`` which returns a DATE.
    """
    return F.timestamp_add(unit.upper(), F.lit(int(amount)), ts)


def months_before(as_of, months: int) -> Column:
    return shift(as_of_literal(as_of), "MONTH", -months)


def years_before(as_of, years: int) -> Column:
    return shift(as_of_literal(as_of), "YEAR", -years)


def nested_months_before(as_of, inner: int, outer: int) -> Column:
    """F-3: ``DATEADD(month, -outer, DATEADD(month, -inner, as_of))``.

    Not the same as subtracting ``inner + outer`` months at once near month
    end (May 31: -1 then -3 is Jan 30; -4 is Jan 31).
    """
    return shift(shift(as_of_literal(as_of), "MONTH", -inner), "MONTH", -outer)


def day_diff(start: Column, end: Column) -> Column:
    """F-4: ``DATEDIFF(day, start, end)`` = day boundaries crossed."""
    return F.datediff(end, start)


def hour_diff(start: Column, end: Column) -> Column:
    """F-5: ``DATEDIFF(hour, start, end)`` = hour boundaries crossed.

    10:59 -> 11:01 is 1 here, where elapsed-hour arithmetic gives 0. Written as
    day boundaries times 24 plus the hour-of-day difference, which is exact
    for zone-free timestamps and stays in generated code.
    """
    return (F.datediff(end, start) * F.lit(24) + (F.hour(end) - F.hour(start))).cast("long")


def to_day(ts: Column) -> Column:
    """F-6: ``CAST(ts AS DATE)``."""
    return F.to_date(ts)


def run_stamp(ts: Column) -> Column:
    """F-9: ``%Y%m%d`` stamp used in output folder names."""
    return F.date_format(ts, "yyyyMMdd")


def in_window(ts: Column, lower: Column | None, upper: Column | None) -> Column:
    """Half-open interval ``[lower, upper)``; either side may be open."""
    cond = F.lit(True)
    if lower is not None:
        cond = cond & (ts >= lower)
    if upper is not None:
        cond = cond & (ts < upper)
    return cond
