"""Calendar arithmetic with the reference's semantics.

``month_boundaries`` counts month *boundaries* crossed (Jan 31 -> Feb 1 is 1),
which is what a SQL ``datediff('month', a, b)`` means in the reference; Spark's
``months_between`` / ``timestampdiff(MONTH)`` count whole months instead.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def lit_date(d: dt.date) -> Column:
    return F.lit(d).cast("date")


def month_index(c: Column) -> Column:
    return F.year(c) * 12 + F.month(c)


def month_boundaries(start: Column, end: Column) -> Column:
    """Number of month boundaries between two dates."""
    return month_index(end) - month_index(start)


def day_boundaries(start: Column, end: Column) -> Column:
    """Number of midnights between two dates/timestamps (I4)."""
    return F.datediff(F.to_date(end), F.to_date(start))


def week_bucket(days: Column) -> Column:
    """floor(days / 7); negative days round down (-4 -> -1)."""
    return F.floor(days / F.lit(7))


def date_plus_days_ts(d: Column, days: int) -> Column:
    """DATE + INTERVAL n DAYS as a timestamp without zone."""
    return F.date_add(d, days).cast("timestamp_ntz")


def trunc_date(c: Column, unit: str) -> Column:
    """date_trunc(unit, x)::date with an ISO-Monday week."""
    d = F.to_date(c)
    if unit == "day":
        return d
    return F.trunc(d, unit)
