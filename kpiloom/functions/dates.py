"""Calendar-month helpers."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def month_of(c: Column | str) -> Column:
    """First day of the month, as a DATE."""
    return F.trunc(_c(c).cast("date"), "MM")


def as_date(d: dt.date | str) -> Column:
    """A DATE literal from a date or an ISO string."""
    return F.lit(d if isinstance(d, dt.date) else dt.date.fromisoformat(d))


def month_range(first: Column, last: Column) -> Column:
    """Array of month starts from ``first`` to ``last`` inclusive (both month starts).

    Callers must guarantee first <= last (``sequence`` raises otherwise).
    """
    return F.sequence(first, last, F.expr("INTERVAL 1 MONTH"))
