"""Numeric recipes that agree bit-for-bit with the SQL definitions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_half_away(x: Column | str, digits: int) -> Column:
    """round(x, digits) for a double, computed as round(x * 10^d) / 10^d.

    Scaling first and rounding the double (half away from zero) is the rule the
    metric definitions follow; rounding the decimal text instead differs at
    exact binary ties such as 57/800.
    """
    scale = float(10 ** digits)
    return F.round(_c(x).cast("double") * F.lit(scale), 0) / F.lit(scale)


def ratio(num: Column | str, den: Column | str, digits: int | None = None,
          empty: Column | float | None = None) -> Column:
    """num / den as a double; ``empty`` (default null) when den is 0 or null."""
    r = _c(num).cast("double") / F.nullif(_c(den).cast("double"), F.lit(0.0))
    if digits is not None:
        r = round_half_away(r, digits)
    if empty is not None:
        r = F.coalesce(r, empty if isinstance(empty, Column) else F.lit(float(empty)))
    return r


def cents_to_amount(cents: Column | str) -> Column:
    """Integer cents to a double amount (cents / 100.0 as a double, not a decimal)."""
    return _c(cents).cast("double") / F.lit(100.0)
