"""A dirty variant of the derived raw tables: faults that the data tests must report.

By key arithmetic, like the clean derivation (rules in FIXTURES.md), so faults grow with the tables: spellings no
vocabulary knows, missing amounts, unknown payment types, locations that do not exist, rows that came twice. Amounts that
are no numbers are a rule of their own, as staging stops at them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NO_SUCH_LOCATION, NO_SUCH_HOME = "99", "77"


def _every(key: str, n: int, fault: Column | str | None, column: str) -> Column:
    """``fault`` (or null) in every n-th record, the column as it is elsewhere."""
    fault = F.lit(fault).cast("string") if not isinstance(fault, Column) else fault
    return F.when(F.col(key).cast("bigint") % n == 0, fault).otherwise(F.col(column))


def _twice(df: DataFrame, key: str, n: int) -> DataFrame:
    """Every n-th record comes twice."""
    times = F.when(F.col(key).cast("bigint") % n == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return df.withColumn("__time", F.explode(times)).drop("__time")


def damaged(name: str, df: DataFrame, amounts: bool = False) -> DataFrame:
    """The dirty form of one raw table; ``amounts`` adds amounts that are no numbers."""
    if name == "payments":
        df = df.withColumns({"payment_type": _every("payment_id", 53, "voucher", "payment_type"),
                             "location_id": _every("payment_id", 59, NO_SUCH_LOCATION, "location_id"),
                             "amount": _every("payment_id", 71, None, "amount")})
        if amounts:
            df = df.withColumn("amount", _every("payment_id", 47, "n/a", "amount"))
            df = df.withColumn("amount", _every("payment_id", 83, F.concat(F.lit("EUR "), F.col("amount")), "amount"))
        return _twice(df, "payment_id", 101)
    if name == "appointments":
        df = df.withColumn("status", _every("appointment_id", 41, "Rescheduled", "status"))
        return df.withColumns({"status": _every("appointment_id", 43, " In progress ", "status"),
                               "location_id": _every("appointment_id", 61, NO_SUCH_LOCATION, "location_id")})
    if name == "leads":
        df = df.withColumn("lead_source", _every("lead_id", 37, "TikTok Ads", "lead_source"))
        return df.withColumn("lead_source", _every("lead_id", 91, None, "lead_source"))
    if name == "customers":
        return df.withColumn("home_location_id", _every("customer_id", 67, NO_SUCH_HOME, "home_location_id"))
    if name == "locations":
        return df.withColumns({"ownership": _every("location_id", 4, "leased", "ownership"), "brand": _every("location_id", 5, "Cedar Spa", "brand")})
    if name == "memberships":
        return _twice(df, "membership_id", 73)
    return df
