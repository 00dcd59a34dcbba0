"""Certified dimensions and facts.

Facts join the identity table on ``customer_id`` to replace each source id by
its master id and to drop test accounts. These joins shuffle both sides on
the customer id (or broadcast the identity side when AQE measures it small);
one customer holding a third of the fact rows is split by AQE's skew-join
handling. Outer joins with many null keys spread those rows with a salt.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiloom.functions.dates import as_date, month_of, month_range
from kpiloom.functions.numeric import cents_to_amount
from kpiloom.functions.vocabulary import MEMBERSHIP_TYPE
from kpiloom.operators.joins import left_join_spread_nulls


def _real(identity: DataFrame) -> DataFrame:
    return identity.where(~F.col("is_test_account")).select("customer_id", "master_customer_id")


def dim_location(stg_locations: DataFrame) -> DataFrame:
    """The location dimension (a projection of staged locations)."""
    return stg_locations.select("location_id", "location_name", "city", "brand", "ownership",
                                "franchisee_id", "opened_on", "closed_on", "is_active")


def dim_customer(identity_wide: DataFrame) -> DataFrame:
    """One row per real person: merged duplicates, test accounts removed.

    ``identity_wide`` is :func:`resolve_identity` output (all staged customer
    columns plus the master id), so no join back to staging is needed: the
    customer id is the staging key. Grouping by master aggregates map-side.
    ``home_location_id`` is that of the smallest customer id whose home is not
    null (records without a home are skipped, as by ``arg_min``).
    """
    ids = identity_wide.where(~F.col("is_test_account") & F.col("customer_id").isNotNull())
    order = F.when(F.col("home_location_id").isNotNull(), F.col("customer_id"))
    return ids.groupBy(F.col("master_customer_id").alias("customer_id")).agg(
        F.min("created_at").alias("first_seen_at"),
        F.min_by("home_location_id", order).alias("home_location_id"),
        F.count(F.lit(1)).alias("source_records_merged"),
    )


def fct_appointments(stg_appointments: DataFrame, identity: DataFrame, stg_services: DataFrame) -> DataFrame:
    """Appointments of real customers with the master id and service category; unknown services keep a null category."""
    appts = stg_appointments.join(_real(identity), "customer_id")
    services = stg_services.select(F.col("service_id").alias("__sid"), "service_category")
    with_cat = left_join_spread_nulls(appts, services, "service_id", "__sid", "appointment_id")
    return with_cat.select(
        "appointment_id",
        F.col("master_customer_id").alias("customer_id"),
        "location_id",
        "service_id",
        "service_category",
        F.col("scheduled_at").cast("date").alias("appointment_date"),
        "status",
    )


def fct_payments(stg_payments: DataFrame, identity: DataFrame) -> DataFrame:
    """Net revenue ledger: settled sales and refunds (negative); no voids, no tests.

    A null ``is_void`` (null status) fails ``not is_void`` and is dropped, as
    in the SQL definition; :func:`kpiloom.operators.quality.dropped_rows`
    reports how many rows that and the identity join remove.
    """
    pays = stg_payments.where(~F.col("is_void")).join(_real(identity), "customer_id")
    return pays.select(
        "payment_id",
        F.col("master_customer_id").alias("customer_id"),
        "location_id",
        "payment_type",
        F.when(F.col("payment_type") == F.lit(MEMBERSHIP_TYPE), F.lit("membership"))
         .otherwise(F.lit("service")).alias("revenue_stream"),
        "amount_cents",
        cents_to_amount("amount_cents").alias("amount"),
        F.col("paid_at").cast("date").alias("payment_date"),
    )


def fct_membership_months(stg_memberships: DataFrame, identity: DataFrame,
                          first_month: dt.date | str, last_month: dt.date | str) -> DataFrame:
    """One row per membership per calendar month it was active.

    Start month to end month inclusive, an open end runs to the end of the
    axis, everything clipped to [first_month, last_month]. Instead of a range
    join to a month table (a nested-loop join) each membership explodes its
    own bounded month sequence -- at most the axis length per row, no shuffle.
    """
    lo, hi = as_date(first_month), as_date(last_month)
    m = stg_memberships.join(_real(identity), "customer_id")
    start_m, end_m = month_of("start_date"), month_of("end_date")
    first = F.greatest(start_m, lo)        # null start -> null (guarded below)
    last = F.least(F.coalesce(end_m, hi), hi)
    bounded = (m.withColumns({"__first": F.when(start_m.isNotNull(), first), "__last": last})
                .where(F.col("__first").isNotNull() & (F.col("__first") <= F.col("__last"))))
    exploded = bounded.withColumn("month_start", F.explode(month_range(F.col("__first"), F.col("__last"))))
    return exploded.select(
        "membership_id",
        F.col("master_customer_id").alias("customer_id"),
        "location_id",
        "plan_name",
        "monthly_fee",
        "month_start",
        (start_m == F.col("month_start")).alias("is_new"),
        F.coalesce(end_m == F.col("month_start"), F.lit(False)).alias("is_churned"),
    )


def fct_leads(stg_leads: DataFrame, identity: DataFrame) -> DataFrame:
    """All leads; converted when the converted id belongs to a real customer.

    The "not a test account" condition sits in the join condition, so it is
    applied to the identity side before the left join. Most leads have no
    converted id; those null keys are spread instead of filling one task.
    """
    real = _real(identity).withColumnRenamed("customer_id", "__cid")
    j = left_join_spread_nulls(stg_leads, real, "converted_customer_id", "__cid", "lead_id")
    return j.select(
        "lead_id",
        "location_id",
        "channel",
        F.col("created_at").cast("date").alias("lead_date"),
        F.col("master_customer_id").alias("converted_customer_id"),
        F.col("master_customer_id").isNotNull().alias("is_converted"),
    )
