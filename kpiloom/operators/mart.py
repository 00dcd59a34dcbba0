"""KPI mart: one row per location per month it was open.

Plan shape of :func:`kpi_location_monthly`:

* revenue: payments aggregated to (location_id, month_start) with map-side
  partial aggregation -- a location holding a third of all rows costs one
  partial row per task;
* spine: each location explodes its own month sequence (no range join), is
  FULL OUTER joined once with the revenue rollup, and a per-location window
  finds the last payment month, so payments are read once;
* activity: visits, members and leads unioned and aggregated in one more
  partial + final aggregate, joined to the spine on the same two keys.

The individual rollups (:func:`revenue_rollup` .. :func:`lead_rollup`) and
the plain :func:`location_month_spine` remain available as operators.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kpiloom.functions.dates import as_date, month_of, month_range
from kpiloom.functions.numeric import cents_to_amount, ratio

KEYS = ["location_id", "month_start"]
FACT_MONTH = "fact_month"       # partition column of written facts: the month of their date


def month_axis(spark: SparkSession, first_month: dt.date | str, last_month: dt.date | str) -> DataFrame:
    """Calendar months from first to last inclusive, one DATE row each."""
    return spark.range(1).select(
        F.explode(month_range(as_date(first_month), as_date(last_month))).alias("month_start"))


def last_activity(fct_payments: DataFrame) -> DataFrame:
    """Latest payment month per location (refunds after closure count)."""
    return fct_payments.groupBy("location_id").agg(F.max(month_of("payment_date")).alias("last_month"))


def last_activity_from_revenue(revenue: DataFrame) -> DataFrame:
    """Same result from the revenue rollup, which has a row for every
    (location, month) with at least one payment -- so a plan that needs both
    reads the payments once."""
    return revenue.groupBy("location_id").agg(F.max("month_start").alias("last_month"))


def location_month_spine(dim_loc: DataFrame, last_act: DataFrame,
                         first_month: dt.date | str, last_month: dt.date | str) -> DataFrame:
    """Months from the opening month while open; a closed location continues to
    the later of its closing month and its last payment month. Clipped to the axis.

    ``greatest`` skips nulls, so a closed location without payments ends at
    its closing month.
    """
    lo, hi = as_date(first_month), as_date(last_month)
    open_m = month_of("opened_on")
    end = F.when(F.col("closed_on").isNull(), hi).otherwise(
        F.least(F.greatest(month_of("closed_on"), F.col("last_month")), hi))
    first = F.greatest(open_m, lo)
    spine = (dim_loc.join(last_act, "location_id", "left")
             .withColumns({"__first": F.when(open_m.isNotNull(), first), "__last": end})
             .where(F.col("__first").isNotNull() & F.col("__last").isNotNull()
                    & (F.col("__first") <= F.col("__last"))))
    return spine.select("location_id", "location_name", "brand", "ownership", "franchisee_id",
                        F.explode(month_range(F.col("__first"), F.col("__last"))).alias("month_start"))


def spine_with_revenue(dim_loc: DataFrame, revenue: DataFrame,
                       first_month: dt.date | str, last_month: dt.date | str) -> DataFrame:
    """The location-month spine with the revenue rollup attached, reading the
    revenue rollup once.

    Candidate months run from the opening month to the end of the axis. They
    are FULL OUTER joined with the revenue rollup on (location_id,
    month_start); a window max over each location's rows then gives its last
    payment month -- revenue months outside the axis included, as in
    :func:`last_activity` -- and the closed-location rule filters the
    candidates. A location has at most one row per calendar month here, so
    the window's groups are bounded by the calendar, however hot the location.
    """
    lo, hi = as_date(first_month), as_date(last_month)
    open_m = month_of("opened_on")
    first = F.when(open_m.isNotNull(), F.greatest(open_m, lo))
    cand = (dim_loc.withColumn("__first", first)
            .where(F.col("__first").isNotNull() & (F.col("__first") <= hi))
            .select("location_id", "location_name", "brand", "ownership", "franchisee_id", "closed_on",
                    F.explode(month_range(F.col("__first"), hi)).alias("month_start"),
                    F.lit(True).alias("__spine")))
    j = cand.join(revenue.withColumn("__paid", F.lit(True)), KEYS, "full")
    last_paid = F.max(F.when(F.col("__paid"), F.col("month_start"))).over(Window.partitionBy("location_id"))
    keep = F.col("__spine") & (F.col("closed_on").isNull()
                               | (F.col("month_start") <= F.greatest(month_of("closed_on"), F.col("__last_paid"))))
    return j.withColumn("__last_paid", last_paid).where(keep).drop("__spine", "__paid", "__last_paid", "closed_on")


def revenue_rollup(fct_payments: DataFrame) -> DataFrame:
    """Net, membership and service cents per (location_id, month_start)."""
    amt, stream = F.col("amount_cents"), F.col("revenue_stream")
    return fct_payments.groupBy("location_id", month_of("payment_date").alias("month_start")).agg(
        F.sum(amt).alias("net_revenue_cents"),
        F.sum(F.when(stream == "membership", amt).otherwise(F.lit(0))).alias("membership_revenue_cents"),
        F.sum(F.when(stream == "service", amt).otherwise(F.lit(0))).alias("service_revenue_cents"),
    )


def visit_rollup(fct_appts: DataFrame) -> DataFrame:
    """E5: scheduled, completed and no-show appointments per (location_id, month_start)."""
    st = F.col("status")
    return fct_appts.groupBy("location_id", month_of("appointment_date").alias("month_start")).agg(
        F.count(F.lit(1)).alias("appointments_scheduled"),
        F.count_if(st == "completed").alias("completed_visits"),
        F.count_if(st == "no_show").alias("no_shows"),
    )


def member_rollup(fct_mm: DataFrame) -> DataFrame:
    """Active, new and churned memberships per (location_id, month_start)."""
    return fct_mm.groupBy("location_id", "month_start").agg(
        F.count(F.lit(1)).alias("active_members"),
        F.count_if(F.col("is_new")).alias("new_members"),
        F.count_if(F.col("is_churned")).alias("churned_members"),
    )


def lead_rollup(fct_lds: DataFrame) -> DataFrame:
    """Leads and converted leads per (location_id, month_start)."""
    return fct_lds.groupBy("location_id", month_of("lead_date").alias("month_start")).agg(
        F.count(F.lit(1)).alias("leads"),
        F.count_if(F.col("is_converted")).alias("converted_leads"),
    )


ACTIVITY = ["appointments_scheduled", "completed_visits", "no_shows", "active_members", "new_members",
            "churned_members", "leads", "converted_leads"]


def activity_rollup(fct_appts: DataFrame, fct_mm: DataFrame, fct_lds: DataFrame) -> DataFrame:
    """Visits, members and leads per (location_id, month_start) in ONE aggregation.

    The three facts are projected to a common shape of 0/1 counters and
    unioned, so a single partial + final aggregate (one shuffle) replaces
    three rollups and the mart needs one join instead of three. A missing
    fact gives 0 instead of null; every measure built on these counters
    treats the two alike (``coalesce(x, 0)`` or ``nullif(x, 0)``).
    """
    one = F.lit(1).cast("long")
    zero = F.lit(0).cast("long")
    flag = lambda c: F.col(c).cast("long") if isinstance(c, str) else c.cast("long")

    def shape(df: DataFrame, month, **counters) -> DataFrame:
        return df.select("location_id", month.alias("month_start"),
                         *[(counters.get(c, zero)).alias(c) for c in ACTIVITY])

    st = F.col("status")
    visits = shape(fct_appts, month_of("appointment_date"), appointments_scheduled=one,
                   completed_visits=flag(F.coalesce(st == "completed", F.lit(False))),
                   no_shows=flag(F.coalesce(st == "no_show", F.lit(False))))
    members = shape(fct_mm, F.col("month_start"), active_members=one,
                    new_members=flag(F.coalesce(F.col("is_new"), F.lit(False))),
                    churned_members=flag(F.coalesce(F.col("is_churned"), F.lit(False))))
    leads = shape(fct_lds, month_of("lead_date"), leads=one,
                  converted_leads=flag(F.coalesce(F.col("is_converted"), F.lit(False))))
    return visits.unionByName(members).unionByName(leads).groupBy(*KEYS).agg(
        *[F.sum(c).alias(c) for c in ACTIVITY])


MEASURES = ["net_revenue", "membership_revenue", "service_revenue", "appointments_scheduled",
            "completed_visits", "no_shows", "no_show_rate", "revenue_per_visit", "active_members",
            "new_members", "churned_members", "member_churn_rate", "leads", "converted_leads",
            "lead_conversion_rate"]
KPI_COLUMNS = ["location_id", "location_name", "brand", "ownership", "franchisee_id", "month_start", *MEASURES]


def assemble_kpis(spine: DataFrame, revenue: DataFrame | None, visits: DataFrame, members: DataFrame | None,
                  leads: DataFrame | None) -> DataFrame:
    """Spine LEFT JOIN the four rollups on (location_id, month_start), then the measures.

    ``revenue=None`` means the spine already carries the revenue columns
    (see :func:`spine_with_revenue`); ``members=leads=None`` means ``visits``
    is the combined :func:`activity_rollup`.

    Revenue stays integer cents until the single division at the end; ratios
    are null on an empty base and rounded half away from zero after scaling.
    """
    j = spine if revenue is None else spine.join(revenue, KEYS, "left")
    for r in (visits, members, leads):          # members/leads are None when visits is the activity rollup
        if r is not None:
            j = j.join(r, KEYS, "left")
    z = lambda c: F.coalesce(F.col(c), F.lit(0))
    svc = cents_to_amount(z("service_revenue_cents"))
    return j.select(
        "location_id", "location_name", "brand", "ownership", "franchisee_id", "month_start",
        cents_to_amount(z("net_revenue_cents")).alias("net_revenue"),
        cents_to_amount(z("membership_revenue_cents")).alias("membership_revenue"),
        svc.alias("service_revenue"),
        z("appointments_scheduled").alias("appointments_scheduled"),
        z("completed_visits").alias("completed_visits"),
        z("no_shows").alias("no_shows"),
        ratio(z("no_shows"), "appointments_scheduled", 4).alias("no_show_rate"),
        ratio(svc, "completed_visits", 2).alias("revenue_per_visit"),
        z("active_members").alias("active_members"),
        z("new_members").alias("new_members"),
        z("churned_members").alias("churned_members"),
        ratio(z("churned_members"), z("active_members") - z("new_members"), 4).alias("member_churn_rate"),
        z("leads").alias("leads"),
        z("converted_leads").alias("converted_leads"),
        ratio(z("converted_leads"), "leads", 4).alias("lead_conversion_rate"),
    )


def kpi_location_monthly(dim_loc: DataFrame, fct_pay: DataFrame, fct_appts: DataFrame, fct_mm: DataFrame,
                         fct_lds: DataFrame, first_month: dt.date | str, last_month: dt.date | str) -> DataFrame:
    """The certified KPI table, one row per location per month it was open."""
    spine_rev = spine_with_revenue(dim_loc, revenue_rollup(fct_pay), first_month, last_month)
    return assemble_kpis(spine_rev, None, activity_rollup(fct_appts, fct_mm, fct_lds), None, None)


# --- only the months that a batch touches ----------------------------------------
def touched_months(changed: dict[str, DataFrame], staged: dict[str, DataFrame],
                   first_month: dt.date | str, last_month: dt.date | str) -> DataFrame:
    """(month_start): months of the KPI table that may differ after a batch; at most the axis has.

    ``changed``: staged rows of each table that the batch brought, and those they replaced (tables without any may be left
    out, which keeps the plan small); ``staged``: the tables after it. A payment, appointment or lead touches its month, a membership the months of its span, a customer record (its
    test flag decides whether facts count) the months of its facts, a location all. At a closed location a payment can
    also add or take the months between closing and itself.
    """
    lo, hi = as_date(first_month), as_date(last_month)
    ids = changed["customers"].select(F.col("customer_id").alias("__id")).distinct() if "customers" in changed else None

    def both(table: str, *columns: str, key: str = "customer_id") -> DataFrame | None:
        rows = [changed[table].select(*columns)] if table in changed else []
        if ids is not None:
            rows.append(staged[table].join(ids, F.col(key) == F.col("__id"), "left_semi").select(*columns))
        return rows[0].unionByName(rows[1]) if len(rows) == 2 else rows[0] if rows else None

    parts = [staged["locations"].where(F.lit(False)).select(lo.alias("m"))]
    pay = both("payments", "location_id", "paid_at")
    if pay is not None:
        pay = pay.select("location_id", month_of("paid_at").alias("m")).distinct()
        closed = staged["locations"].where(F.col("closed_on").isNotNull()).select("location_id", month_of("closed_on").alias("c"))
        parts += [pay.select("m"),
                  pay.join(closed, "location_id").where(F.col("m") > F.col("c")).select(F.explode(month_range(F.col("c"), F.col("m"))).alias("m"))]
    for rows, date in ((both("appointments", "scheduled_at"), "scheduled_at"), (both("leads", "created_at", key="converted_customer_id"), "created_at")):
        if rows is not None:
            parts.append(rows.select(month_of(date).alias("m")))
    members = both("memberships", "start_date", "end_date")
    if members is not None:
        span = month_range(month_of("start_date"), F.coalesce(month_of("end_date"), hi))
        parts.append(members.where(month_of("start_date") <= F.coalesce(month_of("end_date"), hi)).select(F.explode(span).alias("m")))
    if "locations" in changed:
        parts.append(changed["locations"].select(F.explode(month_range(lo, hi)).alias("m")))
    months = parts[0]
    for p in parts[1:]:
        months = months.unionByName(p)
    return months.where(F.col("m").between(lo, hi)).select(F.col("m").alias("month_start")).distinct()


def kpi_for_months(dim_loc: DataFrame, fct_pay: DataFrame, fct_appts: DataFrame, fct_mm: DataFrame, fct_lds: DataFrame,
                   first_month: dt.date | str, last_month: dt.date | str, months: list[dt.date]) -> DataFrame:
    """The rows of the KPI table in ``months``, which are no more than the axis has: literals that prune partitions of
    written facts (``fact_month``, ``month_start``).

    Facts of other months are dropped before they are aggregated; only payments of closed locations are read whole, for their
    last activity.
    """
    def within(df: DataFrame, month) -> DataFrame:
        return df.where((F.col(FACT_MONTH) if FACT_MONTH in df.columns else month).isin(months))

    closed = dim_loc.where(F.col("closed_on").isNotNull()).select("location_id")
    last = last_activity(fct_pay.join(closed, "location_id", "left_semi"))
    spine = within(location_month_spine(dim_loc, last, first_month, last_month), F.col("month_start"))
    activity = activity_rollup(within(fct_appts, month_of("appointment_date")), within(fct_mm, F.col("month_start")), within(fct_lds, month_of("lead_date")))
    return assemble_kpis(spine, revenue_rollup(within(fct_pay, month_of("payment_date"))), activity, None, None)


def refresh_months(kpi: DataFrame, recomputed: DataFrame, months: list[dt.date],
                   axis: tuple[dt.date | str, dt.date | str] | None = None) -> DataFrame:
    """The KPI table with the rows of ``months`` replaced by the recomputed ones.

    ``axis``: first and last month of the table. The months that stay are then named one by one, so that the facts of the others
    are dropped before they are aggregated; where none stays Spark plans no read of the table before.
    """
    if axis is None:
        return kpi.where(~F.col("month_start").isin(months)).unionByName(recomputed)
    first, last = (d if isinstance(d, dt.date) else dt.date.fromisoformat(d) for d in axis)
    span = (dt.date(m // 12, m % 12 + 1, 1) for m in range(first.year * 12 + first.month - 1, last.year * 12 + last.month))
    return kpi.where(F.col("month_start").isin([m for m in span if m not in set(months)])).unionByName(recomputed)
