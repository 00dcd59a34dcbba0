"""Serving aggregates over the KPI table (H1-H9): the data behind a dashboard.

The KPI table is location x month sized. Sums of money are taken over
integer cents (round(x * 100) as bigint) and divided once, so results do not
depend on row order or partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ALL = "All"

REPORT_COLUMNS = ["location_id", "location_name", "brand", "ownership", "month", "net_revenue",
                  "membership_revenue", "service_revenue", "appointments_scheduled", "completed_visits",
                  "no_shows", "active_members", "new_members", "churned_members", "leads",
                  "converted_leads", "lead_conversion_rate"]


def _month_label(c: str = "month_start") -> Column:
    return F.date_format(F.col(c), "yyyy-MM")


def _cents_sum(c: str) -> Column:
    return F.sum(F.round(F.col(c) * 100, 0).cast("bigint")).cast("double") / F.lit(100.0)


def report_extract(kpi: DataFrame) -> DataFrame:
    """H1: 17 mart columns with the month as 'YYYY-MM', ordered by month and location."""
    return kpi.select(*[(_month_label().alias("month") if c == "month" else F.col(c)) for c in REPORT_COLUMNS]) \
        .orderBy("month", "location_id")


def report_periods(kpi: DataFrame) -> DataFrame:
    """H2: distinct months and brands, each with its position; latest / previous month flagged.

    The windows run over the distinct values only (months are bounded by the
    month axis, brands by the brand list), never over the KPI rows.
    """
    months = kpi.select(_month_label().alias("value")).distinct().withColumn("dimension", F.lit("month"))
    brands = kpi.select(F.col("brand").alias("value")).distinct().withColumn("dimension", F.lit("brand"))
    w_up = Window.partitionBy("dimension").orderBy("value")
    w_down = Window.partitionBy("dimension").orderBy(F.col("value").desc())
    both = months.unionByName(brands)
    back = F.row_number().over(w_down)
    return both.select(
        "dimension", "value",
        F.row_number().over(w_up).cast("bigint").alias("position"),
        ((F.col("dimension") == "month") & (back == 1)).alias("is_latest"),
        ((F.col("dimension") == "month") & (back == 2)).alias("is_previous"),
    )


def by_brand(kpi: DataFrame, brand: str = ALL) -> DataFrame:
    """H3: the KPI rows of one brand; 'All' keeps every brand."""
    return kpi if brand == ALL else kpi.where(F.col("brand") == F.lit(brand))


def monthly_rollup(kpi: DataFrame) -> DataFrame:
    """H3+H4: per month, per brand and for 'All' brands, in one grouping-sets aggregate.

    Churn = sum churned / (sum active - sum new) and no-show = sum no-shows /
    sum scheduled, 0 (not null) on an empty base, unrounded.
    """
    base = kpi.withColumn("month", _month_label())
    g = base.groupingSets([["month", "brand"], ["month"]], "month", "brand").agg(
        F.grouping("brand").alias("__all"),
        _cents_sum("net_revenue").alias("net_revenue"),
        _cents_sum("membership_revenue").alias("membership_revenue"),
        _cents_sum("service_revenue").alias("service_revenue"),
        F.sum("active_members").alias("active_members"),
        F.sum("new_members").alias("new_members"),
        F.sum("churned_members").alias("churned_members"),
        F.sum("appointments_scheduled").alias("appointments_scheduled"),
        F.sum("no_shows").alias("no_shows"),
    )
    start = F.col("active_members") - F.col("new_members")
    return g.select(
        "month",
        F.when(F.col("__all") == 1, F.lit(ALL)).otherwise(F.col("brand")).alias("brand"),
        "net_revenue", "membership_revenue", "service_revenue", "active_members", "new_members",
        "churned_members", "appointments_scheduled", "no_shows",
        F.when(start > 0, F.col("churned_members") / start).otherwise(F.lit(0.0)).alias("member_churn_rate"),
        F.when(F.col("appointments_scheduled") > 0, F.col("no_shows") / F.col("appointments_scheduled"))
         .otherwise(F.lit(0.0)).alias("no_show_rate"),
    )


# metric -> (rollup column, whether up is good)
CARDS = {"net_revenue": ("net_revenue", True), "active_members": ("active_members", True),
         "member_churn_rate": ("member_churn_rate", False), "no_show_rate": ("no_show_rate", False)}


def mom_cards(rollup: DataFrame, cards: dict[str, tuple[str, bool]] = CARDS) -> DataFrame:
    """H5: latest month vs previous month for every brand (and 'All') and card metric.

    change = (now - before) / before, 0 when before is 0 or missing, and 0 when
    |change| < 0.0005. ``is_good``: no change, or the direction the metric wants.
    """
    # the two latest months by a window over the rollup itself (months x brands rows), so the facts are read once
    ranked = rollup.withColumn("__back", F.dense_rank().over(Window.orderBy(F.desc("month"))))
    long = ranked.select("month", "brand", "__back", F.explode(F.array(*[
        F.struct(F.lit(k).alias("metric"), F.col(c).cast("double").alias("value"),
                 F.lit(up).alias("good_up")) for k, (c, up) in cards.items()])).alias("m")
    ).select("month", "brand", "__back", "m.*")
    j = long.where("__back <= 2")
    g = j.groupBy("brand", "metric").agg(
        F.max(F.when(F.col("__back") == 1, F.col("month"))).alias("month"),
        F.max(F.when(F.col("__back") == 2, F.col("month"))).alias("previous_month"),
        F.coalesce(F.sum(F.when(F.col("__back") == 1, F.col("value"))), F.lit(0.0)).alias("value"),
        F.coalesce(F.sum(F.when(F.col("__back") == 2, F.col("value"))), F.lit(0.0)).alias("previous_value"),
        F.max("good_up").alias("good_up"),
    )
    raw = F.when(F.col("previous_value") != 0,
                 (F.col("value") - F.col("previous_value")) / F.col("previous_value")).otherwise(F.lit(0.0))
    change = F.when(F.abs(raw) < 0.0005, F.lit(0.0)).otherwise(raw)
    return g.withColumn("change", change).select(
        "brand", "metric", "month", "previous_month", "value", "previous_value", "change",
        ((F.col("change") == 0) | ((F.col("change") >= 0) == F.col("good_up"))).alias("is_good"))


LEADERBOARD_COLUMNS = ["location_id", "location_name", "brand", "ownership", "net_revenue", "active_members",
                       "member_churn_rate", "lead_conversion_rate"]


def leaderboard(kpi: DataFrame, sort_key: str = "net_revenue", descending: bool = True,
                brand: str | None = None) -> DataFrame:
    """H6: locations in the latest month; churn recomputed unrounded (0 on an empty base).

    Sorted by ``sort_key`` (a distributed range sort); optionally one brand. The latest month is found in the same pass
    (rows per location and month are few), so no job runs while the plan is built and the table is computed once.
    """
    latest = F.max("month_start").over(Window.partitionBy())
    rows = kpi.withColumn("__latest", latest).where(F.col("month_start") == F.col("__latest")).drop("__latest")
    if brand and brand != ALL:
        rows = rows.where(F.col("brand") == brand)
    start = F.col("active_members") - F.col("new_members")
    out = rows.select(
        "location_id", "location_name", "brand", "ownership", _month_label().alias("month"), "net_revenue",
        "active_members",
        F.when(start > 0, F.col("churned_members") / start).otherwise(F.lit(0.0)).alias("member_churn_rate"),
        "lead_conversion_rate")
    key = F.col(sort_key).desc() if descending else F.col(sort_key).asc()
    return out.orderBy(key, "location_id")


def brand_monthly(kpi: DataFrame, min_base: int = 100) -> DataFrame:
    """H7+H8: sums by month and brand; churn % only where the starting base >= ``min_base``."""
    g = kpi.withColumn("month", _month_label()).groupBy("month", "brand").agg(
        _cents_sum("net_revenue").alias("net_revenue"),
        F.sum("active_members").alias("active_members"),
        F.sum("churned_members").alias("churned_members"),
        F.sum("new_members").alias("new_members"),
    )
    start = F.col("active_members") - F.col("new_members")
    return g.withColumn("churn_pct", F.when(start >= min_base, F.col("churned_members") / start * 100.0))


def layer_row_counts(tables: dict[tuple[str, str], DataFrame]) -> DataFrame:
    """H9: rows per (layer, table), one global count per table, unioned."""
    parts = [df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        F.lit(layer).alias("layer"), F.lit(name).alias("table_name"), "n_rows")
        for (layer, name), df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
