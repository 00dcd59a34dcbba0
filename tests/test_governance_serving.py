"""KPI registry validation, docs, and the serving aggregates."""

from pyspark.sql import functions as F

from kpiloom.operators import governance as g
from kpiloom.operators import serving
from kpiloom.plans.models import Models
from conftest import SF_SMALL


def _wh(spark, m):
    return g.warehouse_columns(spark, {n: m.model(n) for n in g.MODEL_CATALOG})


def test_registry_validates(spark):
    m = Models.from_testdata(spark, SF_SMALL)
    errs = g.validate_registry(g.kpi_registry(spark), g.model_catalog(spark), _wh(spark, m))
    assert errs.count() == 0


def test_registry_rejects_bad_kpis(spark):
    m = Models.from_testdata(spark, SF_SMALL)
    base = g.KPI_REGISTRY[0]
    rows = list(g.KPI_REGISTRY) + [
        ("bogus", *base[1:6], "made_up_metric", *base[7:]),
        ("raw_read", *base[1:5], "stg_payments", "amount_cents", *base[7:]),
        ("net_revenue", *base[1:]),
        ("ghost", *base[1:5], "no_such_model", "x", *base[7:]),
    ]
    errs = {(r.kpi_id, r.check) for r in g.validate_registry(g.kpi_registry(spark, rows), g.model_catalog(spark),
                                                             _wh(spark, m)).collect()}
    assert ("bogus", "not_documented") in errs and ("bogus", "not_in_warehouse") in errs
    assert ("raw_read", "not_certified") in errs
    assert ("net_revenue", "duplicate_id") in errs
    assert ("ghost", "missing_model") in errs and not any(k == "ghost" and c != "missing_model" for k, c in errs)


def test_kpi_docs(spark):
    docs = g.kpi_docs(g.kpi_registry(spark)).collect()
    assert len(docs) == 10 and docs[0].source == "kpi_location_monthly.net_revenue"


def test_rollup_all_row_is_sum_of_brands(spark):
    m = Models.from_testdata(spark, SF_SMALL)
    r = serving.monthly_rollup(m.kpi_location_monthly)
    tot = r.where("brand = 'All'").agg(F.sum("active_members")).first()[0]
    parts = r.where("brand <> 'All'").agg(F.sum("active_members")).first()[0]
    assert tot == parts and tot > 0


def test_mom_card_rules(spark):
    rollup = spark.createDataFrame(
        [("2025-01", "All", 100.0, 10.0, 0.0, 0.1), ("2025-02", "All", 100.04, 12.0, 0.2, 0.1)],
        "month string, brand string, net_revenue double, active_members double, member_churn_rate double, "
        "no_show_rate double")
    got = {r.metric: (r.change, r.is_good) for r in serving.mom_cards(rollup).collect()}
    assert got["net_revenue"] == (0.0, True)          # |change| < 0.0005 -> 0
    assert got["active_members"] == (0.2, True)
    assert got["member_churn_rate"] == (0.0, True)    # before = 0 -> 0
    assert got["no_show_rate"] == (0.0, True)


def test_small_base_suppression(spark):
    kpi = spark.createDataFrame(
        [("2025-01-01", "B", 1.0, 150, 10, 5), ("2025-01-01", "C", 1.0, 50, 10, 5)],
        "month_start string, brand string, net_revenue double, active_members long, new_members long, "
        "churned_members long").withColumn("month_start", F.col("month_start").cast("date"))
    got = {r.brand: r.churn_pct for r in serving.brand_monthly(kpi).collect()}
    assert got["C"] is None and abs(got["B"] - 5 / 140 * 100) < 1e-12


def _kpi_rows(spark, rows):
    return spark.createDataFrame(rows, "location_id int, location_name string, brand string, ownership string, "
                                       "month_start string, net_revenue double, active_members long, "
                                       "new_members long, churned_members long, lead_conversion_rate double") \
        .withColumn("month_start", F.col("month_start").cast("date"))


def test_report_periods_flags_latest_and_previous(spark):
    kpi = _kpi_rows(spark, [(1, "A", "X", "c", "2025-01-01", 1.0, 1, 0, 0, None),
                            (1, "A", "X", "c", "2025-03-01", 1.0, 1, 0, 0, None),
                            (2, "B", "Y", "f", "2025-02-01", 1.0, 1, 0, 0, None)])
    got = {(r.dimension, r.value): (r.position, r.is_latest, r.is_previous)
           for r in serving.report_periods(kpi).collect()}
    assert got[("month", "2025-03")] == (3, True, False)
    assert got[("month", "2025-02")] == (2, False, True)
    assert got[("month", "2025-01")] == (1, False, False)
    assert got[("brand", "X")] == (1, False, False) and got[("brand", "Y")] == (2, False, False)


def test_leaderboard_latest_month_sort_and_brand(spark):
    kpi = _kpi_rows(spark, [(1, "A", "X", "c", "2025-02-01", 10.0, 10, 2, 4, 0.5),
                            (2, "B", "X", "c", "2025-02-01", 30.0, 5, 5, 1, None),
                            (3, "C", "Y", "f", "2025-02-01", 20.0, 8, 0, 2, 0.25),
                            (1, "A", "X", "c", "2025-01-01", 99.0, 1, 0, 0, None)])
    rows = serving.leaderboard(kpi).collect()
    assert [r.location_id for r in rows] == [2, 3, 1]               # latest month only, revenue descending
    churn = {r.location_id: r.member_churn_rate for r in rows}
    assert churn[1] == 0.5 and churn[2] == 0.0 and churn[3] == 0.25   # unrounded; 0 on an empty base
    asc = serving.leaderboard(kpi, "active_members", descending=False, brand="X").collect()
    assert [r.location_id for r in asc] == [2, 1]
