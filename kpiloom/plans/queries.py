"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Each query derives the raw CRM tables from the driver's tables, runs the
operators it names and returns a lazy DataFrame over the whole input.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as _F

from kpiloom.functions.vocabulary import STATUS_VALUES as _STATUS, TABLES
from kpiloom.operators import ingest as _ing
from kpiloom.operators import quality as _q
from kpiloom.operators import serving as _s
from kpiloom.plans import checks as _checks
from kpiloom.plans.ingest_plan import BATCH_1, LOADED_1, TwoBatches
from kpiloom.plans.models import Models
from kpiloom.session import configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str, dirt: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            configure(spark)
            return fn(Models.from_testdata(spark, sf_dir, dirt))
        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        return fn
    return deco


def _model_query(name: str) -> None:
    query(name)(lambda m, _n=name: m.model(_n))


for _name in [*Models.STAGING, "int_customer_identity", *Models.CERTIFIED, "last_activity",
              "revenue_rollup", "visit_rollup", "member_rollup", "lead_rollup", *Models.METRICS]:
    _model_query(_name)


@query("location_month_spine")
def _spine(m: Models) -> DataFrame:
    return m.spine


# --- B19 ----------------------------------------------------------------------
@query("vocabulary_audit")
def _vocab(m: Models) -> DataFrame:
    from kpiloom.operators.staging import vocabulary_audit
    return vocabulary_audit(m.stg_appointments, m.stg_leads)


@query("unmapped_values")
def _unmapped(m: Models) -> DataFrame:
    """Raw spellings the vocabularies do not know (empty while they are complete)."""
    from kpiloom.operators.staging import unmapped_values, vocabulary_audit
    return unmapped_values(vocabulary_audit(m.stg_appointments, m.stg_leads))


# --- F: data quality ------------------------------------------------------------


@query("dq_not_null")
def _dq_nn(m: Models) -> DataFrame:
    """Customer records without an e-mail (the not-null test's failing rows)."""
    return _q.dq_not_null(m.stg_customers, "email_normalized")


@query("dq_unique")
def _dq_u(m: Models) -> DataFrame:
    """E-mails held by more than one customer record."""
    return _q.dq_unique(m.stg_customers, "email_normalized")


@query("dq_accepted_values")
def _dq_av(m: Models) -> DataFrame:
    """Raw status spellings outside the controlled vocabulary."""
    return _q.dq_accepted_values(m.stg_appointments.select("appointment_id", "status_raw"), "status_raw",
                                 _STATUS)


@query("dq_relationships")
def _dq_rel(m: Models) -> DataFrame:
    """Certified appointments whose service is not in the service table."""
    return _q.dq_relationships(m.fct_appointments, "service_id", m.stg_services, "service_id")


@query("dq_unique_combo")
def _dq_combo(m: Models) -> DataFrame:
    """Customers with more than one appointment on a day."""
    return _q.dq_unique_combo(m.fct_appointments, ["customer_id", "appointment_date"])


@query("dq_duplicates_merged")
def _dq_dm(m: Models) -> DataFrame:
    return _q.dq_duplicates_merged(m.int_customer_identity)


@query("dq_customer_reconcile")
def _dq_cr(m: Models) -> DataFrame:
    return _q.dq_customer_reconcile(m.stg_customers, m.dim_customer)


@query("dq_kpi_vs_ledger")
def _dq_kl(m: Models) -> DataFrame:
    return _q.dq_kpi_vs_ledger(m.kpi_location_monthly, m.fct_payments)


@query("dq_no_test_accounts")
def _dq_nt(m: Models) -> DataFrame:
    return _q.dq_no_test_accounts(m.fct_payments, m.stg_customers)


@query("dq_revenue_vs_source")
def _dq_rs(m: Models) -> DataFrame:
    return _q.dq_revenue_vs_source(m.raw["payments"], m.raw["customers"], m.fct_payments)


@query("dq_results")
def _dq_results(m: Models) -> DataFrame:
    """All 45 data tests: failures per test."""
    return _checks.suite_results(m)


@query("dq_summary")
def _dq_summary(m: Models) -> DataFrame:
    return _q.dq_summary(_checks.suite_results(m), len(_checks.MODEL_NAMES))


@query("unparseable_amounts")
def _dq_amounts(m: Models) -> DataFrame:
    """Raw payment amounts that staging could not parse (empty on clean data)."""
    return _q.unparseable_amounts(m.raw["payments"])


@query("ledger_exclusions")
def _dq_excl(m: Models) -> DataFrame:
    return _q.ledger_exclusions(m.stg_payments, m.int_customer_identity)


# the same over the dirty variant of the raw tables, where the tests must find something
query("dq_results_dirty", "faults")(_dq_results)
query("dq_summary_dirty", "faults")(_dq_summary)
query("unmapped_values_dirty", "faults")(_unmapped)
query("unparseable_amounts_dirty", "amounts")(_dq_amounts)


@query("frequent_unmapped_dirty", "faults")
def _frequent(m: Models) -> DataFrame:
    """The most frequent spellings that no vocabulary knows, by a sketch, with exact counts."""
    from kpiloom.operators.staging import frequent_unmapped
    return frequent_unmapped(m.stg_appointments, m.stg_leads)


@query("dq_failing_keys_dirty", "faults")
def _dq_failing(m: Models) -> DataFrame:
    """The five smallest failing keys of every generic test."""
    return _q.failing_keys({n: m.model(n) for n in Models.STAGING + Models.CERTIFIED + Models.METRICS}, _checks.platform_checks(), _checks.PRIMARY_KEYS)


# --- H: serving -------------------------------------------------------------------


@query("report_extract")
def _h1(m: Models) -> DataFrame:
    return _s.report_extract(m.kpi_location_monthly)


@query("report_periods")
def _h2(m: Models) -> DataFrame:
    return _s.report_periods(m.kpi_location_monthly)


@query("monthly_rollup")
def _h4(m: Models) -> DataFrame:
    return _s.monthly_rollup(m.kpi_location_monthly)


@query("mom_cards")
def _h5(m: Models) -> DataFrame:
    return _s.mom_cards(_s.monthly_rollup(m.kpi_location_monthly))


@query("leaderboard")
def _h6(m: Models) -> DataFrame:
    return _s.leaderboard(m.kpi_location_monthly)


@query("brand_monthly")
def _h7(m: Models) -> DataFrame:
    return _s.brand_monthly(m.kpi_location_monthly)


@query("layer_row_counts")
def _h9(m: Models) -> DataFrame:
    tables = {("raw", f"crm_{t}"): m.raw[t] for t in
              ["locations", "customers", "services", "memberships", "appointments", "payments", "leads"]}
    tables.update({("certified", n): m.model(n) for n in Models.CERTIFIED})
    tables[("metrics", "kpi_location_monthly")] = m.kpi_location_monthly
    return _s.layer_row_counts(tables)


# --- A: ingestion -------------------------------------------------------------------


@query("incremental_extract")
def _a3(m: Models) -> DataFrame:
    """Second batch of payments: changed since batch 1's mark, as text, with audit columns."""
    return TwoBatches(m.raw).batch_2["payments"]


@query("raw_text_audit")
def _a5(m: Models) -> DataFrame:
    """A typed source table landed as raw text with audit columns."""
    src = m.spark.read.parquet(f"{m.sf_dir}/orders.parquet")
    return _ing.with_audit(_ing.to_raw_text(src), BATCH_1, LOADED_1)


@query("raw_landing")
def _a6(m: Models) -> DataFrame:
    """All seven source tables landed as raw text with audit columns, one row of text each."""
    out = None
    for name in TABLES:
        landed = _ing.with_audit(_ing.to_raw_text(m.raw[name]), BATCH_1, LOADED_1)
        data = [c for c in landed.columns if not c.startswith("_")]
        line = _F.concat_ws("|", *[_F.coalesce(_F.col(c), _F.lit("\\N")) for c in data])
        rows = landed.select(_F.lit(name).alias("table_name"), _F.lit(",".join(data)).alias("columns"), line.alias("line"), "_batch_id", "_loaded_at")
        out = rows if out is None else out.unionByName(rows)
    return out


@query("upsert_by_key")
def _a8(m: Models) -> DataFrame:
    return TwoBatches(m.raw).upserted("payments")


@query("watermark_state")
def _a9(m: Models) -> DataFrame:
    return TwoBatches(m.raw).state_2


@query("load_log_summary")
def _a10(m: Models) -> DataFrame:
    return TwoBatches(m.raw).load_log()


@query("kpi_refreshed")
def _e23(m: Models) -> DataFrame:
    """The KPI table after the second batch, only the touched months recomputed."""
    return TwoBatches(m.raw).refreshed_kpis()
