"""The platform's data-test suite (45 tests) as ``Check`` specs plus tie-outs."""

from __future__ import annotations

from pyspark.sql import DataFrame

from kpiloom.functions.vocabulary import CHANNEL_VALUES, OWNERSHIP_VALUES, PAYMENT_TYPES, STATUS_VALUES
from kpiloom.operators import quality as q
from kpiloom.operators.quality import Check, TieOut, Total

# Brands of the derived test data (the reference's own chain uses two others).
FIXTURE_BRANDS = ("Alder Clinics", "Birch Wellness")


PRIMARY_KEYS = {"stg_locations": ("location_id",), "stg_customers": ("customer_id",), "stg_appointments": ("appointment_id",),
                "stg_payments": ("payment_id",), "stg_leads": ("lead_id",), "dim_location": ("location_id",), "dim_customer": ("customer_id",),
                "fct_appointments": ("appointment_id",), "fct_payments": ("payment_id",), "fct_membership_months": ("membership_id", "month_start"),
                "fct_leads": ("lead_id",), "kpi_location_monthly": ("location_id", "month_start")}


def _uid(model: str, col: str) -> list[Check]:
    return [Check(model, "unique", (col,)), Check(model, "not_null", (col,))]


def platform_checks(brands: tuple[str, ...] = FIXTURE_BRANDS) -> list[Check]:
    """The 40 generic data tests of the platform (staging 18, certified 19, metrics 3)."""
    c: list[Check] = []
    # staging: 18
    c += _uid("stg_locations", "location_id")
    c += [Check("stg_locations", "accepted_values", ("ownership",), tuple(OWNERSHIP_VALUES))]
    c += _uid("stg_customers", "customer_id")
    c += [Check("stg_customers", "not_null", ("is_test_account",))]
    c += _uid("stg_appointments", "appointment_id")
    c += [Check("stg_appointments", "not_null", ("status",)),
          Check("stg_appointments", "accepted_values", ("status",), tuple(STATUS_VALUES))]
    c += _uid("stg_payments", "payment_id")
    c += [Check("stg_payments", "not_null", ("amount_cents",)),
          Check("stg_payments", "accepted_values", ("payment_type",), tuple(PAYMENT_TYPES))]
    c += _uid("stg_leads", "lead_id")
    c += [Check("stg_leads", "not_null", ("channel",)),
          Check("stg_leads", "accepted_values", ("channel",), tuple(CHANNEL_VALUES))]
    # certified: 19
    c += _uid("dim_location", "location_id") + _uid("dim_location", "location_name")
    c += [Check("dim_location", "accepted_values", ("brand",), tuple(brands))]
    c += _uid("dim_customer", "customer_id")
    c += [Check("dim_customer", "relationships", ("home_location_id",), parent="dim_location",
                parent_field="location_id")]
    c += _uid("fct_appointments", "appointment_id")
    c += [Check("fct_appointments", "relationships", ("customer_id",), parent="dim_customer",
                parent_field="customer_id"),
          Check("fct_appointments", "relationships", ("location_id",), parent="dim_location",
                parent_field="location_id")]
    c += _uid("fct_payments", "payment_id")
    c += [Check("fct_payments", "not_null", ("amount_cents",)),
          Check("fct_payments", "relationships", ("location_id",), parent="dim_location",
                parent_field="location_id")]
    c += [Check("fct_membership_months", "unique_combo", ("membership_id", "month_start"))]
    c += _uid("fct_leads", "lead_id")
    # metrics: 3
    c += [Check("kpi_location_monthly", "unique_combo", ("location_id", "month_start")),
          Check("kpi_location_monthly", "not_null", ("location_id",)),
          Check("kpi_location_monthly", "not_null", ("month_start",))]
    return c


def tie_outs(m) -> dict[str, DataFrame]:
    """The five singular tests on a ``Models``-like object (attribute access)."""
    return {
        "assert_duplicates_merged": q.dq_duplicates_merged(m.int_customer_identity),
        "assert_every_real_customer_certified": q.dq_customer_reconcile(m.stg_customers, m.dim_customer),
        "assert_kpi_revenue_ties_to_ledger": q.dq_kpi_vs_ledger(m.kpi_location_monthly, m.fct_payments),
        "assert_no_test_accounts_certified": q.dq_no_test_accounts(m.fct_payments, m.stg_customers),
        "assert_revenue_ties_to_source": q.dq_revenue_vs_source(m.raw["payments"], m.raw["customers"],
                                                                m.fct_payments),
    }


# Two of the five tie-outs only compare totals of tables the generic checks
# already read; in the suite they are computed in the same single pass.
SUITE_TOTALS = [
    Total("total_source_records", "stg_customers", "IF(NOT is_test_account, 1, 0)", empty_as_zero=True),
    Total("total_certified_records", "dim_customer", "source_records_merged"),
    Total("total_kpi_cents", "kpi_location_monthly", "round(net_revenue * 100, 0)"),
    Total("total_ledger_cents", "fct_payments", "amount_cents"),
]
SUITE_TIES = [
    TieOut("assert_every_real_customer_certified", "total_source_records", "total_certified_records"),
    TieOut("assert_kpi_revenue_ties_to_ledger", "total_kpi_cents", "total_ledger_cents"),
    # certified side from the pass; the source side is recomputed from raw text (external total)
    TieOut("assert_revenue_ties_to_source", "total_source_cents", "total_ledger_cents"),
]

# No certified payment may belong to a test record: a key check in the same pass.
NO_TEST_ACCOUNTS = Check("fct_payments", "absent_from", ("customer_id",), parent="stg_customers",
                         parent_field="customer_id", name="assert_no_test_accounts_certified",
                         parent_where="is_test_account", report_as=("singular", "tie_out"))


MODEL_NAMES = ["stg_locations", "stg_customers", "stg_services", "stg_memberships", "stg_appointments",
               "stg_payments", "stg_leads", "int_customer_identity", "dim_location", "dim_customer",
               "fct_appointments", "fct_payments", "fct_membership_months", "fct_leads", "kpi_location_monthly"]


def observable(model: str, brands: tuple[str, ...] = FIXTURE_BRANDS) -> dict[str, str]:
    """What can be counted while a model is written: test or total -> SQL aggregate."""
    return q.observable(model, platform_checks(brands), SUITE_TOTALS)


def suite_results(m, brands: tuple[str, ...] = FIXTURE_BRANDS, observed: dict[str, int | None] | None = None) -> DataFrame:
    """All 45 tests; ``observed`` holds those that were counted while their models were written. 40 generic checks, the no-test-accounts check and three total
    comparisons share one pass over the models; the duplicates check (a join)
    and the raw-text revenue total run beside it."""
    checks = platform_checks(brands) + [NO_TEST_ACCOUNTS]
    needed = ({c.model for c in checks} | {c.parent for c in checks if c.parent}
              | {t.model for t in SUITE_TOTALS})
    models = {name: m.model(name) for name in needed}
    singular = {"assert_duplicates_merged": q.dq_duplicates_merged(m.int_customer_identity)}
    external = {"total_source_cents": q.raw_source_cents(m.raw["payments"], m.raw["customers"])}
    return q.run_suite(models, checks, singular, SUITE_TOTALS, SUITE_TIES, external, observed)
