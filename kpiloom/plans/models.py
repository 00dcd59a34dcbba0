"""The platform's model graph as lazily built DataFrames.

``Models`` wires raw -> staging -> identity -> certified -> metrics. Each
property is built once per instance, so a query touching three models builds
only those three (plus their inputs). Nothing here executes a Spark job.
"""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from kpiloom.operators import certified, identity, mart, staging
from kpiloom.sources.crm import FIXTURE_MONTHS, RawSource
from kpiloom.sources.dirt import damaged


class Models:
    def __init__(self, spark: SparkSession, raw: dict[str, DataFrame],
                 first_month: dt.date | str = FIXTURE_MONTHS[0], last_month: dt.date | str = FIXTURE_MONTHS[1]):
        self.spark = spark
        self.raw = raw
        self.first_month = first_month
        self.last_month = last_month
        self.sf_dir = None

    @classmethod
    def from_testdata(cls, spark: SparkSession, sf_dir: str, dirt: str | None = None, **kw) -> "Models":
        """Over one directory of driver tables; ``dirt``: None, "faults" or "amounts" (see sources.dirt)."""
        m = cls(spark, _LazyRaw(spark, sf_dir, dirt), **kw)
        m.sf_dir = sf_dir
        return m

    # staging ---------------------------------------------------------------
    @cached_property
    def stg_locations(self): return staging.stg_locations(self.raw["locations"])
    @cached_property
    def stg_customers(self): return staging.stg_customers(self.raw["customers"])
    @cached_property
    def stg_services(self): return staging.stg_services(self.raw["services"])
    @cached_property
    def stg_memberships(self): return staging.stg_memberships(self.raw["memberships"])
    @cached_property
    def stg_appointments(self): return staging.stg_appointments(self.raw["appointments"])
    @cached_property
    def stg_payments(self): return staging.stg_payments(self.raw["payments"])
    @cached_property
    def stg_leads(self): return staging.stg_leads(self.raw["leads"])

    # intermediate ----------------------------------------------------------
    @cached_property
    def identity_wide(self): return identity.resolve_identity(self.stg_customers)
    @cached_property
    def int_customer_identity(self):
        return self.identity_wide.select("customer_id", "master_customer_id", "email_normalized", "is_test_account")

    # certified -------------------------------------------------------------
    @cached_property
    def dim_location(self): return certified.dim_location(self.stg_locations)
    @cached_property
    def dim_customer(self): return certified.dim_customer(self.identity_wide)
    @cached_property
    def fct_appointments(self):
        return certified.fct_appointments(self.stg_appointments, self.int_customer_identity, self.stg_services)
    @cached_property
    def fct_payments(self): return certified.fct_payments(self.stg_payments, self.int_customer_identity)
    @cached_property
    def fct_membership_months(self):
        return certified.fct_membership_months(self.stg_memberships, self.int_customer_identity,
                                               self.first_month, self.last_month)
    @cached_property
    def fct_leads(self): return certified.fct_leads(self.stg_leads, self.int_customer_identity)

    # metrics ---------------------------------------------------------------
    @cached_property
    def month_axis(self): return mart.month_axis(self.spark, self.first_month, self.last_month)
    @cached_property
    def last_activity(self): return mart.last_activity(self.fct_payments)
    @cached_property
    def spine(self):
        # last payment month taken from the revenue rollup: one pass over payments
        last = mart.last_activity_from_revenue(self.revenue_rollup)
        return mart.location_month_spine(self.dim_location, last, self.first_month, self.last_month)
    @cached_property
    def revenue_rollup(self): return mart.revenue_rollup(self.fct_payments)
    @cached_property
    def visit_rollup(self): return mart.visit_rollup(self.fct_appointments)
    @cached_property
    def member_rollup(self): return mart.member_rollup(self.fct_membership_months)
    @cached_property
    def lead_rollup(self): return mart.lead_rollup(self.fct_leads)
    @cached_property
    def spine_with_revenue(self):
        return mart.spine_with_revenue(self.dim_location, self.revenue_rollup, self.first_month, self.last_month)
    @cached_property
    def kpi_location_monthly(self):
        return mart.assemble_kpis(self.spine_with_revenue, None,
                                  mart.activity_rollup(self.fct_appointments, self.fct_membership_months,
                                                       self.fct_leads), None, None)

    CERTIFIED = ["dim_location", "dim_customer", "fct_appointments", "fct_payments",
                 "fct_membership_months", "fct_leads"]
    METRICS = ["kpi_location_monthly"]
    STAGING = ["stg_locations", "stg_customers", "stg_services", "stg_memberships",
               "stg_appointments", "stg_payments", "stg_leads"]

    def model(self, name: str) -> DataFrame:
        return getattr(self, name)


class _LazyRaw(dict):
    """Raw tables built on first access (only the ones a query needs)."""

    def __init__(self, spark: SparkSession, sf_dir: str, dirt: str | None = None):
        super().__init__()
        self._src, self._dirt = RawSource(spark, sf_dir), dirt

    def __missing__(self, name: str) -> DataFrame:
        table = self._src.table(name)
        self[name] = damaged(name, table, amounts=self._dirt == "amounts") if self._dirt else table
        return self[name]
