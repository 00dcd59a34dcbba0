"""KPI governance (G1-G9): registry, model catalog, validation, docs table.

The registry and catalog are metadata-sized DataFrames; validation is a set
of joins between them and the columns of the tables actually built, so an
invalid KPI shows up as a row in the errors DataFrame.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

REGISTRY_SCHEMA = T.StructType([T.StructField(n, T.StringType(), True) for n in
                                ["id", "name", "definition", "formula", "grain", "source_model", "column",
                                 "tier", "unit"]])

# --- fixed values: the KPI registry (id, name, definition, formula, grain,
# source model, column, tier, unit), in registry order -----------------------
KPI_REGISTRY = [
    ("net_revenue", "Net Revenue",
     "Settled sales and refunds for real customers, excluding voided payments and test accounts.",
     "sum(fct_payments.amount_cents) / 100", "location x month", "kpi_location_monthly", "net_revenue",
     "board", "currency"),
    ("membership_revenue", "Membership Revenue", "Net revenue from recurring membership charges.",
     "sum(amount_cents) where revenue_stream = 'membership'", "location x month", "kpi_location_monthly",
     "membership_revenue", "board", "currency"),
    ("service_revenue", "Service Revenue",
     "Net revenue from individual services, including refunds of those services.",
     "sum(amount_cents) where revenue_stream = 'service'", "location x month", "kpi_location_monthly",
     "service_revenue", "executive", "currency"),
    ("active_members", "Active Members",
     "Memberships active at any point in the month, including those that start or end in it.",
     "count(fct_membership_months rows)", "location x month", "kpi_location_monthly", "active_members",
     "board", "count"),
    ("new_members", "New Members", "Memberships whose start date falls in the month.",
     "count where is_new", "location x month", "kpi_location_monthly", "new_members", "executive", "count"),
    ("member_churn_rate", "Member Churn Rate",
     "Memberships ending in the month divided by memberships active at the start of the month.",
     "churned_members / (active_members - new_members)", "location x month", "kpi_location_monthly",
     "member_churn_rate", "board", "percent"),
    ("completed_visits", "Completed Visits", "Appointments with a completed status for real customers.",
     "count(fct_appointments) where status = 'completed'", "location x month", "kpi_location_monthly",
     "completed_visits", "executive", "count"),
    ("no_show_rate", "No-Show Rate",
     "No-show appointments divided by all scheduled appointments in the month.",
     "no_shows / appointments_scheduled", "location x month", "kpi_location_monthly", "no_show_rate",
     "operational", "percent"),
    ("revenue_per_visit", "Revenue per Visit",
     "Service revenue divided by completed visits. Membership revenue is excluded.",
     "service_revenue / completed_visits", "location x month", "kpi_location_monthly", "revenue_per_visit",
     "operational", "currency"),
    ("lead_conversion_rate", "Lead Conversion Rate",
     "Leads created in the month that became real customers, divided by all leads created in the month.",
     "converted_leads / leads", "location x month", "kpi_location_monthly", "lead_conversion_rate",
     "executive", "percent"),
]

OWNER = "Data, Analytics & AI"

# Model catalog: name -> (layer, certified, tier, documented columns).
MODEL_CATALOG = {
    "stg_locations": ("staging", False, None, ["location_id", "ownership"]),
    "stg_customers": ("staging", False, None, ["customer_id", "is_test_account"]),
    "stg_services": ("staging", False, None, []),
    "stg_memberships": ("staging", False, None, []),
    "stg_appointments": ("staging", False, None, ["appointment_id", "status"]),
    "stg_payments": ("staging", False, None, ["payment_id", "amount_cents", "payment_type"]),
    "stg_leads": ("staging", False, None, ["lead_id", "channel"]),
    "int_customer_identity": ("intermediate", False, None, []),
    "dim_location": ("certified", True, "board", ["location_id", "location_name", "brand"]),
    "dim_customer": ("certified", True, "executive", ["customer_id", "home_location_id"]),
    "fct_appointments": ("certified", True, "executive", ["appointment_id", "customer_id", "location_id"]),
    "fct_payments": ("certified", True, "board", ["payment_id", "amount_cents", "location_id"]),
    "fct_membership_months": ("certified", True, "board", []),
    "fct_leads": ("certified", True, "executive", ["lead_id"]),
    "kpi_location_monthly": ("metrics", True, "board", [
        "location_id", "month_start", "net_revenue", "membership_revenue", "service_revenue",
        "appointments_scheduled", "completed_visits", "no_shows", "no_show_rate", "revenue_per_visit",
        "active_members", "new_members", "churned_members", "member_churn_rate", "leads", "converted_leads",
        "lead_conversion_rate"]),
}
# --- end of fixed values ------------------------------------------------------

CATALOG_SCHEMA = T.StructType([
    T.StructField("name", T.StringType(), False),
    T.StructField("layer", T.StringType(), False),
    T.StructField("certified", T.BooleanType(), False),
    T.StructField("tier", T.StringType(), True),
    T.StructField("owner", T.StringType(), True),
    T.StructField("columns", T.ArrayType(T.StringType()), False),
])


def kpi_registry(spark: SparkSession, rows: list[tuple] | None = None) -> DataFrame:
    """G1: one row per KPI, plus its position in the registry."""
    rows = KPI_REGISTRY if rows is None else rows
    schema = T.StructType([*REGISTRY_SCHEMA.fields, T.StructField("position", T.IntegerType(), False)])
    return spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], schema)


def model_catalog(spark: SparkSession, catalog: dict | None = None) -> DataFrame:
    """Name, layer, certified, tier, owner, documented columns."""
    catalog = MODEL_CATALOG if catalog is None else catalog
    return spark.createDataFrame(
        [(n, layer, cert, tier, OWNER if cert else None, cols) for n, (layer, cert, tier, cols) in catalog.items()],
        CATALOG_SCHEMA)


def warehouse_columns(spark: SparkSession, tables: dict[str, DataFrame]) -> DataFrame:
    """(model, column) for the tables as built -- from their schemas, no job runs."""
    rows = [(name, c) for name, df in tables.items() for c in df.columns]
    return spark.createDataFrame(rows, "model string, column string")


def validate_registry(registry: DataFrame, catalog: DataFrame, wh_columns: DataFrame) -> DataFrame:
    """G2-G6 as joins. Returns (kpi_id, check, message); empty means valid.

    duplicate_id: second and later occurrences of an id. missing_model: later
    checks are skipped for that KPI. not_certified, not_documented and
    not_in_warehouse are independent of each other.
    """
    reg = registry.withColumn("__n", F.row_number().over(Window.partitionBy("id").orderBy("position")))
    dup = reg.where(F.col("__n") > 1).select(
        "position", F.col("id").alias("kpi_id"), F.lit("duplicate_id").alias("check"),
        F.concat(F.col("id"), F.lit(": duplicate KPI id")).alias("message"))
    cat = catalog.select(F.col("name").alias("source_model"), "certified", "columns")
    j = reg.join(cat, "source_model", "left")
    missing = j.where(F.col("certified").isNull()).select(
        "position", F.col("id").alias("kpi_id"), F.lit("missing_model").alias("check"),
        F.concat(F.col("id"), F.lit(": source model '"), F.col("source_model"),
                 F.lit("' does not exist")).alias("message"))
    known = j.where(F.col("certified").isNotNull())
    uncert = known.where(~F.col("certified")).select(
        "position", F.col("id").alias("kpi_id"), F.lit("not_certified").alias("check"),
        F.concat(F.col("id"), F.lit(": source model '"), F.col("source_model"),
                 F.lit("' is not certified")).alias("message"))
    undoc = known.where(~F.array_contains(F.col("columns"), F.col("column"))).select(
        "position", F.col("id").alias("kpi_id"), F.lit("not_documented").alias("check"),
        F.concat(F.col("id"), F.lit(": column '"), F.col("column"), F.lit("' is not documented on "),
                 F.col("source_model")).alias("message"))
    whc = wh_columns.select(F.col("model").alias("source_model"), F.col("column"))
    absent = known.join(whc, ["source_model", "column"], "left_anti").select(
        "position", F.col("id").alias("kpi_id"), F.lit("not_in_warehouse").alias("check"),
        F.concat(F.col("id"), F.lit(": column '"), F.col("column"), F.lit("' not found in "),
                 F.col("source_model")).alias("message"))
    return dup.unionByName(missing).unionByName(uncert).unionByName(undoc).unionByName(absent)


def kpi_docs(registry: DataFrame) -> DataFrame:
    """The documentation table (name, definition, formula, tier, source)."""
    return registry.orderBy("position").select(
        "name", "definition", "formula", "tier",
        F.concat_ws(".", F.col("source_model"), F.col("column")).alias("source"))
