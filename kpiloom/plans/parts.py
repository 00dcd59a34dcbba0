"""Published models by month: what a batch touches, and which run wrote which month.

Facts and the KPI table are partitioned by month. A run after a batch writes only the months whose rows may differ; a
publication lists for each model the runs that wrote it, oldest first, with the months each of them wrote (None: all). Of
a month the latest run that wrote it counts, so nothing published is rewritten or copied, and a run that fails its tests
leaves no trace in what readers see. The lists are bounded by the months of the data and by ``MAX_PARTS`` runs; beyond
it a model is written whole again.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kpiloom.functions.dates import as_date, month_of, month_range
from kpiloom.operators import ingest
from kpiloom.operators.mart import FACT_MONTH, touched_months

LAYER_OF = {"customer_identity_wide": "intermediate", "dim_location": "certified", "dim_customer": "certified",
            "fct_appointments": "certified", "fct_payments": "certified", "fct_membership_months": "certified",
            "fct_leads": "certified", "kpi_location_monthly": "metrics"}
DATE_OF = {"fct_payments": "payment_date", "fct_appointments": "appointment_date", "fct_leads": "lead_date"}
PARTITION = {**{m: FACT_MONTH for m in DATE_OF}, "fct_membership_months": "month_start", "kpi_location_monthly": "month_start"}
MAX_PARTS = 12


def model_path(root: str, run_id: str, model: str) -> str:
    """Folder of one model written by one run."""
    return f"{root}/runs/{run_id}/{LAYER_OF.get(model, 'other')}/{model}"


def in_months(month: Column, months: list[dt.date | None]) -> Column:
    """Whether a month is listed; None stands for rows without a date. Never null, so that its negation keeps the others."""
    known = [m for m in months if m is not None]
    hit = F.coalesce(month.isin(known), F.lit(False)) if known else F.lit(False)
    return hit | month.isNull() if None in months else hit


def to_json(months: list[dt.date | None] | None) -> list[str | None] | None:
    return None if months is None else [m and m.isoformat() for m in months]


def read_parts(spark: SparkSession, root: str, model: str, entry: dict) -> DataFrame:
    """A model from the folders of the runs that wrote it; months that a later run wrote are pruned from earlier folders."""
    schema = T.StructType.fromJson(entry["schema"])
    later: list[dt.date | None] = []
    out = None
    for run_id, months in reversed(entry["parts"]):
        df = spark.read.schema(schema).parquet(model_path(root, run_id, model)).select(*schema.names)
        if later:
            df = df.where(~in_months(F.col(PARTITION[model]), later))
        out = df if out is None else out.unionByName(df)
        later = later + [m and dt.date.fromisoformat(m) for m in months or []]
    return out


# --- what came since a publication --------------------------------------------------
def deltas_since(state: dict[str, ingest.TableState], snapshots: dict[str, str]) -> dict[str, list[tuple[str, str]]] | None:
    """table -> deltas loaded after the published snapshots; None where a table was written anew since (a full refresh or
    a compaction), so that its changes are no longer apart from the rest."""
    out = {}
    for table, s in state.items():
        chain = [s.base, *[b for b, _ in s.deltas]]
        if snapshots.get(table) not in chain:
            return None
        out[table] = s.deltas[chain.index(snapshots[table]):]
    return out


def changed_rows(spark: SparkSession, root: str, table: str, state: ingest.TableState, since: list[tuple[str, str]]) -> DataFrame:
    """Raw rows of the deltas (at least one) and those that were there before under their keys."""
    before = ingest.read_state(spark, root, table, state._replace(deltas=state.deltas[:len(state.deltas) - len(since)]))
    new = None
    for batch, _ in since:
        d = spark.read.parquet(ingest.delta_path(root, table, batch))
        new = d if new is None else new.unionByName(d)
    return new.unionByName(before.join(new.select(state.key).distinct(), state.key, "left_semi"))


def changed_identities(before: DataFrame, after: DataFrame, touched: DataFrame) -> DataFrame:
    """(customer_id) of the records that a batch brought or replaced (``touched``), and of those whose master id or test
    flag differs because of them."""
    what = F.struct("master_customer_id", "is_test_account")
    a = before.where("customer_id is not null").select("customer_id", what.alias("__a"))
    b = after.where("customer_id is not null").select("customer_id", what.alias("__b"))
    differ = a.join(b, "customer_id", "full").where(~F.col("__a").eqNullSafe(F.col("__b"))).select("customer_id")
    return differ.unionByName(touched.where("customer_id is not null").select("customer_id")).distinct()


def months_to_write(changed: dict[str, DataFrame], staged: dict[str, DataFrame], moved: DataFrame | None,
                    first_month: dt.date | str, last_month: dt.date | str) -> dict[str, list[dt.date | None]]:
    """model -> months whose rows may differ, for the facts and the KPI table.

    A fact's row depends on its own raw row, on the identity of its customer (``moved``: those that differ) and, for
    appointments, on the service. ``changed`` holds the tables with changed rows only. One job; at most one row a model and
    month reaches the driver.
    """
    lo, hi = as_date(first_month), as_date(last_month)
    start, last = month_of("start_date"), F.least(F.coalesce(month_of("end_date"), hi), hi)
    found: list[DataFrame] = []

    def of_keys(table: str, key: str, ids: DataFrame, id_name: str) -> DataFrame:
        ids = ids.select(F.col(id_name).alias("__id")).distinct()
        return staged[table].join(ids, F.col(key) == F.col("__id"), "left_semi")

    def add(model: str, table: str, key: str, months) -> None:
        rows = [changed[table]] if table in changed else []
        if moved is not None:
            rows.append(of_keys(table, key, moved, "customer_id"))
        if table == "appointments" and "services" in changed:
            rows.append(of_keys(table, "service_id", changed["services"], "service_id"))
        found.extend(months(r).select(F.lit(model).alias("model"), "m") for r in rows)

    def active(memberships: DataFrame) -> DataFrame:
        spans = memberships.where(start.isNotNull() & (F.greatest(start, lo) <= last))
        return spans.select(F.explode(month_range(F.greatest(start, lo), last)).alias("m"))

    add("fct_payments", "payments", "customer_id", lambda r: r.select(month_of("paid_at").alias("m")))
    add("fct_appointments", "appointments", "customer_id", lambda r: r.select(month_of("scheduled_at").alias("m")))
    add("fct_leads", "leads", "converted_customer_id", lambda r: r.select(month_of("created_at").alias("m")))
    add("fct_membership_months", "memberships", "customer_id", active)
    all_ = touched_months(changed, staged, first_month, last_month).select(F.lit("kpi_location_monthly").alias("model"), F.col("month_start").alias("m"))
    for df in found:
        all_ = all_.unionByName(df)
    out: dict[str, list[dt.date | None]] = {m: [] for m in PARTITION}
    for r in all_.distinct().collect():
        out[r["model"]].append(r["m"])
    return {m: sorted(v, key=lambda x: x or dt.date.min) for m, v in out.items()}
