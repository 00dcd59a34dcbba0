"""The whole platform as one run: ingest -> build -> audit -> publish -> report.

Write-audit-publish on plain parquet:

* every model of a run is written under ``<root>/runs/<run_id>/<layer>/<model>``
  (staging stays a view over raw; the identity table is written once, as
  ``customer_identity_wide``, because five models read it); facts and the KPI table are
  partitioned by month;
* a run after a batch writes only what the batch touches (see :mod:`kpiloom.plans.parts`): the
  months of facts and KPIs whose rows may differ, and the identity and dimensions if their inputs
  changed; all else stays where earlier published runs wrote it. The tests run on the whole result;
* the 45 data tests run on the candidates -- row-local tests and totals are
  counted while a model is written, the others on what was written -- and their outcomes are
  written to ``runs/<run_id>/audit/test_results``; any failure raises
  :class:`GateError` before anything is published;
* publishing appends one partition to ``<root>/meta/publish_log`` naming the
  run, the raw batches it was built from, a digest of the models' code and the folders of each model; readers resolve a model through
  the latest published run. A failed or interrupted run leaves the previous
  publication current; the next run builds anew unless the latest publication
  was built from the very rows, parameters and code that are current then.

Each model is written before its consumers are built, so the consumers read
parquet instead of recomputing lineage -- the written tables are the lineage
cut -- and a lost executor only recomputes tasks of the current write.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import json
import time
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from pathlib import Path

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from kpiloom.functions.dates import month_of
from kpiloom.functions.vocabulary import TABLES
from kpiloom.operators import certified, identity, ingest, mart, quality, serving, staging
from kpiloom.operators.ingest import absent
from kpiloom.operators.governance import (kpi_registry, model_catalog, validate_registry,
                                          warehouse_columns)
from kpiloom.operators.mart import FACT_MONTH
from kpiloom.plans import checks, parts
from kpiloom.plans.parts import LAYER_OF, PARTITION, model_path
from kpiloom.session import configure

PUBLISH_SCHEMA = "published_at timestamp_ntz, parameters string, snapshots string, models string"
RECORD_SCHEMA = "run_id string, item string, name string, value long"


KPI_INPUTS = ["dim_location", "fct_payments", "fct_appointments", "fct_membership_months", "fct_leads"]
IDENTITY_COLUMNS = ["customer_id", "master_customer_id", "email_normalized", "is_test_account"]


@dataclass
class RunReport:
    run_id: str
    loaded: dict[str, int]
    tests: DataFrame | None = None
    summary: dict = field(default_factory=dict)
    months: dict = field(default_factory=dict)         # model -> months written (None: all of it)
    published: bool = False
    seconds: dict[str, float] = field(default_factory=dict)


def model_version() -> str:
    """Digest of the sources that define the models and their tests: other logic means another published run."""
    package, h = Path(__file__).resolve().parents[1], hashlib.sha256()
    for f in sorted(p for d in ("functions", "operators", "plans") for p in (package / d).glob("*.py")):
        h.update(f.read_bytes())
    return h.hexdigest()[:16]


def latest_published_run(spark: SparkSession, root: str) -> str | None:
    """Run id of the latest publication, or None."""
    try:
        log = spark.read.schema(f"{PUBLISH_SCHEMA}, run_id string").option("basePath", f"{root}/meta/publish_log").parquet(f"{root}/meta/publish_log")
    except AnalysisException as e:
        if absent(e):
            return None
        raise
    r = log.agg(F.max_by("run_id", "published_at").alias("r")).first()
    return r["r"] if r else None


def publication(spark: SparkSession, root: str, run_id: str) -> dict:
    """What a published run was built from (parameters, raw snapshots: table -> batch id) and where its models lie."""
    row = spark.read.schema(PUBLISH_SCHEMA).parquet(f"{root}/meta/publish_log/run_id={run_id}").first()
    return {"parameters": row["parameters"], "snapshots": json.loads(row["snapshots"]), "models": json.loads(row["models"] or "{}")}


def read_published(spark: SparkSession, root: str, model: str, months: list[dt.date] | None = None) -> DataFrame:
    """A model as of the latest published run; staging models are views over the current raw tables.

    ``months`` (month starts): only these months of a fact or of the KPI table; the others' folders are not read.
    """
    if model.startswith("stg_"):
        return staging.stage_all({tb: ingest.read_raw(spark, root, tb) for tb in TABLES})[model.removeprefix("stg_")]
    run_id = latest_published_run(spark, root)
    if run_id is None:
        raise FileNotFoundError(f"nothing has been published under {root}")
    stored = "customer_identity_wide" if model == "int_customer_identity" else model
    entry = publication(spark, root, run_id)["models"].get(stored)
    df = parts.read_parts(spark, root, stored, entry) if entry else spark.read.parquet(model_path(root, run_id, stored))
    if months is not None:
        df = df.where(parts.in_months(F.col(PARTITION[model]), months))
    return df.select(*IDENTITY_COLUMNS) if model == "int_customer_identity" else df.drop(FACT_MONTH)


class _Written:
    """Models of one run, each written once and then read back from parquet; ``carried``: what the publication before has."""

    def __init__(self, spark: SparkSession, root: str, run_id: str, brands: tuple[str, ...], carried: dict | None = None):
        self.spark, self.root, self.run_id, self.brands = spark, root, run_id, brands
        self.carried = carried or {}
        self.entries: dict[str, dict] = {}                 # where the models of this run lie
        self.tables: dict[str, DataFrame] = {}
        self.observed: dict[str, int | None] = {}          # tests and totals counted while the models were written
        self.months: dict[str, list | None] = {}           # months written (None: the whole model)

    def put(self, name: str, df: DataFrame, partition: str | None = None, months: list[dt.date | None] | None = None) -> DataFrame:
        """Write a model; with ``months`` ``df`` holds its rows of these months, which take the place of those before."""
        path, partition = model_path(self.root, self.run_id, name), partition or PARTITION.get(name)
        if name in parts.DATE_OF:
            df = df.withColumn(FACT_MONTH, month_of(parts.DATE_OF[name]))
        # rows of a partition meet in few files; a partition beyond the advisory size is split
        rows = df.hint("rebalance", partition) if partition else df
        # observed on top of the plan, in the tasks that write: a task that runs again replaces its own count
        metrics = checks.observable(name, self.brands) if months is None else None
        seen = Observation(f"{self.run_id}-{name}") if metrics else None
        if seen:
            rows = rows.observe(seen, *[F.expr(sql).alias(test) for test, sql in metrics.items()])
        out = rows.write.mode("overwrite")
        (out.partitionBy(partition) if partition else out).parquet(path)
        if seen:
            self.observed.update(seen.get)
        before = self.carried[name]["parts"] if months is not None else []
        return self._use(name, {"schema": json.loads(df.schema.json()), "parts": [*before, [self.run_id, parts.to_json(months)]]}, months)

    def carry(self, name: str) -> DataFrame:
        """A model as the publication before has it."""
        return self._use(name, self.carried[name], [])

    def _use(self, name: str, entry: dict, months: list | None) -> DataFrame:
        self.entries[name], self.months[name] = entry, months
        self.tables[name] = parts.read_parts(self.spark, self.root, name, entry)
        return self.tables[name]

    def whole(self, name: str) -> bool:
        """Whether a model has to be written whole, as too many runs hold a part of it."""
        return len(self.carried[name]["parts"]) >= parts.MAX_PARTS

    def put_all(self, dfs: dict[str, tuple], parallel: int = 4) -> None:
        """Several models at once: name -> (rows, months)."""
        with ThreadPoolExecutor(max_workers=parallel) as pool:
            list(pool.map(lambda kv: self.put(kv[0], kv[1][0], months=kv[1][1]), dfs.items()))


class _Suite:
    """Attribute view over staged views and written models for the tie-outs."""

    def __init__(self, views: dict[str, DataFrame], raw: dict[str, DataFrame]):
        self.__dict__.update(views)
        self.raw = raw

    def model(self, name: str) -> DataFrame:
        return getattr(self, name)


def _build(w: _Written, stg: dict[str, DataFrame], first_month: str, last_month: str, lap) -> None:
    """Every model, from all rows."""
    # written once, read by five models; int_customer_identity is the 4-column view of it
    ident = w.put("customer_identity_wide", identity.resolve_identity(stg["customers"]))
    ids = ident.select(*IDENTITY_COLUMNS)
    # the six certified models only share the written identity: write them concurrently
    w.put_all({
        "dim_location": (certified.dim_location(stg["locations"]), None),
        "dim_customer": (certified.dim_customer(ident), None),
        **{m: (f(stg), None) for m, f in _facts(ids, first_month, last_month).items()},
    })
    lap("certified")
    w.put("kpi_location_monthly", mart.kpi_location_monthly(*[w.tables[n] for n in KPI_INPUTS], first_month, last_month))
    lap("metrics")


def _facts(ids: DataFrame, first_month: str, last_month: str) -> dict:
    """fact -> function of the staged tables."""
    return {
        "fct_appointments": lambda s: certified.fct_appointments(s["appointments"], ids, s["services"]),
        "fct_payments": lambda s: certified.fct_payments(s["payments"], ids),
        "fct_membership_months": lambda s: certified.fct_membership_months(s["memberships"], ids, first_month, last_month),
        "fct_leads": lambda s: certified.fct_leads(s["leads"], ids),
    }


STAGED_DATE = {"fct_payments": ("payments", "paid_at"), "fct_appointments": ("appointments", "scheduled_at"), "fct_leads": ("leads", "created_at")}


def _refresh(w: _Written, stg: dict[str, DataFrame], state: dict[str, ingest.TableState], since: dict[str, list], first_month: str,
             last_month: str, lap) -> None:
    """The models after some batches: only what these touch is written, from the rows of the touched months."""
    scratch = f"{w.root}/runs/{w.run_id}/refresh"

    def kept(name: str, df: DataFrame) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{scratch}/{name}")
        return w.spark.read.schema(df.schema).parquet(f"{scratch}/{name}")

    changed = staging.stage_all({tb: kept(tb, parts.changed_rows(w.spark, w.root, tb, state[tb], since[tb])) for tb in TABLES if since[tb]})
    ident, moved = w.carry("customer_identity_wide"), None
    if since["customers"]:
        old, ident = ident, w.put("customer_identity_wide", identity.resolve_identity(stg["customers"]))
        moved = kept("moved_identities", parts.changed_identities(old, ident, changed["customers"]))
        w.put("dim_customer", certified.dim_customer(ident))
    else:
        w.carry("dim_customer")
    if since["locations"]:
        w.put("dim_location", certified.dim_location(stg["locations"]))
    else:
        w.carry("dim_location")
    months = parts.months_to_write(changed, stg, moved, first_month, last_month)
    lap("touched")
    todo = {}
    for name, fact in _facts(ident.select(*IDENTITY_COLUMNS), first_month, last_month).items():
        if w.whole(name):
            todo[name] = (fact(stg), None)
        elif not months[name]:
            w.carry(name)
        elif name in STAGED_DATE:                          # rows of other months are dropped before they are joined
            table, date = STAGED_DATE[name]
            todo[name] = (fact({**stg, table: stg[table].where(parts.in_months(month_of(date), months[name]))}), months[name])
        else:
            todo[name] = (fact(stg).where(parts.in_months(F.col("month_start"), months[name])), months[name])
    w.put_all(todo)
    lap("certified")
    name, inputs = "kpi_location_monthly", [w.tables[n] for n in KPI_INPUTS]
    if w.whole(name):
        w.put(name, mart.kpi_location_monthly(*inputs, first_month, last_month))
    elif months[name]:
        w.put(name, mart.kpi_for_months(*inputs, first_month, last_month, months[name]), months=months[name])
    else:
        w.carry(name)
    lap("metrics")


def run(spark: SparkSession, sources: dict[str, DataFrame], root: str, first_month: str, last_month: str,
        brands: tuple[str, ...] = checks.FIXTURE_BRANDS, full: bool = False, run_id: str | None = None,
        publish: bool = True) -> RunReport:
    """Ingest, build, test, validate and publish one run; raises GateError before publishing if anything fails."""
    configure(spark)
    run_id = run_id or "r" + uuid.uuid4().hex[:12]
    t = time.perf_counter()
    secs: dict[str, float] = {}

    def lap(name: str) -> None:
        nonlocal t
        now = time.perf_counter()
        secs[name] = round(now - t, 3)
        t = now

    loaded = ingest.extract_load(spark, sources, root, full=full)
    lap("ingest")
    parameters = json.dumps([first_month, last_month, brands, model_version()], default=str)
    state = ingest.current_state(spark, root)
    snapshots = {tb: state[tb].version for tb in TABLES}
    last = latest_published_run(spark, root)
    before = publication(spark, root, last) if last else None
    same = publish and before is not None and not full and before["parameters"] == parameters
    if same and before["snapshots"] == snapshots:
        # the published run was built from these very snapshots and nothing else differs: it stands
        results = spark.read.parquet(f"{root}/runs/{last}/audit/test_results")
        return RunReport(last, loaded, results, quality.dq_summary(results, len(checks.MODEL_NAMES)).first().asDict(), published=True, seconds=secs)
    raw = {tb: ingest.read_state(spark, root, tb, state[tb]) for tb in TABLES}
    stg = staging.stage_all(raw)                       # views
    since = parts.deltas_since({tb: state[tb] for tb in TABLES}, before["snapshots"]) if same and before["models"] else None
    w = _Written(spark, root, run_id, brands, before["models"] if since else None)
    if since is None:
        _build(w, stg, first_month, last_month, lap)
    else:
        _refresh(w, stg, state, since, first_month, last_month, lap)
    ids = w.tables["customer_identity_wide"].select(*IDENTITY_COLUMNS)

    views = {f"stg_{k}": v for k, v in stg.items()}
    views.update({n: df.drop(FACT_MONTH) for n, df in w.tables.items()})
    views["int_customer_identity"] = ids
    # every test's outcome is kept with the run (the audit trail), then summarised
    results_path = f"{root}/runs/{run_id}/audit/test_results"
    checks.suite_results(_Suite(views, raw), brands, w.observed).coalesce(1).write.mode("overwrite").parquet(results_path)
    results = spark.read.parquet(results_path)
    summary_row = quality.dq_summary(results, len(checks.MODEL_NAMES)).first().asDict()
    lap("tests")
    report = RunReport(run_id, loaded, results, summary_row, w.months, seconds=secs)
    record = [(run_id, "rows_loaded", tb, n) for tb, n in loaded.items()]
    record += [(run_id, "summary", k, int(v)) for k, v in summary_row.items()]
    spark.createDataFrame(record, RECORD_SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"{root}/runs/{run_id}/audit/run_record")
    failing = [r["test_name"] for r in results.where("status <> 'pass'").select("test_name").sort("test_name").collect()]   # at most one per test
    quality.gate(summary_row["tests_failed"], f"data tests of run {run_id}", failing)

    errors = validate_registry(kpi_registry(spark), model_catalog(spark),
                               warehouse_columns(spark, {**views}))
    named = [" ".join(str(x) for x in r if x is not None) for r in errors.collect()]        # at most a few per KPI
    quality.gate(len(named), "KPI registry", named)
    lap("registry")
    if publish:
        row = (dt.datetime.now(dt.timezone.utc).replace(tzinfo=None), parameters, json.dumps(snapshots, sort_keys=True), json.dumps(w.entries))
        spark.createDataFrame([row], PUBLISH_SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"{root}/meta/publish_log/run_id={run_id}")
        report.published = True
    lap("publish")
    return report


def layer_counts(spark: SparkSession, root: str) -> DataFrame:
    """H9 over the published warehouse: raw tables and published models."""
    tables = {("raw", f"crm_{tb}"): ingest.read_raw(spark, root, tb) for tb in TABLES}
    for name, layer in LAYER_OF.items():
        if layer in ("certified", "metrics"):
            tables[(layer, name)] = read_published(spark, root, name)
    return serving.layer_row_counts(tables)


def report(spark: SparkSession, root: str, parallel: int = 4) -> dict[str, str]:
    """Step 5: the dashboard's data, written from the published KPI table only.

    Writes under ``<root>/runs/<run_id>/serving/``: the report extract, the
    monthly rollup (per brand and 'All'), month-over-month cards, the
    leaderboard, the brand preview, the KPI documentation table and the
    layer row counts. Returns name -> path.
    """
    from kpiloom.operators.governance import kpi_docs

    run_id = latest_published_run(spark, root)
    if run_id is None:
        raise FileNotFoundError(f"nothing has been published under {root}")
    kpi = read_published(spark, root, "kpi_location_monthly")
    rollup = serving.monthly_rollup(kpi)
    outputs = {
        "report_extract": serving.report_extract(kpi),
        "monthly_rollup": rollup,
        "mom_cards": serving.mom_cards(rollup),
        "leaderboard": serving.leaderboard(kpi),
        "brand_monthly": serving.brand_monthly(kpi),
        "kpi_docs": kpi_docs(kpi_registry(spark)),
        "layer_row_counts": layer_counts(spark, root),
    }
    base = f"{root}/runs/{run_id}/serving"

    def write(item):
        name, df = item
        df.write.mode("overwrite").parquet(f"{base}/{name}")
        return name, f"{base}/{name}"

    with ThreadPoolExecutor(max_workers=parallel) as pool:
        return dict(pool.map(write, outputs.items()))
