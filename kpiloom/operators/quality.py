"""Data-quality checks.

Generic column tests (F1-F5) return the failing rows: empty means pass.
Cross-layer tie-outs (F6-F10) return one row with both totals and a null-safe
``passes`` flag, so the result is never empty. :func:`run_suite` turns test
specs into one DataFrame of failure counts: generic checks, key checks and
the totals that tie-outs compare are evaluated in a single pass -- one scan
per model and one aggregation of what they report for the whole suite.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kpiloom.functions.cleaning import is_test_account, to_cents, try_to_cents
from kpiloom.functions.vocabulary import TEST_EMAIL_SUFFIX, TEST_FIRST_NAME, VOID_STATUS
from kpiloom.operators.joins import left_join_spread_nulls


# --- F1-F5: generic tests, failing rows ---------------------------------------
def dq_not_null(df: DataFrame, col: str) -> DataFrame:
    """rows where ``col`` is null."""
    return df.where(F.col(col).isNull())


def dq_unique(df: DataFrame, col: str) -> DataFrame:
    """Values that occur more than once (nulls ignored). Aggregated map-side."""
    return (df.where(F.col(col).isNotNull()).groupBy(col)
            .agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1))


def dq_accepted_values(df: DataFrame, col: str, values: list) -> DataFrame:
    """Rows whose value is not in ``values`` (null passes)."""
    return df.where(~F.col(col).isin(values))


def dq_relationships(child: DataFrame, col: str, parent: DataFrame, field_: str) -> DataFrame:
    """Child rows whose non-null ``col`` has no ``field_`` in the parent (anti join)."""
    keys = parent.select(F.col(field_).alias("__parent_key")).where(F.col("__parent_key").isNotNull())
    return (child.where(F.col(col).isNotNull())
            .join(keys, F.col(col) == F.col("__parent_key"), "left_anti"))


def dq_unique_combo(df: DataFrame, cols: list[str]) -> DataFrame:
    """Combinations of ``cols`` that occur more than once (nulls group together)."""
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


# --- F6-F10: cross-layer tie-outs ----------------------------------------------
def _passes(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b).alias("passes")


def dq_duplicates_merged(identity: DataFrame) -> DataFrame:
    """Each non-test e-mail has exactly one master id (``identity`` holds e-mail, flag and master of every record)."""
    per_email = (identity.where(F.col("email_normalized").isNotNull() & ~F.col("is_test_account"))
                 .groupBy("email_normalized").agg(F.min("master_customer_id").alias("lo"), F.max("master_customer_id").alias("hi")))
    return per_email.agg(
        F.count(F.lit(1)).alias("emails_checked"),
        F.count_if(F.col("lo") != F.col("hi")).alias("emails_with_several_masters"),
    ).select("*", _passes(F.col("emails_with_several_masters"), F.lit(0).cast("bigint")))


def dq_customer_reconcile(stg_customers: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """Non-test source records = sum of merged records in the dimension."""
    src = stg_customers.agg(F.count_if(~F.col("is_test_account")).alias("source_records"))
    cert = dim_customer.agg(F.sum("source_records_merged").cast("bigint").alias("certified_records"))
    return _side_by_side(src, cert, "source_records", "certified_records")


def dq_kpi_vs_ledger(kpi: DataFrame, fct_payments: DataFrame) -> DataFrame:
    """Every ledger cent is reachable from the KPI table (cents summed as integers)."""
    k = kpi.agg(F.sum(F.round(F.col("net_revenue") * 100, 0).cast("bigint")).alias("kpi_cents"))
    led = fct_payments.agg(F.sum("amount_cents").alias("ledger_cents"))
    return _side_by_side(k, led, "kpi_cents", "ledger_cents")


def dq_no_test_accounts(fct_payments: DataFrame, stg_customers: DataFrame) -> DataFrame:
    """Certified payments whose (master) customer id is a test record; the payments are read once."""
    tests = stg_customers.where(F.col("is_test_account")).select(F.col("customer_id").alias("__cid")).distinct()
    out = fct_payments.select("customer_id").join(tests, F.col("customer_id") == F.col("__cid"), "left").agg(
        F.count(F.lit(1)).alias("payments_checked"), F.count("__cid").alias("test_account_payments"))
    return out.select("payments_checked", "test_account_payments",
                      _passes(F.col("test_account_payments"), F.lit(0).cast("bigint")))


def raw_source_cents(raw_payments: DataFrame, raw_customers: DataFrame, void_status: str = VOID_STATUS,
                     test_suffix: str = TEST_EMAIL_SUFFIX, test_first_name: str = TEST_FIRST_NAME) -> DataFrame:
    """Net cents recomputed independently from the raw text (one row: ``source_cents``).

    Deliberately does not reuse staging: raw amount text, raw status, raw
    customer test rule, joined on the raw customer id text.
    """
    cust = (raw_customers.where(~is_test_account("email", "first_name", test_suffix, test_first_name))
            .select(F.col("customer_id").alias("__cid")))
    return (raw_payments.where(F.col("payment_status") != F.lit(void_status))
            .join(cust, F.col("customer_id") == F.col("__cid"))
            .agg(F.sum(to_cents("amount")).alias("source_cents")))


def dq_revenue_vs_source(raw_payments: DataFrame, raw_customers: DataFrame, fct_payments: DataFrame,
                         void_status: str = VOID_STATUS, test_suffix: str = TEST_EMAIL_SUFFIX,
                         test_first_name: str = TEST_FIRST_NAME) -> DataFrame:
    """Certified revenue against the raw-text recomputation (:func:`raw_source_cents`)."""
    src = raw_source_cents(raw_payments, raw_customers, void_status, test_suffix, test_first_name)
    cert = fct_payments.agg(F.sum("amount_cents").alias("certified_cents"))
    return _side_by_side(src, cert, "source_cents", "certified_cents")


def _side_by_side(a: DataFrame, b: DataFrame, ca: str, cb: str) -> DataFrame:
    """Two one-row aggregates as one row, without a join: union, then re-aggregate."""
    ta, tb = a.schema[ca].dataType, b.schema[cb].dataType
    u = a.select(F.col(ca), F.lit(None).cast(tb).alias(cb)).unionByName(
        b.select(F.lit(None).cast(ta).alias(ca), F.col(cb)))
    return u.agg(F.max(ca).alias(ca), F.max(cb).alias(cb)).select(ca, cb, _passes(F.col(ca), F.col(cb)))


# --- T9: amounts that would not parse ----------------------------------------
def unparseable_amounts(raw_payments: DataFrame, col: str = "amount") -> DataFrame:
    """Raw payments whose amount text is not a number after removing '$' and ','.

    Staging raises on such text (it must never silently become null, or the
    revenue tie-out would be blind to it); this lists the offenders first.
    """
    return raw_payments.where(F.col(col).isNotNull() & try_to_cents(col).isNull())


# --- T8: why rows leave the ledger -----------------------------------------------
def ledger_exclusions(stg_payments: DataFrame, identity: DataFrame) -> DataFrame:
    """Counts of staged payments by the reason they are not in the ledger.

    ``void_status_null`` rows are silently dropped by ``not is_void``; the
    other reasons are by design. One pass over payments plus the identity join.
    """
    ids = identity.select(F.col("customer_id").alias("__cid"), "is_test_account",
                          F.lit(True).alias("__known"))
    j = left_join_spread_nulls(stg_payments, ids, "customer_id", "__cid", "payment_id")
    reason = (F.when(F.col("is_void").isNull(), F.lit("void_status_null"))
              .when(F.col("is_void"), F.lit("void"))
              .when(F.col("__known").isNull(), F.lit("unknown_customer"))
              .when(F.col("is_test_account"), F.lit("test_account"))
              .otherwise(F.lit("in_ledger")))
    return j.groupBy(reason.alias("reason")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("amount_cents").alias("amount_cents"))


# --- F11: suites and summary -------------------------------------------------------
@dataclass(frozen=True)
class Check:
    """One data test: ``kind`` in not_null, unique, accepted_values, relationships, unique_combo,
    absent_from (the child value must NOT occur among the parent rows selected by ``parent_where``, a SQL condition)."""
    model: str
    kind: str
    columns: tuple[str, ...]
    values: tuple = ()
    parent: str | None = None
    parent_field: str | None = None
    name: str = field(default="")
    parent_where: str | None = None                       # absent_from: which parent rows count
    report_as: tuple[str, str] | None = None              # (model, kind) shown in the results

    @property
    def test_name(self) -> str:
        if self.name:
            return self.name
        return f"{self.kind}_{self.model}_{'__'.join(self.columns)}"


@dataclass(frozen=True)
class Total:
    """A named total over one model, computed in the suite's single pass.

    ``expr`` is the SQL of the per-row value to sum. ``empty_as_zero`` gives count
    semantics (0 over no rows) instead of sum semantics (null over no rows).
    """
    name: str
    model: str
    expr: str
    empty_as_zero: bool = False


@dataclass(frozen=True)
class TieOut:
    """A tie-out that compares two totals null-safely: one failure unless equal."""
    name: str
    a: str
    b: str


ROW_LOCAL = ("not_null", "accepted_values")


def _row_local(c: Check) -> str:
    """Number of rows that fail a test which looks at one row only."""
    col = f"`{c.columns[0]}`"
    bad = f"{col} IS NULL" if c.kind == "not_null" else f"{col} NOT IN ({', '.join(_quoted(v) for v in c.values)})"
    return f"count_if({bad})"


def observable(model: str, checks: list[Check], totals: list[Total]) -> dict[str, str]:
    """Test or total -> SQL aggregate: what can be counted by ``DataFrame.observe`` while the model is written."""
    out = {c.test_name: _row_local(c) for c in checks if c.model == model and c.kind in ROW_LOCAL}
    return out | {t.name: f"sum(CAST({t.expr} AS BIGINT))" for t in totals if t.model == model}


INTEGRAL = {"tinyint", "smallint", "int", "bigint"}


def _quoted(v) -> str:
    return "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"


class _Pass:
    """The one statement that measures a model for all checks and totals that touch it."""

    def __init__(self, name: str, key_type: str):
        self.name, self.key_type = name, key_type
        self.columns: list[str] = []               # key columns of all sets, in order
        self.sets: list[tuple[str, ...]] = []
        self.measures: list[str] = []              # aggregates, named m0, m1, ...
        self.records: list[tuple[tuple[str, ...], str, str]] = []

    def measure(self, aggregate: str) -> str:
        self.measures.append(aggregate)
        return f"m{len(self.measures) - 1}"

    def record(self, keys: tuple[str, ...], test: str, when: str, **values: str) -> None:
        """Emit a record for each group of a key set (the empty one: all rows) where ``when`` holds."""
        if keys not in self.sets:
            self.sets.append(keys)
            self.columns += [k for k in keys if k not in self.columns]
        v = {"key": "NULL", "fail": "0", "child": "0", "parent": "0", "total": "NULL", **values}
        v["key"] = f"CAST({v['key']} AS {self.key_type})"
        fields = ", ".join(f"'{k}', " + (v[k] if k == "key" else f"CAST({v[k]} AS BIGINT)") for k in ("key", "fail", "child", "parent", "total"))
        self.records.append((keys, when, f"named_struct('test', {_quoted(test)}, {fields})"))

    def key(self, column: str) -> str:
        return f"k{self.columns.index(column)}"

    def add(self, c: Check, observed: bool = False) -> None:
        if c.model == self.name:
            if c.kind in ROW_LOCAL:
                if not observed:
                    self.record((), c.test_name, "true", fail=self.measure(_row_local(c)))
            elif c.kind in ("unique", "unique_combo"):
                some = f"{{{c.columns[0]}}} IS NOT NULL" if c.kind == "unique" else "true"
                self.record(c.columns, c.test_name, f"n > 1 AND {some}", fail="1")
            elif c.kind in ("relationships", "absent_from"):
                k = f"{{{c.columns[0]}}}"
                self.record(c.columns, c.test_name, f"{k} IS NOT NULL", key=k, child="n")
            else:
                raise ValueError(f"unknown check kind {c.kind}")
        if c.kind in ("relationships", "absent_from") and c.parent == self.name:
            k = f"{{{c.parent_field}}}"
            where = f" AND coalesce({self.measure(f'bool_or({c.parent_where})')}, false)" if c.parent_where else ""
            self.record((c.parent_field,), c.test_name, f"{k} IS NOT NULL{where}", key=k, parent="1")

    def sql(self) -> str:
        """Groups by all key sets at once (one scan, typed keys), then a record where a group has something to report."""
        all_of = (1 << len(self.columns)) - 1

        def group(keys: tuple[str, ...]) -> int:
            """grouping_id of a set: a bit for each column that it leaves out."""
            return sum(1 << (len(self.columns) - 1 - i) for i, c in enumerate(self.columns) if c not in keys) if keys else all_of

        names = {c: self.key(c) for c in self.columns}
        emit = ", ".join(f"IF(g = {group(keys)} AND {when.format(**names)}, {struct.format(**names)}, NULL)" for keys, when, struct in self.records)
        aggregates = ", ".join(["count(*) AS n", *[f"{m} AS m{i}" for i, m in enumerate(self.measures)]])
        if not self.columns:
            return f"SELECT inline(array_compact(array({emit}))) FROM (SELECT 0 AS g, {aggregates} FROM {{model}})"
        keys = ", ".join(names.values())
        sets = ", ".join("(" + ", ".join(names[c] for c in s) + ")" for s in self.sets)
        renamed = ", ".join(f"`{c}` AS {k}" for c, k in names.items())
        return (f"SELECT inline(array_compact(array({emit}))) FROM (SELECT grouping_id() AS g, {keys}, {aggregates} "
                f"FROM (SELECT *, {renamed} FROM {{model}}) GROUP BY {keys} GROUPING SETS ({sets}))")


def _spread(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows dealt by all tested columns before they are aggregated by some of them.

    Keys are mostly distinct, so the map side of an aggregate holds nearly every row of its task; a task that reads a
    whole file, or explodes its rows, would hold them all. Dealt rows come in partitions of the advisory size. By all columns
    at once, so that only equal rows meet, which the map side combines.
    """
    return df.repartition(*[F.col(f"`{c}`") for c in columns]) if columns else df


def run_suite(models: dict[str, DataFrame], checks: list[Check],
              singular: dict[str, DataFrame] | None = None, totals: list[Total] | None = None,
              ties: list[TieOut] | None = None, external: dict[str, DataFrame] | None = None,
              observed: dict[str, int | None] | None = None) -> DataFrame:
    """DataFrame(test_name, model, kind, failures, status) for all checks.

    Rows are dealt over partitions of bounded size before they are aggregated (:func:`_spread`). ``observed``: test or total -> value, of those that were counted while their
    model was written (:func:`observable`); they cost no scan here. One scan per model: its rows are grouped by all keys that are tested at once
    (grouping sets, keys in their own types), the empty set among them, in which
    the row-local tests and the totals are plain aggregates that collapse before the
    shuffle. A group reports only what counts: a repeated key, a child key with
    its rows, a parent key, or the model's totals. These few records meet in one
    ``groupBy(test, key)``, which gives orphans and totals. Hot keys are combined
    map-side throughout. ``ties`` compare two totals in the same final aggregation
    (no second scan of the models they read); ``external`` adds one-row totals
    computed elsewhere (e.g. from raw data) to compare against. Tie-outs in
    ``singular`` count as one failure when their ``passes`` flag is not true.
    """
    totals, ties, observed = totals or [], ties or [], observed or {}
    names = sorted({c.model for c in checks} | {c.parent for c in checks if c.parent} | {t.model for t in totals})
    linked = [c for c in checks if c.kind in ("relationships", "absent_from")]
    kinds = {dict(models[m].dtypes)[f] for c in linked for m, f in ((c.model, c.columns[0]), (c.parent, c.parent_field))}
    key_type = "BIGINT" if kinds <= INTEGRAL else "STRING"
    emitted = None
    for name in names:
        p = _Pass(name, key_type)
        for c in checks:
            p.add(c, c.test_name in observed)
        for t in totals:
            if t.model == name and t.name not in observed:
                p.record((), t.name, "true", total=p.measure(f"sum(CAST({t.expr} AS BIGINT))"))
        if p.records:
            spark = models[name].sparkSession
            part = spark.sql(p.sql(), model=_spread(models[name], p.columns))
            emitted = part if emitted is None else emitted.unionByName(part)
    per_key = emitted.groupBy("test", "key").agg(F.sum("fail").alias("fail"), F.sum("child").alias("child"), F.max("parent").alias("parent"), F.sum("total").alias("total"))
    per_test = per_key.groupBy(F.col("test").alias("check")).agg(
        F.sum("fail").alias("fail"),
        F.sum(F.when(F.col("parent") == 0, F.col("child"))).alias("orphans"),
        F.sum(F.when(F.col("parent") > 0, F.col("child"))).alias("matched"),
        F.sum("total").alias("total"))
    for name, one_row in (external or {}).items():
        # a one-row total computed elsewhere (e.g. from raw data), compared like the others
        per_test = per_test.unionByName(one_row.select(
            F.lit(name).alias("check"), *[F.lit(None).cast("long").alias(c) for c in ["fail", "orphans", "matched"]],
            F.col(one_row.columns[0]).cast("long").alias("total")))
    spark = emitted.sparkSession
    if observed:
        sums = {t.name for t in totals}
        counted = [(k, None if k in sums else v, None, None, v if k in sums else None) for k, v in observed.items()]
        per_test = per_test.unionByName(spark.createDataFrame(counted, "check string, fail long, orphans long, matched long, total long"))
    zero_totals = {t.name for t in totals if t.empty_as_zero}
    spec_rows = [(c.test_name, c.test_name, *(c.report_as or (c.model, c.kind)), None, False, c.kind) for c in checks]
    for t in ties:
        spec_rows += [(t.a, t.name, "singular", "tie_out", "a", t.a in zero_totals, "tie"),
                      (t.b, t.name, "singular", "tie_out", "b", t.b in zero_totals, "tie")]
    specs = spark.createDataFrame(spec_rows, "check string, test_name string, model string, kind string, "
                                             "side string, empty_as_zero boolean, counts string")
    j = specs.join(per_test, "check", "left")
    total = F.when(F.col("empty_as_zero"), F.coalesce(F.col("total"), F.lit(0).cast("long"))).otherwise(F.col("total"))
    raw = F.when(F.col("counts") == "relationships", F.col("orphans")).when(F.col("counts") == "absent_from", F.col("matched")).otherwise(F.col("fail"))
    g = j.groupBy("test_name", "model", "kind").agg(
        F.max(raw).alias("__raw"), F.max(F.col("counts") == "tie").alias("__tie"),
        F.max(F.when(F.col("side") == "a", total)).alias("__a"),
        F.max(F.when(F.col("side") == "b", total)).alias("__b"))
    failures = F.when(F.col("__tie"), F.when(F.col("__a").eqNullSafe(F.col("__b")), F.lit(0)).otherwise(F.lit(1))) \
        .otherwise(F.coalesce(F.col("__raw"), F.lit(0)))
    out = g.select("test_name", "model", "kind", failures.cast("bigint").alias("failures"))
    for name, df in (singular or {}).items():
        out = out.unionByName(df.agg(F.count_if(~F.coalesce(F.col("passes"), F.lit(False))).alias("failures"))
                              .select(F.lit(name).alias("test_name"), F.lit("singular").alias("model"),
                                      F.lit("tie_out").alias("kind"), "failures"))
    return out.withColumn("status", F.when(F.col("failures") == 0, F.lit("pass")).otherwise(F.lit("fail")))


def failing_keys(models: dict[str, DataFrame], checks: list[Check], primary: dict[str, tuple[str, ...]], k: int = 5) -> DataFrame:
    """(test_name, position, failing_key, n_rows): the ``k`` smallest failing keys of every check, as text.

    The key of a failing row is its model's primary key; of a uniqueness test the repeated value; of a relationship the
    value without a parent. One scan per model, its rows dealt over partitions of bounded size (:func:`_spread`), emits the failing rows' and the tested keys, which are counted once per key; the
    ``k`` smallest of a check are taken by a ranked limit that Spark applies before it shuffles, so a test that
    fails on a billion rows still sends ``k`` rows a task.
    """
    parts = []
    for name in sorted({c.model for c in checks} | {c.parent for c in checks if c.parent}):
        text = lambda cols: F.concat_ws("|", *[F.col(x).cast("string") for x in cols])
        out, tested = [], []
        for c in checks:
            col = F.col(c.columns[0])
            if c.model == name:
                tested += c.columns if c.kind not in ROW_LOCAL else primary[name]
                if c.kind == "not_null":
                    out.append((c, text(primary[name]), 2, col.isNull()))
                elif c.kind == "accepted_values":
                    out.append((c, text(primary[name]), 2, col.isNotNull() & ~col.isin(list(c.values))))
                elif c.kind in ("unique", "unique_combo"):
                    out.append((c, text(c.columns), 0, col.isNotNull() if c.kind == "unique" else F.lit(True)))
                else:
                    out.append((c, text(c.columns), 1, col.isNotNull()))
            if c.parent == name:
                tested.append(c.parent_field)
                out.append((c, text([c.parent_field]), -1, F.col(c.parent_field).isNotNull()))
        if out:
            # role: 0 tested for repeats, 1 child, 2 failing row, -1 parent
            records = F.array_compact(F.array(*[F.when(keep, F.struct(F.lit(c.test_name).alias("test_name"), key.alias("failing_key"),
                                                                   F.lit(role).alias("role"))) for c, key, role, keep in out]))
            parts.append(_spread(models[name], list(dict.fromkeys(tested))).select(F.explode(records).alias("r")).select("r.*"))
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    per_key = rows.groupBy("test_name", "failing_key").agg(F.count_if(F.col("role") >= 0).alias("n_rows"), F.max("role").alias("kind"), F.min("role").alias("parent"))
    bad = per_key.where((F.col("kind") == 2) | ((F.col("kind") == 0) & (F.col("n_rows") > 1)) | ((F.col("kind") == 1) & (F.col("parent") == 1)))
    place = F.row_number().over(Window.partitionBy("test_name").orderBy("failing_key"))
    return bad.withColumn("position", place).where(F.col("position") <= k).select("test_name", F.col("position").cast("bigint").alias("position"), "failing_key", "n_rows")


def dq_summary(results: DataFrame, models_built: int) -> DataFrame:
    """Models built, tests passed, tests failed (anything not 'pass' counts as failed)."""
    return results.agg(
        F.lit(models_built).cast("bigint").alias("models_built"),
        F.count_if(F.col("status") == "pass").alias("tests_passed"),
        F.count_if(F.col("status") != "pass").alias("tests_failed"),
    )


class GateError(RuntimeError):
    """A failed data test or registry error stops publication."""


def gate(failures: int, what: str, names: list[str] | None = None) -> None:
    """Stop the run (raise :class:`GateError`) when anything failed, naming what did."""
    if failures:
        listed = f" ({', '.join(names)})" if names else ""
        raise GateError(f"{what}: {failures} failing{listed}; nothing was published")
