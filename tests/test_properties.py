"""Property tests: generated cases checked against plain-Python models.

Each example is a whole list of cases in one DataFrame, so an example costs
one Spark job.
"""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kpiloom.functions.cleaning import to_cents, tolerant_int
from kpiloom.operators.ingest import upsert

SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))


def money_text(cents: int, dollar: bool, commas: bool, pad: bool) -> str:
    sign = "-" if cents < 0 else ""
    d, c = divmod(abs(cents), 100)
    digits = f"{d:,}" if commas else str(d)
    body = f"{sign}{digits}.{c:02d}"
    text = f"${body}" if dollar else body
    return f"  {text} " if pad else text


@SETTINGS
@given(st.lists(st.tuples(st.integers(-10**11, 10**11), st.booleans(), st.booleans(), st.booleans()),
                min_size=1, max_size=200))
def test_to_cents_round_trip(spark, cases):
    rows = [(money_text(*c), c[0]) for c in cases]
    df = spark.createDataFrame(rows, "amount string, expected long")
    bad = df.where(to_cents("amount") != df.expected).count()
    assert bad == 0


@SETTINGS
@given(st.lists(st.tuples(st.integers(-2**31 + 1, 2**31 - 2), st.sampled_from(["{}", "{}.0", " {} ", "{}.00"])),
                min_size=1, max_size=200))
def test_tolerant_int(spark, cases):
    rows = [(fmt.format(i), i) for i, fmt in cases]
    df = spark.createDataFrame(rows, "x string, expected int")
    assert df.where(tolerant_int("x") != df.expected).count() == 0


@SETTINGS
@given(st.dictionaries(st.integers(0, 50), st.integers(0, 9), max_size=30),
       st.dictionaries(st.integers(0, 50), st.integers(10, 19), max_size=30))
def test_upsert_matches_delete_then_insert(spark, target, batch):
    schema = "k int, v int"
    t = spark.createDataFrame(sorted(target.items()), schema)
    b = spark.createDataFrame(sorted(batch.items()), schema)
    got = sorted(tuple(r) for r in upsert(t, b, "k").collect())
    expected = sorted({**target, **batch}.items())
    assert got == expected


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 10_000), st.one_of(st.none(), st.sampled_from(["a", "b", "c", "d"]))),
                min_size=1, max_size=60, unique_by=lambda t: t[0]))
def test_identity_matches_brute_force(spark, records):
    import datetime as dt

    from kpiloom.operators.identity import int_customer_identity
    schema = ("customer_id int, first_name string, last_name string, email_normalized string, "
              "home_location_id int, created_at timestamp_ntz, is_test_account boolean")
    ts = dt.datetime(2025, 1, 1)
    df = spark.createDataFrame([(i, "F", "L", e, 1, ts, False) for i, e in records], schema)
    got = {r.customer_id: r.master_customer_id for r in int_customer_identity(df).collect()}
    first = {}
    for i, e in records:
        if e is not None:
            first[e] = min(first.get(e, i), i)
    expected = {i: (i if e is None else first[e]) for i, e in records}
    assert got == expected


@SETTINGS
@given(st.lists(st.tuples(st.dates(min_value=__import__("datetime").date(2024, 6, 1),
                                   max_value=__import__("datetime").date(2026, 12, 31)),
                          st.one_of(st.none(), st.integers(-40, 700))), min_size=1, max_size=40))
def test_membership_months_match_brute_force(spark, rows):
    import datetime as dt
    from decimal import Decimal

    from kpiloom.operators.certified import fct_membership_months
    lo, hi = dt.date(2025, 1, 1), dt.date(2026, 6, 1)
    mems = [(i, 1, 1, "Core", Decimal("199.00"), s, None if d is None else s + dt.timedelta(days=d))
            for i, (s, d) in enumerate(rows)]
    df = spark.createDataFrame(mems, "membership_id int, customer_id int, location_id int, plan_name string, "
                                     "monthly_fee decimal(10,2), start_date date, end_date date")
    ids = spark.createDataFrame([(1, 1, None, False)], "customer_id int, master_customer_id int, "
                                                       "email_normalized string, is_test_account boolean")
    got = sorted((r.membership_id, r.month_start, r.is_new, r.is_churned)
                 for r in fct_membership_months(df, ids, lo, hi).collect())

    def month(d):
        return dt.date(d.year, d.month, 1)

    def months(a, b):
        out = []
        while a <= b:
            out.append(a)
            a = dt.date(a.year + (a.month == 12), a.month % 12 + 1, 1)
        return out

    expected = []
    for i, _, _, _, _, s, e in mems:
        sm, em = month(s), (month(e) if e else None)
        for m in months(lo, hi):                     # the axis, as the SQL definition joins it
            if m >= sm and (e is None or m <= em):
                expected.append((i, m, sm == m, em == m if em else False))
    assert got == sorted(expected)


@SETTINGS
@given(st.lists(st.tuples(st.dates(min_value=__import__("datetime").date(2024, 1, 1),
                                   max_value=__import__("datetime").date(2026, 12, 31)),
                          st.one_of(st.none(), st.integers(0, 600)),
                          st.lists(st.dates(min_value=__import__("datetime").date(2023, 6, 1),
                                            max_value=__import__("datetime").date(2027, 6, 30)), max_size=4)),
                min_size=1, max_size=12))
def test_spines_match_the_definition(spark, locs):
    import datetime as dt

    from kpiloom.operators import mart
    lo, hi = dt.date(2025, 1, 1), dt.date(2026, 6, 1)

    def month(d):
        return dt.date(d.year, d.month, 1)

    rows, pays = [], []
    for i, (opened, close_after, paid) in enumerate(locs):
        closed = None if close_after is None else opened + dt.timedelta(days=close_after)
        rows.append((i, f"L{i}", "C", "A B", "corporate", None, opened, closed, closed is None))
        pays += [(i, month(p)) for p in paid]
    dim = spark.createDataFrame(rows, "location_id int, location_name string, city string, brand string, "
                                      "ownership string, franchisee_id string, opened_on date, closed_on date, "
                                      "is_active boolean")
    rev = spark.createDataFrame(pays, "location_id int, month_start date").groupBy("location_id", "month_start") \
        .count().selectExpr("location_id", "month_start", "count as net_revenue_cents",
                            "0L as membership_revenue_cents", "count as service_revenue_cents")
    last = mart.last_activity_from_revenue(rev)
    plain = sorted((r.location_id, r.month_start) for r in
                   mart.location_month_spine(dim, last, lo, hi).collect())
    one_pass = sorted((r.location_id, r.month_start) for r in mart.spine_with_revenue(dim, rev, lo, hi).collect())
    expected = []
    for i, (opened, close_after, paid) in enumerate(locs):
        closed = None if close_after is None else opened + dt.timedelta(days=close_after)
        last_paid = max((month(p) for p in paid), default=None)
        m = lo
        while m <= hi:
            end = None if closed is None else max(x for x in [month(closed), last_paid] if x is not None)
            if m >= month(opened) and (closed is None or m <= end):
                expected.append((i, m))
            m = dt.date(m.year + (m.month == 12), m.month % 12 + 1, 1)
    assert plain == sorted(expected)
    assert one_pass == sorted(expected)


@SETTINGS
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 8)), st.one_of(st.none(), st.sampled_from("xyz"))),
                min_size=1, max_size=50),
       st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 8)), st.booleans()), min_size=1, max_size=20))
def test_single_pass_suite_matches_the_standalone_checks(spark, child_rows, parent_rows):
    from pyspark.sql import functions as F

    from kpiloom.operators import quality as q
    from kpiloom.operators.quality import Check
    child = spark.createDataFrame(child_rows, "k int, v string")
    parent = spark.createDataFrame(parent_rows, "k int, flag boolean")
    checks = [Check("child", "not_null", ("k",)), Check("child", "unique", ("k",)),
              Check("child", "accepted_values", ("v",), ("x", "y")),
              Check("child", "relationships", ("k",), parent="parent", parent_field="k"),
              Check("child", "unique_combo", ("k", "v")),
              Check("child", "absent_from", ("k",), parent="parent", parent_field="k", name="absent",
                    parent_where="flag")]
    got = {r.test_name: r.failures for r in q.run_suite({"child": child, "parent": parent}, checks).collect()}
    flagged = {k for k, f in parent_rows if f and k is not None}
    expected = {
        checks[0].test_name: q.dq_not_null(child, "k").count(),
        checks[1].test_name: q.dq_unique(child, "k").count(),
        checks[2].test_name: q.dq_accepted_values(child, "v", ["x", "y"]).count(),
        checks[3].test_name: q.dq_relationships(child, "k", parent, "k").count(),
        checks[4].test_name: q.dq_unique_combo(child, ["k", "v"]).count(),
        "absent": sum(1 for k, _ in child_rows if k is not None and k in flagged),
    }
    assert got == expected


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 100_000), st.integers(1, 100_000)), min_size=1, max_size=200))
def test_ratio_rounding_equals_the_sql_engine(spark, pairs):
    import duckdb

    from kpiloom.functions.numeric import ratio
    df = spark.createDataFrame(pairs, "n long, d long")
    got = [(r.a, r.b) for r in df.select(ratio("n", "d", 4).alias("a"),
                                         ratio(_cents_amount("n"), "d", 2).alias("b")).collect()]
    con = duckdb.connect()
    con.register("t", __import__("pandas").DataFrame(pairs, columns=["n", "d"]))
    want = [tuple(r) for r in con.execute("SELECT round(n / d, 4), round(n / 100.0 / d, 2) FROM t").fetchall()]
    assert got == want


def _cents_amount(c):
    from kpiloom.functions.numeric import cents_to_amount
    return cents_to_amount(c)


@pytest.mark.parametrize("seed", [1, 2])
def test_refreshing_touched_months_equals_a_full_rebuild(spark, seed):
    """Payments, appointments, memberships, leads and customers changed or added at random: only the touched months are
    recomputed, and the KPI table equals one built from all rows."""
    from kpiloom.functions.vocabulary import TABLES
    from kpiloom.operators import ingest, mart, staging
    from kpiloom.plans.models import Models
    from kpiloom.sources.crm import raw_tables

    raw = raw_tables(spark, "/root/testdata/sf0.001")
    pick = lambda t, n, k=0: F.pmod(F.xxhash64(TABLES[t], F.lit(seed)), F.lit(n)) == k
    moved = lambda c: F.concat(F.lit("1999-0"), (1 + F.pmod(F.xxhash64(c, F.lit(seed)), F.lit(9))).cast("string"), F.lit("-11 10:00:00"))
    delta = {
        "payments": raw["payments"].where(pick("payments", 150)).withColumns({
            "amount": F.lit("77.70"), "paid_at": moved("payment_id"), "location_id": F.when(F.col("payment_id").cast("int") % 2 == 0, "7").otherwise(F.col("location_id"))}),
        "appointments": raw["appointments"].where(pick("appointments", 200)).withColumn("status", F.lit("No Show")),
        "memberships": raw["memberships"].where(pick("memberships", 40)).withColumn("end_date", F.lit("1998-02-03")),
        "leads": raw["leads"].where(pick("leads", 100)).withColumn("created_at", moved("lead_id")),
        "customers": raw["customers"].where(pick("customers", 60)).withColumn("first_name", F.lit("Test")),
        "services": raw["services"].limit(0), "locations": raw["locations"].limit(0),
    }
    after = {t: ingest.merge_deltas(raw[t], [(delta[t], ingest.EXTRACT)], TABLES[t]) for t in TABLES}
    changed = {t: delta[t].unionByName(raw[t].join(delta[t].select(TABLES[t]).distinct(), TABLES[t], "left_semi")) for t in TABLES}
    a, b = Models(spark, raw), Models(spark, after)
    axis = (b.first_month, b.last_month)
    months = mart.touched_months(staging.stage_all(changed), {t: b.model(f"stg_{t}") for t in TABLES}, *axis)
    months = [r.month_start for r in months.collect()]
    assert 0 < len(months) < 84
    again = mart.kpi_for_months(b.dim_location, b.fct_payments, b.fct_appointments, b.fct_membership_months, b.fct_leads, *axis, months)
    got = mart.refresh_months(a.kpi_location_monthly, again, months)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, b.kpi_location_monthly.collect()), key=str)
    assert sorted(map(tuple, a.kpi_location_monthly.collect()), key=str) != sorted(map(tuple, got.collect()), key=str)
