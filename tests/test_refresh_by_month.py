"""Published facts by month: a run after a batch writes only the months it touches, and readers see what a full rebuild gives."""

import datetime as dt
import glob

import pytest
from pyspark.sql import functions as F

from kpiloom.functions.vocabulary import TABLES
from kpiloom.operators import ingest, quality as q
from kpiloom.plans import parts, pipeline
from kpiloom.plans.models import Models
from kpiloom.sources.crm import FIXTURE_MONTHS, raw_tables
from conftest import SF_SMALL

BY_MONTH = ["fct_payments", "fct_appointments", "fct_leads", "fct_membership_months", "kpi_location_monthly"]
PUBLISHED = [*BY_MONTH, "dim_location", "dim_customer", "int_customer_identity"]
LATER = "2099-01-01 00:00:00"


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def pick(table, n, seed):
    return F.pmod(F.xxhash64(TABLES[table], F.lit(seed)), F.lit(n)) == 0


def batch(raw, seed):
    """Changed rows of every table; some appointments lose their dates, a service its category, customers their test flag or e-mail."""
    moved = F.concat(F.lit("2001-0"), (1 + F.pmod(F.xxhash64("updated_at", F.lit(seed)), F.lit(3))).cast("string"), F.lit("-11 10:00:00"))
    out = {
        "payments": raw["payments"].where(pick("payments", 300, seed)).withColumns({"amount": F.lit("77.70"), "paid_at": moved}),
        "appointments": raw["appointments"].where(pick("appointments", 400, seed)).withColumns(
            {"status": F.lit("No Show"), "scheduled_at": F.when(pick("appointments", 800, seed), None).otherwise(F.col("scheduled_at"))}),
        "memberships": raw["memberships"].where(pick("memberships", 60, seed)).withColumn("end_date", F.lit("1998-02-03")),
        "leads": raw["leads"].where(pick("leads", 200, seed)).withColumn("created_at", moved),
        "customers": raw["customers"].where(pick("customers", 80, seed)).withColumn("email", F.lit(f"shared{seed}@x.org")),
        "services": raw["services"].where(pick("services", 150, seed)).withColumn("category", F.lit("Other")),
        "locations": raw["locations"].limit(0),
    }
    return {t: d.withColumn("updated_at", F.lit(LATER)) for t, d in out.items()}


def after(raw, delta):
    return {t: ingest.merge_deltas(raw[t], [(delta[t], ingest.EXTRACT)], TABLES[t]) for t in TABLES}


def test_a_run_after_a_batch_equals_a_full_rebuild(spark, scratch):
    raw = raw_tables(spark, SF_SMALL)
    source = after(raw, batch(raw, 3))
    pipeline.run(spark, raw, scratch, *FIXTURE_MONTHS, run_id="r1")
    rep = pipeline.run(spark, source, scratch, *FIXTURE_MONTHS, run_id="r2")
    assert rep.published and all(rep.months[m] is not None for m in BY_MONTH)
    assert None in rep.months["fct_appointments"]                           # some without a date now
    assert 0 < len(rep.months["kpi_location_monthly"]) < 84
    rebuilt = Models(spark, {t: source[t] for t in TABLES})
    for m in PUBLISHED:
        got, want = pipeline.read_published(spark, scratch, m), rebuilt.model(m)
        assert got.columns == want.columns and rows(got) == rows(want), m


def test_one_row_writes_one_month_and_a_failing_run_none(spark, scratch):
    raw = raw_tables(spark, SF_SMALL)
    pipeline.run(spark, raw, scratch, *FIXTURE_MONTHS, run_id="r1")
    real = Models(spark, raw).dim_customer.agg(F.min("customer_id")).first()[0]
    row = spark.createDataFrame([("999999", str(real), "1", None, None, "service", "$10.00", "settled", "2001-06-30 12:00:00", LATER)],
                                raw["payments"].schema)
    more = {**raw, "payments": raw["payments"].unionByName(row)}
    bad = {**more, "locations": raw["locations"].limit(1).withColumns(
        {"location_id": F.lit("99999"), "location_name": F.lit("Alder - Northgate"), "brand": F.lit("No Such Brand"), "updated_at": F.lit(LATER)}).unionByName(raw["locations"])}
    before = rows(pipeline.read_published(spark, scratch, "fct_payments"))
    with pytest.raises(q.GateError):
        pipeline.run(spark, bad, scratch, *FIXTURE_MONTHS, run_id="r2")
    assert rows(pipeline.read_published(spark, scratch, "fct_payments")) == before
    # the source's fault is mended: the location belongs to a known brand now, so all is published, the payment with it
    good = {**bad, "locations": bad["locations"].where("location_id <> '99999'").unionByName(
        bad["locations"].where("location_id = '99999'").withColumns({"brand": F.lit("Alder Clinics"), "updated_at": F.lit("2099-02-01 00:00:00")}))}
    rep = pipeline.run(spark, good, scratch, *FIXTURE_MONTHS, run_id="r3")
    june = dt.date(2001, 6, 1)
    assert rep.published and rep.months["fct_payments"] == [june] and rep.months["fct_appointments"] == [] == rep.months["fct_leads"]
    path = parts.model_path(scratch, "r3", "fct_payments")
    assert [p.rsplit("/", 1)[-1] for p in glob.glob(f"{path}/fact_month=*")] == ["fact_month=2001-06-01"]
    assert len(glob.glob(f"{path}/fact_month=*/*.parquet")) == 1            # one file a month
    assert not glob.glob(parts.model_path(scratch, "r3", "fct_appointments"))
    assert rows(pipeline.read_published(spark, scratch, "fct_payments")) == rows(Models(spark, good).fct_payments)
    # a month is read from its own folders only
    one = pipeline.read_published(spark, scratch, "fct_payments", [june])
    assert "fact_month" not in one.columns and rows(one) == rows(Models(spark, good).fct_payments.where("trunc(payment_date, 'MM') = date'2001-06-01'"))
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan
    scanned = [r for r in one.select(F.input_file_name().alias("f")).distinct().collect()]
    assert scanned and all("/r3/" in r.f and "fact_month=2001-06-01" in r.f for r in scanned)


def test_changes_that_cannot_be_told_apart_are_built_whole(spark, scratch):
    s = ingest.TableState({}, "b1", [("b2", ingest.EXTRACT), ("b3", ingest.LANDED)], 3, "k")
    assert parts.deltas_since({"t": s}, {"t": "b1"}) == {"t": s.deltas}
    assert parts.deltas_since({"t": s}, {"t": "b2"}) == {"t": [("b3", ingest.LANDED)]}
    assert parts.deltas_since({"t": s}, {"t": "b3"}) == {"t": []}
    assert parts.deltas_since({"t": s}, {"t": "b0"}) is None                 # a new base since


def test_rows_of_a_month_come_from_the_run_that_wrote_it_last(spark, scratch):
    schema = "v int, month_start date"
    day = lambda m: dt.date(2000, m, 1)

    def write(run, data):
        spark.createDataFrame(data, schema).write.partitionBy("month_start").parquet(parts.model_path(scratch, run, "kpi_location_monthly"))

    write("a", [(1, day(1)), (2, day(2)), (3, None), (4, day(4))])
    write("b", [(20, day(2)), (30, None)])
    write("c", [])                                                          # month 4 has no rows any more
    entry = {"schema": spark.createDataFrame([], schema).schema.jsonValue(),
             "parts": [["a", None], ["b", parts.to_json([day(2), None])], ["c", parts.to_json([day(4)])]]}
    assert rows(parts.read_parts(spark, scratch, "kpi_location_monthly", entry)) == [(1, day(1)), (20, day(2)), (30, None)]


def test_months_that_stay_are_named(spark, capsys):
    """Where a batch touches every month, the KPI table before it is not planned; elsewhere the untouched months stay."""
    from kpiloom.operators import mart
    months = [dt.date(1995, m, 1) for m in range(11, 13)] + [dt.date(1996, 1, 1)]
    table = lambda tag, ms: spark.createDataFrame([(m, tag) for m in ms], "month_start date, v string")
    axis = ("1995-11-01", dt.date(1996, 1, 1))
    some = mart.refresh_months(table("before", months), table("again", months[1:2]), months[1:2], axis)
    assert rows(some) == rows(table("before", [months[0], months[2]]).unionByName(table("again", months[1:2])))
    every = mart.refresh_months(table("before", months), table("again", months), months, axis)
    assert rows(every) == rows(table("again", months))
    every.explain()
    assert "Union" not in capsys.readouterr().out


def test_refreshed_kpis_read_the_orders_no_more_than_needed(spark, monkeypatch):
    """Touched months need no merged tables: the rows of touched customers that no batch replaced were there before."""
    from kpiloom.operators import mart
    from kpiloom.plans.ingest_plan import TwoBatches
    b = TwoBatches(raw_tables(spark, SF_SMALL))
    seen = {}
    real = mart.touched_months
    monkeypatch.setattr(mart, "touched_months", lambda changed, staged, *axis: seen.update(changed=changed, staged=staged, axis=axis) or real(changed, staged, *axis))
    got = b.refreshed_kpis()
    merged = Models(spark, {t: b.upserted(t) for t in TABLES})
    wanted = rows(real(seen["changed"], {t: merged.model(f"stg_{t}") for t in TABLES}, *seen["axis"]))
    assert rows(real(seen["changed"], seen["staged"], *seen["axis"])) == wanted
    text = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    assert text(seen["staged"]["payments"]).count("LeftAnti") == 0
    assert rows(got) == rows(merged.kpi_location_monthly)
