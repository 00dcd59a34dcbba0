"""Identity, dimensions, facts and the spine on tiny hand-made inputs."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from kpiloom.operators import certified, identity, mart
from kpiloom.operators.quality import dq_no_test_accounts

CUST = ("customer_id int, first_name string, last_name string, email_normalized string, "
        "home_location_id int, created_at timestamp_ntz, is_test_account boolean")


def customers(spark, rows):
    ts = dt.datetime(2025, 1, 1)
    return spark.createDataFrame([(i, fn, "L", e, h, ts, t) for i, fn, e, h, t in rows], CUST)


def test_master_is_smallest_id_per_email_and_null_is_own_master(spark):
    stg = customers(spark, [(3, "A", "a", 1, False), (1, "B", "a", 1, False), (2, "C", None, 1, False)])
    got = {r.customer_id: r.master_customer_id for r in identity.int_customer_identity(stg).collect()}
    assert got == {3: 1, 1: 1, 2: 2}


def test_test_record_first_becomes_master_and_is_caught(spark):
    stg = customers(spark, [(1, "Test", "x@y.z", 1, True), (2, "Ana", "x@y.z", 1, False)])
    ids = identity.int_customer_identity(stg)
    assert {r.customer_id: r.master_customer_id for r in ids.collect()} == {1: 1, 2: 1}
    pays = spark.createDataFrame(
        [(10, 2, 1, None, None, "service", 500, False, dt.datetime(2025, 1, 5))],
        "payment_id int, customer_id int, location_id int, appointment_id int, membership_id int, "
        "payment_type string, amount_cents bigint, is_void boolean, paid_at timestamp_ntz")
    fct = certified.fct_payments(pays, ids)
    assert [r.customer_id for r in fct.collect()] == [1]
    res = dq_no_test_accounts(fct, stg).first()
    assert res.test_account_payments == 1 and res.passes is False


def test_first_value_by_key_skips_null_home(spark):
    stg = customers(spark, [(1, "A", "m@x", None, False), (2, "B", "m@x", 7, False)])
    dim = certified.dim_customer(identity.resolve_identity(stg)).collect()
    assert [(r.customer_id, r.home_location_id, r.source_records_merged) for r in dim] == [(1, 7, 2)]


MEM = ("membership_id int, customer_id int, location_id int, plan_name string, monthly_fee decimal(10,2), "
       "start_date date, end_date date")


def test_membership_months(spark):
    d = dt.date
    mem = spark.createDataFrame([
        (1, 1, 1, "Core", Decimal("199.00"), d(2025, 1, 31), d(2025, 3, 1)),
        (2, 1, 1, "Core", Decimal("199.00"), d(2026, 4, 10), None),
        (3, 1, 1, "Core", Decimal("199.00"), d(2025, 5, 1), d(2025, 3, 1)),
        (4, 1, 1, "Core", Decimal("199.00"), d(2024, 11, 1), d(2025, 2, 3)),
    ], MEM)
    ids = spark.createDataFrame([(1, 1, "e", False)], "customer_id int, master_customer_id int, "
                                                      "email_normalized string, is_test_account boolean")
    rows = certified.fct_membership_months(mem, ids, "2025-01-01", "2026-06-01").collect()
    by = {}
    for r in rows:
        by.setdefault(r.membership_id, []).append(r)
    m1 = sorted(by[1], key=lambda r: r.month_start)
    assert [r.month_start for r in m1] == [d(2025, 1, 1), d(2025, 2, 1), d(2025, 3, 1)]
    assert [r.is_new for r in m1] == [True, False, False] and [r.is_churned for r in m1] == [False, False, True]
    assert len(by[2]) == 3 and not any(r.is_churned for r in by[2])       # open end: to the axis end
    assert 3 not in by                                                    # ends before it starts
    m4 = sorted(by[4], key=lambda r: r.month_start)                       # starts before the axis
    assert [r.month_start for r in m4] == [d(2025, 1, 1), d(2025, 2, 1)]
    assert not any(r.is_new for r in m4) and [r.is_churned for r in m4] == [False, True]


LOC = ("location_id int, location_name string, city string, brand string, ownership string, franchisee_id string, "
       "opened_on date, closed_on date, is_active boolean")


def test_spine_closed_locations_follow_last_payment(spark):
    d = dt.date
    locs = spark.createDataFrame([
        (1, "A - X", "X", "A B", "corporate", None, d(2025, 1, 1), d(2025, 3, 10), False),
        (2, "A - Y", "Y", "A B", "corporate", None, d(2025, 1, 1), d(2025, 3, 10), False),
        (3, "A - Z", "Z", "A B", "corporate", None, d(2026, 3, 2), None, True),
    ], LOC)
    last = spark.createDataFrame([(1, d(2025, 5, 1))], "location_id int, last_month date")
    spine = mart.location_month_spine(locs, last, "2025-01-01", "2026-06-01")
    ends = {r.location_id: (r.first, r.last, r.n) for r in spine.groupBy("location_id").agg(
        F.min("month_start").alias("first"), F.max("month_start").alias("last"), F.count("*").alias("n")).collect()}
    assert ends[1] == (d(2025, 1, 1), d(2025, 5, 1), 5)
    assert ends[2] == (d(2025, 1, 1), d(2025, 3, 1), 3)
    assert ends[3] == (d(2026, 3, 1), d(2026, 6, 1), 4)
    # the one-pass variant gives the same spine
    rev = spark.createDataFrame([(1, d(2025, 5, 1), 100, 0, 100), (1, d(2027, 1, 1), -5, 0, -5)],
                                "location_id int, month_start date, net_revenue_cents bigint, "
                                "membership_revenue_cents bigint, service_revenue_cents bigint")
    one = mart.spine_with_revenue(locs, rev, "2025-01-01", "2026-06-01")
    # location 1's last payment (2027-01) is past the axis: spine runs to the axis end
    assert one.where("location_id = 1").count() == 18
    assert one.where("location_id = 2").count() == 3
