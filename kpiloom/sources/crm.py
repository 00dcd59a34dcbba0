"""Raw CRM tables derived from the driver's TPC-H-like tables.

The platform's input is seven operational CRM tables loaded as text. The
driver supplies TPC-H-like tables instead, so each raw table is projected
from one of them by deterministic key arithmetic (documented in FIXTURES.md):
every kind of mess the platform must handle -- stray spaces, duplicate
customers, test accounts, status and channel spellings, '$1,234.50' amounts,
voids, refunds, late openings, a closure with refunds after it -- occurs at
a fixed rate, so the work grows with the input tables.

Every output column is a string, like the raw layer of the reference. All
expressions are built-in Column functions; the only shuffle is the
orders-customer join that gives payments and appointments their location.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiloom.sources.testdata import read_table

# Month axis that covers the fixture dates (orders run 1995-01 .. 2001-08).
FIXTURE_MONTHS = ("1995-01-01", "2001-12-01")

UNKNOWN_SERVICE_ID = -1              # no part has a negative key
TIME_OF_DAY = " 09:05:00"
MIDNIGHT = " 00:00:00"
NO_TIMESTAMP = "1994-01-01 00:00:00"

# --- fixed values: the source spellings the staging layer must collapse ---
COMPLETED_SPELLINGS = ["Completed", "completed", "COMPLETED", "Complete"]
CANCELLED_SPELLINGS = ["Cancelled", "canceled", "CANCELLED"]
NO_SHOW_SPELLINGS = ["No Show", "no-show", "NoShow"]
LEAD_SOURCE_SPELLINGS = [
    "Google Ads", "google", "adwords",
    "Facebook Ads", "FB", "facebook", "Instagram", "IG",
    "Referral", "referral", "Friend",
    "Website", "organic", "SEO",
    "Walk-in", "walkin",
]
PLANS = [("Core", "199.0"), ("Plus", "349.0"), ("Premium", "599.0")]
# --- end of fixed values ---------------------------------------------------


def _s(c: Column) -> Column:
    return c.cast("string")


def _day(offset: Column, base: str = "1995-01-01") -> Column:
    return F.date_add(F.lit(base).cast("date"), offset.cast("int"))


def _pick(values: list[str], idx: Column) -> Column:
    return F.array(*[F.lit(v) for v in values])[idx.cast("int")]


def has_duplicate(key: Column) -> Column:
    """Customers registered twice."""
    return (key % 33 == 0) & (key % 25 != 3) & ~(key % 150).isin(7, 8)


def record_id(key: Column, second: Column | bool = False) -> Column:
    """Customer record id: 2k for a customer's first record, 2k + 1 for the second -- never equal, at any size."""
    return 2 * key + (second.cast("long") if isinstance(second, Column) else int(second))


def locations(nation: DataFrame) -> DataFrame:
    """Raw locations from ``nation``."""
    i = F.col("n_nationkey")
    corporate = i < 10
    brand = F.when(corporate, F.lit("Alder Clinics")).otherwise(F.lit("Birch Wellness"))
    clean = F.concat(F.when(corporate, F.lit("Alder")).otherwise(F.lit("Birch")), F.lit(" - "),
                     F.replace(F.col("n_name"), F.lit("_"), F.lit(" ")))
    messy = F.concat(F.lit("  "), F.lower(clean), F.lit(" "))
    opened = F.when(i.isin(9, 18, 23), F.lit("1996-03-10").cast("date")).otherwise(
        F.date_add(F.lit("1994-01-05").cast("date"), (i * 10).cast("int")))
    closed = F.when(i.isin(7, 15), F.lit("1999-06-15").cast("date"))
    return nation.select(
        _s(i).alias("location_id"),
        F.when(i % 3 == 0, messy).otherwise(clean).alias("location_name"),
        brand.alias("brand"),
        F.when(corporate, F.lit("corporate")).otherwise(F.lit("franchise")).alias("ownership"),
        F.when(~corporate, F.concat(F.lit("FR-0"), _s(i % 6 + 1))).alias("franchisee_id"),
        _s(opened).alias("opened_on"),
        _s(closed).alias("closed_on"),
        F.concat(_s(opened), F.lit(MIDNIGHT)).alias("updated_at"),
    )


def customers(customer: DataFrame) -> DataFrame:
    """Customer records: one per customer, plus a second record for the
    customers registered twice -- both emitted from a single scan."""
    k = F.col("c_custkey")
    email = (F.when(k % 25 == 3, F.lit(None).cast("string"))
             .when(k % 150 == 8, F.concat(F.lit("test"), _s(k), F.lit("@clinic-test.com")))
             .otherwise(F.concat(F.lit("user"), _s(k), F.lit("@example.com"))))
    created = F.concat(_s(_day(k % 2000)), F.lit(TIME_OF_DAY))
    base = F.struct(
        _s(record_id(k)).alias("customer_id"),
        F.when(k % 150 == 7, F.lit("Test")).otherwise(F.concat(F.lit("First"), _s(k % 20))).alias("first_name"),
        F.concat(F.lit("Last"), _s(k % 10)).alias("last_name"),
        email.alias("email"),
        _s(F.col("c_nationkey")).alias("home_location_id"),
        created.alias("created_at"),
        created.alias("updated_at"),
    )
    dup_created = F.concat(_s(_day(k % 2000 + 30)), F.lit(TIME_OF_DAY))
    dup = F.struct(
        _s(record_id(k, True)).alias("customer_id"),
        F.concat(F.lit("First"), _s(k % 20)).alias("first_name"),
        F.concat(F.lit("Last"), _s(k % 10)).alias("last_name"),
        F.when(k % 2 == 0, F.upper(email)).otherwise(F.concat(F.lit(" "), email, F.lit(" "))).alias("email"),
        _s(F.col("c_nationkey")).alias("home_location_id"),
        dup_created.alias("created_at"),
        dup_created.alias("updated_at"),
    )
    records = F.when(has_duplicate(k), F.array(base, dup)).otherwise(F.array(base))
    return customer.select(F.explode(records).alias("r")).select("r.*")


def services(part: DataFrame) -> DataFrame:
    """Raw services from ``part``."""
    return part.select(
        _s(F.col("p_partkey")).alias("service_id"),
        F.col("p_name").alias("service_name"),
        F.col("p_type").alias("category"),
        _s(F.col("p_retailprice").cast("decimal(12,2)")).alias("list_price"),
        F.lit(NO_TIMESTAMP).alias("updated_at"),
    )


def memberships(customer: DataFrame) -> DataFrame:
    """Raw memberships from ``customer``: one for every customer."""
    k = F.col("c_custkey")
    start = _day((k * 7) % 2000)
    end = F.when(k % 3 != 0, F.date_add(start, (F.lit(30) * (k % 24 + 1)).cast("int")))
    plan = k % 3
    return customer.select(
        _s(k).alias("membership_id"),
        _s(record_id(k)).alias("customer_id"),
        _s(F.col("c_nationkey")).alias("location_id"),
        _pick([p for p, _ in PLANS], plan).alias("plan_name"),
        _pick([f for _, f in PLANS], plan).alias("monthly_fee"),
        _s(start).alias("start_date"),
        _s(end).alias("end_date"),
        F.concat(_s(start), F.lit(MIDNIGHT)).alias("updated_at"),
    )


def _orders_with_customer(orders: DataFrame, customer: DataFrame) -> DataFrame:
    # Equi-join on the customer key; both sides shuffle on it (or the
    # customer side is broadcast when its measured size allows).
    return orders.join(customer.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey"), "o_custkey")


def _payer_id(ok: Column, ck: Column) -> Column:
    # Odd orders of customers with a duplicate record are booked to the duplicate.
    return record_id(ck, (ok % 2 == 1) & has_duplicate(ck))


def appointments(oc: DataFrame) -> DataFrame:
    """Raw appointments from ``orders`` joined to the customer's nation; services spread over the keys of ``part``."""
    ok, ck = F.col("o_orderkey"), F.col("o_custkey")
    status = (F.when(F.col("o_orderstatus") == "F", _pick(COMPLETED_SPELLINGS, ok % 4))
              .when(F.col("o_orderstatus") == "O", _pick(CANCELLED_SPELLINGS, ok % 3))
              .when(F.col("o_orderstatus") == "P", _pick(NO_SHOW_SPELLINGS, ok % 3)))
    at = F.concat(_s(F.col("o_orderdate").cast("date")), F.lit(TIME_OF_DAY))
    return oc.select(
        _s(ok).alias("appointment_id"),
        _s(_payer_id(ok, ck)).alias("customer_id"),
        _s(F.col("c_nationkey")).alias("location_id"),
        _s(F.when(ok % 97 == 0, F.lit(UNKNOWN_SERVICE_ID)).otherwise(ck)).alias("service_id"),
        at.alias("scheduled_at"),
        status.alias("status"),
        at.alias("updated_at"),
    )


def _amount_text(cents: Column, negative: Column, dollar_style: Column) -> Column:
    dollars, rest = (cents / 100).cast("bigint"), F.lpad(_s(cents % 100), 2, "0")
    sign = F.when(negative, F.lit("-")).otherwise(F.lit(""))
    plain = F.concat(sign, _s(dollars), F.lit("."), rest)
    fancy = F.concat(F.lit("$"), sign, F.format_number(dollars, 0), F.lit("."), rest)
    return F.when(dollar_style, fancy).otherwise(plain)


def payments(oc: DataFrame) -> DataFrame:
    """Raw payments from ``orders``: sales, membership charges, refunds, voids, '$1,234.50' amounts."""
    ok, ck, nat = F.col("o_orderkey"), F.col("o_custkey"), F.col("c_nationkey")
    day = F.col("o_orderdate").cast("date")
    refund = ok % 50 == 0
    ptype = (F.when(refund, F.lit("refund"))
             .when(F.col("o_orderpriority") == "1-URGENT", F.lit("membership"))
             .otherwise(F.lit("service")))
    keep = ~((nat.isin(7, 15) & ~refund & (day > F.lit("1999-06-15").cast("date")))
             | (nat.isin(9, 18, 23) & (day < F.lit("1996-03-10").cast("date"))))
    cents = F.round(F.col("o_totalprice") * 100, 0).cast("bigint")
    at = F.concat(_s(day), F.lit(TIME_OF_DAY))
    return oc.where(keep).select(
        _s(ok).alias("payment_id"),
        _s(_payer_id(ok, ck)).alias("customer_id"),
        _s(nat).alias("location_id"),
        F.when(ptype != "membership", F.concat(_s(ok), F.lit(".0"))).alias("appointment_id"),
        F.when(ptype == "membership", F.concat(_s(ck), F.lit(".0"))).alias("membership_id"),
        ptype.alias("payment_type"),
        _amount_text(cents, refund, ok % 7 == 0).alias("amount"),
        F.when(ok % 100 == 13, F.lit("void")).otherwise(F.lit("settled")).alias("payment_status"),
        at.alias("paid_at"),
        at.alias("updated_at"),
    )


def leads(events: DataFrame) -> DataFrame:
    """Raw leads from ``events``; signups carry a converted customer id as '123.0' text."""
    e = F.col("event_id")
    at = F.concat(_s(_day(e % 2400)), F.lit(TIME_OF_DAY))
    return events.select(
        _s(e).alias("lead_id"),
        _s(e % 25).alias("location_id"),
        _pick(LEAD_SOURCE_SPELLINGS, e % 16).alias("lead_source"),
        at.alias("created_at"),
        F.when(F.col("event_type") == "signup", F.concat(_s(record_id(F.col("user_id"))), F.lit(".0"))).alias(
            "converted_customer_id"),
        at.alias("updated_at"),
    )


SOURCE_COLUMNS = {
    "nation": ["n_nationkey", "n_name"],
    "customer": ["c_custkey", "c_nationkey"],
    "part": ["p_partkey", "p_name", "p_type", "p_retailprice"],
    "orders": ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"],
    "events": ["event_id", "user_id", "event_type"],
}


class RawSource:
    """The seven raw CRM tables over one directory of driver tables.

    Each driver table is opened once (one footer read, one plan) however many
    raw tables use it; raw tables are built on first access.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._src: dict[str, DataFrame] = {}
        self._raw: dict[str, DataFrame] = {}

    def source(self, name: str) -> DataFrame:
        if name not in self._src:
            self._src[name] = read_table(self.spark, self.sf_dir, name, SOURCE_COLUMNS[name])
        return self._src[name]

    def _orders_customer(self) -> DataFrame:
        if "__oc" not in self._src:
            self._src["__oc"] = _orders_with_customer(self.source("orders"), self.source("customer"))
        return self._src["__oc"]

    def table(self, name: str) -> DataFrame:
        if name not in self._raw:
            build = {
                "locations": lambda: locations(self.source("nation")),
                "customers": lambda: customers(self.source("customer")),
                "services": lambda: services(self.source("part")),
                "memberships": lambda: memberships(self.source("customer")),
                "appointments": lambda: appointments(self._orders_customer()),
                "payments": lambda: payments(self._orders_customer()),
                "leads": lambda: leads(self.source("events")),
            }[name]
            self._raw[name] = build()
        return self._raw[name]


def raw_tables(spark: SparkSession, sf_dir: str, only: list[str] | None = None) -> dict[str, DataFrame]:
    """The seven raw CRM tables (all text columns); ``only`` limits which."""
    src = RawSource(spark, sf_dir)
    names = only or ["locations", "customers", "services", "memberships", "appointments", "payments", "leads"]
    return {n: src.table(n) for n in names}


# A later state of the source: voided payments are corrected (re-settled) and
# carry a new updated_at, so an incremental load must pick them up again.
CORRECTION_TIME = "2002-01-02 09:05:00"


def corrected_payments(raw_payments: DataFrame) -> DataFrame:
    void = F.col("payment_status") == F.lit("void")
    return raw_payments.withColumns({
        "payment_status": F.when(void, F.lit("settled")).otherwise(F.col("payment_status")),
        "updated_at": F.when(void, F.lit(CORRECTION_TIME)).otherwise(F.col("updated_at")),
    })
