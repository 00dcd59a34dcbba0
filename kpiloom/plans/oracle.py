"""Independent DuckDB SQL for every registered query (the correctness oracle).

The SQL is written from the model definitions, not generated from the Spark
code: raw tables are derived with the same key arithmetic (FIXTURES.md),
then each model is a CTE. ``sql_for(final, deps)`` pulls in the CTEs a query
needs, in dependency order. Views ``nation customer part orders events`` are
registered by the caller.
"""

from __future__ import annotations

import re

from kpiloom.functions.vocabulary import CHANNEL_VOCABULARY, STATUS_VOCABULARY

_CTES: dict[str, tuple[list[str], str]] = {}

AXIS_FIRST, AXIS_LAST = "1995-01-01", "2001-12-01"


def cte(name: str, deps: list[str], sql: str) -> None:
    _CTES[name] = (deps, sql)


# The dirty variant: raw table -> (columns changed in every n-th record, in order; n of the records that come twice).
DIRT = {
    "raw_payments": ("payment_id", [("payment_type", 53, "'voucher'"), ("location_id", 59, "'99'"), ("amount", 71, "NULL")], 101),
    "raw_appointments": ("appointment_id", [("status", 41, "'Rescheduled'"), ("status", 43, "' In progress '"), ("location_id", 61, "'99'")], None),
    "raw_leads": ("lead_id", [("lead_source", 37, "'TikTok Ads'"), ("lead_source", 91, "NULL")], None),
    "raw_customers": ("customer_id", [("home_location_id", 67, "'77'")], None),
    "raw_locations": ("location_id", [("ownership", 4, "'leased'"), ("brand", 5, "'Cedar Spa'")], None),
    "raw_memberships": ("membership_id", [], 73),
}
BAD_AMOUNTS = [("amount", 47, "'n/a'"), ("amount", 83, "'EUR ' || amount")]


def _dirty(name: str, sql: str, amounts: bool) -> str:
    key, faults, twice = DIRT[name]
    for column, n, fault in faults + (BAD_AMOUNTS if amounts and name == "raw_payments" else []):
        sql = f"SELECT * REPLACE (CASE WHEN CAST({key} AS BIGINT) % {n} = 0 THEN {fault} ELSE {column} END AS {column}) FROM ({sql}) t"
    return f"WITH d AS ({sql}) SELECT * FROM d UNION ALL SELECT * FROM d WHERE CAST({key} AS BIGINT) % {twice} = 0" if twice else sql


def sql_for(final: str, deps: list[str], dirt: str | None = None) -> str:
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in _CTES[n][0]:
            visit(d)
        order.append(n)

    for d in deps:
        visit(d)
    if not order:
        return final
    sql = {n: _dirty(n, _CTES[n][1], dirt == "amounts") if dirt and n in DIRT else _CTES[n][1] for n in order}
    body = ",\n".join(f"{n} AS (\n{sql[n]}\n)" for n in order)
    return f"WITH {body}\n{final}"


# --- raw tables -------------------------------------------------------------
DUP = "(c_custkey % 33 = 0 AND c_custkey % 25 <> 3 AND c_custkey % 150 NOT IN (7, 8))"

cte("raw_locations", [], """
SELECT cast(n_nationkey AS varchar) AS location_id,
       CASE WHEN n_nationkey % 3 = 0 THEN '  ' || lower(nm) || ' ' ELSE nm END AS location_name,
       CASE WHEN n_nationkey < 10 THEN 'Alder Clinics' ELSE 'Birch Wellness' END AS brand,
       CASE WHEN n_nationkey < 10 THEN 'corporate' ELSE 'franchise' END AS ownership,
       CASE WHEN n_nationkey >= 10 THEN 'FR-0' || cast(n_nationkey % 6 + 1 AS varchar) END AS franchisee_id,
       cast(opened AS varchar) AS opened_on,
       cast(CASE WHEN n_nationkey IN (7, 15) THEN date '1999-06-15' END AS varchar) AS closed_on,
       cast(opened AS varchar) || ' 00:00:00' AS updated_at
FROM (SELECT n_nationkey,
             CASE WHEN n_nationkey < 10 THEN 'Alder' ELSE 'Birch' END || ' - ' || replace(n_name, '_', ' ') AS nm,
             CASE WHEN n_nationkey IN (9, 18, 23) THEN date '1996-03-10'
                  ELSE date '1994-01-05' + cast(10 * n_nationkey AS integer) END AS opened
      FROM nation) n""")

cte("cust_base", [], f"""
SELECT c_custkey, c_nationkey, {DUP} AS has_dup,
       CASE WHEN c_custkey % 25 = 3 THEN NULL
            WHEN c_custkey % 150 = 8 THEN 'test' || cast(c_custkey AS varchar) || '@clinic-test.com'
            ELSE 'user' || cast(c_custkey AS varchar) || '@example.com' END AS email
FROM customer""")

cte("raw_customers", ["cust_base"], """
SELECT cast(2 * c_custkey AS varchar) AS customer_id,
       CASE WHEN c_custkey % 150 = 7 THEN 'Test' ELSE 'First' || cast(c_custkey % 20 AS varchar) END AS first_name,
       'Last' || cast(c_custkey % 10 AS varchar) AS last_name,
       email,
       cast(c_nationkey AS varchar) AS home_location_id,
       cast(date '1995-01-01' + cast(c_custkey % 2000 AS integer) AS varchar) || ' 09:05:00' AS created_at,
       cast(date '1995-01-01' + cast(c_custkey % 2000 AS integer) AS varchar) || ' 09:05:00' AS updated_at
FROM cust_base
UNION ALL
SELECT cast(2 * c_custkey + 1 AS varchar),
       'First' || cast(c_custkey % 20 AS varchar),
       'Last' || cast(c_custkey % 10 AS varchar),
       CASE WHEN c_custkey % 2 = 0 THEN upper(email) ELSE ' ' || email || ' ' END,
       cast(c_nationkey AS varchar),
       cast(date '1995-01-01' + cast(c_custkey % 2000 + 30 AS integer) AS varchar) || ' 09:05:00',
       cast(date '1995-01-01' + cast(c_custkey % 2000 + 30 AS integer) AS varchar) || ' 09:05:00'
FROM cust_base WHERE has_dup""")

cte("raw_services", [], """
SELECT cast(p_partkey AS varchar) AS service_id, p_name AS service_name, p_type AS category,
       cast(cast(p_retailprice AS decimal(12, 2)) AS varchar) AS list_price,
       '1994-01-01 00:00:00' AS updated_at
FROM part""")

cte("raw_memberships", [], """
SELECT cast(c_custkey AS varchar) AS membership_id, cast(2 * c_custkey AS varchar) AS customer_id,
       cast(c_nationkey AS varchar) AS location_id,
       ['Core', 'Plus', 'Premium'][c_custkey % 3 + 1] AS plan_name,
       ['199.0', '349.0', '599.0'][c_custkey % 3 + 1] AS monthly_fee,
       cast(s AS varchar) AS start_date,
       cast(CASE WHEN c_custkey % 3 <> 0 THEN s + cast(30 * (c_custkey % 24 + 1) AS integer) END AS varchar) AS end_date,
       cast(s AS varchar) || ' 00:00:00' AS updated_at
FROM (SELECT c_custkey, c_nationkey, date '1995-01-01' + cast((7 * c_custkey) % 2000 AS integer) AS s
      FROM customer) m""")

cte("orders_customer", [], f"""
SELECT o.o_orderkey, o.o_custkey, o.o_orderstatus, o.o_totalprice, o.o_orderpriority,
       cast(o.o_orderdate AS date) AS odate, c.c_nationkey,
       CASE WHEN o.o_orderkey % 2 = 1 AND {DUP} THEN 2 * o.o_custkey + 1 ELSE 2 * o.o_custkey END AS payer,
       cast(cast(o.o_orderdate AS date) AS varchar) || ' 09:05:00' AS ts_text
FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey""")

cte("raw_appointments", ["orders_customer"], """
SELECT cast(o_orderkey AS varchar) AS appointment_id, cast(payer AS varchar) AS customer_id,
       cast(c_nationkey AS varchar) AS location_id,
       cast(CASE WHEN o_orderkey % 97 = 0 THEN -1 ELSE o_custkey END AS varchar) AS service_id,
       ts_text AS scheduled_at,
       CASE o_orderstatus
            WHEN 'F' THEN ['Completed', 'completed', 'COMPLETED', 'Complete'][o_orderkey % 4 + 1]
            WHEN 'O' THEN ['Cancelled', 'canceled', 'CANCELLED'][o_orderkey % 3 + 1]
            WHEN 'P' THEN ['No Show', 'no-show', 'NoShow'][o_orderkey % 3 + 1] END AS status,
       ts_text AS updated_at
FROM orders_customer""")

cte("raw_payments", ["orders_customer"], """
SELECT cast(o_orderkey AS varchar) AS payment_id, cast(payer AS varchar) AS customer_id,
       cast(c_nationkey AS varchar) AS location_id,
       CASE WHEN ptype <> 'membership' THEN cast(o_orderkey AS varchar) || '.0' END AS appointment_id,
       CASE WHEN ptype = 'membership' THEN cast(o_custkey AS varchar) || '.0' END AS membership_id,
       ptype AS payment_type,
       CASE WHEN o_orderkey % 7 = 0
            THEN '$' || sgn || format('{:,}', cents // 100) || '.' || lpad(cast(cents % 100 AS varchar), 2, '0')
            ELSE sgn || cast(cents // 100 AS varchar) || '.' || lpad(cast(cents % 100 AS varchar), 2, '0') END AS amount,
       CASE WHEN o_orderkey % 100 = 13 THEN 'void' ELSE 'settled' END AS payment_status,
       ts_text AS paid_at, ts_text AS updated_at
FROM (SELECT *, CASE WHEN o_orderkey % 50 = 0 THEN 'refund'
                     WHEN o_orderpriority = '1-URGENT' THEN 'membership' ELSE 'service' END AS ptype,
             CASE WHEN o_orderkey % 50 = 0 THEN '-' ELSE '' END AS sgn,
             cast(round(o_totalprice * 100) AS bigint) AS cents
      FROM orders_customer
      WHERE NOT ((c_nationkey IN (7, 15) AND o_orderkey % 50 <> 0 AND odate > date '1999-06-15')
              OR (c_nationkey IN (9, 18, 23) AND odate < date '1996-03-10'))) p""")

cte("raw_leads", [], """
SELECT cast(event_id AS varchar) AS lead_id, cast(event_id % 25 AS varchar) AS location_id,
       ['Google Ads', 'google', 'adwords', 'Facebook Ads', 'FB', 'facebook', 'Instagram', 'IG',
        'Referral', 'referral', 'Friend', 'Website', 'organic', 'SEO', 'Walk-in', 'walkin'][event_id % 16 + 1] AS lead_source,
       ts_text AS created_at,
       CASE WHEN event_type = 'signup' THEN cast(2 * user_id AS varchar) || '.0' END AS converted_customer_id,
       ts_text AS updated_at
FROM (SELECT *, cast(date '1995-01-01' + cast(event_id % 2400 AS integer) AS varchar) || ' 09:05:00' AS ts_text
      FROM events) e""")

# --- staging ------------------------------------------------------------------
# What staging does to a raw text column, by name; everything else is a cast to the declared type.
TEST_RECORD = """(regexp_matches(lower(trim(ifnull(email, ''))), '@clinic-test[.]com$') OR lower(ifnull(first_name, '')) = 'test')"""
CENTS = "CAST(round(100 * CAST(replace(replace(trim(amount), '$', ''), ',', '') AS DECIMAL(14, 2))) AS BIGINT)"
TEXT, ID, DAY, TIME, MONEY = "VARCHAR", "BIGINT", "DATE", "TIMESTAMP", "DECIMAL(10, 2)"

# model -> (raw table, columns that only change type: staged name, type, raw name where it differs; computed columns)
STAGED: dict[str, tuple[str, list[tuple], dict[str, str]]] = {
    "stg_customers": ("raw_customers", [
        ("customer_id", ID), ("first_name", TEXT), ("last_name", TEXT), ("home_location_id", ID), ("created_at", TIME)],
        {"email_normalized": "nullif(lower(trim(email)), '')", "is_test_account": TEST_RECORD}),
    "stg_services": ("raw_services", [
        ("service_id", ID), ("service_name", TEXT), ("service_category", TEXT, "category"), ("list_price", MONEY)], {}),
    "stg_memberships": ("raw_memberships", [
        ("membership_id", ID), ("customer_id", ID), ("location_id", ID), ("plan_name", TEXT), ("monthly_fee", MONEY),
        ("start_date", DAY), ("end_date", DAY)], {}),
    "stg_payments": ("raw_payments", [
        ("payment_id", ID), ("customer_id", ID), ("location_id", ID), ("appointment_id", ID), ("membership_id", ID),
        ("payment_type", TEXT), ("paid_at", TIME)],
        {"amount_cents": CENTS, "is_void": "payment_status = 'void'"}),
    "stg_appointments": ("raw_appointments r LEFT JOIN status_map v ON v.spelling = lower(regexp_replace(trim(r.status), '[- ]', '', 'g'))", [
        ("appointment_id", ID), ("customer_id", ID), ("location_id", ID), ("service_id", ID), ("scheduled_at", TIME),
        ("status_raw", TEXT, "r.status")], {"status": "v.status"}),
    "stg_leads": ("raw_leads r LEFT JOIN channel_map v ON v.spelling = lower(trim(r.lead_source))", [
        ("lead_id", ID), ("location_id", ID), ("lead_source_raw", TEXT, "lead_source"), ("created_at", TIME),
        ("converted_customer_id", ID)], {"channel": "v.channel"}),
}


def _vocabulary(column: str, vocabulary: dict) -> str:
    """A table (spelling, value) of one of the fixed vocabularies."""
    rows = ", ".join(f"('{x}', '{value}')" for value, spellings in vocabulary.items() for x in spellings)
    return f"SELECT * FROM (VALUES {rows}) v(spelling, {column})"


cte("status_map", [], _vocabulary("status", STATUS_VOCABULARY))
cte("channel_map", [], _vocabulary("channel", CHANNEL_VOCABULARY))

for _model, (_from, _casts, _computed) in STAGED.items():
    _columns = [f"CAST({c[2] if len(c) > 2 else c[0]} AS {c[1]}) AS {c[0]}" for c in _casts]
    _columns += [f"{expr} AS {name}" for name, expr in _computed.items()]
    _needs = [t for t in ("status_map", "channel_map") if t in _from]
    cte(_model, [_from.split()[0], *_needs], f"SELECT {', '.join(_columns)}\nFROM {_from}")

# a location's name is 'Brand - City': the brand's first word, and the city with each word's first letter in capitals
cte("city_words", ["raw_locations"], """
SELECT location_id, generate_subscripts(words, 1) AS place, unnest(words) AS word
FROM (SELECT location_id, string_split(lower(trim(string_split(trim(location_name), ' - ')[2])), ' ') AS words
      FROM raw_locations) s""")
cte("stg_locations", ["raw_locations", "city_words"], """
WITH cities AS (SELECT location_id, string_agg(upper(word[1]) || word[2:], ' ' ORDER BY place) AS city FROM city_words GROUP BY location_id)
SELECT CAST(r.location_id AS BIGINT) AS location_id, string_split(r.brand, ' ')[1] || ' - ' || cities.city AS location_name,
       cities.city, r.brand, r.ownership, r.franchisee_id, CAST(r.opened_on AS DATE) AS opened_on,
       CAST(r.closed_on AS DATE) AS closed_on, r.closed_on IS NULL AS is_active
FROM raw_locations r LEFT JOIN cities ON cities.location_id IS NOT DISTINCT FROM r.location_id""")

# --- identity and certified -----------------------------------------------------
# records with one e-mail are one person, known by the smallest record id; a record without an e-mail stands alone
cte("int_customer_identity", ["stg_customers"], """
SELECT customer_id, email_normalized, is_test_account,
       CASE WHEN email_normalized IS NULL THEN customer_id
            ELSE min(customer_id) OVER (PARTITION BY email_normalized) END AS master_customer_id
FROM stg_customers""")

# who a real (not a test) record belongs to
cte("person", ["int_customer_identity"], """
SELECT customer_id AS record_id, master_customer_id AS person_id FROM int_customer_identity WHERE NOT is_test_account""")

cte("dim_location", ["stg_locations"], "SELECT * FROM stg_locations")

cte("dim_customer", ["stg_customers", "person"], """
WITH records AS (SELECT person_id, customer_id, created_at, home_location_id
                 FROM stg_customers JOIN person ON record_id = customer_id),
homes AS (SELECT DISTINCT ON (person_id) person_id, home_location_id FROM records
          WHERE home_location_id IS NOT NULL ORDER BY person_id, customer_id)
SELECT r.person_id AS customer_id, min(r.created_at) AS first_seen_at, any_value(h.home_location_id) AS home_location_id,
       count(*) AS source_records_merged
FROM records r LEFT JOIN homes h ON h.person_id = r.person_id
GROUP BY r.person_id""")

cte("fct_appointments", ["stg_appointments", "person", "stg_services"], """
SELECT appointment_id, person_id AS customer_id, location_id, a.service_id, service_category,
       CAST(scheduled_at AS DATE) AS appointment_date, status
FROM stg_appointments a JOIN person ON record_id = customer_id LEFT JOIN stg_services s ON s.service_id = a.service_id""")

cte("fct_payments", ["stg_payments", "person"], """
SELECT payment_id, person_id AS customer_id, location_id, payment_type,
       if(payment_type = 'membership', 'membership', 'service') AS revenue_stream, amount_cents,
       CAST(amount_cents AS DOUBLE) / 100 AS amount, CAST(paid_at AS DATE) AS payment_date
FROM stg_payments JOIN person ON record_id = customer_id
WHERE NOT is_void""")

cte("fct_leads", ["stg_leads", "person"], """
SELECT lead_id, location_id, channel, CAST(created_at AS DATE) AS lead_date, person_id AS converted_customer_id,
       person_id IS NOT NULL AS is_converted
FROM stg_leads LEFT JOIN person ON record_id = converted_customer_id""")

# months are numbered (12 * year + month) so that spans are plain ranges of numbers
MONTH_NO = "(12 * year({0}) + month({0}) - 1)"
MONTH_DAY = "make_date(({0}) // 12, ({0}) % 12 + 1, 1)"


def month_no(day: str) -> str:
    return MONTH_NO.format(day)


def month_day(number: str) -> str:
    return f"CAST({MONTH_DAY.format(number)} AS DATE)"


FIRST_NO, LAST_NO = month_no(f"DATE '{AXIS_FIRST}'"), month_no(f"DATE '{AXIS_LAST}'")

# a membership is active from its first month to its last one, both included, as far as the axis goes
cte("fct_membership_months", ["stg_memberships", "person"], f"""
WITH spans AS (SELECT *, {month_no('start_date')} AS first_no, {month_no('end_date')} AS last_no
               FROM stg_memberships JOIN person ON record_id = customer_id WHERE start_date IS NOT NULL),
months AS (SELECT *, unnest(range(greatest(first_no, {FIRST_NO}), least(ifnull(last_no, {LAST_NO}), {LAST_NO}) + 1)) AS no FROM spans)
SELECT membership_id, person_id AS customer_id, location_id, plan_name, monthly_fee, {month_day('no')} AS month_start,
       no = first_no AS is_new, last_no IS NOT NULL AND no = last_no AS is_churned
FROM months""")

# --- metrics --------------------------------------------------------------------
# The dated facts behind all measures, one row each: which measure it counts for at its location and month, and how much.
FACTS = [
    ("fct_payments", "payment_date", "'net_revenue_cents'", "amount_cents", "true"),
    ("fct_payments", "payment_date", "revenue_stream || '_revenue_cents'", "amount_cents", "true"),
    ("fct_appointments", "appointment_date", "'appointments_scheduled'", "1", "true"),
    ("fct_appointments", "appointment_date", "'completed_visits'", "1", "status = 'completed'"),
    ("fct_appointments", "appointment_date", "'no_shows'", "1", "status = 'no_show'"),
    ("fct_membership_months", "month_start", "'active_members'", "1", "true"),
    ("fct_membership_months", "month_start", "'new_members'", "1", "is_new"),
    ("fct_membership_months", "month_start", "'churned_members'", "1", "is_churned"),
    ("fct_leads", "lead_date", "'leads'", "1", "true"),
    ("fct_leads", "lead_date", "'converted_leads'", "1", "is_converted"),
]
# rollup -> its measures; the first one exists wherever the rollup has a row
ROLLUPS = {
    "revenue_rollup": ["net_revenue_cents", "membership_revenue_cents", "service_revenue_cents"],
    "visit_rollup": ["appointments_scheduled", "completed_visits", "no_shows"],
    "member_rollup": ["active_members", "new_members", "churned_members"],
    "lead_rollup": ["leads", "converted_leads"],
}
MEASURES = [m for ms in ROLLUPS.values() for m in ms]
# ratio, numerator, denominator, decimal digits; without a base there is no ratio
RATIOS = [
    ("no_show_rate", "no_shows", "appointments_scheduled", 4),
    ("revenue_per_visit", "service_revenue", "completed_visits", 2),
    ("member_churn_rate", "churned_members", "active_members - new_members", 4),
    ("lead_conversion_rate", "converted_leads", "leads", 4),
]

cte("facts", sorted({f[0] for f in FACTS}), "\nUNION ALL\n".join(
    f"SELECT location_id, {month_no(day)} AS no, {measure} AS measure, {amount} AS amount FROM {table} WHERE {where}"
    for table, day, measure, amount, where in FACTS))
_SUMS = ", ".join(f"CAST(ifnull(sum(amount) FILTER (WHERE measure = '{m}'), 0) AS BIGINT) AS {m}" for m in MEASURES)
for _name, _measures in ROLLUPS.items():
    _in = ", ".join(f"'{m}'" for m in _measures)
    cte(_name, ["facts"], f"""
SELECT location_id, {month_day('no')} AS month_start, {', '.join(_measures)}
FROM (SELECT location_id, no, {_SUMS} FROM facts WHERE measure IN ({_in}) GROUP BY location_id, no) t""")
cte("all_measures", ["facts"], f"SELECT location_id, no, {_SUMS} FROM facts GROUP BY location_id, no")

cte("last_activity", ["fct_payments"], f"""
SELECT location_id, {month_day(f"max({month_no('payment_date')})")} AS last_month FROM fct_payments GROUP BY location_id""")

# a location reports from its opening month; after its closing month only as long as money moves
cte("spine", ["dim_location", "last_activity"], f"""
WITH life AS (SELECT d.location_id, location_name, brand, ownership, franchisee_id, {month_no('opened_on')} AS first_no,
                     CASE WHEN closed_on IS NOT NULL THEN greatest({month_no('closed_on')}, {month_no('last_month')}) ELSE {LAST_NO} END AS last_no
              FROM dim_location d LEFT JOIN last_activity a ON a.location_id = d.location_id WHERE opened_on IS NOT NULL),
numbered AS (SELECT *, unnest(range(greatest(first_no, {FIRST_NO}), least(last_no, {LAST_NO}) + 1)) AS no FROM life)
SELECT location_id, location_name, brand, ownership, franchisee_id, {month_day('no')} AS month_start FROM numbered""")

_REVENUES = [m for m in MEASURES if m.endswith("_cents")]
_zeroed = [f"CAST(ifnull(m.{m}, 0) AS DOUBLE) / 100 AS {m.removesuffix('_cents')}" if m in _REVENUES else f"ifnull(m.{m}, 0) AS {m}" for m in MEASURES]
_guarded = [f"CASE WHEN {below} <> 0 THEN round(({above}) / ({below}), {digits}) END AS {name}" for name, above, below, digits in RATIOS]
cte("kpi_location_monthly", ["spine", "all_measures"], f"""
WITH filled AS (SELECT s.*, {', '.join(_zeroed)}
                FROM spine s LEFT JOIN all_measures m ON m.location_id = s.location_id AND {month_day('m.no')} = s.month_start)
SELECT *, {', '.join(_guarded)} FROM filled""")


def model_sql(name: str) -> str:
    """SELECT * from one model CTE."""
    return sql_for(f"SELECT * FROM {name}", [name])


ORACLE: dict[str, str] = {}


def register(name: str, sql: str) -> None:
    ORACLE[name] = sql


for _m in ["stg_locations", "stg_customers", "stg_services", "stg_memberships", "stg_appointments",
           "stg_payments", "stg_leads", "int_customer_identity", "dim_location", "dim_customer",
           "fct_appointments", "fct_payments", "fct_membership_months", "fct_leads", "kpi_location_monthly"]:
    register(_m, model_sql(_m))

register("last_activity", model_sql("last_activity"))
register("location_month_spine", model_sql("spine"))
for _m in ROLLUPS:
    register(_m, model_sql(_m))

# --- B19 ------------------------------------------------------------------------
register("vocabulary_audit", sql_for("""
SELECT 'appointment_status' AS vocabulary, status_raw AS raw_value, status AS mapped_value, count(*) AS n_rows,
       status IS NULL AND status_raw IS NOT NULL AS is_unmapped
FROM stg_appointments GROUP BY status_raw, status
UNION ALL
SELECT 'lead_channel', lead_source_raw, channel, count(*), channel IS NULL AND lead_source_raw IS NOT NULL
FROM stg_leads GROUP BY lead_source_raw, channel""", ["stg_appointments", "stg_leads"]))

UNMAPPED = """
SELECT 'appointment_status' AS vocabulary, status_raw AS raw_value, status AS mapped_value, count(*) AS n_rows,
       status_raw IS NOT NULL AS is_unmapped
FROM stg_appointments WHERE status IS NULL GROUP BY status_raw, status
UNION ALL
SELECT 'lead_channel', lead_source_raw, channel, count(*), lead_source_raw IS NOT NULL
FROM stg_leads WHERE channel IS NULL GROUP BY lead_source_raw, channel"""
register("unmapped_values", sql_for(UNMAPPED, ["stg_appointments", "stg_leads"]))

# --- F1-F5 ----------------------------------------------------------------------
register("dq_not_null", sql_for("SELECT * FROM stg_customers WHERE email_normalized IS NULL", ["stg_customers"]))
register("dq_unique", sql_for("""
SELECT email_normalized, count(*) AS n FROM stg_customers WHERE email_normalized IS NOT NULL
GROUP BY email_normalized HAVING count(*) > 1""", ["stg_customers"]))
register("dq_accepted_values", sql_for("""
SELECT appointment_id, status_raw FROM stg_appointments
WHERE status_raw NOT IN ('completed', 'cancelled', 'no_show')""", ["stg_appointments"]))
register("dq_relationships", sql_for("""
SELECT * FROM fct_appointments a
WHERE a.service_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM stg_services s WHERE s.service_id = a.service_id)""",
                                     ["fct_appointments", "stg_services"]))
register("dq_unique_combo", sql_for("""
SELECT customer_id, appointment_date, count(*) AS n FROM fct_appointments
GROUP BY customer_id, appointment_date HAVING count(*) > 1""", ["fct_appointments"]))

# --- F6-F10 ---------------------------------------------------------------------
cte("tie_duplicates_merged", ["stg_customers", "int_customer_identity"], """
SELECT count(*) AS emails_checked, CAST(count_if(masters > 1) AS BIGINT) AS emails_with_several_masters,
       CAST(count_if(masters > 1) AS BIGINT) = 0 AS passes
FROM (SELECT c.email_normalized, count(DISTINCT i.master_customer_id) AS masters
      FROM stg_customers c JOIN int_customer_identity i ON i.customer_id = c.customer_id
      WHERE c.email_normalized IS NOT NULL AND c.is_test_account = false
      GROUP BY c.email_normalized) e""")
cte("tie_customer_reconcile", ["stg_customers", "dim_customer"], """
SELECT src AS source_records, cert AS certified_records, src IS NOT DISTINCT FROM cert AS passes
FROM (SELECT (SELECT CAST(count_if(NOT is_test_account) AS BIGINT) FROM stg_customers) AS src,
             (SELECT CAST(sum(source_records_merged) AS BIGINT) FROM dim_customer) AS cert) t""")
cte("tie_kpi_vs_ledger", ["kpi_location_monthly", "fct_payments"], """
SELECT k AS kpi_cents, l AS ledger_cents, k IS NOT DISTINCT FROM l AS passes
FROM (SELECT (SELECT CAST(sum(CAST(round(net_revenue * 100) AS BIGINT)) AS BIGINT) FROM kpi_location_monthly) AS k,
             (SELECT CAST(sum(amount_cents) AS BIGINT) FROM fct_payments) AS l) t""")
cte("tie_no_test_accounts", ["fct_payments", "stg_customers"], """
SELECT n AS payments_checked, t AS test_account_payments, t = 0 AS passes
FROM (SELECT (SELECT count(*) FROM fct_payments) AS n,
             (SELECT count(*) FROM fct_payments p
              WHERE EXISTS (SELECT 1 FROM stg_customers c
                            WHERE c.customer_id = p.customer_id AND c.is_test_account)) AS t) x""")
cte("tie_revenue_vs_source", ["raw_payments", "raw_customers", "fct_payments"], f"""
SELECT s AS source_cents, f AS certified_cents, s IS NOT DISTINCT FROM f AS passes
FROM (SELECT (SELECT CAST(sum({CENTS}) AS BIGINT) FROM raw_payments JOIN raw_customers USING (customer_id)
              WHERE payment_status <> 'void' AND NOT {TEST_RECORD}) AS s,
             (SELECT CAST(sum(amount_cents) AS BIGINT) FROM fct_payments) AS f) t""")

TIE_OUTS = {
    "assert_duplicates_merged": "tie_duplicates_merged",
    "assert_every_real_customer_certified": "tie_customer_reconcile",
    "assert_kpi_revenue_ties_to_ledger": "tie_kpi_vs_ledger",
    "assert_no_test_accounts_certified": "tie_no_test_accounts",
    "assert_revenue_ties_to_source": "tie_revenue_vs_source",
}
register("dq_duplicates_merged", model_sql("tie_duplicates_merged"))
register("dq_customer_reconcile", model_sql("tie_customer_reconcile"))
register("dq_kpi_vs_ledger", model_sql("tie_kpi_vs_ledger"))
register("dq_no_test_accounts", model_sql("tie_no_test_accounts"))
register("dq_revenue_vs_source", model_sql("tie_revenue_vs_source"))


# The 40 generic tests, as SURVEY lists them: test, model, column(s), and what the column is held against.
TESTS = """
unique, not_null | stg_locations.location_id
accepted         | stg_locations.ownership            | corporate, franchise
unique, not_null | stg_customers.customer_id
not_null         | stg_customers.is_test_account
unique, not_null | stg_appointments.appointment_id
not_null         | stg_appointments.status
accepted         | stg_appointments.status            | completed, cancelled, no_show
unique, not_null | stg_payments.payment_id
not_null         | stg_payments.amount_cents
accepted         | stg_payments.payment_type          | membership, service, refund
unique, not_null | stg_leads.lead_id
not_null         | stg_leads.channel
accepted         | stg_leads.channel                  | paid_search, paid_social, referral, organic, walk_in
unique, not_null | dim_location.location_id
unique, not_null | dim_location.location_name
accepted         | dim_location.brand                 | Alder Clinics, Birch Wellness
unique, not_null | dim_customer.customer_id
refers           | dim_customer.home_location_id      | dim_location.location_id
unique, not_null | fct_appointments.appointment_id
refers           | fct_appointments.customer_id       | dim_customer.customer_id
refers           | fct_appointments.location_id       | dim_location.location_id
unique, not_null | fct_payments.payment_id
not_null         | fct_payments.amount_cents
refers           | fct_payments.location_id           | dim_location.location_id
together         | fct_membership_months.membership_id, month_start
unique, not_null | fct_leads.lead_id
together         | kpi_location_monthly.location_id, month_start
not_null         | kpi_location_monthly.location_id
not_null         | kpi_location_monthly.month_start
"""
# test -> (kind in the results, SQL that counts its failures)
COUNTED = {
    "not_null": ("not_null", "SELECT count(*) FROM {model} WHERE {column} IS NULL"),
    "accepted": ("accepted_values", "SELECT count(*) FROM {model} WHERE {column} NOT IN ({values})"),
    "unique": ("unique", "SELECT count(*) FROM (SELECT {column} FROM {model} WHERE {column} IS NOT NULL GROUP BY {column} HAVING count(*) > 1) d"),
    "together": ("unique_combo", "SELECT count(*) FROM (SELECT {column} FROM {model} GROUP BY {column} HAVING count(*) > 1) d"),
    "refers": ("relationships", "SELECT count(*) FROM {model} c ANTI JOIN {parent} p ON p.{field} = c.{column} WHERE c.{column} IS NOT NULL"),
}


def _tests() -> list[tuple[str, str, dict]]:
    """(test, its name in the results, what its SQL is about) of the 40 generic tests."""
    out = []
    for line in TESTS.strip().splitlines():
        tests, target, *against = (x.strip() for x in line.split("|"))
        model, column = target.split(".", 1)
        values = ", ".join(f"'{v.strip()}'" for v in against[0].split(",")) if against else ""
        parent, _, field = against[0].partition(".") if against else ("", "", "")
        key = "concat_ws('|', membership_id, month_start)" if model == "fct_membership_months" else \
            "concat_ws('|', location_id, month_start)" if model == "kpi_location_monthly" else \
            f"CAST({model.split('_')[-1].removesuffix('s')}_id AS VARCHAR)"
        for test in tests.split(", "):
            out.append((test, f"{COUNTED[test][0]}_{model}_{column.replace(', ', '__')}",
                        {"model": model, "column": column, "values": values, "parent": parent, "field": field, "key": key}))
    return out


def _suite() -> tuple[str, list[str]]:
    """SQL of (test_name, model, kind, failures) for all 45 tests, and the models it reads."""
    parts, reads = [], set(TIE_OUTS.values())
    for test, name, about in _tests():
        kind, count = COUNTED[test]
        parts.append(f"SELECT '{name}' AS test_name, '{about['model']}' AS model, '{kind}' AS kind, ({count.format(**about)}) AS failures")
        reads |= {about["model"]} | ({about["parent"]} if test == "refers" else set())
    parts += [f"SELECT '{name}', 'singular', 'tie_out', (SELECT count(*) FROM {tie} WHERE passes IS DISTINCT FROM true)" for name, tie in TIE_OUTS.items()]
    return "\nUNION ALL\n".join(parts), sorted(reads)


_sql, _reads = _suite()
cte("suite", _reads, _sql)
cte("dq_results", ["suite"], "SELECT *, if(failures = 0, 'pass', 'fail') AS status FROM suite")
register("dq_results", model_sql("dq_results"))
SUMMARY = """
SELECT cast(15 AS bigint) AS models_built, count(*) FILTER (WHERE status = 'pass') AS tests_passed,
       count(*) FILTER (WHERE status <> 'pass') AS tests_failed
FROM dq_results"""
UNPARSEABLE = """
SELECT * FROM raw_payments
WHERE amount IS NOT NULL
  AND try_cast(replace(replace(trim(amount), '$', ''), ',', '') AS decimal(14, 2)) IS NULL"""
register("dq_summary", sql_for(SUMMARY, ["dq_results"]))
register("unparseable_amounts", sql_for(UNPARSEABLE, ["raw_payments"]))
register("ledger_exclusions", sql_for("""
SELECT reason, count(*) AS n_rows, cast(sum(amount_cents) AS bigint) AS amount_cents
FROM (SELECT p.amount_cents,
             CASE WHEN p.is_void IS NULL THEN 'void_status_null'
                  WHEN p.is_void THEN 'void'
                  WHEN i.customer_id IS NULL THEN 'unknown_customer'
                  WHEN i.is_test_account THEN 'test_account'
                  ELSE 'in_ledger' END AS reason
      FROM stg_payments p LEFT JOIN int_customer_identity i ON i.customer_id = p.customer_id) x
GROUP BY reason""", ["stg_payments", "int_customer_identity"]))

# --- H: serving ------------------------------------------------------------------
cte("kpi_m", ["kpi_location_monthly"], """
SELECT *, strftime(month_start, '%Y-%m') AS month FROM kpi_location_monthly""")

register("report_extract", sql_for("""
SELECT location_id, location_name, brand, ownership, month, net_revenue, membership_revenue, service_revenue,
       appointments_scheduled, completed_visits, no_shows, active_members, new_members, churned_members, leads,
       converted_leads, lead_conversion_rate
FROM kpi_m ORDER BY month, location_id""", ["kpi_m"]))

register("report_periods", sql_for("""
SELECT dimension, value,
       row_number() OVER (PARTITION BY dimension ORDER BY value) AS position,
       dimension = 'month' AND row_number() OVER (PARTITION BY dimension ORDER BY value DESC) = 1 AS is_latest,
       dimension = 'month' AND row_number() OVER (PARTITION BY dimension ORDER BY value DESC) = 2 AS is_previous
FROM (SELECT DISTINCT 'month' AS dimension, month AS value FROM kpi_m
      UNION ALL SELECT DISTINCT 'brand', brand FROM kpi_m) d""", ["kpi_m"]))

# each row counts for its brand and for 'All'
_CENTS = ["net_revenue", "membership_revenue", "service_revenue"]
_COUNTS = ["active_members", "new_members", "churned_members", "appointments_scheduled", "no_shows"]
_brand_sums = [f"CAST(sum(CAST(round({c} * 100) AS BIGINT)) AS DOUBLE) / 100.0 AS {c}" for c in _CENTS]
_brand_sums += [f"CAST(sum({c}) AS BIGINT) AS {c}" for c in _COUNTS]
_brand_ratios = [f"CASE WHEN {below} > 0 THEN {above} / ({below}) ELSE 0.0 END AS {name}"
                 for name, above, below, _ in RATIOS if name in ("member_churn_rate", "no_show_rate")]
cte("rollup", ["kpi_m"], f"""
WITH counted AS (SELECT * FROM kpi_m UNION ALL SELECT * REPLACE ('All' AS brand) FROM kpi_m),
sums AS (SELECT month, brand, {', '.join(_brand_sums)} FROM counted GROUP BY month, brand)
SELECT *, {', '.join(_brand_ratios)} FROM sums""")
register("monthly_rollup", model_sql("rollup"))

cte("mom_ranked", ["rollup"], """
SELECT month, row_number() OVER (ORDER BY month DESC) AS back FROM (SELECT DISTINCT month FROM rollup) d""")
cte("mom_long", ["rollup"], """
SELECT month, brand, 'net_revenue' AS metric, cast(net_revenue AS double) AS value, true AS good_up FROM rollup
UNION ALL SELECT month, brand, 'active_members', cast(active_members AS double), true FROM rollup
UNION ALL SELECT month, brand, 'member_churn_rate', cast(member_churn_rate AS double), false FROM rollup
UNION ALL SELECT month, brand, 'no_show_rate', cast(no_show_rate AS double), false FROM rollup""")
cte("mom_g", ["mom_ranked", "mom_long"], """
SELECT l.brand, l.metric,
       max(CASE WHEN r.back = 1 THEN l.month END) AS month,
       max(CASE WHEN r.back = 2 THEN l.month END) AS previous_month,
       coalesce(sum(CASE WHEN r.back = 1 THEN l.value END), 0.0) AS value,
       coalesce(sum(CASE WHEN r.back = 2 THEN l.value END), 0.0) AS previous_value,
       bool_or(l.good_up) AS good_up
FROM mom_long l JOIN mom_ranked r ON r.month = l.month AND r.back <= 2
GROUP BY l.brand, l.metric""")
register("mom_cards", sql_for("""
SELECT brand, metric, month, previous_month, value, previous_value, change,
       change = 0 OR ((change >= 0) = good_up) AS is_good
FROM (SELECT *, CASE WHEN abs(raw) < 0.0005 THEN 0.0 ELSE raw END AS change
      FROM (SELECT *, CASE WHEN previous_value <> 0 THEN (value - previous_value) / previous_value ELSE 0.0 END AS raw
            FROM mom_g) x) c""", ["mom_g"]))

register("leaderboard", sql_for("""
SELECT location_id, location_name, brand, ownership, month, net_revenue, active_members,
       CASE WHEN active_members - new_members > 0 THEN churned_members / (active_members - new_members)
            ELSE 0.0 END AS member_churn_rate,
       lead_conversion_rate
FROM kpi_m WHERE month_start = (SELECT max(month_start) FROM kpi_m)
ORDER BY net_revenue DESC, location_id""", ["kpi_m"]))

register("brand_monthly", sql_for("""
SELECT month, brand,
       cast(sum(cast(round(net_revenue * 100) AS bigint)) AS double) / 100.0 AS net_revenue,
       cast(sum(active_members) AS bigint) AS active_members,
       cast(sum(churned_members) AS bigint) AS churned_members,
       cast(sum(new_members) AS bigint) AS new_members,
       CASE WHEN sum(active_members) - sum(new_members) >= 100
            THEN sum(churned_members) / (sum(active_members) - sum(new_members)) * 100.0 END AS churn_pct
FROM kpi_m GROUP BY month, brand""", ["kpi_m"]))

_LAYER_TABLES = [("raw", f"crm_{t}", f"raw_{t}") for t in
                 ["locations", "customers", "services", "memberships", "appointments", "payments", "leads"]]
_LAYER_TABLES += [("certified", n, n) for n in ["dim_location", "dim_customer", "fct_appointments", "fct_payments",
                                                "fct_membership_months", "fct_leads"]]
_LAYER_TABLES += [("metrics", "kpi_location_monthly", "kpi_location_monthly")]
register("layer_row_counts", sql_for("\nUNION ALL\n".join(
    f"SELECT '{layer}' AS layer, '{name}' AS table_name, count(*) AS n_rows FROM {src}"
    for layer, name, src in _LAYER_TABLES), [src for _, _, src in _LAYER_TABLES]))

# --- A: ingestion ----------------------------------------------------------------
AS_OF = "1999-01-01 00:00:00"
B1, B2 = "b000000000001", "b000000000002"
L1, L2 = "2026-01-01 06:00:00", "2026-01-02 06:00:00"
_RAW = ["locations", "customers", "services", "memberships", "appointments", "payments", "leads"]

cte("src2_payments", ["raw_payments"], """
SELECT payment_id, customer_id, location_id, appointment_id, membership_id, payment_type, amount,
       CASE WHEN payment_status = 'void' THEN 'settled' ELSE payment_status END AS payment_status,
       paid_at,
       CASE WHEN payment_status = 'void' THEN '2002-01-02 09:05:00' ELSE updated_at END AS updated_at
FROM raw_payments""")
for _t in _RAW:
    cte(f"batch1_{_t}", [f"raw_{_t}"], f"""
SELECT *, '{B1}' AS _batch_id, TIMESTAMP '{L1}' AS _loaded_at
FROM raw_{_t} WHERE updated_at <= '{AS_OF}' AND updated_at > ''""")
    _src2 = "src2_payments" if _t == "payments" else f"raw_{_t}"
    cte(f"batch2_{_t}", [_src2, f"batch1_{_t}"], f"""
SELECT *, '{B2}' AS _batch_id, TIMESTAMP '{L2}' AS _loaded_at
FROM {_src2} WHERE updated_at > (SELECT coalesce(max(updated_at), '') FROM batch1_{_t})""")
for _k in (1, 2):
    cte(f"stats{_k}", [f"batch{_k}_{t}" for t in _RAW], "\nUNION ALL\n".join(
        f"SELECT '{t}' AS table_name, count(*) AS rows_loaded, max(updated_at) AS batch_mark FROM batch{_k}_{t}"
        for t in _RAW))
cte("state1", ["stats1"], "SELECT table_name, batch_mark AS high_watermark FROM stats1 WHERE rows_loaded > 0")
cte("state2", ["state1", "stats2"], """
SELECT * FROM state1 WHERE table_name NOT IN (SELECT table_name FROM stats2 WHERE rows_loaded > 0)
UNION ALL
SELECT table_name, batch_mark FROM stats2 WHERE rows_loaded > 0""")

register("incremental_extract", model_sql("batch2_payments"))
register("upsert_by_key", sql_for("""
SELECT * FROM batch1_payments
WHERE NOT coalesce(payment_id IN (SELECT payment_id FROM batch2_payments WHERE payment_id IS NOT NULL), false)
UNION ALL
SELECT * FROM batch2_payments""", ["batch1_payments", "batch2_payments"]))
register("watermark_state", model_sql("state2"))
register("load_log_summary", sql_for(f"""
SELECT '{B1}' AS batch_id, s.table_name, s.rows_loaded, coalesce(w.high_watermark, '') AS high_watermark,
       TIMESTAMP '{L1}' AS loaded_at
FROM stats1 s LEFT JOIN state1 w USING (table_name)
UNION ALL
SELECT '{B2}', s.table_name, s.rows_loaded, coalesce(w.high_watermark, ''), TIMESTAMP '{L2}'
FROM stats2 s LEFT JOIN state2 w USING (table_name)""", ["stats1", "state1", "stats2", "state2"]))
register("raw_text_audit", f"""
SELECT cast(o_orderkey AS varchar) AS o_orderkey, cast(o_custkey AS varchar) AS o_custkey,
       cast(o_orderstatus AS varchar) AS o_orderstatus, cast(o_totalprice AS varchar) AS o_totalprice,
       cast(o_orderdate AS varchar) AS o_orderdate, cast(o_orderpriority AS varchar) AS o_orderpriority,
       '{B1}' AS _batch_id, TIMESTAMP '{L1}' AS _loaded_at
FROM orders""")

register("raw_landing", sql_for("\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, '{','.join(columns)}' AS columns, "
    + " || '|' || ".join(f"ifnull({c}, '\\N')" for c in columns)
    + f" AS line, '{B1}' AS _batch_id, TIMESTAMP '{L1}' AS _loaded_at FROM raw_{t}" for t, columns in {
        "locations": ["location_id", "location_name", "brand", "ownership", "franchisee_id", "opened_on", "closed_on", "updated_at"],
        "customers": ["customer_id", "first_name", "last_name", "email", "home_location_id", "created_at", "updated_at"],
        "services": ["service_id", "service_name", "category", "list_price", "updated_at"],
        "memberships": ["membership_id", "customer_id", "location_id", "plan_name", "monthly_fee", "start_date", "end_date", "updated_at"],
        "appointments": ["appointment_id", "customer_id", "location_id", "service_id", "scheduled_at", "status", "updated_at"],
        "payments": ["payment_id", "customer_id", "location_id", "appointment_id", "membership_id", "payment_type", "amount", "payment_status",
                     "paid_at", "updated_at"],
        "leads": ["lead_id", "location_id", "lead_source", "created_at", "converted_customer_id", "updated_at"]}.items()), [f"raw_{t}" for t in _RAW]))

# --- the dirty variant -------------------------------------------------------------
register("dq_results_dirty", sql_for("SELECT * FROM dq_results", ["dq_results"], "faults"))
register("dq_summary_dirty", sql_for(SUMMARY, ["dq_results"], "faults"))
register("unmapped_values_dirty", sql_for(UNMAPPED, ["stg_appointments", "stg_leads"], "faults"))
register("unparseable_amounts_dirty", sql_for(UNPARSEABLE, ["raw_payments"], "amounts"))


register("frequent_unmapped_dirty", sql_for("""
SELECT 'appointment_status' AS vocabulary, status_raw AS raw_value, count(*) AS n_rows FROM stg_appointments
WHERE status IS NULL AND status_raw IS NOT NULL GROUP BY status_raw
UNION ALL
SELECT 'lead_channel', lead_source_raw, count(*) FROM stg_leads WHERE channel IS NULL AND lead_source_raw IS NOT NULL GROUP BY lead_source_raw""",
                                            ["stg_appointments", "stg_leads"], "faults"))


# the keys that fail a test, counted; each test keeps its five smallest
KEYS = {
    "not_null": "SELECT {key} AS k, count(*) AS n FROM {model} WHERE {column} IS NULL GROUP BY ALL",
    "accepted": "SELECT {key} AS k, count(*) AS n FROM {model} WHERE {column} NOT IN ({values}) GROUP BY ALL",
    "unique": "SELECT CAST({column} AS VARCHAR) AS k, count(*) AS n FROM {model} WHERE {column} IS NOT NULL GROUP BY ALL HAVING count(*) > 1",
    "together": "SELECT concat_ws('|', {column}) AS k, count(*) AS n FROM {model} GROUP BY ALL HAVING count(*) > 1",
    "refers": "SELECT CAST(c.{column} AS VARCHAR) AS k, count(*) AS n FROM {model} c ANTI JOIN {parent} p ON p.{field} = c.{column} "
              "WHERE c.{column} IS NOT NULL GROUP BY ALL",
}
_reported = [f"SELECT '{name}' AS test_name, k AS failing_key, n AS n_rows FROM ({KEYS[test].format(**about)}) t" for test, name, about in _tests()]
register("dq_failing_keys_dirty", sql_for(f"""
SELECT test_name, row_number() OVER (PARTITION BY test_name ORDER BY failing_key) AS position, failing_key, n_rows
FROM ({' UNION ALL '.join(_reported)}) f
QUALIFY position <= 5""", [r for r in _reads if r not in TIE_OUTS.values()], "faults"))

# --- the KPI table of the raw tables as they stand after the second batch: built from all rows, nothing refreshed -----
_after = {}
for _t in _RAW:
    _key = {"locations": "location_id", "customers": "customer_id", "services": "service_id", "memberships": "membership_id",
            "appointments": "appointment_id", "payments": "payment_id", "leads": "lead_id"}[_t]
    _after[f"raw_{_t}"] = f"(SELECT * EXCLUDE (_batch_id, _loaded_at) FROM batch1_{_t} ANTI JOIN batch2_{_t} USING ({_key}) " \
                          f"UNION ALL SELECT * EXCLUDE (_batch_id, _loaded_at) FROM batch2_{_t})"


def _after_second_batch(model: str) -> str:
    """A model over the second state: its CTEs again, under names of their own, reading the merged raw tables."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n not in order and not n.startswith("raw_"):
            for d in _CTES[n][0]:
                visit(d)
            order.append(n)
    visit(model)
    batches = [f"batch{k}_{t}" for k in (1, 2) for t in _RAW]
    merged = [f"after_{raw} AS ({sql})" for raw, sql in _after.items()]
    names = sorted({*order, *_after}, key=len, reverse=True)
    body = [f"after_{n} AS (\n" + re.sub(r"\b(" + "|".join(names) + r")\b", r"after_\1", _CTES[n][1]) + "\n)" for n in order]
    head = sql_for("SELECT 1", batches).rsplit("\nSELECT 1", 1)[0]
    return head + ",\n" + ",\n".join(merged + body) + f"\nSELECT * FROM after_{model}"


register("kpi_refreshed", _after_second_batch("kpi_location_monthly"))
