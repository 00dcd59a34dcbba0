"""Column functions on hand-made edge rows."""

import pytest
from pyspark.errors import ArithmeticException, NumberFormatException, SparkRuntimeException
from pyspark.sql import functions as F

from kpiloom.functions import cleaning as c
from kpiloom.functions.numeric import ratio, round_half_away
from kpiloom.functions.vocabulary import CHANNEL_VOCABULARY, STATUS_VOCABULARY


def col(spark, values, expr, typ="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {typ}")
    return [r[0] for r in df.select(expr(F.col("x"))).collect()]


def test_tolerant_int(spark):
    assert col(spark, ["123.0", "1.5", " 12 ", None, "-2.5"], c.tolerant_int) == [123, 2, 12, None, -3]


def test_to_cents(spark):
    vals = ["$1,234.50", "-179.00", "$-179.00", " 5 ", "12.345", None]
    assert col(spark, vals, c.to_cents) == [123450, -17900, -17900, 500, 1235, None]


@pytest.mark.parametrize("bad", ["", "(12.00)"])
def test_to_cents_raises_on_garbage(spark, bad):
    with pytest.raises((NumberFormatException, SparkRuntimeException, ArithmeticException, Exception)):
        col(spark, [bad], c.to_cents)


def test_try_to_cents_reports_garbage_as_null(spark):
    assert col(spark, ["", "(12.00)", "$1.00"], c.try_to_cents) == [None, None, 100]


def test_test_account_flag_never_null(spark):
    rows = [(None, None), (None, "TEST"), (" X@Clinic-Test.com ", "Ana"), ("a@b.c", " test")]
    df = spark.createDataFrame(rows, "email string, first_name string")
    got = [r[0] for r in df.select(c.is_test_account("email", "first_name")).collect()]
    assert got == [False, True, True, False]


def test_normalize_email(spark):
    assert col(spark, ["  A@B.com ", "", "   ", None], c.normalize_email) == ["a@b.com", None, None, None]


def test_status_vocabulary(spark):
    vals = ["no-show", "No Show", " COMPLETE ", "Canceled", "rescheduled", None]
    got = col(spark, vals, lambda x: c.map_vocab(c.vocab_key(x, "- "), STATUS_VOCABULARY))
    assert got == ["no_show", "no_show", "completed", "cancelled", None, None]


def test_channel_vocabulary_keeps_hyphen(spark):
    got = col(spark, [" Walk-in ", "FB", "Referral", "tiktok"],
              lambda x: c.map_vocab(c.vocab_key(x, ""), CHANNEL_VOCABULARY))
    assert got == ["walk_in", "paid_social", "referral", None]


def test_proper_case(spark):
    assert col(spark, ["salt lake city", "SAN  DIEGO"], c.proper_case) == ["Salt Lake City", "San  Diego"]


def test_ratios_round_half_away_after_scaling(spark):
    df = spark.createDataFrame([(57, 800), (1, 3), (5, 0), (1, None)], "n int, d int")
    got = [r[0] for r in df.select(ratio("n", "d", 4)).collect()]
    # 57/800 = 0.07125 is stored just below the tie: scaling first gives 712.4999.. -> 0.0712
    assert got == [0.0712, 0.3333, None, None]
    got2 = [r[0] for r in df.select(ratio("n", "d", 4, empty=0.0)).collect()]
    assert got2[2:] == [0.0, 0.0]


def test_round_half_away(spark):
    df = spark.createDataFrame([(2.5,), (-2.5,), (0.125,)], "x double")
    assert [r[0] for r in df.select(round_half_away("x", 0)).collect()] == [3.0, -3.0, 0.0]


def test_a_new_spelling_is_reported_as_unmapped(spark):
    from kpiloom.operators.staging import stg_appointments, stg_leads, unmapped_values, vocabulary_audit
    appts = spark.createDataFrame(
        [("1", "1", "1", "1", "2025-01-01 09:00:00", "Completed", "t"),
         ("2", "1", "1", "1", "2025-01-02 09:00:00", "Rescheduled", "t")],
        "appointment_id string, customer_id string, location_id string, service_id string, "
        "scheduled_at string, status string, updated_at string")
    leads = spark.createDataFrame([("1", "1", "TikTok", "2025-01-01 09:00:00", None, "t")],
                                  "lead_id string, location_id string, lead_source string, created_at string, "
                                  "converted_customer_id string, updated_at string")
    got = {(r.vocabulary, r.raw_value, r.is_unmapped) for r in
           unmapped_values(vocabulary_audit(stg_appointments(appts), stg_leads(leads))).collect()}
    assert got == {("appointment_status", "Rescheduled", True), ("lead_channel", "TikTok", True)}
