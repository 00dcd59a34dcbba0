"""Staging: typing and normalisation of the raw text tables (pure projections).

Each function is a single ``select`` over one raw table -- no shuffle; Catalyst
prunes the raw columns that are not used and fuses the expressions into one
whole-stage-codegen span with the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiloom.functions.cleaning import (
    is_test_account,
    map_vocab,
    normalize_email,
    proper_case,
    to_cents,
    tolerant_int,
    vocab_key,
)
from kpiloom.functions.vocabulary import (
    CHANNEL_VOCABULARY,
    STATUS_VOCABULARY,
    TEST_EMAIL_SUFFIX,
    TEST_FIRST_NAME,
    VOID_STATUS,
)


def _ts(c: str):
    # The platform's timestamps carry no zone: TIMESTAMP_NTZ end to end.
    return F.col(c).cast("timestamp_ntz").alias(c)


def stg_locations(raw: DataFrame) -> DataFrame:
    """City parsed from '<brand> - <city>' and proper-cased; name rebuilt; is_active."""
    city = proper_case(F.trim(F.split_part(F.trim(F.col("location_name")), F.lit(" - "), F.lit(2))))
    closed = F.col("closed_on").cast("date")
    return raw.select(
        tolerant_int("location_id").alias("location_id"),
        F.concat(F.split_part(F.col("brand"), F.lit(" "), F.lit(1)), F.lit(" - "), city).alias("location_name"),
        city.alias("city"),
        "brand",
        "ownership",
        "franchisee_id",
        F.col("opened_on").cast("date").alias("opened_on"),
        closed.alias("closed_on"),
        closed.isNull().alias("is_active"),
    )


def stg_customers(raw: DataFrame, test_suffix: str = TEST_EMAIL_SUFFIX,
                  test_first_name: str = TEST_FIRST_NAME) -> DataFrame:
    """Typed customers with the normalised e-mail and the never-null test flag."""
    return raw.select(
        tolerant_int("customer_id").alias("customer_id"),
        "first_name",
        "last_name",
        normalize_email("email").alias("email_normalized"),
        tolerant_int("home_location_id").alias("home_location_id"),
        _ts("created_at"),
        is_test_account("email", "first_name", test_suffix, test_first_name).alias("is_test_account"),
    )


def stg_services(raw: DataFrame) -> DataFrame:
    """Typed services; ``category`` becomes ``service_category``."""
    return raw.select(
        tolerant_int("service_id").alias("service_id"),
        "service_name",
        F.col("category").alias("service_category"),
        F.col("list_price").cast("decimal(10,2)").alias("list_price"),
    )


def stg_memberships(raw: DataFrame) -> DataFrame:
    """Typed memberships (decimal fee, dates)."""
    return raw.select(
        tolerant_int("membership_id").alias("membership_id"),
        tolerant_int("customer_id").alias("customer_id"),
        tolerant_int("location_id").alias("location_id"),
        "plan_name",
        F.col("monthly_fee").cast("decimal(10,2)").alias("monthly_fee"),
        F.col("start_date").cast("date").alias("start_date"),
        F.col("end_date").cast("date").alias("end_date"),
    )


def stg_appointments(raw: DataFrame, vocabulary: dict[str, list[str]] = STATUS_VOCABULARY) -> DataFrame:
    """Status spellings collapse to a controlled vocabulary; the raw text is kept."""
    return raw.select(
        tolerant_int("appointment_id").alias("appointment_id"),
        tolerant_int("customer_id").alias("customer_id"),
        tolerant_int("location_id").alias("location_id"),
        tolerant_int("service_id").alias("service_id"),
        _ts("scheduled_at"),
        map_vocab(vocab_key("status", "- "), vocabulary).alias("status"),
        F.col("status").alias("status_raw"),
    )


def stg_payments(raw: DataFrame, void_status: str = VOID_STATUS) -> DataFrame:
    """Money text to integer cents; ``is_void`` is null when the status is null."""
    return raw.select(
        tolerant_int("payment_id").alias("payment_id"),
        tolerant_int("customer_id").alias("customer_id"),
        tolerant_int("location_id").alias("location_id"),
        tolerant_int("appointment_id").alias("appointment_id"),
        tolerant_int("membership_id").alias("membership_id"),
        "payment_type",
        to_cents("amount").alias("amount_cents"),
        (F.col("payment_status") == F.lit(void_status)).alias("is_void"),
        _ts("paid_at"),
    )


def stg_leads(raw: DataFrame, vocabulary: dict[str, list[str]] = CHANNEL_VOCABULARY) -> DataFrame:
    """Typed leads with the channel vocabulary; the raw source is kept."""
    return raw.select(
        tolerant_int("lead_id").alias("lead_id"),
        tolerant_int("location_id").alias("location_id"),
        F.col("lead_source").alias("lead_source_raw"),
        map_vocab(vocab_key("lead_source", ""), vocabulary).alias("channel"),
        _ts("created_at"),
        tolerant_int("converted_customer_id").alias("converted_customer_id"),
    )


STAGING = {
    "locations": stg_locations,
    "customers": stg_customers,
    "services": stg_services,
    "memberships": stg_memberships,
    "appointments": stg_appointments,
    "payments": stg_payments,
    "leads": stg_leads,
}


def stage_all(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Staging for every raw table given (name -> staged DataFrame)."""
    return {name: STAGING[name](df) for name, df in raw.items()}


def vocabulary_audit(stg_appts: DataFrame, stg_lds: DataFrame) -> DataFrame:
    """Every raw spelling with the value it maps to and its row count.

    ``is_unmapped`` rows are the spellings the vocabulary does not know yet
    (they became null and fail the not-null test). Aggregated map-side, so a
    single very common spelling costs one partial row per task.
    """
    a = stg_appts.groupBy(F.col("status_raw").alias("raw_value"), F.col("status").alias("mapped_value")).agg(
        F.count(F.lit(1)).alias("n_rows")).withColumn("vocabulary", F.lit("appointment_status"))
    b = stg_lds.groupBy(F.col("lead_source_raw").alias("raw_value"), F.col("channel").alias("mapped_value")).agg(
        F.count(F.lit(1)).alias("n_rows")).withColumn("vocabulary", F.lit("lead_channel"))
    return a.unionByName(b).select(
        "vocabulary", "raw_value", "mapped_value", "n_rows",
        (F.col("mapped_value").isNull() & F.col("raw_value").isNotNull()).alias("is_unmapped"))


def unmapped_values(audit: DataFrame) -> DataFrame:
    """Only the spellings that did not map (empty when the vocabularies are complete)."""
    return audit.where(F.col("mapped_value").isNull())


def frequent_unmapped(stg_appts: DataFrame, stg_lds: DataFrame, k: int = 20, tracked: int = 1024) -> DataFrame:
    """(vocabulary, raw_value, n_rows): the most frequent spellings that the vocabularies do not know, at most ``k`` each.

    Free text may hold as many spellings as rows. So a frequent-items sketch of fixed size per vocabulary names the
    candidates (summaries are built per task and merge), and only those are counted exactly; a spelling with more than
    8/``tracked`` of the unknown ones is always among them, as far as ``k`` reaches. Its candidates are few, so they are sent to
    every task.
    """
    def unknown(df: DataFrame, name: str, raw: str, value: str) -> DataFrame:
        return df.where(F.col(value).isNull() & F.col(raw).isNotNull()).select(F.lit(name).alias("vocabulary"), F.col(raw).alias("raw_value"))

    rows = unknown(stg_appts, "appointment_status", "status_raw", "status").unionByName(unknown(stg_lds, "lead_channel", "lead_source_raw", "channel"))
    listed = rows.groupBy("vocabulary").agg(F.expr(f"approx_top_k(raw_value, {k}, {tracked})").alias("top")).select(
        "vocabulary", F.explode("top.item").alias("raw_value"))
    return rows.join(F.broadcast(listed), ["vocabulary", "raw_value"], "left_semi").groupBy("vocabulary", "raw_value").agg(F.count("*").alias("n_rows"))
