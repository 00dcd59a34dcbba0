"""Hot keys and null keys give exact results; the month axis is inclusive."""

import datetime as dt

from pyspark.sql import functions as F

from kpiloom.operators import certified, identity, mart, serving
from kpiloom.operators.joins import left_join_spread_nulls


def test_month_axis_inclusive(spark):
    got = [r.month_start for r in mart.month_axis(spark, "2025-01-01", "2026-06-01").collect()]
    assert len(got) == 18 and got[0] == dt.date(2025, 1, 1) and got[-1] == dt.date(2026, 6, 1)


def test_identity_with_one_hot_email(spark):
    n = 3000
    df = spark.range(n).select(
        F.col("id").cast("int").alias("customer_id"), F.lit("F").alias("first_name"), F.lit("L").alias("last_name"),
        F.when(F.col("id") % 3 == 0, F.lit("hot@x.com"))
         .when(F.col("id") % 3 == 1, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("u"), F.col("id").cast("string"), F.lit("@x.com"))).alias("email_normalized"),
        F.lit(1).alias("home_location_id"), F.lit(dt.datetime(2025, 1, 1)).cast("timestamp_ntz").alias("created_at"),
        F.lit(False).alias("is_test_account"))
    ids = identity.int_customer_identity(df.repartition(7))
    got = ids.groupBy("master_customer_id").count()
    assert got.where("master_customer_id = 0").first()["count"] == n // 3        # all hot records merged
    assert ids.where("email_normalized is null and master_customer_id <> customer_id").count() == 0
    assert got.count() == 1 + 2 * n // 3


def test_left_join_spread_nulls_is_a_left_join(spark):
    left = spark.createDataFrame([(i, None if i % 4 else i % 8) for i in range(400)], "rid int, k int")
    right = spark.createDataFrame([(0, "zero"), (4, "four")], "rk int, name string")
    j = left_join_spread_nulls(left, right, "k", "rk", "rid")
    assert j.count() == 400
    assert j.where("name = 'zero'").count() == 50 and j.where("name = 'four'").count() == 50
    assert set(j.columns) == {"rid", "k", "name"}


def test_leads_mostly_unconverted(spark):
    leads = spark.range(1000).select(
        F.col("id").cast("int").alias("lead_id"), F.lit(1).alias("location_id"), F.lit("x").alias("lead_source_raw"),
        F.lit("organic").alias("channel"), F.lit(dt.datetime(2025, 2, 3)).cast("timestamp_ntz").alias("created_at"),
        F.when(F.col("id") % 10 == 0, (F.col("id") % 3).cast("int")).alias("converted_customer_id"))
    ids = spark.createDataFrame([(0, 0, None, False), (1, 0, None, False), (2, 2, None, True)],
                                "customer_id int, master_customer_id int, email_normalized string, "
                                "is_test_account boolean")
    f = certified.fct_leads(leads, ids)
    assert f.count() == 1000
    # converted ids 0 and 1 are real (master 0); id 2 is a test account, so not converted
    assert f.where("is_converted").count() == leads.where("converted_customer_id in (0, 1)").count()
    assert f.where("is_converted and converted_customer_id <> 0").count() == 0


def test_by_brand(spark):
    kpi = spark.createDataFrame([("A", 1), ("B", 2)], "brand string, x int")
    assert serving.by_brand(kpi).count() == 2 and serving.by_brand(kpi, "B").first().x == 2


SKEW_CONF = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
             "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1024",
             "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
             "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4096",
             "spark.sql.adaptive.coalescePartitions.enabled": "false"}


class _conf:
    """Temporarily force shuffle joins and tiny skew thresholds (what 100 TB looks like to AQE)."""

    def __init__(self, spark):
        self.spark = spark

    def __enter__(self):
        self.old = {k: self.spark.conf.get(k, None) for k in SKEW_CONF}
        for k, v in SKEW_CONF.items():
            self.spark.conf.set(k, v)

    def __exit__(self, *exc):
        for k, v in self.old.items():
            if v is None:
                self.spark.conf.unset(k)
            else:
                self.spark.conf.set(k, v)


def _final_plan(df, capsys):
    rows = df.collect()                   # run this DataFrame's own plan, then read AQE's final plan
    capsys.readouterr()
    df.explain()
    return rows, capsys.readouterr().out


def test_hot_customer_is_split_by_aqe(spark, capsys):
    n = 30000
    pays = spark.range(n).select(
        F.col("id").cast("int").alias("payment_id"),
        F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise((F.col("id") % 3000).cast("int")).alias("customer_id"),
        F.lit(1).alias("location_id"), F.lit(None).cast("int").alias("appointment_id"),
        F.lit(None).cast("int").alias("membership_id"), F.lit("service").alias("payment_type"),
        F.lit(100).cast("bigint").alias("amount_cents"), F.lit(False).alias("is_void"),
        F.lit(dt.datetime(2025, 1, 1)).cast("timestamp_ntz").alias("paid_at"))
    ids = spark.range(3000).select(
        F.col("id").cast("int").alias("customer_id"), F.col("id").cast("int").alias("master_customer_id"),
        F.lit(None).cast("string").alias("email_normalized"), (F.col("id") == 2).alias("is_test_account"))
    with _conf(spark):
        rows, plan = _final_plan(certified.fct_payments(pays, ids), capsys)
    assert len(rows) == n - 10                         # customer 2 is a test account: its 10 payments go
    assert "skew=true" in plan                         # the third of the rows on customer 1 was split


def test_hot_email_identity_is_split_by_aqe(spark, capsys):
    n = 30000
    stg = spark.range(n).select(
        F.col("id").cast("int").alias("customer_id"), F.lit("F").alias("first_name"), F.lit("L").alias("last_name"),
        F.when(F.col("id") % 3 == 0, F.lit("hot@x.com"))
         .otherwise(F.concat(F.lit("u"), F.col("id").cast("string"), F.lit("@x.com"))).alias("email_normalized"),
        F.lit(1).alias("home_location_id"), F.lit(dt.datetime(2025, 1, 1)).cast("timestamp_ntz").alias("created_at"),
        F.lit(False).alias("is_test_account"))
    with _conf(spark):
        rows, plan = _final_plan(identity.int_customer_identity(stg), capsys)
    assert sum(1 for r in rows if r.master_customer_id == 0) == n // 3
    assert "skew=true" in plan
