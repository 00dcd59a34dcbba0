"""Incremental extract-load: upsert, marks, idempotence, change pick-up, streaming."""

import datetime as dt
import os

from pyspark.sql import functions as F

from kpiloom.operators import ingest
from kpiloom.sources.crm import raw_tables

SCHEMA = "id string, v string, updated_at string"
T0 = dt.datetime(2026, 1, 1)


def test_upsert_replaces_and_adds(spark):
    target = spark.createDataFrame([("1", "a", "t1"), ("2", "b", "t1")], SCHEMA)
    batch = spark.createDataFrame([("2", "b2", "t2"), ("3", "c", "t2")], SCHEMA)
    got = sorted(tuple(r) for r in ingest.upsert(target, batch, "id").collect())
    assert got == [("1", "a", "t1"), ("2", "b2", "t2"), ("3", "c", "t2")]
    empty = spark.createDataFrame([], SCHEMA)
    assert sorted(tuple(r) for r in ingest.upsert(target, empty, "id").collect()) == sorted(
        tuple(r) for r in target.collect())


def test_upsert_never_replaces_null_key(spark):
    target = spark.createDataFrame([(None, "a", "t1")], SCHEMA)
    batch = spark.createDataFrame([(None, "b", "t2")], SCHEMA)
    assert ingest.upsert(target, batch, "id").count() == 2


def test_watermark_is_strict_string_compare(spark):
    src = spark.createDataFrame([("1", "a", "2025-01-01 00:00:00"), ("2", "b", "2025-01-02 00:00:00"),
                                 ("3", "c", None)], SCHEMA)
    got = [r.id for r in ingest.extract_incremental(src, "2025-01-01 00:00:00").collect()]
    assert got == ["2"]                      # the tie is not loaded, nor the null
    got = sorted(r.id for r in ingest.extract_incremental(src, "2025-01-01 00:00:00", inclusive=True).collect())
    assert got == ["1", "2"]
    assert ingest.extract_incremental(src, "").count() == 2


def test_latest_by_key(spark):
    df = spark.createDataFrame([("1", "old", "t1"), ("1", "new", "t2"), ("2", "x", "t1")], SCHEMA)
    assert sorted(tuple(r) for r in ingest.latest_by_key(df, "id").collect()) == [("1", "new", "t2"),
                                                                                   ("2", "x", "t1")]


def test_to_raw_text_and_audit(spark):
    df = spark.createDataFrame([(1, 2.5, dt.date(2025, 1, 2))], "a int, b double, c date")
    out = ingest.with_audit(ingest.to_raw_text(df), "b1", T0)
    r = out.first()
    assert (r.a, r.b, r.c, r._batch_id, r._loaded_at) == ("1", "2.5", "2025-01-02", "b1", T0)
    assert dict(out.dtypes)["_loaded_at"] == "timestamp_ntz"


def test_extract_load_idempotent_and_picks_up_changes(spark, scratch):
    src = raw_tables(spark, "/root/testdata/sf0.001")
    first = ingest.extract_load(spark, src, scratch, batch_id="bfirst")
    assert all(n > 0 for n in first.values())
    again = ingest.extract_load(spark, src, scratch, batch_id="bsecond")
    assert sum(again.values()) == 0           # nothing new, nothing loaded
    pays = ingest.read_raw(spark, scratch, "payments")
    assert pays.count() == first["payments"]
    # one new payment of $1,000.00 with a later updated_at
    new = spark.createDataFrame(
        [("999999", "1", "1", None, None, "service", "$1,000.00", "settled", "2026-06-30 12:00:00",
          "2099-01-01 00:00:00")], src["payments"].schema)
    changed = {**src, "payments": src["payments"].unionByName(new)}
    third = ingest.extract_load(spark, changed, scratch, batch_id="bthird")
    assert third["payments"] == 1 and sum(third.values()) == 1
    pays = ingest.read_raw(spark, scratch, "payments")
    assert pays.count() == first["payments"] + 1
    assert pays.where("payment_id = '999999'").select("_batch_id").first()[0] == "bthird"
    # a replayed batch id is recognised as committed and changes nothing
    assert ingest.extract_load(spark, changed, scratch, batch_id="bthird") == third
    log = ingest.read_log(spark, scratch)
    assert log.count() == 3 * 7
    summary = {r.table_name: r.rows_loaded for r in ingest.load_summary(log, "bthird").collect()}
    assert summary == third                       # A11: table -> rows loaded, zeros included
    marks = {r.table_name: r.mark for r in log.groupBy("table_name").agg(F.max("high_watermark").alias("mark"))
             .collect()}
    assert marks["payments"] == "2099-01-01 00:00:00"


def test_empty_first_batch_still_creates_the_table(spark, scratch):
    empty = spark.createDataFrame([], SCHEMA)
    got = ingest.extract_load(spark, {"things": empty}, scratch, tables={"things": "id"}, batch_id="b1")
    assert got == {"things": 0}
    assert ingest.read_raw(spark, scratch, "things").count() == 0


def test_full_refresh_reloads_everything(spark, scratch):
    src = {"things": spark.createDataFrame([("1", "a", "t1"), ("2", "b", "t1")], SCHEMA)}
    ingest.extract_load(spark, src, scratch, tables={"things": "id"}, batch_id="b1")
    smaller = {"things": spark.createDataFrame([("1", "a", "t1")], SCHEMA)}
    assert ingest.extract_load(spark, smaller, scratch, tables={"things": "id"}, batch_id="b2") == {"things": 0}
    assert ingest.extract_load(spark, smaller, scratch, tables={"things": "id"}, batch_id="b3",
                               full=True) == {"things": 1}
    assert ingest.read_raw(spark, scratch, "things").count() == 1       # the delete propagated


def test_streaming_foreach_batch_upsert(spark, scratch):
    from pyspark.sql import types as T

    from kpiloom.streaming import start_incremental_load
    land = os.path.join(scratch, "landing")
    schema = T.StructType([T.StructField(n, T.StringType()) for n in ["id", "v", "updated_at"]])
    spark.createDataFrame([("1", "a", "t1"), ("2", "b", "t1")], schema).write.parquet(f"{land}/f1")
    root = os.path.join(scratch, "wh")
    q = start_incremental_load(spark, f"{land}/*", schema, root, "things", "id",
                               checkpoint=os.path.join(scratch, "ckpt"))
    q.awaitTermination(120)
    assert ingest.read_raw(spark, root, "things").count() == 2
    spark.createDataFrame([("2", "b2", "t2"), ("3", "c", "t2")], schema).write.parquet(f"{land}/f2")
    q = start_incremental_load(spark, f"{land}/*", schema, root, "things", "id",
                               checkpoint=os.path.join(scratch, "ckpt"))
    q.awaitTermination(120)
    got = sorted((r.id, r.v) for r in ingest.read_raw(spark, root, "things").collect())
    assert got == [("1", "a"), ("2", "b2"), ("3", "c")]


def test_dedupe_keeps_the_newest_row_per_key(spark, scratch):
    src = {"things": spark.createDataFrame([("1", "old", "t1"), ("1", "new", "t2"), ("2", "x", "t1")], SCHEMA)}
    ingest.extract_load(spark, src, f"{scratch}/a", tables={"things": "id"}, batch_id="b1")
    assert ingest.read_raw(spark, f"{scratch}/a", "things").count() == 3        # default: duplicates kept
    ingest.extract_load(spark, src, f"{scratch}/b", tables={"things": "id"}, batch_id="b1", dedupe=True)
    got = sorted((r.id, r.v) for r in ingest.read_raw(spark, f"{scratch}/b", "things").collect())
    assert got == [("1", "new"), ("2", "x")]
