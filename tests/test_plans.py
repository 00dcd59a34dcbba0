"""Physical-plan properties, read from ``explain()`` output."""

import re

from kpiloom.operators import ingest
from kpiloom.plans.models import Models
from kpiloom.plans.queries import QUERIES
from conftest import SF_SMALL


def plan_text(df, capsys):
    df.explain(mode="formatted")
    return capsys.readouterr().out


def test_mart_has_no_nested_loop_cartesian_or_python(spark, capsys):
    p = plan_text(Models.from_testdata(spark, SF_SMALL).kpi_location_monthly, capsys)
    for bad in ["BroadcastNestedLoopJoin", "CartesianProduct", "BatchEvalPython", "ArrowEvalPython",
                "FlatMapGroupsInPandas"]:
        assert bad not in p
    assert "Generate" in p            # month ranges come from explode(sequence), not a range join


def test_suite_and_tie_outs_have_no_cartesian(spark, capsys):
    from kpiloom.plans import checks
    p = plan_text(checks.suite_results(Models.from_testdata(spark, SF_SMALL)), capsys)
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_watermark_is_pushed_into_the_scan(spark, scratch, capsys):
    df = spark.createDataFrame([("1", "2025-01-01 00:00:00")], "id string, updated_at string")
    df.write.parquet(f"{scratch}/src")
    p = plan_text(ingest.extract_incremental(spark.read.parquet(f"{scratch}/src"), "2024-12-31 00:00:00"), capsys)
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThan\(updated_at,2024-12-31 00:00:00\)", p)


def test_unused_columns_are_pruned_from_the_scan(spark, capsys):
    p = plan_text(Models.from_testdata(spark, SF_SMALL).fct_appointments, capsys)
    part_scans = [s for s in re.findall(r"ReadSchema: struct<([^>]*)>", p) if "p_partkey" in s]
    assert part_scans and all("p_name" not in s and "p_retailprice" not in s for s in part_scans)


def test_scale_settings_size_partitions_to_the_input():
    from kpiloom.session import scale_settings
    s = scale_settings(100 * 1024 ** 4, 8000)            # 100 TB on 8000 cores
    assert int(s["spark.sql.shuffle.partitions"]) == 20_000          # what a driver can keep track of
    assert s["spark.sql.files.maxPartitionBytes"] == str(1024 ** 3)
    small = scale_settings(10 * 1024 ** 2, 8)            # tiny input: at least 2 x cores
    assert small["spark.sql.shuffle.partitions"] == "16"
    assert small["spark.sql.adaptive.advisoryPartitionSizeInBytes"] == str(256 * 1024 ** 2)


def test_rollups_aggregate_map_side_first(spark, capsys):
    from kpiloom.operators import mart
    m = Models.from_testdata(spark, SF_SMALL)
    rev = plan_text(mart.revenue_rollup(m.fct_payments), capsys)
    act = plan_text(mart.activity_rollup(m.fct_appointments, m.fct_membership_months, m.fct_leads), capsys)
    assert "partial_sum" in rev and "partial_sum" in act      # a hot location costs one partial row per task


def test_cli_runs_the_platform(spark, scratch):
    from kpiloom.__main__ import main
    assert main(["--sf-dir", SF_SMALL, "--root", scratch]) == 0


def test_small_batch_upsert_does_not_shuffle_the_target(spark, scratch, capsys):
    target = spark.range(200000).selectExpr("cast(id as string) as id", "'v' as v", "'t1' as updated_at")
    target.write.parquet(f"{scratch}/target")
    batch = spark.createDataFrame([("5", "w", "t2"), ("999999999", "x", "t2")], "id string, v string, updated_at string")
    batch.write.parquet(f"{scratch}/batch")
    up = ingest.upsert(spark.read.parquet(f"{scratch}/target"), spark.read.parquet(f"{scratch}/batch"), "id")
    p = plan_text(up, capsys)
    assert "BroadcastHashJoin" in p and "LeftAnti" in p
    assert "SortMergeJoin" not in p                   # the big side is only scanned and filtered


FORBIDDEN = ["BroadcastNestedLoopJoin", "CartesianProduct", "BatchEvalPython", "ArrowEvalPython",
             "FlatMapGroupsInPandas", "MapInPandas"]


def test_no_registered_query_uses_nested_loops_cartesians_or_python(spark, capsys):
    offenders = {}
    for name, q in sorted(QUERIES.items()):
        p = plan_text(q(spark, SF_SMALL), capsys)
        hits = [f for f in FORBIDDEN if f in p]
        if hits:
            offenders[name] = hits
    assert offenders == {}


def test_ordered_extract_sorts_within_partitions_only(spark, capsys):
    src = spark.range(1000).selectExpr("cast(id as string) as id", "cast(id % 97 as string) as updated_at")
    out = ingest.extract_incremental(src, "", ordered=True)
    p = plan_text(out, capsys)
    assert re.search(r"Arguments: \[updated_at#\d+ ASC NULLS FIRST\], false", p)   # not a global sort
    assert "Exchange" not in p                                                      # no shuffle
    assert out.count() == 1000


def test_data_tests_aggregate_dealt_rows(spark, capsys):
    """Rows of a tested model are dealt by its keys before the map side of an aggregate may hold them: a task that reads a
    whole file, or explodes its rows, does not hold all their keys."""
    from kpiloom.operators.quality import Check, failing_keys, run_suite
    rows = spark.range(0, 1000, 1, 1).selectExpr("id AS k", "IF(id = 7, NULL, id % 5) AS place", "'x' AS unused")
    models, tests = {"m": rows.unionByName(rows.where("k < 3"))}, [Check("m", "unique", ("k",)), Check("m", "not_null", ("place",))]
    for df in (run_suite(models, tests), failing_keys(models, tests, {"m": ("k",)})):
        assert re.search(r"hashpartitioning\(k#\d+L, \d+\), REPARTITION_BY_COL", plan_text(df, capsys))
    assert {r.test_name: r.failures for r in run_suite(models, tests).collect()} == {"unique_m_k": 3, "not_null_m_place": 1}
    got = failing_keys(models, tests, {"m": ("k",)}).collect()
    assert sorted((r.test_name, r.failing_key, r.n_rows) for r in got) == [("not_null_m_place", "7", 1), *[("unique_m_k", str(i), 2) for i in range(3)]]


def test_advisory_partition_size_is_a_default(spark):
    from kpiloom.session import ADVISORY, configure
    key = ADVISORY[0]
    try:
        spark.conf.unset(key)
        assert configure(spark).conf.get(key) == "8MB"
        spark.conf.set(key, "256MB")
        assert configure(spark).conf.get(key) == "256MB"
    finally:
        spark.conf.unset(key)
