"""Nothing landed is lost: restarts, small triggers, full refresh, batch ids, large ids, typed marks."""

import itertools
import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kpiloom.functions.cleaning import tolerant_int
from kpiloom.operators import ingest
from kpiloom.streaming import start_incremental_load

SCHEMA = T.StructType([T.StructField(n, T.StringType()) for n in ["id", "v", "updated_at"]])
FILES = [[("1", "a", "t5"), ("2", "b", "t1"), (None, "n", "t1")], [("3", "late", "t2"), ("1", "older", "t3"), ("4", "x", "t5")],
         [("4", "tie", "t5"), ("5", "no mark", None), ("2", "b2", "t1")]]


def run(query):
    query.awaitTermination(180)
    assert query.exception() is None


def contents(spark, root):
    return sorted(((r.id, r.v, r.updated_at) for r in ingest.read_raw(spark, root, "things").collect()), key=str)


def test_stream_result_does_not_depend_on_the_trigger(spark, scratch):
    got = []
    for k, (order, limit) in enumerate([((0, 1, 2), None), ((0, 1, 2), 1), ((2, 1, 0), 1)]):
        land, root = f"{scratch}/land{k}", f"{scratch}/wh{k}"
        for n, f in enumerate(order):
            spark.createDataFrame(FILES[f], SCHEMA).coalesce(1).write.parquet(f"{land}/f{n}")
        run(start_incremental_load(spark, f"{land}/*", SCHEMA, root, "things", "id", max_files_per_trigger=limit))
        got.append(contents(spark, root))
    assert got[0] == got[1] == got[2]
    assert [(i, v) for i, v, _ in got[0]] == [("1", "a"), ("2", "b2"), ("3", "late"), ("4", "x"), ("5", "no mark"), (None, "n")]
    mark = {r.table_name: r.high_watermark for r in ingest.read_log(spark, f"{scratch}/wh1").collect()}
    assert mark == {"things": "t5"}


def test_stream_restart_in_a_new_application(spark, scratch):
    """The default location of the stream's state must be the same in every application."""
    land, root = f"{scratch}/land", f"{scratch}/wh"
    code = ("import sys; from kpiloom.session import get_session; from kpiloom.streaming import start_incremental_load\n"
            "from pyspark.sql import types as T\n"
            "s = get_session('local[2]', shuffle_partitions=2)\n"
            "schema = T.StructType([T.StructField(n, T.StringType()) for n in ['id', 'v', 'updated_at']])\n"
            "q = start_incremental_load(s, sys.argv[1] + '/*', schema, sys.argv[2], 'things', 'id'); q.awaitTermination(180)\n")
    for k in range(2):
        spark.createDataFrame(FILES[k], SCHEMA).coalesce(1).write.parquet(f"{land}/f{k}")
        subprocess.run([sys.executable, "-c", code, land, root], check=True, timeout=240, cwd=os.path.dirname(os.path.dirname(__file__)))
    assert [i for i, _, _ in contents(spark, root)] == ["1", "2", "3", "4", None]


def test_merge_is_independent_of_the_split(spark):
    rows = [r for f in FILES for r in f]
    df = spark.createDataFrame(rows, SCHEMA)
    whole = sorted(map(tuple, ingest.merge_newest(None, df, "id").collect()), key=str)
    for order in itertools.islice(itertools.permutations(range(3)), 3):
        state = None
        for f in order:
            state = ingest.merge_newest(state, spark.createDataFrame(FILES[f], SCHEMA), "id")
        assert sorted(map(tuple, state.collect()), key=str) == whole


def test_full_refresh_takes_the_mark_back(spark, scratch):
    def load(rows, batch, full=False):
        return ingest.extract_load(spark, {"things": spark.createDataFrame(rows, SCHEMA)}, scratch, tables={"things": "id"}, batch_id=batch, full=full)["things"]
    assert load([("1", "a", "2024-06")], "000123") == 1
    assert load([("1", "a", "2024-03")], "000124", full=True) == 1
    assert load([("1", "a", "2024-03"), ("2", "b", "2024-04")], "000125") == 1
    assert [i for i, _, _ in contents(spark, scratch)] == ["1", "2"]          # and ids of digits only can be read back


def test_other_read_errors_are_not_taken_for_an_empty_log(spark, scratch):
    os.makedirs(f"{scratch}/meta/load_log/batch_id=b1")
    with open(f"{scratch}/meta/load_log/batch_id=b1/part-0.parquet", "w") as f:
        f.write("broken")
    with pytest.raises(Exception):
        ingest.extract_load(spark, {"things": spark.createDataFrame([("1", "a", "t")], SCHEMA)}, scratch, tables={"things": "id"})


def test_two_loads_at_once_do_not_both_commit(spark, scratch, monkeypatch):
    src = {"things": spark.createDataFrame([("1", "a", "t")], SCHEMA)}
    real = ingest._load_table

    def slow(*a, **k):
        out = real(*a, **k)
        monkeypatch.setattr(ingest, "_load_table", real)
        ingest.extract_load(spark, src, scratch, tables={"things": "id"}, batch_id="other")
        return out
    monkeypatch.setattr(ingest, "_load_table", slow)
    with pytest.raises(RuntimeError, match="another batch"):
        ingest.extract_load(spark, src, scratch, tables={"things": "id"}, batch_id="mine")
    assert ingest.committed(spark, scratch, "mine") is None


def test_large_ids(spark):
    got = spark.range(1).select(tolerant_int(F.lit("3000000000.0")).alias("a"), tolerant_int(F.lit("900000000000000001")).alias("b")).first()
    assert (got.a, got.b) == (3_000_000_000, 900_000_000_000_000_001)


def test_record_ids_never_collide(spark):
    from kpiloom.sources.crm import customers
    keys = [66, 10_000_066, 33, 10_000_033, 20_000_066, 2_147_483_649]
    df = spark.createDataFrame([(k, 1) for k in keys], "c_custkey long, c_nationkey long")
    ids = [r.customer_id for r in customers(df).collect()]
    assert len(ids) == len(set(ids)) > len(keys)


def test_typed_marks_reach_the_scan(spark, scratch, capsys):
    df = spark.range(10).select("id", F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_interval(0, 0, 0, cast(id as int))").alias("updated_at"))
    df.write.parquet(f"{scratch}/t")
    changed = ingest.extract_incremental(spark.read.parquet(f"{scratch}/t"), "2024-01-05 00:00:00")
    assert changed.count() == 5
    changed.explain("formatted")
    assert "GreaterThan(updated_at" in capsys.readouterr().out
    assert ingest.extract_incremental(spark.read.parquet(f"{scratch}/t"), None).count() == 10


def load(spark, root, rows, batch, **options):
    return ingest.extract_load(spark, {"things": spark.createDataFrame(rows, SCHEMA)}, root, tables={"things": "id"}, batch_id=batch, **options)["things"]


def test_batch_after_stream_loads_what_the_stream_never_saw(spark, scratch):
    """Marks are kept per channel: a landed row of June does not hide a source row of May."""
    april, may, june = ("1", "a", "2024-04"), ("2", "b", "2024-05"), ("9", "z", "2024-06")
    assert load(spark, scratch, [april], "b1") == 1
    assert load(spark, scratch, [june], "s1", landed=True) == 1
    assert load(spark, scratch, [april, may], "b2") == 1
    assert [i for i, _, _ in contents(spark, scratch)] == ["1", "2", "9"]
    marks = ingest.current_state(spark, scratch)["things"].marks
    assert marks == {"extract": "2024-05", "landed": "2024-06"}
    assert load(spark, scratch, [april, may], "b3") == 0


def test_a_small_batch_writes_its_own_rows_only(spark, scratch):
    load(spark, scratch, [(str(i), "x", "t1") for i in range(5000)], "b1")
    load(spark, scratch, [("7", "new", "t2")], "b2")
    written = spark.read.parquet(f"{scratch}/raw/things/delta=b2")
    assert written.count() == 1 and not os.path.exists(f"{scratch}/raw/things/base=b2")
    assert sum(os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(f"{scratch}/raw/things/delta=b2") for f in fs if f.endswith(".parquet")) < 4000
    assert ingest.read_raw(spark, scratch, "things").count() == 5000
    assert ingest.compact(spark, scratch) == ["things"] and ingest.compact(spark, scratch) == []
    assert ingest.current_state(spark, scratch)["things"].deltas == [] and ingest.read_raw(spark, scratch, "things").count() == 5000
    assert load(spark, scratch, [("7", "new", "t2")], "b3") == 0            # the mark survives compaction


def sequential(batches):
    """The table after each batch replaced or merged rows by key, in plain Python."""
    table = []
    for channel, rows in batches:
        if channel == "extract":
            gone = {r[0] for r in rows if r[0] is not None}
            table = [r for r in table if r[0] is None or r[0] not in gone] + rows
        else:
            both, best = table + rows, {}
            for r in both:
                if r[0] is not None and (r[0] not in best or (r[2] or "", r[1], r[2]) > (best[r[0]][2] or "", best[r[0]][1], best[r[0]][2])):
                    best[r[0]] = r
            table = list(best.values()) + [r for r in both if r[0] is None]
    return sorted(table, key=str)


@pytest.mark.parametrize("seed", range(4))
def test_deltas_stand_for_the_batches_in_order(spark, seed):
    import random
    r = random.Random(seed)
    batches = [(r.choice(["extract", "extract", "landed"]), [(r.choice(["1", "2", "3", "4", None]), f"v{n}.{i}", f"t{r.randrange(4)}") for i in range(r.randint(0, 4))])
               for n in range(6)]
    base = [(str(i), "base", "t1") for i in range(1, 4)]
    frames = [(spark.createDataFrame(rows, SCHEMA), c) for c, rows in batches]
    got = sorted(map(tuple, ingest.merge_deltas(spark.createDataFrame(base, SCHEMA), frames, "id").collect()), key=str)
    assert got == sequential([("extract", base), *batches])


def test_many_batches_write_a_base_now_and_then(spark, scratch):
    for n in range(5):
        load(spark, scratch, [(str(n % 3), f"v{n}", f"t{n}")], f"b{n}", compact_after=2)
    state = ingest.current_state(spark, scratch)["things"]
    assert (state.base, [b for b, _ in state.deltas], state.marks["extract"]) == ("b3", ["b4"], "t4")
    assert [v for _, v, _ in contents(spark, scratch)] == ["v3", "v4", "v2"]


def test_a_compacted_table_is_clustered_by_the_mark(spark, scratch):
    """What changed since a mark lies in few row groups; the others are skipped by their statistics."""
    import glob

    import pyarrow.parquet as pq
    rows = [(str(i), "x" * 50, f"t{i * 7919 % 5000:05d}") for i in range(5000)]
    load(spark, scratch, rows, "b1")
    load(spark, scratch, [("1", "y", "t09999")], "b2")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ingest.compact(spark, scratch, "c1")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    groups = []
    for f in glob.glob(f"{scratch}/raw/things/base=c1/*.parquet"):
        m = pq.ParquetFile(f).metadata
        column = m.schema.to_arrow_schema().names.index("updated_at")
        groups += [m.row_group(g).column(column).statistics.max for g in range(m.num_row_groups)]
    assert len(groups) > 4 and sum(g > "t04900" for g in groups) == 1
    assert ingest.read_raw(spark, scratch, "things").count() == 5000
