"""Incremental, idempotent extract-load into the raw layer.

Pure operators (no side effects) come first; :func:`extract_load` then runs
them against a parquet warehouse root:

    <root>/raw/<table>/base=<batch_id>/        a full table
    <root>/raw/<table>/delta=<batch_id>/       the rows of one later batch
    <root>/meta/load_log/batch_id=<batch_id>/  one row per table per batch

A batch writes its own rows only; :func:`read_raw` merges a table's base with
the deltas since (:func:`merge_deltas`), and :func:`compact` writes a new base.
The load log is the commit point: a batch only counts once its log partition
exists, and every write targets a path owned by its batch id, so a retried
batch (lost executor, restarted driver) overwrites its own output and changes
nothing else. Only metadata-sized scalars (marks, row counts) reach the driver.

Marks are kept per channel: what a stream landed says nothing about how far
the source was extracted, so neither hides rows from the other.
"""

from __future__ import annotations

import datetime as dt
import uuid
from concurrent.futures import ThreadPoolExecutor
from itertools import groupby
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

from kpiloom.functions.vocabulary import TABLES
from kpiloom.operators.joins import left_join_spread_nulls

WATERMARK_COLUMN = "updated_at"
EXTRACT, LANDED = "extract", "landed"      # channels
COMPACT_AFTER = 16                          # deltas after which a batch writes a new base
LOG_SCHEMA = T.StructType([
    T.StructField("table_name", T.StringType(), False),
    T.StructField("rows_loaded", T.LongType(), False),
    T.StructField("high_watermark", T.StringType(), True),
    T.StructField("loaded_at", T.TimestampNTZType(), False),
    T.StructField("seq", T.LongType(), False),
    T.StructField("channel", T.StringType(), False),
    T.StructField("wrote", T.StringType(), False),           # base, delta or nothing
    T.StructField("key_column", T.StringType(), False),
])


# --- pure operators ------------------------------------------------------------
def extract_incremental(source: DataFrame, mark: str | None, col: str = WATERMARK_COLUMN,
                        inclusive: bool = False, ordered: bool = False) -> DataFrame:
    """Rows changed since ``mark``: ``col > mark`` as a string comparison.

    Strictly greater by default (a late row with an equal or smaller value is
    not picked up; null values never are). ``inclusive=True`` re-reads rows
    equal to the mark, which the key upsert makes harmless. The mark is cast to
    the column's own type, so the predicate is a plain comparison on the column
    and is pushed into the parquet/JDBC scan whatever that type is.
    """
    kind = source.schema[col].dataType
    c = F.col(col)
    if isinstance(kind, T.StringType):
        bound = F.lit(mark or "")
    else:
        bound = F.lit(mark).cast(kind) if mark else None
    if bound is None:
        out = source.where(c.isNotNull())
    else:
        out = source.where(c >= bound if inclusive else c > bound)
    # A4: ordered extract. Sorting within partitions (no shuffle) does not change
    # the result; written files are then clustered by the watermark column, so
    # parquet min/max statistics let later ``col > mark`` reads skip row groups.
    return out.sortWithinPartitions(col) if ordered else out


def to_raw_text(df: DataFrame) -> DataFrame:
    """Every column cast to string, no cleaning (typing is staging's job)."""
    return df.select([F.col(c).cast("string").alias(c) for c in df.columns])


def _ntz(ts: dt.datetime):
    # from text, so neither the Python process's zone nor the session zone can shift it
    return F.lit(ts.isoformat(sep=" ")).cast("timestamp_ntz")


def with_audit(df: DataFrame, batch_id: str, loaded_at: dt.datetime) -> DataFrame:
    """``_batch_id`` and naive-UTC ``_loaded_at`` on every row."""
    return df.withColumns({"_batch_id": F.lit(batch_id), "_loaded_at": _ntz(loaded_at)})


def load_frame(source: DataFrame, mark: str | None, batch_id: str, loaded_at: dt.datetime,
               ordered: bool = False) -> DataFrame:
    """A3 + A4 + A5 + A6: the batch as it lands in raw."""
    return with_audit(to_raw_text(extract_incremental(source, mark, ordered=ordered)), batch_id, loaded_at)


def upsert(target: DataFrame | None, incoming: DataFrame, key: str) -> DataFrame:
    """Replace every target row whose key is in the batch, then add the batch.

    ``left_anti`` on the key (shuffle on the key; the batch side is broadcast
    when measured small) plus ``unionByName``. Duplicates inside one batch
    are kept, deletes are not propagated -- the same contract as
    delete-then-insert. A null target key is never replaced.
    """
    if target is None:
        return incoming
    keys = incoming.select(F.col(key).alias("__k")).where(F.col("__k").isNotNull())
    # null target keys never match; they are spread instead of filling one task
    kept = left_join_spread_nulls(target, keys, key, "__k", how="left_anti")
    return kept.unionByName(incoming)


def latest_by_key(df: DataFrame, key: str, col: str = WATERMARK_COLUMN) -> DataFrame:
    """Optional de-duplication inside a batch: the newest row per key.

    Done as ``max_by`` over a struct so a hot key is combined map-side.
    """
    cols = [c for c in df.columns if c != key]
    agg = df.groupBy(key).agg(F.max_by(F.struct(*cols), F.col(col)).alias("__row"))
    return agg.select(key, "__row.*").select(*df.columns)


def merge_newest(target: DataFrame | None, incoming: DataFrame, key: str, col: str = WATERMARK_COLUMN) -> DataFrame:
    """For each key the row with the newest ``col``, be it stored or incoming (a null counts as oldest).

    Ties go by the row's own data, never by arrival, so the result is the same
    however landed rows are split into batches. Rows without a key are all kept.
    Combined map-side, so a hot key is not gathered in one task.
    """
    both = incoming if target is None else target.unionByName(incoming)
    data = [c for c in both.columns if c not in (key, "_batch_id", "_loaded_at")]
    audit = [c for c in ("_batch_id", "_loaded_at") if c in both.columns]
    order = F.struct(F.coalesce(F.col(col).cast("string"), F.lit("")).alias("__at"), *data, *audit)
    newest = both.where(F.col(key).isNotNull()).groupBy(key).agg(F.max(order).alias("__row"))
    rows = newest.select(key, *[F.col(f"__row.{c}").alias(c) for c in (*data, *audit)]).select(*both.columns)
    return rows.unionByName(both.where(F.col(key).isNull()))


def merge_deltas(base: DataFrame | None, deltas: list[tuple[DataFrame, str]], key: str) -> DataFrame:
    """The table that ``base`` and its deltas (rows, channel), oldest first, stand for.

    Extracted deltas replace rows by key, the latest batch of a key wins with all its rows; landed ones compete by
    ``updated_at``. Consecutive deltas of a channel are merged in one step, so the plan does not grow with their number.
    """
    out = base
    for channel, run in groupby(deltas, key=lambda d: d[1]):
        frames = [d for d, _ in run]
        if channel == LANDED:
            rows = frames[0]
            for f in frames[1:]:
                rows = rows.unionByName(f)
            out = merge_newest(out, rows, key)
            continue
        rows = frames[0]
        if len(frames) > 1:
            rows = frames[0].withColumn("__n", F.lit(0))
            for n, f in enumerate(frames[1:], 1):
                rows = rows.unionByName(f.withColumn("__n", F.lit(n)))
            last = rows.groupBy(F.col(key).alias("__k")).agg(F.max("__n").alias("__last"))
            latest = rows.join(last, (F.col(key) == F.col("__k")) & (F.col("__n") == F.col("__last")), "left_semi")
            rows = latest.unionByName(rows.where(F.col(key).isNull())).drop("__n")
        out = upsert(out, rows, key)
    return out


def batch_stats(batches: dict[str, DataFrame], col: str = WATERMARK_COLUMN) -> DataFrame:
    """(table_name, rows_loaded, batch_mark) -- one global aggregate per batch, unioned."""
    parts = [b.agg(F.count(F.lit(1)).alias("rows_loaded"), F.max(F.col(col).cast("string")).alias("batch_mark"))
             .select(F.lit(t).alias("table_name"), "rows_loaded", "batch_mark") for t, b in batches.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def advance_watermarks(state: DataFrame | None, stats: DataFrame) -> DataFrame:
    """New (table_name, high_watermark): tables with rows take the batch's max;
    the others keep their mark.

    The replace-by-key of the small state table is a union and one
    ``groupBy(table_name)`` in which the new mark outranks the old one --
    no join, so no degenerate join on the per-table literal names.
    """
    new = stats.where(F.col("rows_loaded") > 0).select(
        "table_name", F.col("batch_mark").alias("high_watermark"), F.lit(1).alias("__rank"))
    if state is None:
        return new.drop("__rank")
    old = state.select("table_name", "high_watermark", F.lit(0).alias("__rank"))
    return old.unionByName(new).groupBy("table_name").agg(
        F.max_by("high_watermark", "__rank").alias("high_watermark"))


def log_rows(stats: DataFrame, state_after: DataFrame, batch_id: str, loaded_at: dt.datetime) -> DataFrame:
    """A10: one row per table per batch, even for 0 rows; the mark after the batch ('' if none).

    Stats and state are combined by table in one small aggregation (no join).
    """
    s = stats.select("table_name", "rows_loaded", F.lit(None).cast("string").alias("high_watermark"))
    w = state_after.select("table_name", F.lit(None).cast("long").alias("rows_loaded"), "high_watermark")
    g = s.unionByName(w).groupBy("table_name").agg(F.max("rows_loaded").alias("rows_loaded"),
                                                   F.max("high_watermark").alias("high_watermark"))
    return g.where(F.col("rows_loaded").isNotNull()).select(
        F.lit(batch_id).alias("batch_id"), "table_name", "rows_loaded",
        F.coalesce(F.col("high_watermark"), F.lit("")).alias("high_watermark"),
        _ntz(loaded_at).alias("loaded_at"))


def load_summary(log: DataFrame, batch_id: str) -> DataFrame:
    """Table -> rows loaded for one batch."""
    return log.where(F.col("batch_id") == batch_id).select("table_name", "rows_loaded")


# --- side-effecting loader -------------------------------------------------------
def new_batch_id() -> str:
    """A fresh batch id ('b' + 12 hex digits)."""
    return "b" + uuid.uuid4().hex[:12]


def absent(error: AnalysisException) -> bool:
    """Whether a read failed because the path does not exist (any other error must not pass for "never loaded")."""
    return error.getCondition() == "PATH_NOT_FOUND"


def read_log(spark: SparkSession, root: str) -> DataFrame | None:
    """The append-only load log (one partition per batch), or None before the first load.

    The schema is declared: a batch id that looks like a number stays text.
    """
    path = f"{root}/meta/load_log"
    schema = T.StructType([*LOG_SCHEMA.fields, T.StructField("batch_id", T.StringType(), True)])
    try:
        return spark.read.schema(schema).option("basePath", path).parquet(path)
    except AnalysisException as e:
        if absent(e):
            return None
        raise


class TableState(NamedTuple):
    """What the log says of one table."""
    marks: dict[str, str]                      # by channel
    base: str | None                           # batch that wrote the base
    deltas: list[tuple[str, str]]              # (batch, channel) since, oldest first
    seq: int
    key: str

    @property
    def version(self) -> str | None:
        """The batch that changed the table last."""
        return self.deltas[-1][0] if self.deltas else self.base


def current_state(spark: SparkSession, root: str) -> dict[str, TableState]:
    """table -> its state. A channel's mark is that of its latest batch (after a full refresh it may be lower than an
    earlier one). One row per table reaches the driver, with the deltas since its base: compaction keeps them few."""
    log = read_log(spark, root)
    if log is None:
        return {}
    based = F.max(F.when(F.col("wrote") == "base", F.col("seq"))).over(Window.partitionBy("table_name"))
    log = log.withColumn("based", based)
    since = F.when((F.col("wrote") == "delta") & (F.col("seq") > F.col("based")), F.struct("seq", "batch_id", "channel"))
    mark = [F.max_by("high_watermark", F.when(F.col("channel") == c, F.col("seq"))).alias(c) for c in (EXTRACT, LANDED)]
    rows = log.groupBy("table_name").agg(*mark, F.max_by("batch_id", F.when(F.col("seq") == F.col("based"), F.col("seq"))).alias("base"),
                                         F.sort_array(F.collect_list(since)).alias("deltas"), F.max("seq").alias("seq"),
                                         F.max_by("key_column", "seq").alias("key")).collect()
    return {r["table_name"]: TableState({c: r[c] or "" for c in (EXTRACT, LANDED)}, r["base"], [(d["batch_id"], d["channel"]) for d in r["deltas"]],
                                        r["seq"], r["key"]) for r in rows}


def committed(spark: SparkSession, root: str, batch_id: str) -> dict[str, int] | None:
    """Rows loaded per table if ``batch_id`` already committed its log partition."""
    try:
        rows = spark.read.schema(LOG_SCHEMA).parquet(f"{root}/meta/load_log/batch_id={batch_id}").collect()   # one row per table
    except AnalysisException as e:
        if absent(e):
            return None
        raise
    return {r["table_name"]: int(r["rows_loaded"]) for r in rows} or None


def base_path(root: str, table: str, batch_id: str) -> str:
    """Folder of a full table written by one batch."""
    return f"{root}/raw/{table}/base={batch_id}"


def delta_path(root: str, table: str, batch_id: str) -> str:
    """Folder of the rows of one batch."""
    return f"{root}/raw/{table}/delta={batch_id}"


def read_state(spark: SparkSession, root: str, table: str, state: TableState) -> DataFrame:
    """The raw table as of a state."""
    return merge_deltas(spark.read.parquet(base_path(root, table, state.base)),
                        [(spark.read.parquet(delta_path(root, table, b)), c) for b, c in state.deltas], state.key)


def read_raw(spark: SparkSession, root: str, table: str) -> DataFrame:
    """The current raw table."""
    state = current_state(spark, root).get(table)
    if state is None or state.base is None:
        raise FileNotFoundError(f"raw table {table} has never been loaded under {root}")
    return read_state(spark, root, table, state)


def _load_table(spark: SparkSession, source: DataFrame, root: str, table: str, key: str, state: TableState | None,
                batch_id: str, loaded_at: dt.datetime, dedupe: bool, landed: bool, compact_after: int) -> tuple[int, str | None, str]:
    """Write one table's batch; (rows, largest mark in it, what was written)."""
    first = state is None or state.base is None
    if landed:
        batch = with_audit(to_raw_text(source), batch_id, loaded_at)
        if first:
            batch = merge_newest(None, batch, key)
    else:
        batch = load_frame(source, state.marks[EXTRACT] if state else "", batch_id, loaded_at)
        if dedupe:
            batch = latest_by_key(batch, key)
    path = base_path(root, table, batch_id) if first else delta_path(root, table, batch_id)
    batch.write.mode("overwrite").parquet(path)                # one pass over the source, the batch's rows only
    st = spark.read.parquet(path).agg(F.count(F.lit(1)).alias("n"), F.max(WATERMARK_COLUMN).alias("m")).first()
    n = int(st["n"])
    if first:
        return n, st["m"], "base"
    if n and len(state.deltas) + 1 > compact_after:
        now = state._replace(deltas=[*state.deltas, (batch_id, LANDED if landed else EXTRACT)])
        clustered(read_state(spark, root, table, now)).write.mode("overwrite").parquet(base_path(root, table, batch_id))
        return n, st["m"], "base"
    return n, st["m"], "delta" if n else "nothing"


def _commit(spark: SparkSession, root: str, batch_id: str, loaded_at: dt.datetime, seq: int, channel: str, tables: dict[str, str],
            marks: dict[str, str], outcome: dict[str, tuple[int, str | None, str]]) -> None:
    """Advance the marks and write the batch's log partition, unless another batch was logged meanwhile."""
    now = max([s.seq for s in current_state(spark, root).values()], default=0) + 1
    if now != seq:
        raise RuntimeError(f"another batch was loaded under {root} while {batch_id} ran; run it again")
    stats = spark.createDataFrame([(t, n, m) for t, (n, m, _) in outcome.items()], "table_name string, rows_loaded long, batch_mark string")
    before = spark.createDataFrame(list(marks.items()), "table_name string, high_watermark string")
    log = log_rows(stats, advance_watermarks(before, stats), batch_id, loaded_at)
    of = F.create_map(*[F.lit(x) for t, (_, _, w) in outcome.items() for x in (t, w)])
    keys = F.create_map(*[F.lit(x) for t, k in tables.items() for x in (t, k)])
    log = log.select("table_name", "rows_loaded", "high_watermark", "loaded_at", F.lit(seq).cast("long").alias("seq"), F.lit(channel).alias("channel"),
                     of[F.col("table_name")].alias("wrote"), keys[F.col("table_name")].alias("key_column"))
    log.coalesce(1).write.mode("overwrite").parquet(f"{root}/meta/load_log/batch_id={batch_id}")


def extract_load(spark: SparkSession, sources: dict[str, DataFrame], root: str, tables: dict[str, str] = TABLES,
                 batch_id: str | None = None, loaded_at: dt.datetime | None = None,
                 full: bool = False, parallel: int = 4, dedupe: bool = False, landed: bool = False,
                 compact_after: int = COMPACT_AFTER) -> dict[str, int]:
    """Load every table's changes since its mark; returns table -> rows loaded.

    Per table: extract -> write the batch's rows (one pass over the source) as
    a delta, or as the base if it is the first -> count and max of what was
    written. A table whose first batch is empty still gets an empty base, so
    staging never meets a missing table. After ``compact_after`` deltas a
    batch also writes a new base. Tables are independent and are submitted
    ``parallel`` at a time (concurrent Spark jobs). The log partition for the
    batch is written last; until then nothing of the batch is current.
    ``full=True`` ignores marks and tables (full refresh). ``dedupe=True``
    keeps only the newest row per key within a batch (off by default: a
    batch's duplicates are kept, as in delete-then-insert). ``landed=True``:
    the sources are change files that landed, so every row takes part
    whatever the mark, the newest ``updated_at`` wins per key, also against
    the stored row (:func:`merge_newest`); their mark is that of their own
    channel, the extract's mark stays.

    One writer at a time: if another batch was logged since the state was
    read, this one fails before it commits, and can be run again.
    """
    batch_id = batch_id or new_batch_id()
    loaded_at = loaded_at or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None, microsecond=0)
    done = committed(spark, root, batch_id)
    if done is not None:           # a retried batch that already committed: nothing to do
        return done
    known = current_state(spark, root)
    state = {} if full else known
    seq = max([s.seq for s in known.values()], default=0) + 1
    channel = LANDED if landed else EXTRACT
    marks = {t: state[t].marks[channel] if t in state else "" for t in tables}

    def one(item):
        table, key = item
        n, mark, wrote = _load_table(spark, sources[table], root, table, key, state.get(table), batch_id, loaded_at, dedupe, landed, compact_after)
        return table, (n, max(marks[table], mark or "") if landed else mark, wrote)

    with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
        outcome = dict(pool.map(one, tables.items()))
    _commit(spark, root, batch_id, loaded_at, seq, channel, tables, marks, outcome)
    return {t: outcome[t][0] for t in tables}


def clustered(df: DataFrame, col: str = WATERMARK_COLUMN) -> DataFrame:
    """Rows in ranges of the mark column, sorted: files and row groups then hold narrow ranges of it, and their min/max
    statistics let a read of what changed since a mark skip all others. One shuffle, so done where a table is rewritten
    anyway. Ties beyond one value spread by a hash of the row."""
    data = [c for c in df.columns if c != col]
    spread = df.withColumn("__spread", F.xxhash64(*data))
    return spread.repartitionByRange(col, "__spread").sortWithinPartitions(col, "__spread").drop("__spread")


def compact(spark: SparkSession, root: str, batch_id: str | None = None) -> list[str]:
    """Write a new base, clustered by the mark column, for every table that has deltas; returns their names. The log gets a
    batch without rows."""
    known = {t: s for t, s in current_state(spark, root).items() if s.deltas}
    if not known:
        return []
    batch_id = batch_id or new_batch_id()
    for t, s in known.items():
        clustered(read_state(spark, root, t, s)).write.mode("overwrite").parquet(base_path(root, t, batch_id))
    seq = max(s.seq for s in current_state(spark, root).values()) + 1
    _commit(spark, root, batch_id, dt.datetime.now(dt.timezone.utc).replace(tzinfo=None, microsecond=0), seq, EXTRACT, {t: s.key for t, s in known.items()},
            {t: s.marks[EXTRACT] for t, s in known.items()}, {t: (0, None, "base") for t in known})
    return sorted(known)
