"""Repair of conversations: the cheapest edits that turn their roles into ``(s?(ua)+)?``, by parallel Viterbi.

A row may be kept (0, and 5 if it is truncated), given the role user or assistant (1, the same 5), or deleted (2; blank
rows and repeats must be); an empty row of user or assistant may be put in anywhere (5).  Four states stand for what was
given out last: nothing, system, user, assistant.  A backward pass over the rows gives the cost to go from each state; a
forward pass follows it, always by the ASCII-least letter (D, I, K, R) among the cheapest, which gives the least audit.

Conversations of up to ``chunk`` rows are solved whole, many at a time.  Longer ones are sorted by range, so a conversation
with a third of all rows is spread over the cluster, and cut into chunks, which are solved in parallel by rank convergence:

1. Every chunk starts its backward pass from a speculative cost vector, that of a conversation's end.
2. Fix-up passes: a chunk whose successor's vector is another than it assumed, by more than a constant, runs again; it stops
   as soon as its old and its new vectors differ only by a constant, for then all further ones do.  Most chunks lead to
   the same vector, up to a constant, from wherever they start, so nearly all is settled after one pass.
3. Some chunks never converge (rows of other roles cost 1 from any state, for instance).  What ``passes`` passes do not
   settle is bridged: those conversations' chunks give their 4 x 4 cost matrix, and the vectors are carried over one row a
   chunk.  Constants are not carried through the chunks: a conversation's cost is the sum of what its chunks add.
4. Stitched costs drive the tracing: each chunk follows them from all four states, one row a chunk chains the states,
   and the chunks are traced from the state that they are really entered in.

Texts take part only at the end, when the edits meet them by a digest of the row.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kpiloom.llm.common import materialize

CHUNK, PASSES = 4096, 6
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5      # fixed values: what edits cost
NEVER = 1 << 40
AFTER = np.array([2, 2, 3, 2])            # the state after the role that may be given out next: user, but assistant after user
SYSTEM, USER, ASSISTANT, OTHER = range(4)
END = np.array([0, 2 * INSERT, INSERT, 0])                   # cost to end in a state
CELLS = 1 << 18                           # rows of conversations solved at once
LAST_PLACE = (1 << 63) - 1


def _kept(role: int) -> list[tuple[int, int]]:
    """(state, next state) pairs in which a row of this role can be kept."""
    return {SYSTEM: [(0, 1)], USER: [(0, 2), (1, 2), (3, 2)], ASSISTANT: [(2, 3)], OTHER: []}[role]


def _matrices() -> np.ndarray:
    """Cost from state to state over one row, by its code (role + 4 * fault: none, truncated, must go; 12 stands for no row)."""
    out = np.full((13, 4, 4), NEVER)
    for code in range(12):
        m = out[code]
        np.fill_diagonal(m, DELETE)
        if code < 8:
            extra = TRUNCATED if code >= 4 else 0
            for s in range(4):
                m[s, AFTER[s]] = min(m[s, AFTER[s]], REROLE + extra)
            for s, t in _kept(code % 4):
                m[s, t] = min(m[s, t], KEEP + extra)
        direct = m.copy()
        for s in range(4):
            one, two = AFTER[s], AFTER[AFTER[s]]
            m[s] = np.minimum(direct[s], np.minimum(INSERT + direct[one], 2 * INSERT + direct[two]))
    np.fill_diagonal(out[12], 0)
    return out


STEP = _matrices()
KEEPS = np.full((13, 4), -1)              # next state where a row is kept, by code and state
for _code in range(8):
    for _s, _t in _kept(_code % 4):
        KEEPS[_code, _s] = _t


def backward(codes: np.ndarray, vector: np.ndarray) -> np.ndarray:
    """Costs to go before each row and after the last one: (n, rows + 1, 4), from ``vector`` (n, 4) at the end."""
    n, rows = codes.shape
    out = np.empty((n, rows + 1, 4), np.int64)
    out[:, rows] = vector
    for i in range(rows - 1, -1, -1):
        out[:, i] = (STEP[codes[:, i]] + out[:, i + 1, None, :]).min(2)
    return out


def fix_up(codes: np.ndarray, new: np.ndarray, old: np.ndarray, out: np.ndarray) -> np.ndarray:
    """The vectors at the chunks' beginnings from ``new`` ones at their ends, given that ``old`` ones led to ``out``.
    Stops where new and old differ only by constants."""
    new, old, result, live = new.copy(), old.copy(), out.copy(), np.arange(len(codes))
    for i in range(codes.shape[1] - 1, -1, -1):
        gap = new - old
        same = (gap == gap[:, :1]).all(1)
        result[live[same]] = out[live[same]] + gap[same, :1]
        live, new, old = live[~same], new[~same], old[~same]
        if not len(live):
            return result
        m = STEP[codes[live, i]]
        new, old = (m + new[:, None, :]).min(2), (m + old[:, None, :]).min(2)
    result[live] = new
    return result


def trace(codes: np.ndarray, costs: np.ndarray, state: np.ndarray, last: np.ndarray):
    """Least audit along the costs: (edit of each row, state where it began, rows put in after the last one, end state).
    An edit is 3 * rows put in before it + 0, 1 or 2 for D, K and R."""
    n, rows = codes.shape
    edits, began, every = np.zeros((n, rows), np.int8), np.empty((n, rows), np.int8), np.arange(n)
    state = state.copy()
    for i in range(rows):
        began[:, i] = state
        code, here, after = codes[:, i], costs[:, i], costs[:, i + 1]
        open_, letter, put = code != 12, np.zeros(n, np.int8), np.zeros(n, np.int8)
        extra = np.where(code >= 4, TRUNCATED, 0)
        for _ in range(3):
            now = here[every, state]
            delete = open_ & (DELETE + after[every, state] == now)
            insert = open_ & ~delete & (INSERT + here[every, AFTER[state]] == now)
            to = KEEPS[code, state]
            keep = open_ & ~delete & ~insert & (to >= 0) & (KEEP + extra + after[every, to] == now)
            rerole = open_ & ~delete & ~insert & ~keep
            letter[keep], letter[rerole] = 1, 2
            put[insert] += 1
            state = np.where(keep, to, np.where(insert | rerole, AFTER[state], state))
            open_ = insert
            if not open_.any():
                break
        edits[:, i] = 3 * put + letter
    tail = np.where(last, np.array([0, 2, 1, 0])[state], 0)
    return edits, began, tail, np.where(tail > 0, 3, state)


def _names():
    """Text of an edit, by beginning state and number: initials of the rows put in, D, K or R, the new initial after R; and
    its letters in the audit."""
    edit, audit = np.empty((4, 9), object), np.empty(9, object)
    for e in range(9):
        audit[e] = "I" * (e // 3) + "DKR"[e % 3]
        for s in range(4):
            t, put = s, ""
            for _ in range(e // 3):
                t = AFTER[t]
                put += "__ua"[t]
            edit[s, e] = put + "DKR"[e % 3] + ("__ua"[AFTER[t]] if e % 3 == 2 else "")
    return edit, audit


EDIT, AUDIT = _names()


def _groups(lengths: np.ndarray):
    """Row numbers of a batch, in groups of like lengths of at most ``CELLS`` cells (or one chunk)."""
    order, start = np.argsort(lengths, kind="stable"), 0
    while start < len(order):
        stop = start + 1
        while stop < len(order) and (stop + 1 - start) * max(int(lengths[order[stop]]), 1) <= CELLS:
            stop += 1
        yield order[start:stop]
        start = stop


def _padded(flat: np.ndarray, offsets: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Codes of some chunks as a table, filled up at the end by 12 (no row)."""
    width = int((offsets[at + 1] - offsets[at]).max(initial=0))
    place = offsets[at][:, None] + np.arange(width)
    inside = place < offsets[at + 1][:, None]
    return np.where(inside, flat[np.where(inside, place, 0)] if len(flat) else 12, 12)


def _column(batch: pa.RecordBatch, name: str):
    c = batch.column(batch.schema.get_field_index(name))
    flat, offsets = c.flatten(), c.offsets.to_numpy()
    return flat, offsets - offsets[0]


def _table(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return _column(batch, name)[0].to_numpy().reshape(-1, 4).astype(np.int64)


def _lists(values: np.ndarray) -> pa.Array:
    return pa.array(list(values.astype(np.int64)), pa.list_(pa.int64()))


def with_codes(batches):
    """Whole conversations: rows of (turn, role, head, said, key, role code, blank, cut), in order, get their codes.  A row whose
    role and text were seen earlier is a repeat."""
    for b in batches:
        flat, offsets = _column(b, "rows")
        who = np.repeat(np.arange(b.num_rows), np.diff(offsets))
        again = pd.DataFrame({"who": who, "said": flat.field("said").to_pandas()}).duplicated().to_numpy()
        blank = flat.field("blank").to_numpy(zero_copy_only=False)
        cut = flat.field("cut").to_numpy(zero_copy_only=False)
        fault = np.where(blank, 2, np.where(again, 3, np.where(cut, 1, 0)))
        codes = pa.array((flat.field("role_code").to_numpy() + 4 * fault).astype(np.int8))
        keys = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), flat.field("key"))
        yield pa.record_batch([b.column(0), keys, pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), codes)], names=["conv", "keys", "codes"])


def _plain(flat: np.ndarray) -> np.ndarray:
    """Codes 0 to 15 to those of STEP: blank rows and repeats are alike to it."""
    return np.where(flat >= 8, 8 + flat % 4, flat).astype(np.int64)


def measured(batches):
    """Speculative pass, or cost of whole conversations: ``codes`` and ``enter`` (vector at the end) give ``leave``."""
    for b in batches:
        flat, offsets = _column(b, "codes")
        codes, enter = _plain(flat.to_numpy()), _table(b, "enter")
        leave = np.empty_like(enter)
        for at in _groups(np.diff(offsets)):
            leave[at] = backward(_padded(codes, offsets, at), enter[at])[:, 0]
        yield pa.record_batch([b.column(0), b.column(1), b.column(b.schema.get_field_index("enter")), _lists(leave)], names=["conv", "no", "enter", "leave"])


def fixed_up(batches):
    """A fix-up pass over chunks with ``codes``, ``enter``, ``leave`` and the successor's vector ``next``."""
    for b in batches:
        flat, offsets = _column(b, "codes")
        codes, old, out, new = _plain(flat.to_numpy()), _table(b, "enter"), _table(b, "leave"), _table(b, "next")
        leave = np.empty_like(new)
        for at in _groups(np.diff(offsets)):
            leave[at] = fix_up(_padded(codes, offsets, at), new[at], old[at], out[at])
        yield pa.record_batch([b.column(0), b.column(1), _lists(new), _lists(leave)], names=["conv", "no", "enter", "leave"])


def crossed(batches):
    """The 4 x 4 cost matrix of each chunk, as 16 numbers (from state by state)."""
    for b in batches:
        flat, offsets = _column(b, "codes")
        codes = _plain(flat.to_numpy())
        out = np.empty((b.num_rows, 4, 4), np.int64)
        unit = np.full((4, 4), NEVER)
        np.fill_diagonal(unit, 0)
        for at in _groups(np.diff(offsets)):
            table = _padded(codes, offsets, at)
            for t in range(4):
                out[at, :, t] = np.minimum(backward(table, np.tile(unit[t], (len(at), 1)))[:, 0], NEVER)
        yield pa.record_batch([b.column(0), b.column(1), _lists(out.reshape(-1, 16))], names=["conv", "no", "matrix"])


def bridged(batches):
    """Vectors through the matrices of a conversation's chunks, last one first; one row a chunk, nothing is held."""
    conv, vector = None, END
    for b in batches:
        enter, leave = [], []
        for c, m in zip(b.column(0).to_pylist(), b.column(2).to_pylist()):
            if c != conv:
                conv, vector = c, END
            enter.append(vector - vector[0])
            vector = (np.array(m).reshape(4, 4) + enter[-1]).min(1)
            leave.append(vector)
        yield pa.record_batch([b.column(0), b.column(1), _lists(np.array(enter).reshape(-1, 4)), _lists(np.array(leave).reshape(-1, 4))],
                              names=["conv", "no", "enter", "leave"])


def ends(batches):
    """End state of each chunk by the state it is entered in, and the roles at its ends."""
    for b in batches:
        flat, offsets = _column(b, "codes")
        raw = flat.to_numpy()
        codes, enter = _plain(raw), _table(b, "enter")
        out = np.empty((b.num_rows, 4), np.int64)
        for at in _groups(np.diff(offsets)):
            table = _padded(codes, offsets, at)
            costs = backward(table, enter[at])
            for s in range(4):
                out[at, s] = trace(table, costs, np.full(len(at), s), np.zeros(len(at), bool))[3]
        yield pa.record_batch([b.column(0), b.column(1), _lists(out), pa.array(raw[offsets[:-1]] % 4, pa.int8()), pa.array(raw[offsets[1:] - 1] % 4, pa.int8())],
                              names=["conv", "no", "ends", "first", "last"])


def _legal(a, b):
    return ((a == SYSTEM) & (b == USER)) | ((a == USER) & (b == ASSISTANT)) | ((a == ASSISTANT) & (b == USER))


def chained(batches):
    """The state in which each chunk is really entered, and whether its first row does not follow the row before."""
    conv, state, role = None, 0, None
    for b in batches:
        begin, edge = [], []
        for c, e, first, last in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), b.column(3).to_pylist(), b.column(4).to_pylist()):
            if c != conv:
                conv, state, role = c, 0, None
            begin.append(state)
            edge.append(0 if role is None or _legal(role, first) else 1)
            state, role = e[state], last
        yield pa.record_batch([b.column(0), b.column(1), pa.array(begin, pa.int64()), pa.array(edge, pa.int64())], names=["conv", "no", "begin", "edge"])


def traced(batches):
    """Edits, audit and counts of each chunk from its vector ``enter`` and state ``begin``; ``final`` marks the last chunk."""
    for b in batches:
        flat, offsets = _column(b, "codes")
        raw = flat.to_numpy()
        codes, enter = _plain(raw), _table(b, "enter")
        begin = b.column(b.schema.get_field_index("begin")).to_numpy()
        final = b.column(b.schema.get_field_index("final")).to_numpy(zero_copy_only=False)
        edits, audits, tails = np.empty(len(raw), object), np.empty(b.num_rows, object), np.empty(b.num_rows, object)
        added = np.empty(b.num_rows, np.int64)
        for at in _groups(np.diff(offsets)):
            table = _padded(codes, offsets, at)
            costs = backward(table, enter[at])
            e, s, tail, end = trace(table, costs, begin[at], final[at])
            added[at] = costs[:, 0, 0] - enter[at][:, 0]
            for j, k in enumerate(at):
                n = offsets[k + 1] - offsets[k]
                edits[offsets[k]:offsets[k + 1]] = EDIT[s[j, :n], e[j, :n]]
                audits[k] = "".join(AUDIT[e[j, :n]]) + "I" * tail[j]
                tails[k] = {0: "", 1: "a", 2: "ua"}[tail[j]]
        who, fault = np.repeat(np.arange(b.num_rows), np.diff(offsets)), raw // 4
        count = [np.bincount(who[fault == f], minlength=b.num_rows) for f in (2, 3, 1)]
        wrong = (who[1:] == who[:-1]) & ~_legal(raw[:-1] % 4, raw[1:] % 4)
        illegal = np.bincount(who[1:][wrong], minlength=b.num_rows)
        yield pa.record_batch(
            [b.column(0), b.column(1), b.column(b.schema.get_field_index("keys")), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(edits, pa.string())),
             pa.array(audits, pa.string()), pa.array(tails, pa.string()), *[pa.array(c, pa.int64()) for c in (*count, illegal, added)]],
            names=["conv", "no", "keys", "edits", "audit", "tail", "blank", "duplicate", "truncated", "illegal", "added"])


TRACED = ("conv string, no long, keys array<binary>, edits array<string>, audit string, tail string, "
          "blank long, duplicate long, truncated long, illegal long, added long")
VECTORS = "conv string, no long, enter array<long>, leave array<long>"


def conv_key(conv: Column) -> Column:
    """A conversation's id as text that is never null."""
    return F.when(conv.isNull(), "").otherwise(F.concat(F.lit("="), conv.cast("string")))


def _slim(rows: DataFrame) -> DataFrame:
    """Rows without their texts: what the edits depend on, and two digests: of role and text, and of the whole row."""
    said = F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")
    whole = F.concat(F.length("conv").cast("string"), F.lit(":"), "conv", F.coalesce(F.col("turn").cast("string"), F.lit("-")), F.lit(":"), said)
    initial = F.substring("role", 1, 1)
    role = F.when(initial == "s", SYSTEM).when(initial == "u", USER).when(initial == "a", ASSISTANT).otherwise(OTHER).cast("byte")
    return rows.select("conv", "turn", "role", F.substring("text", 1, 64).alias("head"), F.unhex(F.sha2(said, 256)).alias("said"),
                       F.unhex(F.sha2(whole, 256)).alias("key"), role.alias("role_code"), (~F.col("text").rlike(r"[^\x20\x09-\x0D]")).alias("blank"),
                       (~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")).alias("cut"))


def _long_chunks(slim: DataFrame, chunk: int) -> DataFrame:
    """Chunks (conv, no, final, keys, codes) of long conversations, numbered in order."""
    by = ["conv", "turn", "role", "head", "said", "uid"]
    rows = slim.withColumn("uid", F.monotonically_increasing_id()).repartitionByRange(*by).sortWithinPartitions(*by)
    rows = materialize(rows.drop("head", "role").withColumn("place", F.monotonically_increasing_id()), "ordered-rows")
    seen = rows.groupBy("conv", "said").agg(F.min("place").alias("earliest"), F.count("*").alias("times")).where("times > 1")
    seen = seen.select("conv", "said", F.xxhash64("conv", "said").alias("h"), "earliest")
    rows = rows.withColumn("h", F.xxhash64("conv", "said")).join(seen, ["h", "conv", "said"], "left")
    fault = F.when(F.col("blank"), 2).when(F.col("earliest") < F.col("place"), 3).when(F.col("cut"), 1).otherwise(0)
    rows = rows.select("conv", "place", "key", (F.col("role_code") + 4 * fault).cast("byte").alias("code"), F.shiftrightunsigned("place", 33).alias("part"))
    # a conversation's rows in one sorted part are at most that part
    rows = rows.withColumn("block", F.floor((F.row_number().over(Window.partitionBy("conv", "part").orderBy("place")) - 1) / chunk))
    chunks = rows.groupBy("conv", "part", "block").agg(F.sort_array(F.collect_list(F.struct("place", "key", "code"))).alias("rows"))
    chunks = materialize(chunks.select("conv", "part", "block", F.col("rows.key").alias("keys"), F.col("rows.code").alias("codes")), "chunks")
    # one row a chunk
    w = Window.partitionBy("conv").orderBy("part", "block")
    number = chunks.select("conv", "part", "block", F.row_number().over(w).cast("long").alias("no"), F.lead("part").over(w).isNull().alias("final"))
    return materialize(chunks.join(number, ["conv", "part", "block"]).select("conv", "no", "final", "keys", "codes"), "chunks")


def _relative(vector: str) -> Column:
    return F.transform(vector, lambda x: x - F.col(vector)[0])


def stitched(chunks: DataFrame, passes: int = PASSES) -> DataFrame:
    """The vector ``enter`` at the end of each chunk, right up to a constant: speculation, fix-up passes, bridges."""
    coded = chunks.select("conv", "no", "codes")
    end = F.array(*[F.lit(int(x)).cast("long") for x in END])
    now = materialize(coded.withColumn("enter", end).mapInArrow(measured, VECTORS), "vectors")
    for _ in range(passes + 1):
        after = now.select("conv", (F.col("no") - 1).alias("no"), F.col("leave").alias("next"))
        stale = materialize(now.join(after, ["conv", "no"]).where(_relative("next") != _relative("enter")), "stale")
        if not stale.take(1):
            return now.select("conv", "no", "enter")
        if _ == passes:
            break
        again = materialize(coded.join(stale, ["conv", "no"]).mapInArrow(fixed_up, VECTORS), "fixed")
        now = materialize(now.join(again.select("conv", "no"), ["conv", "no"], "left_anti").unionByName(again), "vectors")
    late = stale.select("conv").distinct()
    matrices = materialize(coded.join(late, "conv", "left_semi").mapInArrow(crossed, "conv string, no long, matrix array<long>"), "matrices")
    bridge = matrices.repartition("conv").sortWithinPartitions("conv", F.desc("no")).mapInArrow(bridged, VECTORS)
    return now.join(late, "conv", "left_anti").unionByName(bridge).select("conv", "no", "enter")


def solve(rows: DataFrame, chunk: int = CHUNK, passes: int = PASSES) -> tuple[DataFrame, DataFrame]:
    """(one row a conversation, edits of its chunks) for ``rows`` with conv, turn, role and text, none null but turn."""
    slim = _slim(rows)
    turns = slim.groupBy("conv", "turn").agg(F.count("*").alias("n"))
    size = materialize(turns.groupBy("conv").agg(F.sum("n").alias("n_rows"), F.min("turn").alias("low"), F.max("turn").alias("high"), F.count("turn").alias("turns")), "sizes")
    long = size.where(F.col("n_rows") > chunk).select("conv")
    some = bool(long.take(1))
    whole = slim.join(long, "conv", "left_anti") if some else slim
    fields = ["turn", "role", "head", "said", "key", "role_code", "blank", "cut"]
    short = (whole.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct(*fields))).alias("rows"))
             .mapInArrow(with_codes, "conv string, keys array<binary>, codes array<byte>"))
    end = F.array(*[F.lit(int(x)).cast("long") for x in END])
    short = short.select("conv", F.lit(1).cast("long").alias("no"), "keys", "codes", end.alias("enter"), F.lit(0).cast("long").alias("begin"), F.lit(True).alias("final"))
    done = short.mapInArrow(traced, TRACED)
    if some:
        chunks = _long_chunks(slim.join(long, "conv", "left_semi"), chunk)
        known = materialize(chunks.join(stitched(chunks, passes), ["conv", "no"]), "stitched")
        through = known.select("conv", "no", "codes", "enter").mapInArrow(ends, "conv string, no long, ends array<long>, first byte, last byte")
        chain = through.repartition("conv").sortWithinPartitions("conv", "no").mapInArrow(chained, "conv string, no long, begin long, edge long")
        chain = materialize(chain, "chain")
        entered = known.join(chain, ["conv", "no"]).select("conv", "no", "keys", "codes", "enter", "begin", "final")
        more = entered.mapInArrow(traced, TRACED)
        more = more.join(chain.select("conv", "no", "edge"), ["conv", "no"]).withColumn("illegal", F.col("illegal") + F.col("edge")).drop("edge")
        done = done.unionByName(more)
    done = materialize(done, "edits")
    gaps = F.when(F.col("turns") > 0, F.col("high") - F.col("low") + 1 - F.col("turns")).otherwise(0).cast("long")
    sums = done.groupBy("conv").agg(*[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal")], F.sum("added").alias("cost"),
                                    F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("no", "audit"))), lambda x: x["audit"]), "").alias("audit"))
    return sums.join(size.select("conv", gaps.alias("gaps")), "conv"), done


def repaired(rows: DataFrame, done: DataFrame) -> DataFrame:
    """The repaired conversations: (conv, no, at, sub, role, text), in order of no, at and sub within conv."""
    each = done.select("conv", "no", F.explode(F.arrays_zip("keys", "edits", F.sequence(F.lit(0), F.size("keys") - 1).alias("at"))).alias("e"))
    each = each.select("conv", "no", F.col("e.at").alias("at"), F.col("e.keys").alias("key"), F.col("e.edits").alias("edit")).where("edit <> 'D'")
    said = F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")
    whole = F.concat(F.length("conv").cast("string"), F.lit(":"), "conv", F.coalesce(F.col("turn").cast("string"), F.lit("-")), F.lit(":"), said)
    texts = rows.select(F.unhex(F.sha2(whole, 256)).alias("key"), "role", "text").dropDuplicates(["key"])
    own = F.struct(F.when(F.col("edit").endswith("Ru"), "user").when(F.col("edit").endswith("Ra"), "assistant").otherwise(F.col("role")).alias("role"), "text")

    def put(initials: Column) -> Column:
        return F.transform(F.filter(F.split(initials, ""), lambda c: c != ""),
                           lambda c: F.struct(F.when(c == "u", "user").otherwise("assistant").alias("role"), F.lit("").alias("text")))

    kept = each.join(texts, "key").select("conv", "no", "at", F.posexplode(F.concat(put(F.regexp_extract("edit", "^[ua]*", 0)), F.array(own))).alias("sub", "r"))
    tails = done.where("tail <> ''").select("conv", "no", F.size("keys").alias("at"), F.posexplode(put(F.col("tail"))).alias("sub", "r"))
    return kept.unionByName(tails).select("conv", "no", "at", "sub", "r.role", "r.text")


def _fingerprints(batches):
    conv, sha = None, None
    for b in batches:
        out = []
        for c, role, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
            if c != conv or sha is None:
                if sha is not None:
                    out.append((conv, sha.hexdigest()))
                conv, sha = c, hashlib.sha256()
            else:
                sha.update(b"\n")
            sha.update(f"{role}:{text}".encode())
        yield pa.record_batch([pa.array([x[0] for x in out], pa.string()), pa.array([x[1] for x in out], pa.string())], names=["conv", "sha"])
    if sha is not None:
        yield pa.record_batch([pa.array([conv], pa.string()), pa.array([sha.hexdigest()], pa.string())], names=["conv", "sha"])


def fingerprints(turns: DataFrame) -> DataFrame:
    """(conv, sha): SHA-256 of each conversation's ``role:text`` lines.  A digest is a stream: a conversation passes through
    one task, row by row, and nothing is held."""
    by = ["conv", "no", "at", "sub"]
    near = turns.repartition("conv").sortWithinPartitions(*by).select("conv", "role", "text")
    return near.mapInArrow(_fingerprints, "conv string, sha string")


def repair(conversations: DataFrame, chunk: int = CHUNK, passes: int = PASSES) -> tuple[DataFrame, DataFrame]:
    """(summary, turns) of a table with conv_id, turn, role and text; other columns are ignored.

    Summary, one row a conv_id (null is one): conv, conv_id, gaps, blank, duplicate, truncated, illegal, cost and audit.
    Turns: conv_id and conv with the repaired rows in order of no, at and sub.  A null role or text counts as one space; a null turn
    comes first.  Rows of one turn follow by role, then by the text's first 64 characters, then by its digest; repeated rows
    are equal, so their order does not matter.  A role that begins with none of s, u and a, the empty one too, cannot be
    kept.  An empty table gives no rows; very long texts are only hashed and written out.
    """
    rows = conversations.select(conv_key(F.col("conv_id")).alias("conv"), F.col("turn").cast("long").alias("turn"),
                                F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"))
    summary, done = solve(rows, chunk, passes)
    ids = conversations.select("conv_id").distinct().select("conv_id", conv_key(F.col("conv_id")).alias("conv"))
    turns = repaired(rows, done)
    return ids.join(summary, "conv"), ids.join(turns, "conv")
