"""Suffix-array dedup of repetitive corpora by run-length indexes.

Every byte that is covered by a string of ``size`` (400) bytes which also starts anywhere else, the same document included, is
removed; all occurrences go.

Strings of ``report`` (250) bytes are found with them, in the same cells: they are not removed, but say how long a run of
a document stands elsewhere, below the size that is cut too.

1. Equal texts are one class: with two documents or more, and ``size`` bytes, they go altogether.  One of them stays in
   what follows, so that others are compared with it.
2. Every string of ``report`` bytes has an anchor, the smallest hash of its runs of 32 bytes.  Strings in a row mostly share it,
   so there is an anchor for about 110 bytes.  Equal strings have equal anchors: counting them finds all candidates.
3. Segments: consecutive strings under one repeated anchor, each of them prolonged to ``size`` bytes where the text goes on, meet by anchor:
   equal strings of either length lie whole in two segments of one anchor.  A run of many strings (periodic texts) is cut, so a
   segment has at most some 2,400 bytes and cells are bounded in bytes.
4. Anchors with more than ``part`` segments (boilerplate) are made distinct first: a segment that stands in several places is
   settled by its count, and only one row of it goes on, however many places it has.  What is still more than ``part``
   different segments is cut into parts, and each pair of parts is a cell of its own.
5. Cells are put together to texts of a few MB, of which a run-compressed Burrows-Wheeler transform is built, with samples at
   the ends of its runs: text place, and common prefix with the neighbour across the border of the run.  Inside a run the
   common prefix with the neighbour grows by one with each step to the left in the text; so a pass over the samples, in
   text order, gives the matching statistics of every place, and what is long enough is marked.
6. Documents are cut at the marked spans, which may lie inside a character: the rest is returned as bytes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiloom.llm.common import materialize
from kpiloom.llm.textbytes import U, slices, window_minima

SIZE, REPORT, GRAM, PART, TEXT_BYTES, RUN = 400, 250, 32, 4096, 1 << 21, 2048
I64 = np.int64


class RunLengthIndex:
    """Run-compressed Burrows-Wheeler transform of some byte strings, each with an end of its own.

    ``heads``: places of the transform where a run begins; ``sample``: the text place of each head and of the end of the run
    before it; ``common``: how long these two neighbours agree.
    """

    def __init__(self, parts: list[bytes], owned: list[int] | None = None):
        """``owned``: of each string, how many places from its beginning take part; the others only say how it goes on."""
        self.text = np.frombuffer(b"".join(parts), np.uint8)
        size = np.array([len(p) for p in parts], dtype=I64)
        self.begin = np.concatenate([[0], np.cumsum(size)])
        self.end = np.repeat(self.begin[1:], size)               # of the string that a place belongs to
        sa = self._sort()
        if owned is not None:
            last = np.repeat(self.begin[:-1] + np.array(owned, dtype=I64), size)
            sa = sa[sa < last[sa]]
        # the byte before each suffix; before the first of a string stands a sign of its own
        before = np.where(np.isin(sa, self.begin[:-1]), -1 - np.arange(len(sa)), self.text[sa - 1].astype(I64))
        self.heads = np.flatnonzero(np.concatenate([[True], before[1:] != before[:-1]]))
        self.sample = np.stack([sa[self.heads], sa[self.heads - 1]])
        self.common = self._agree(*self.sample)
        self.common[:1] = 0

    def _eights(self) -> np.ndarray:
        """The eight bytes from each place, as one number."""
        t = np.concatenate([self.text, np.zeros(8, np.uint8)])
        out = np.zeros(len(self.text), U)
        for j in range(8):
            out = (out << U(8)) | t[j: j + len(self.text)]
        return out

    def _sort(self) -> np.ndarray:
        """Suffix array by doubling; only suffixes that still tie are sorted again.  A suffix that ends ties with none."""
        n = len(self.text)
        room = self.end - np.arange(n)
        key = np.zeros(n, U)
        t = np.concatenate([self.text.astype(U) + U(1), np.zeros(7, U)])
        for j in range(7):
            key = (key << U(9)) | np.where(room > j, t[j: j + n], U(0))
        sa = np.argsort(key, kind="stable")
        k = key[sa]
        new = np.concatenate([[True], k[1:] != k[:-1]]) | ((k & U(511)) == 0)
        rank = np.empty(n, I64)
        start = np.maximum.accumulate(np.where(new, np.arange(n), 0))
        rank[sa] = start
        alone = new & np.append(new[1:], True)
        slots = np.flatnonzero(~alone)
        h = 7
        while len(slots):
            i = sa[slots]
            ends = i + h >= self.end[i]
            second = np.where(ends, 0, rank[np.minimum(i + h, n - 1)] + 1)
            first = rank[i]
            order = np.argsort(first * I64(n + 2) + second, kind="stable")
            i, first, second, ends = i[order], first[order], second[order], ends[order]
            sa[slots] = i
            new = np.concatenate([[True], (first[1:] != first[:-1]) | (second[1:] != second[:-1])]) | ends
            rank[i] = np.maximum.accumulate(np.where(new, slots, 0))
            alone = new & np.append(new[1:], True)
            slots = slots[~alone]
            h *= 2
        return sa

    def _agree(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the common prefix of the suffixes at a and at b."""
        eight = self._eights()
        length = np.zeros(len(a), I64)
        most = np.minimum(self.end[a] - a, self.end[b] - b)
        todo = np.flatnonzero(most >= 8)
        while len(todo):
            p, q = a[todo] + length[todo], b[todo] + length[todo]
            same = eight[p] == eight[q]
            todo = todo[same]
            length[todo] += 8
            todo = todo[most[todo] - length[todo] >= 8]
        for _ in range(8):
            todo = np.flatnonzero(length < most)
            todo = todo[self.text[a[todo] + length[todo]] == self.text[b[todo] + length[todo]]]
            if not len(todo):
                break
            length[todo] += 1
        return length

    def statistics(self) -> np.ndarray:
        """Matching statistics: for each place, how long the text from there also stands anywhere else.

        A sample of length m at place i says m - d for place i + d, until it ends; the largest counts.
        """
        reach = np.zeros(len(self.text), I64)                    # furthest end of a match that begins at the place
        np.maximum.at(reach, self.sample[0], self.sample[0] + self.common)
        np.maximum.at(reach, self.sample[1], self.sample[1] + self.common)
        return np.maximum(np.maximum.accumulate(reach) - np.arange(len(self.text)), 0)

    def long_matches(self, size: int, statistics: np.ndarray | None = None) -> list[tuple[int, int, int]]:
        """(string, from, to): maximal spans covered by repeated strings of ``size`` bytes or more."""
        at = np.flatnonzero((self.statistics() if statistics is None else statistics) >= size)
        if not len(at):
            return []
        # each place covers ``size`` bytes; runs of places cover their union
        part = np.searchsorted(self.begin, at, side="right") - 1
        new = np.concatenate([[True], (at[1:] > at[:-1] + size) | (part[1:] != part[:-1])])
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(at)) - 1
        p = part[first]
        return list(zip(p.tolist(), (at[first] - self.begin[p]).tolist(), (at[last] + size - self.begin[p]).tolist()))


def _signs(b) -> np.ndarray:
    return b.hash_spans(b.at[:-1], b.at[1:]).view(I64)


def _anchors(texts: pa.Array, size: int, gram: int):
    """For slices of texts: first row, the bytes, hash of the run of ``gram`` bytes and anchor of the string at each place."""
    for i, _, b in slices(texts):
        n = max(0, len(b.data) - gram + 1)
        at = np.arange(n)
        h = b.hash_spans(at, at + gram) >> U(16) if n else np.zeros(0, U)
        yield i, b, h.view(I64), window_minima(h, size - gram + 1).view(I64)


def _summaries(size: int, gram: int):
    def run(batches):
        for b in batches:
            ids, out = b.column(0).to_pylist(), [[], [], [], [], []]
            for i, part, h, low in _anchors(b.column(1), size, gram):
                sig = _signs(part)
                for d in range(len(part)):
                    lo, hi = int(part.at[d]), int(part.at[d + 1])
                    values = np.unique(low[lo: max(lo, hi - size + 1)])
                    # anchors that stand twice in the document itself
                    twice = values[:0]
                    if len(values):
                        own = h[lo: hi - gram + 1]
                        own = np.sort(own[own <= values[-1]])
                        again = np.unique(own[1:][own[1:] == own[:-1]])
                        twice = np.intersect1d(values, again, assume_unique=True)
                    for col, v in zip(out, (ids[i + d], hi - lo, int(sig[d]), values, twice)):
                        col.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, (
                pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64())))], ["doc_id", "n", "sig", "anchors", "twice"])

    return run


def _segments(size: int, report: int, gram: int):
    names = ["anchor", "seg", "doc_id", "sig", "start", "owned", "bytes"]

    def run(batches):
        for b in batches:
            out = [[] for _ in names]
            ids, sigs, hots = b.column(0).to_pylist(), b.column(2).to_pylist(), b.column(3)
            for i, part, _, low in _anchors(b.column(1), report, gram):
                sig = _signs(part)
                for d in range(len(part)):
                    lo, hi, stop = int(part.at[d]), int(part.at[d + 1]) - report + 1, int(part.at[d + 1])
                    if hi <= lo or int(sig[d]) != sigs[i + d]:
                        continue
                    known = np.sort(np.asarray(hots[i + d].values))
                    own = low[lo:hi]
                    edge = np.concatenate([[0], np.flatnonzero(own[1:] != own[:-1]) + 1, [hi - lo]])
                    if (np.diff(edge) > RUN).any():
                        edge = np.unique(np.concatenate([edge, *[np.arange(x, y, RUN) for x, y in zip(edge[:-1], edge[1:]) if y - x > RUN]]))
                    k = np.searchsorted(known, own[edge[:-1]])
                    k[k == len(known)] = 0
                    good = known[k] == own[edge[:-1]]
                    first = lo + edge[:-1][good]
                    last = np.minimum(lo + edge[1:][good] + size - 1, stop)
                    seg = part.hash_spans(first, last).view(I64)
                    for a, e, x, h, n in zip(first.tolist(), last.tolist(), own[edge[:-1]][good].tolist(), seg.tolist(), np.diff(edge)[good].tolist()):
                        for col, v in zip(out, (x, h, ids[i + d], sigs[i + d], a - lo, n, part.data[a:e].tobytes())):
                            col.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, (
                pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()))], names)

    return run


SPANS = "doc_id long, sig long, a long, b long, cut boolean"


def _index(size: int, report: int, text_bytes: int):
    """Rows (key, doc_id, sig, start, owned, bytes), sorted by key, to spans; whole cells are put together up to ``text_bytes``.

    Each place of a document takes part once, in the segment that owns it.  Segments with equal bytes own equally many."""
    def search(rows):
        texts: dict = {}
        for r in rows:
            texts.setdefault(r[4], []).append(r)
        out = [[], [], [], [], []]

        def mark(text, a, b, cut):
            for doc, sig, start, _, _ in texts[text]:
                for col, x in zip(out, (doc, sig, start + a, start + b, cut)):
                    col.append(x)
        parts = []
        for text, where in texts.items():
            if len(set(w[:3] for w in where)) > 1:
                mark(text, 0, len(text), len(text) >= size)       # the same segment in two places
            parts.append(text)
        if len(parts) > 1 or len(parts[0]) > report:
            index = RunLengthIndex(parts, [w[0][3] for w in texts.values()])
            found = index.statistics()
            for length in (size, report):
                for p, a, b in index.long_matches(length, found):
                    mark(parts[p], a, b, length == size)
        return pa.RecordBatch.from_arrays([*[pa.array(c, pa.int64()) for c in out[:4]], pa.array(out[4], pa.bool_())], ["doc_id", "sig", "a", "b", "cut"])

    def run(batches):
        key, rows, held = None, [], 0
        for b in batches:
            for *cell, doc, sig, start, owned, data in zip(*[c.to_pylist() for c in b.columns]):
                if cell != key:
                    if held > text_bytes:
                        yield search(rows)
                        rows, held = [], 0
                    key = cell
                rows.append((doc, sig, start, owned, data))
                held += len(data)
        if rows:
            yield search(rows)

    return run


def find_repeats(docs: DataFrame, size: int = SIZE, gram: int = GRAM, part: int = PART, text_bytes: int = TEXT_BYTES,
                 report: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(whole, spans) of ``docs`` (doc_id long, text): (doc_id, sig, n) of texts that stand twice altogether, and byte spans
    (doc_id, sig, a, b, cut) of others; spans may overlap.  ``cut`` tells strings of ``size`` from those of ``report`` bytes."""
    report = min(report or max(size * REPORT // SIZE, gram), size)
    rows = materialize(docs.where("text is not null").mapInArrow(
        _summaries(report, gram), "doc_id long, n long, sig long, anchors array<long>, twice array<long>"), "byte-anchors").where(f"n >= {report}")
    classes = rows.groupBy("n", "sig").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id")).alias("rep"), F.count("*").alias("copies"))
    whole = rows.join(classes.where("copies > 1"), ["n", "sig"], "left_semi").select("doc_id", "sig", "n")
    # one row of each class takes part
    one = rows.join(classes.select("n", "sig", F.col("rep.doc_id").alias("rep")), ["n", "sig"]).where("doc_id <=> rep")
    one = one.dropDuplicates(["doc_id", "n", "sig"])
    each = one.select("doc_id", "sig", F.explode("anchors").alias("anchor"), "twice").select(
        "doc_id", "sig", "anchor", F.array_contains("twice", F.col("anchor")).alias("own"))
    again = materialize(each.groupBy("anchor").agg(F.count("*").alias("c"), F.max("own").alias("own")).where("c > 1 or own")
                        .select("anchor", (F.col("c") > part).alias("hot")), "repeated-anchors")

    def segments(anchors: DataFrame) -> DataFrame:
        lists = each.join(anchors, "anchor").groupBy("doc_id", "sig").agg(F.collect_list("anchor").alias("known"))
        texts = docs.join(lists, docs["doc_id"].eqNullSafe(lists["doc_id"])).select(docs["doc_id"], "text", "sig", "known")
        return texts.mapInArrow(_segments(size, report, gram), "anchor long, seg long, doc_id long, sig long, start long, owned long, bytes binary")

    cold = segments(again.where("not hot").select("anchor")).drop("seg").repartition("anchor").sortWithinPartitions("anchor")
    spans = cold.mapInArrow(_index(size, report, text_bytes), SPANS)
    if again.where("hot").take(1):
        spans = spans.unionByName(_hot_spans(segments(again.where("hot").select("anchor")), size, report, part, text_bytes))
    return whole, spans


def _hot_spans(found: DataFrame, size: int, report: int, part: int, text_bytes: int) -> DataFrame:
    """Spans of segments under anchors that many segments have.

    Places are kept without bytes; bytes only once for each distinct segment (combined before they are shuffled), under a
    name of its own: doc_id is the segment's hash, sig its anchor.  Places get the spans of their segment.
    """
    found = found.withColumn("size", F.octet_length("bytes").cast("long"))
    distinct = materialize(found.groupBy("anchor", "seg").agg(F.first("bytes").alias("bytes"), F.first("owned").alias("owned"), F.count("*").alias("places"), F.first("size").alias("size")), "distinct-segments")
    count = distinct.groupBy("anchor").agg(F.ceil(F.count("*") / part).cast("int").alias("parts"))
    cells = distinct.join(count, "anchor").withColumn("own", F.pmod(F.xxhash64("seg"), F.col("parts")).cast("int"))
    cells = cells.select("anchor", "seg", "owned", "bytes", "own", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other"))
    cells = cells.select("anchor", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), F.col("seg").alias("doc_id"),
                         F.col("anchor").alias("sig"), F.lit(0).cast("long").alias("start"), "owned", "bytes")
    inner = cells.repartition("anchor", "i", "j").sortWithinPartitions("anchor", "i", "j").mapInArrow(_index(size, report, text_bytes), SPANS)
    several = distinct.where("places > 1").select(F.col("seg").alias("doc_id"), F.col("anchor").alias("sig"), F.lit(0).cast("long").alias("a"),
                                                  F.col("size").alias("b"), (F.col("size") >= size).alias("cut"))
    # of one segment: its spans, merged to few by the union of a bounded segment
    of = (inner.unionByName(several).groupBy("doc_id", "sig").agg(F.collect_set(F.struct("a", "b", "cut")).alias("spans"))
          .select(F.col("sig").alias("anchor"), F.col("doc_id").alias("seg"), "spans", F.xxhash64("sig", "doc_id").alias("h")))
    places = found.select("anchor", "seg", "doc_id", "sig", "start", F.xxhash64("anchor", "seg").alias("h"))
    hit = places.join(of, ["h", "anchor", "seg"]).select("doc_id", "sig", "start", F.explode("spans").alias("s"))
    return hit.select("doc_id", "sig", (F.col("start") + F.col("s.a")).alias("a"), (F.col("start") + F.col("s.b")).alias("b"), F.col("s.cut").alias("cut"))


def _covered(n: int, spans) -> np.ndarray:
    edge = np.zeros(n + 1, I64)
    for s in spans:
        edge[s["a"]] += 1
        edge[s["b"]] -= 1
    return np.cumsum(edge[:n]) > 0


def _runs(mask: np.ndarray) -> np.ndarray:
    """Lengths of the runs of true places."""
    step = np.diff(np.concatenate([[0], mask.astype(np.int8), [0]]))
    return np.flatnonzero(step == -1) - np.flatnonzero(step == 1)


def _cut_bytes(size: int):
    def run(batches):
        for b in batches:
            out = ([], [], [], [], [], [])
            texts = pa.array([t.as_py() or "" for t in b.column(1)], pa.large_string())
            sigs = np.concatenate([_signs(p) for _, _, p in slices(texts)]) if len(texts) else []
            for doc, text, sig, verdict in zip(b.column(0).to_pylist(), texts, sigs, b.column(2).to_pylist()):
                data = np.frombuffer(text.as_py().encode(), np.uint8)
                mine = [v for v in verdict or () if v["sig"] == int(sig)]
                if any(v["whole"] for v in mine):
                    gone, shared = np.full(len(data), len(data) >= size), np.ones(len(data), bool)
                else:
                    spans = [s for v in mine for s in v["spans"]]
                    gone, shared = _covered(len(data), (s for s in spans if s["cut"])), _covered(len(data), spans)
                for col, v in zip(out, (doc, len(data), int(gone.sum()), len(_runs(gone)), data[~gone].tobytes(), int(_runs(shared).max(initial=0)))):
                    col.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, (
                pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64()))], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_bytes", "longest_repeat"])

    return run


def remove_repeats(docs: DataFrame, id_name: str = "doc_id", text: str = "text", size: int = SIZE, **options) -> DataFrame:
    """One row per document: id, n_bytes, n_removed, n_spans (maximal removed runs), kept_bytes, longest_repeat.

    ``longest_repeat``: bytes of the longest run that is covered by strings of ``report`` bytes (5/8 of ``size``) which also start
    elsewhere; 0 if there is none.  It also shows passages that are too short to be removed.  Null and empty texts have no
    bytes.  Rows of equal or null ids are documents like any other (their texts tell them apart; rows that are equal count
    as copies).  A very long text is held once by each task that reads it.  Other columns are ignored, whatever their
    names; an empty table gives no rows.
    """
    d = docs.select(F.col(f"`{id_name}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    whole, spans = find_repeats(d, size, **options)
    none = F.array().cast("array<struct<a:bigint,b:bigint,cut:boolean>>")
    parts = spans.groupBy("doc_id", "sig").agg(F.collect_list(F.struct("a", "b", "cut")).alias("spans")).select(
        "doc_id", F.struct("sig", F.lit(False).alias("whole"), "spans").alias("v"))
    all_of = whole.select("doc_id", "sig").distinct().select("doc_id", F.struct("sig", F.lit(True).alias("whole"), none.alias("spans")).alias("v"))
    v = parts.unionByName(all_of).groupBy(F.col("doc_id").alias("_id")).agg(F.collect_list("v").alias("verdict"))
    joined = d.join(v, F.col("doc_id").eqNullSafe(F.col("_id")), "left").select("doc_id", "text", "verdict")
    out = joined.mapInArrow(_cut_bytes(size), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_bytes binary, longest_repeat long")
    return out.withColumnRenamed("doc_id", id_name)
