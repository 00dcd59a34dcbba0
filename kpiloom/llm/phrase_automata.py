"""Substring dedup by repeated-phrase automata.

A window is ``size`` (13) consecutive words.  Of all windows that several documents share, every occurrence but that in the
document with the smallest id is removed, word by word.

1. Texts with equal words are one class; all of its documents but the first go, if they have a window.
2. Every window has an anchor, the smallest hash of its runs of 5 words; windows in a row mostly share it, so a document has few
   anchors (a fifth of its words).  A repeated window repeats its anchor: counting anchors finds all candidates.
3. Segments: runs of windows under one repeated anchor, cut out of their documents, meet by anchor.
4. There, windows are confirmed to recur in a second document, the confirmed phrases of each shard are compiled into
   Aho-Corasick automata whose letters are words, and all segments stream through them; each occurrence found is checked by
   the window's own 64-bit hash and removed unless it stands in the first document.
5. Documents are cut at the found spans.

An anchor with more than ``hot`` documents is split by document over several groups; for its windows, the first document
is found before by an aggregation, so the groups agree.  An automaton is built for at most ``PHRASES`` phrases or one group.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiloom.llm.common import materialize
from kpiloom.llm.spans import cut, removed, rows_of, verdicts
from kpiloom.llm.textbytes import U, _powers, mix, ngrams, slices, window_minima

SIZE, ANCHOR, HOT, PHRASES = 13, 5, 20_000, 200_000
I64 = np.int64


def _signs(h: np.ndarray, borders: np.ndarray) -> np.ndarray:
    """A 64-bit name of each document's whole list of words."""
    up, down = _powers(len(h))
    s = np.zeros(len(h) + 1, dtype=U)
    np.cumsum(mix(h) * up[: len(h)], out=s[1:])
    size = np.diff(borders).astype(U)
    return mix((s[borders[1:]] - s[borders[:-1]]) * down[borders[:-1]] + size * U(0x9E3779B97F4A7C15)).view(I64)


def _named(texts: pa.Array):
    """For slices of texts: first row, borders, names of documents, hashes of words."""
    for i, _, b in slices(texts):
        start, end, borders = b.words()
        h = b.hash_spans(start, end)
        yield i, borders, _signs(h, borders), h


def _windows(texts: pa.Array, size: int, anchor: int):
    """For slices of texts: first row, borders, names, hashes of words, and hash and anchor of the window at each word (those
    that run into the next document are the caller's to leave out)."""
    for i, borders, sig, h in _named(texts):
        low = window_minima(ngrams(h, anchor), size - anchor + 1) >> U(16)
        yield i, borders, sig, h, ngrams(h, size), low.view(I64)


def _summaries(size: int, anchor: int):
    def run(batches):
        for b in batches:
            ids, out = b.column(0).to_pylist(), [[], [], [], []]
            for i, borders, sig, _, _, low in _windows(b.column(1), size, anchor):
                for d in range(len(borders) - 1):
                    lo, hi = borders[d], borders[d + 1]
                    for col, v in zip(out, (ids[i + d], int(hi - lo), int(sig[d]), np.unique(low[lo: max(lo, hi - size + 1)]))):
                        col.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, (
                pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64())))], ["doc_id", "n", "sig", "anchors"])

    return run


def _segments(size: int, anchor: int):
    """Runs of windows under one repeated anchor: their words (32 bits of each hash) and the hashes of their windows."""
    names = ["anchor", "groups", "doc_id", "sig", "start", "words", "windows"]

    def run(batches):
        for b in batches:
            out = [[] for _ in names]
            ids, sigs, hots = b.column(0).to_pylist(), b.column(2).to_pylist(), b.column(3)
            for i, borders, sig, h, win, low in _windows(b.column(1), size, anchor):
                letters = (h >> U(32)).astype(np.uint32)
                for d in range(len(borders) - 1):
                    lo, hi = int(borders[d]), int(borders[d + 1]) - size + 1
                    if hi <= lo or int(sig[d]) != sigs[i + d]:
                        continue
                    hot = hots[i + d].values
                    known, groups = np.asarray(hot.field("anchor")), np.asarray(hot.field("groups"))
                    order = np.argsort(known)
                    own = low[lo:hi]
                    edge = np.concatenate([[0], np.flatnonzero(own[1:] != own[:-1]) + 1, [hi - lo]])
                    values = own[edge[:-1]]
                    k = np.searchsorted(known, values, sorter=order)
                    k[k == len(known)] = 0
                    good = known[order[k]] == values
                    for a, e, v, g in zip(edge[:-1][good].tolist(), edge[1:][good].tolist(), values[good].tolist(), groups[order[k]][good].tolist()):
                        for col, x in zip(out, (v, g, ids[i + d], sigs[i + d], a, letters[lo + a: lo + e + size - 1].tobytes(), win[lo + a: lo + e].tobytes())):
                            col.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, (
                pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary()))], names)

    return run


def _explode_windows(batches):
    """(anchor, groups, window, doc_id) of segments, equal ones of a batch combined."""
    for b in batches:
        wins = [np.frombuffer(x, I64) for x in b.column(3).to_pylist()]
        n = np.array([len(w) for w in wins], dtype=I64)
        if not len(n):
            continue
        a, g, d = (np.repeat(np.asarray(b.column(k)), n) for k in range(3))
        w = np.concatenate(wins)
        order = np.lexsort((d, w, a))
        a, g, d, w = a[order], g[order], d[order], w[order]
        new = np.concatenate([[True], (a[1:] != a[:-1]) | (w[1:] != w[:-1])])
        last = np.append(np.flatnonzero(new)[1:], len(a)) - 1
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (a[new], g[new].astype(np.int32), w[new], d[new], d[last])],
                                         ["anchor", "groups", "window", "low", "high"])


def _locate(size: int, phrases: int):
    """Rows of groups, sorted by (anchor, part, kind, document), to spans (doc_id, sig, a, b).

    Kind 0 rows tell the first document of a window (in place of sig); without them a group has all segments of its anchor."""
    import ahocorasick

    def search(groups):
        """groups: lists of segments (doc, sig, start, words, windows), each with its table of first documents or None."""
        spans = ([], [], [], [])
        automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
        entries: list[dict] = []
        for segments, told in groups:
            wins = np.concatenate([s[4] for s in segments])
            size_of = [len(s[4]) for s in segments]
            doc = np.repeat([s[0] for s in segments], size_of)
            if told is None:
                order = np.lexsort((doc, wins))
                w, d = wins[order], doc[order]
                new = np.concatenate([[True], w[1:] != w[:-1]])
                first = np.flatnonzero(new)
                last = np.append(first[1:], len(w)) - 1
                recur = d[first] != d[last]
                known, low, sample = w[first][recur], d[first][recur], order[first[recur]]
            else:
                u, at = np.unique(wins, return_index=True)
                here = np.isin(u, told[0])
                known, sample = u[here], at[here]
                low = told[1][np.searchsorted(told[0], known)]
            if not len(known):
                continue
            begin = np.concatenate([[0], np.cumsum(size_of)])
            seg = np.searchsorted(begin, sample, side="right") - 1
            for w, f, s, p in zip(known.tolist(), low.tolist(), seg.tolist(), (sample - begin[seg]).tolist()):
                phrase = tuple(np.frombuffer(segments[s][3], np.uint32, size, 4 * p).tolist())
                k = automaton.get(phrase, -1)
                if k < 0:
                    automaton.add_word(phrase, len(entries))
                    entries.append({w: f})
                else:
                    entries[k][w] = min(f, entries[k].get(w, f))
        if entries:
            automaton.make_automaton()
            # segments of equal words hold the same phrases: each distinct one streams through the automaton once
            found: dict = {}
            for segments, _ in groups:
                for doc, sig, start, words, wins in segments:
                    places = found.get(words)
                    if places is None:
                        own, places = wins.tolist(), []
                        for end, k in automaton.iter(tuple(np.frombuffer(words, np.uint32).tolist())):
                            p = end - size + 1
                            first = entries[k].get(own[p])
                            if first is not None:
                                places.append((p, first))
                        found[words] = places
                    a = b = -1
                    for p, first in places:
                        if first < doc:
                            if a < 0:
                                a = p
                            elif p > b:
                                for col, x in zip(spans, (doc, sig, start + a, start + b)):
                                    col.append(x)
                                a = p
                            b = p + size
                    if a >= 0:
                        for col, x in zip(spans, (doc, sig, start + a, start + b)):
                            col.append(x)
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in spans], ["doc_id", "sig", "a", "b"])

    def run(batches):
        key, segments, told, groups, held = None, [], ([], []), [], 0

        def close():
            nonlocal segments, told, held
            if segments and (len(segments) > 1 or told[0]):
                table = None
                if told[0]:
                    order = np.argsort(told[0])
                    table = (np.array(told[0], I64)[order], np.array(told[1], I64)[order])
                groups.append((segments, table))
                held += sum(len(s[4]) for s in segments)
            segments, told = [], ([], [])

        for b in batches:
            for anchor, part, kind, doc, sig, start, words, windows in zip(*[c.to_pylist() for c in b.columns]):
                if (anchor, part) != key:
                    close()
                    if held > phrases:
                        yield search(groups)
                        groups, held = [], 0
                    key = (anchor, part)
                if kind:
                    segments.append((doc, sig, start, words, np.frombuffer(windows, I64)))
                else:
                    told[0].append(sig)
                    told[1].append(doc)
        close()
        if groups:
            yield search(groups)

    return run


def find_repeats(docs: DataFrame, size: int = SIZE, anchor: int = ANCHOR, hot: int = HOT, phrases: int = PHRASES) -> tuple[DataFrame, DataFrame]:
    """(whole, spans) of ``docs`` (doc_id long, text): (doc_id, sig) of documents that are copies altogether, and the word spans
    (doc_id, sig, a, b) to remove from others."""
    rows = materialize(docs.where("doc_id is not null and text is not null").mapInArrow(
        _summaries(size, anchor), "doc_id long, n long, sig long, anchors array<long>"), "phrase-anchors").where(f"n >= {size}")
    classes = rows.groupBy("n", "sig").agg(F.min("doc_id").alias("rep"))
    marked = rows.join(classes, ["n", "sig"])
    whole = marked.where("doc_id > rep").select("doc_id", "sig")
    each = marked.where("doc_id = rep").select("doc_id", "sig", F.explode("anchors").alias("anchor"))
    again = each.groupBy("anchor").agg(F.count("*").alias("c")).where("c > 1").select("anchor", F.ceil(F.col("c") / hot).cast("int").alias("groups"))
    lists = each.join(again, "anchor").groupBy("doc_id", "sig").agg(F.collect_list(F.struct("anchor", "groups")).alias("hot"))
    texts = docs.join(lists, "doc_id").select("doc_id", "text", "sig", "hot")
    segments = materialize(texts.mapInArrow(
        _segments(size, anchor), "anchor long, groups int, doc_id long, sig long, start long, words binary, windows binary"), "phrase-segments")
    # windows of anchors that are split: their first document
    seen = segments.where("groups > 1").select("anchor", "groups", "doc_id", "windows").mapInArrow(
        _explode_windows, "anchor long, groups int, window long, low long, high long")
    told = (seen.groupBy("anchor", "groups", "window").agg(F.min("low").alias("low"), F.max("high").alias("high")).where("low < high")
            .select("anchor", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias("part"), F.lit(0).alias("kind"), F.col("low").alias("doc_id"),
                    F.col("window").alias("sig"), F.lit(0).cast("long").alias("start"), F.lit(None).cast("binary").alias("words"),
                    F.lit(None).cast("binary").alias("windows")))
    parts = segments.select("anchor", F.pmod(F.xxhash64("doc_id"), F.col("groups")).cast("int").alias("part"), F.lit(1).alias("kind"), "doc_id", "sig", "start", "words", "windows")
    rows = parts.unionByName(told).repartition("anchor", "part").sortWithinPartitions("anchor", "part", "kind", "doc_id")
    return whole, rows.mapInArrow(_locate(size, phrases), "doc_id long, sig long, a long, b long")


def _cut_words():
    def run(batches):
        for b in batches:
            out = ([], [], [], [])
            texts = pa.array([t.as_py() or "" for t in b.column(1)], pa.large_string())
            sigs = np.concatenate([sig for _, _, sig, _ in _named(texts)]) if len(texts) else []
            for (doc, _, verdict), text, sig in zip(rows_of(b), texts, sigs):
                words = text.as_py().encode().split()
                gone = removed(len(words), int(sig), verdict)
                kept = [w for w, g in zip(words, gone.tolist()) if not g] if gone.any() else words
                for col, v in zip(out, (doc, len(words), len(words) - len(kept), b" ".join(kept).decode())):
                    col.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, (
                pa.int64(), pa.int64(), pa.int64(), pa.string()))], ["doc_id", "n_words", "n_removed", "kept_text"])

    return run


def remove_repeats(docs: DataFrame, id_name: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row per document: id, n_words, n_removed, kept_text (kept words joined by one blank).

    Null and empty texts have no words.  Rows with a null id neither count as occurrences nor lose words.  Rows of an equal id
    are compared with smaller ids only, each cut by its own text.  Other columns are ignored; an empty table gives no rows.
    """
    d = docs.select(F.col(f"`{id_name}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    out = cut(d, verdicts(*find_repeats(d, **options)), _cut_words(), "doc_id long, n_words long, n_removed long, kept_text string")
    return out.withColumnRenamed("doc_id", id_name)
