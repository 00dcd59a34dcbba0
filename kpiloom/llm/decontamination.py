"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

Seeds are the runs of ``n`` words of the test items.  Every whole document is read once; where it holds seeds, the words
around them are kept, coded by the words of the benchmark (a word no item has is -1).  How often each seed occurs is counted
over the whole corpus; a seed is rare when it does not occur much more often than the item it belongs to as a whole
would explain: at most ``commonness`` times as often as three quarters of that item's seeds do (an item copied into a
thousand documents has seeds that occur a thousand times; it is phrases of common words that stand out).  Document and item that
share a rare seed are aligned: Smith-Waterman over words, so that substitutions, insertions and gaps only cost their
part.  A document is contaminated where the score reaches ``threshold`` of what the whole item scores against itself.

The benchmark is a stated set of queries: it is sent to every task, after a check of its size.  What the corpus yields is
never collected: seeds are counted by an aggregation and joined.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpiloom.llm.common import materialize
from kpiloom.llm.textbytes import _ODD, Bytes, U, inside, mix, ngrams, slices

N, THRESHOLD, COMMONNESS = 3, 0.5, 50.0
MATCH, MISMATCH, GAP = 2, -1, -1
MAX_BENCHMARK_BYTES = 64 << 20
ALIGN = 512                      # pairs aligned at a time
_KEEP = np.ones(256, dtype=bool)                      # signs that do not count: ASCII punctuation
_KEEP[[c for c in range(33, 127) if not chr(c).isalnum()]] = False


def _folded(text: str) -> Column:
    """The text column without case, over all of Unicode: small letters, then capitals, so that letters whose other case is
    two letters (ß, SS) or another sign agree.  The empty text between keeps the optimizer from dropping the first step."""
    return F.upper(F.concat(F.lower(F.col(f"`{text}`").cast("string")), F.lit("")))


def _coded(texts: pa.Array):
    """(first row, word hashes, borders) of slices of folded texts: ASCII punctuation left out."""
    for i, _, b in slices(texts):
        keep = _KEEP[b.data]
        at = np.concatenate([[0], np.cumsum(keep)])
        clean = Bytes(b.data[keep], at[b.at])
        start, end, borders = clean.words()
        yield i, clean.hash_spans(start, end), borders


def benchmark_index(benchmark: DataFrame, n: int = N, id_name: str = "item_id", text: str = "text") -> dict:
    """The items, coded: their word hashes, and their seeds.  Items without words cannot match and are left out; an item of
    fewer than ``n`` words has one seed, all of it.  Repeated items are kept: each is reported."""
    rows = benchmark.select(F.col(f"`{id_name}`").cast("long").alias("i"), _folded(text).alias("t")).where("i is not null and t is not null")
    size = rows.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    if size > MAX_BENCHMARK_BYTES:
        raise ValueError(f"the benchmark has {size} bytes; split it into parts of {MAX_BENCHMARK_BYTES}")
    got = sorted((r["i"], r["t"]) for r in rows.collect())
    ids, words = [], []
    for first, h, borders in _coded(pa.array([t for _, t in got], pa.large_string())):
        for k in range(len(borders) - 1):
            if borders[k + 1] > borders[k]:
                ids.append(got[first + k][0])
                words.append(h[borders[k]: borders[k + 1]])
    seeds: dict[int, dict[int, set]] = {}
    for k, w in enumerate(words):
        m = min(n, len(w))
        seeds.setdefault(m, {})
        for s in ngrams(w, m).tolist():
            seeds[m].setdefault(s, set()).add(k)
    vocabulary = np.unique(np.concatenate(words)) if words else np.zeros(0, np.uint64)
    return {"ids": ids, "vocabulary": vocabulary, "words": [np.searchsorted(vocabulary, w).astype(np.int32) for w in words],
            "seeds": {m: (np.array(sorted(s), dtype=np.uint64), [sorted(s[x]) for x in sorted(s)]) for m, s in seeds.items()}}


def _scan(index):
    """Windows of documents around seeds: (doc_id, seeds found, their places, start, coded words, words in the document)."""
    reach = 2 * max((len(w) for w in index["words"]), default=0)
    vocabulary = index["vocabulary"]

    def scan(batches):
        for b in batches:
            doc_ids = b.column(0).to_pylist()
            out = {k: [] for k in ("doc_id", "seed", "place", "start", "words", "n_words")}
            for first, h, borders in _coded(b.column(1)):
                if not len(h) or not len(vocabulary):
                    continue
                at = np.searchsorted(vocabulary, h)
                at[at == len(vocabulary)] = 0
                code = np.where(vocabulary[at] == h, at, -1).astype(np.int32)
                places, seeds = [], []
                for m, (known, _) in index["seeds"].items():
                    ok, doc = inside(borders, m)
                    inside_vocabulary = ok.copy()
                    for j in range(m):
                        inside_vocabulary &= code[j: j + len(ok)] >= 0
                    p = np.flatnonzero(inside_vocabulary)
                    if not len(p):
                        continue
                    g = _grams_at(h, p, m)
                    k = np.searchsorted(known, g)
                    k[k == len(known)] = 0
                    hit = known[k] == g
                    places.append(p[hit])
                    seeds.append(g[hit])
                if not places:
                    continue
                places, seeds = np.concatenate(places), np.concatenate(seeds)
                order = np.argsort(places, kind="stable")
                places, seeds = places[order], seeds[order]
                if not len(places):
                    continue
                doc = np.searchsorted(borders, places, side="right") - 1
                # seeds of one document that lie near each other share a window
                new = np.concatenate([[True], (doc[1:] != doc[:-1]) | (np.diff(places) > reach)])
                edge = np.append(np.flatnonzero(new), len(places))
                for lo, hi in zip(edge[:-1].tolist(), edge[1:].tolist()):
                    d = int(doc[lo])
                    s = max(int(borders[d]), int(places[lo]) - reach)
                    e = min(int(borders[d + 1]), int(places[hi - 1]) + reach)
                    out["doc_id"].append(doc_ids[first + d])
                    out["seed"].append(seeds[lo:hi].view(np.int64))
                    out["place"].append((places[lo:hi] - s).astype(np.int32))
                    out["start"].append(s - int(borders[d]))
                    out["words"].append(code[s:e].tobytes())
                    out["n_words"].append(int(borders[d + 1] - borders[d]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(out["doc_id"], pa.int64()), pa.array(out["seed"], pa.list_(pa.int64())), pa.array(out["place"], pa.list_(pa.int32())),
                 pa.array(out["start"], pa.int64()), pa.array(out["words"], pa.binary()), pa.array(out["n_words"], pa.int64())], list(out))

    return scan


def _grams_at(h: np.ndarray, places: np.ndarray, m: int) -> np.ndarray:
    """The hashes that ``ngrams`` gives, at some places only."""
    g = np.zeros(len(places), dtype=U)
    for j in range(m):
        g *= U(_ODD)
        g += h[places + j]
    return mix(g)


def smith_waterman(items: list[np.ndarray], windows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best local alignment of each item with its window: score, first and last + 1 place in the window.

    All pairs advance together, a word of the items a step; within a row, gaps in the item spread by a running maximum.
    """
    n, rows, cols = len(items), max(map(len, items)), max(map(len, windows))
    a, b = np.full((n, rows), -2, np.int32), np.full((n, cols), -3, np.int32)
    for k in range(n):
        a[k, : len(items[k])] = items[k]
        b[k, : len(windows[k])] = windows[k]
    prev, origin = np.zeros((n, cols + 1), np.int32), np.tile(np.arange(cols + 1, dtype=np.int32), (n, 1))
    best, first, last = np.zeros(n, np.int32), np.zeros(n, np.int32), np.zeros(n, np.int32)
    slope = (-GAP * np.arange(cols + 1)).astype(np.int32)
    here = np.arange(cols + 1, dtype=np.int32)[None, :]
    pick = np.arange(n)
    for r in range(rows):
        diag = prev[:, :-1] + np.where(a[:, r: r + 1] == b, MATCH, MISMATCH)
        up = prev[:, 1:] + GAP
        cur, org = np.zeros_like(prev), np.broadcast_to(here, prev.shape).copy()
        cur[:, 1:] = np.maximum(np.maximum(diag, up), 0)
        org[:, 1:] = np.where(diag >= up, origin[:, :-1], origin[:, 1:])
        org[:, 1:][cur[:, 1:] == 0] = np.broadcast_to(here[:, 1:], (n, cols))[cur[:, 1:] == 0]
        # a gap of k words in the item costs k: the best start is a running maximum of score + cost so far
        lifted = (cur + slope).astype(np.int64) * (cols + 2) + (cols + 1 - here)       # ties: the leftmost
        run = np.maximum.accumulate(lifted, axis=1)
        source = (cols + 1 - run % (cols + 2)).astype(np.int64)
        spread = (run // (cols + 2)).astype(np.int32) - slope
        org = np.where(spread > cur, np.take_along_axis(org, source, axis=1), org)
        prev, origin = np.maximum(cur, spread), org
        top = prev.argmax(axis=1)
        better = prev[pick, top] > best
        best = np.where(better, prev[pick, top], best)
        first = np.where(better, origin[pick, top], first)
        last = np.where(better, top, last)
    return best, first, last


def _align(index, threshold):
    """Rows (doc_id, start, words, n_words, item) to those whose alignment reaches the threshold."""
    def align(batches):
        for b in batches:
            rows = b.to_pylist()
            rows.sort(key=lambda r: len(r["words"]))
            out = []
            for i in range(0, len(rows), ALIGN):
                part = rows[i: i + ALIGN]
                items = [index["words"][r["item"]] for r in part]
                score, first, last = smith_waterman(items, [np.frombuffer(r["words"], np.int32) for r in part])
                for r, w, s, f, e in zip(part, items, score.tolist(), first.tolist(), last.tolist()):
                    if s >= threshold * MATCH * len(w):
                        out.append((r["doc_id"], index["ids"][r["item"]], s / (MATCH * len(w)), r["start"] + f, r["start"] + e, r["n_words"]))
            cols = list(zip(*out)) if out else [[]] * 6
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(
                cols, (pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64(), pa.int64()))],
                ["doc_id", "item_id", "score", "first_word", "end_word", "n_words"])

    return align


def find_leaks(docs: DataFrame, benchmark: DataFrame, n: int = N, threshold: float = THRESHOLD, commonness: float = COMMONNESS,
               id_name: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per (document, item) found: doc_id, item_id, score (0 to 1), first_word, end_word, n_words.

    Words are compared without case (that of all of Unicode) and without ASCII punctuation.  Null and empty texts hold nothing; rows with a null id are
    searched and reported with a null id; repeated rows are reported once; other columns are ignored; an empty benchmark
    or table gives no rows.
    """
    spark = docs.sparkSession
    index = benchmark_index(benchmark, n)
    shared = spark.sparkContext.broadcast(index)
    d = docs.select(F.col(f"`{id_name}`").cast("long").alias("doc_id"), _folded(text).alias("text")).where("text is not null")
    found = d.mapInArrow(lambda batches: _scan(shared.value)(batches),
                         "doc_id long, seed array<long>, place array<int>, start long, words binary, n_words long")
    found = materialize(found, "leak-windows")
    # how often each seed occurs in the corpus; which items it belongs to is a small table
    members = [(int(np.uint64(s).view(np.int64)), k) for known, owners in index["seeds"].values() for s, o in zip(known, owners) for k in o]
    owner = spark.createDataFrame(members, "seed long, item int")
    counts = found.select(F.explode("seed").alias("seed")).groupBy("seed").agg(F.count("*").alias("n"))
    usual = owner.join(counts, "seed").groupBy("item").agg(F.percentile("n", F.lit(0.75)).alias("usual"))
    rare = owner.join(counts, "seed").join(usual, "item").where(F.col("n") <= commonness * F.col("usual")).select("seed", "item")
    rare = spark.sparkContext.broadcast(_by_seed(rare.collect()))          # at most the seeds of the benchmark
    pairs = found.mapInArrow(lambda batches: _pairs(rare.value)(batches), "doc_id long, start long, words binary, n_words long, item int")
    hits = pairs.repartition(F.xxhash64("doc_id", "start", "item")).mapInArrow(
        lambda batches: _align(shared.value, threshold)(batches),
        "doc_id long, item_id long, score double, first_word long, end_word long, n_words long")
    # the best place of an item in a document
    best = F.max(F.struct("score", (-F.col("first_word")).alias("a"), "end_word", "n_words")).alias("b")
    return hits.groupBy("doc_id", "item_id").agg(best).select(
        "doc_id", "item_id", "b.score", (-F.col("b.a")).alias("first_word"), "b.end_word", "b.n_words")


def _by_seed(rows) -> dict:
    out: dict[int, list] = {}
    for r in rows:
        out.setdefault(r["seed"], []).append(r["item"])
    return out


def _pairs(rare: dict):
    """A row per window and item that share a rare seed, with the part of the window the item can reach."""
    def pairs(batches):
        for b in batches:
            out = {k: [] for k in ("doc_id", "start", "words", "n_words", "item")}
            for r in b.to_pylist():
                items = {k for s in r["seed"] for k in rare.get(s, ())}
                for k in sorted(items):
                    for name in ("doc_id", "start", "words", "n_words"):
                        out[name].append(r[name])
                    out["item"].append(k)
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), (pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int32()))], list(out))

    return pairs


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_name: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text holds no item.  Judged by text: a row with a null id is judged like any other."""
    cols = docs.columns
    name = F.xxhash64(F.col(f"`{text}`"))
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in cols]).alias("_row"), name.alias("_key"), F.col(f"`{text}`").alias("_text"))
    bad = find_leaks(keyed, benchmark, id_name="_key", text="_text").select(F.col("doc_id").alias("_key")).distinct()
    return keyed.join(bad, "_key", "left_anti").select("_row.*")
