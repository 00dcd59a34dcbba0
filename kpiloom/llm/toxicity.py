"""Toxicity: a convolutional text classifier over hashed word embeddings, trained in numpy.

A word is the sum of two embeddings, both found by hash: of the word and of its beginning (so inflected and compound forms
share what was learned).  Filters of several widths slide over the whole text, each keeps its maximum, and a logistic
layer weighs the maxima.  Buckets that too few training documents use, or whose documents have labels as chance would deal
them (less than ``MIN_APART`` standard errors apart), stay zero: what was not learned says nothing, however long the text.

Every labelled row is learned from, by its whole text.  A quarter of them is set aside to calibrate: for each language,
guessed from the text's function words alone, the threshold that parts the labels best becomes score 0.5.  Few rows (at most
``sample`` of each label, none very long) are learned from on the driver.  Otherwise such a sample only gives the first weights;
then Spark counts the buckets over all rows, all rows are learned from in rounds (each task goes over its rows from the shared
weights, the changes are averaged) and the thresholds come from all rows set aside.
"""

from __future__ import annotations

import copy
import itertools
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kpiloom.llm.quality_rules import STOP_WORDS
from kpiloom.llm.textbytes import _LOWER, Bytes, slices

SAMPLE = 2000
SAMPLE_BYTES = 1 << 16                     # texts that are learned from have at most so many bytes
WIDTHS, FILTERS, DIM = (1, 2, 3), 16, 16
WORD_BUCKETS, HEAD_BUCKETS, HEAD_BYTES = 1 << 16, 1 << 15, 4
PART_BYTES = 32 << 20                      # text that one task learns from, before the changes are averaged
RATES = (0.02, 0.01)                       # of the rounds over all rows
GRAIN, STEP = 1 << 18, 1 << 8              # changes are summed as integers (in any order alike); logits are counted by steps
EPOCHS, BATCH, RATE, MIN_DOCS, MIN_APART = 8, 32, 0.05, 3, 2.5
LANGS = sorted(STOP_WORDS)
_KEEP = np.ones(256, dtype=bool)
_KEEP[[c for c in range(33, 127) if not chr(c).isalnum()]] = False


def _hashed(texts: pa.Array):
    """(first row, word buckets, head buckets, language of each word or -1, borders) of slices of texts.

    Bucket 0 is kept free.  Words in lower case without ASCII punctuation."""
    stop = {}
    for k, lang in enumerate(LANGS):
        for w in STOP_WORDS[lang]:
            stop.setdefault(w, []).append(k)
    own = {w: ks[0] for w, ks in stop.items() if len(ks) == 1}        # words of one language only
    data = np.frombuffer(" ".join(own).encode(), np.uint8)
    b = Bytes(data, np.array([0, len(data)]))
    s, e, _ = b.words()
    known = b.hash_spans(s, e)
    order = np.argsort(known)
    known, lang_of = known[order], np.array(list(own.values()))[order]
    for i, _, b in slices(texts):
        keep = _KEEP[b.data]
        at = np.concatenate([[0], np.cumsum(keep)])
        clean = Bytes(_LOWER[b.data[keep]], at[b.at])
        s, e, borders = clean.words()
        h = clean.hash_spans(s, e)
        head = clean.hash_spans(s, np.minimum(e, s + HEAD_BYTES))
        k = np.searchsorted(known, h)
        k[k == len(known)] = 0
        lang = np.where(known[k] == h, lang_of[k], -1)
        yield i, (h % np.uint64(WORD_BUCKETS - 1)).astype(np.int64) + 1, (head % np.uint64(HEAD_BUCKETS - 1)).astype(np.int64) + 1, lang, borders


@dataclass
class Model:
    words: np.ndarray
    heads: np.ndarray
    filters: list            # for each width an array (width, DIM, FILTERS)
    shift: np.ndarray        # of all filters
    weights: np.ndarray
    bias: float
    thresholds: np.ndarray   # for each language, and one for the rest
    state: list | None = None  # sums of squared gradients, while it is trained

    def parameters(self) -> list[np.ndarray]:
        return [self.words, self.heads, *self.filters, self.shift, self.weights, np.array([self.bias])]

    def matrix(self, arrays: list[np.ndarray]) -> np.ndarray:
        """Arrays shaped like the parameters as rows of DIM numbers."""
        flat = [np.asarray(a, np.float64).ravel() for a in arrays]
        return np.concatenate([np.pad(a, (0, -len(a) % DIM)).reshape(-1, DIM) for a in flat])

    def arrays(self, matrix: np.ndarray) -> list[np.ndarray]:
        """What :meth:`matrix` was made of."""
        out, at = [], 0
        for a in self.parameters():
            n = -(-a.size // DIM)
            out.append(matrix[at: at + n].ravel()[: a.size].reshape(a.shape).astype(a.dtype))
            at += n
        return out

    def assign(self, arrays: list[np.ndarray]) -> None:
        self.words, self.heads, *self.filters, self.shift, self.weights, bias = arrays
        self.bias = float(bias[0])

    def features(self, w: np.ndarray, h: np.ndarray, borders: np.ndarray) -> np.ndarray:
        """Maximum of each filter over each document; 0 for an empty one."""
        n, size = len(borders) - 1, np.diff(borders)
        x = self.words[w] + self.heads[h]
        # zeros after each document, so that no window reaches the next
        gap = max(WIDTHS) - 1
        start = borders[:-1] + gap * np.arange(n)
        place = np.arange(len(w)) + gap * np.repeat(np.arange(n), size)
        padded = np.zeros((len(w) + gap * (n + 1), DIM), np.float32)
        padded[place] = x
        out = np.zeros((n, len(WIDTHS) * FILTERS), np.float32)
        full = np.flatnonzero(size)
        if not len(full):
            return out
        edges = np.stack([start[full], start[full] + size[full]], axis=1).ravel()
        rows = len(padded) - gap
        for k, width in enumerate(WIDTHS):
            y = padded[:rows] @ self.filters[k][0]
            for j in range(1, width):
                y += padded[j: rows + j] @ self.filters[k][j]
            top = np.maximum.reduceat(y, edges if edges[-1] < rows else edges[:-1], axis=0)[::2]
            out[full, k * FILTERS: (k + 1) * FILTERS] = top
        out[full] = np.maximum(out[full] + self.shift, 0)
        return out

    def logits(self, features: np.ndarray) -> np.ndarray:
        return features @ self.weights + self.bias

    def score(self, texts: pa.Array) -> np.ndarray:
        out = np.zeros(len(texts))
        for i, w, h, lang, borders in _hashed(texts):
            z = self.logits(self.features(w, h, borders)) - self.thresholds[_guess(lang, borders)]
            out[i: i + len(z)] = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        return out


def _guess(lang: np.ndarray, borders: np.ndarray) -> np.ndarray:
    """The language with most function words in each document; len(LANGS) if none has any."""
    doc = np.repeat(np.arange(len(borders) - 1), np.diff(borders))
    hit = lang >= 0
    counts = np.bincount(doc[hit] * len(LANGS) + lang[hit], minlength=(len(borders) - 1) * len(LANGS)).reshape(-1, len(LANGS))
    return np.where(counts.any(axis=1), counts.argmax(axis=1), len(LANGS))


def train(texts: list[str], labels: np.ndarray, seed: int = 7) -> Model:
    """A model of these texts (labels 0 or 1). One label only, or no text: every score is that label's share."""
    rng = np.random.default_rng(seed)
    docs = []
    for _, w, h, lang, borders in _hashed(pa.array(texts, pa.large_string())):
        g = _guess(lang, borders)
        docs += [(w[a:b], h[a:b], int(g[k])) for k, (a, b) in enumerate(zip(borders[:-1], borders[1:]))]
    n = len(docs)
    y = np.asarray(labels, dtype=np.float64)
    m = Model(rng.normal(0, 0.1, (WORD_BUCKETS, DIM)).astype(np.float32), rng.normal(0, 0.1, (HEAD_BUCKETS, DIM)).astype(np.float32),
              [rng.normal(0, 0.5, (w, DIM, FILTERS)).astype(np.float32) for w in WIDTHS], np.zeros(len(WIDTHS) * FILTERS, np.float32),
              rng.normal(0, 0.3, len(WIDTHS) * FILTERS).astype(np.float32), 0.0, np.zeros(len(LANGS) + 1))
    if not n or y.min() == y.max():
        m.words[:], m.heads[:], m.weights[:] = 0, 0, 0
        m.bias = 20.0 if n and y.min() == 1 else -20.0
        return m
    order = rng.permutation(n)
    fit_rows, held = order[n // 4:], order[: n // 4]
    for table, part in ((m.words, 0), (m.heads, 1)):
        each = [np.unique(docs[k][part]) for k in fit_rows]
        used = np.bincount(np.concatenate(each), minlength=len(table))
        ones = np.bincount(np.concatenate([x for x, k in zip(each, fit_rows) if y[k] == 1] or [each[0][:0]]), minlength=len(table))
        table[~_telling(used, ones, y[fit_rows].mean())] = 0
    m.state = [np.zeros_like(a) for a in m.parameters()]
    for epoch in range(EPOCHS):
        todo = rng.permutation(fit_rows)
        _descend(m, [docs[k] for k in todo], y[todo], RATE * (1 - epoch / EPOCHS) + 0.005, y[fit_rows].mean())
    _calibrate(m, [docs[k] for k in held], y[held])
    return m


def _telling(used: np.ndarray, ones: np.ndarray, share: float) -> np.ndarray:
    """Buckets that enough documents use, with other labels than chance would deal them."""
    apart = np.abs(ones - used * share) / np.sqrt(np.maximum(used, 1) * share * (1 - share) + 1e-9)
    out = (used >= MIN_DOCS) & (apart >= MIN_APART)
    out[0] = False
    return out


def _descend(m: Model, docs: list, y: np.ndarray, rate: float, share: float) -> None:
    """One pass over the documents in their order, by small batches (Adagrad; both labels weigh alike)."""
    seen = (m.words.any(axis=1), m.heads.any(axis=1))
    state = m.state
    balance = {0: 0.5 / max(1e-9, 1 - share), 1: 0.5 / max(1e-9, share)}
    for at in range(0, len(docs), BATCH):
        batch, target = docs[at: at + BATCH], y[at: at + BATCH]
        size = np.array([len(d[0]) for d in batch])
        borders = np.concatenate([[0], np.cumsum(size)])
        w, h = np.concatenate([d[0] for d in batch]), np.concatenate([d[1] for d in batch])
        feats, peaks, x = _forward(m, w, h, borders)
        z = m.logits(feats)
        g = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - target) * np.array([balance[int(t)] for t in target]) / len(batch)
        grads = [np.zeros_like(f) for f in m.filters]
        gw = feats.T @ g + 1e-4 * m.weights
        gf = (g[:, None] * m.weights[None, :]) * (feats > 0)
        rows_w, rows_h, rows_g = [], [], []
        for k, width in enumerate(WIDTHS):
            cols = slice(k * FILTERS, (k + 1) * FILTERS)
            d, f = np.nonzero(gf[:, cols])
            p, v = peaks[k][d, f], gf[:, cols][d, f].astype(np.float32)
            for j in range(width):
                ok = p + j < borders[d + 1]
                q = (p + j)[ok]
                np.add.at(grads[k][j].T, f[ok], x[q] * v[ok, None])
                rows_w.append(w[q])
                rows_h.append(h[q])
                rows_g.append(m.filters[k][j].T[f[ok]] * v[ok, None])
        rw, rh, rg = np.concatenate(rows_w), np.concatenate(rows_h), np.concatenate(rows_g)
        for table, rows, st, known in ((m.words, rw, state[0], seen[0]), (m.heads, rh, state[1], seen[1])):
            u, inv = np.unique(rows, return_inverse=True)
            total = np.zeros((len(u), DIM), np.float32)
            np.add.at(total, inv, rg)
            u, total = u[known[u]], total[known[u]]
            st[u] += total ** 2
            table[u] -= rate * total / (np.sqrt(st[u]) + 1e-6)
        for param, grad, st in (*zip(m.filters, grads, state[2:-3]), (m.shift, gf.sum(axis=0).astype(np.float32), state[-3]), (m.weights, gw.astype(np.float32), state[-2])):
            st += grad ** 2
            param -= (rate * grad / (np.sqrt(st) + 1e-6)).astype(np.float32)
        gb = float(g.sum())
        state[-1] += gb ** 2
        m.bias -= rate * gb / (float(state[-1][0]) ** 0.5 + 1e-6)


def _forward(m: Model, w, h, borders):
    """Features, the place of each maximum, and the embedded words."""
    x = m.words[w] + m.heads[h]
    n = len(borders) - 1
    feats, peaks = np.zeros((n, len(WIDTHS) * FILTERS), np.float32), []
    pad = np.concatenate([x, np.zeros((max(WIDTHS), DIM), np.float32)])
    for k, width in enumerate(WIDTHS):
        best = np.zeros((n, FILTERS), np.int64)
        for d in range(n):
            a, b = borders[d], borders[d + 1]
            if a == b:
                best[d] = a
                continue
            own = np.zeros((b - a + width - 1, DIM), np.float32)
            own[: b - a] = pad[a:b]
            y = own[: b - a] @ m.filters[k][0]
            for j in range(1, width):
                y += own[j: b - a + j] @ m.filters[k][j]
            top = y.argmax(axis=0)
            best[d] = a + top
            feats[d, k * FILTERS: (k + 1) * FILTERS] = y[top, np.arange(FILTERS)]
        peaks.append(best)
    size = np.diff(borders)
    feats[size > 0] = np.maximum(feats[size > 0] + m.shift, 0)
    return feats, peaks, x


def _cut(z: np.ndarray, y: np.ndarray) -> float:
    """The threshold that parts the labels best (balanced accuracy), in the middle of the widest range of equal worth."""
    return _cut_counts(z, y == 0, y == 1)


def _cut_counts(z: np.ndarray, zeros: np.ndarray, ones: np.ndarray) -> float:
    """The same of logits with the number of documents of each label."""
    values, where = np.unique(z, return_inverse=True)
    down, up = np.bincount(where, zeros), np.bincount(where, ones)
    cuts = np.concatenate([[values[0] - 1], (values[1:] + values[:-1]) / 2, [values[-1] + 1]])
    below = np.concatenate([[0], np.cumsum(down)]) / max(1, down.sum())
    above = (up.sum() - np.concatenate([[0], np.cumsum(up)])) / max(1, up.sum())
    worth = above + below
    good = np.flatnonzero(worth >= worth.max() - 1e-12)
    room = [(values[min(k, len(values) - 1)] - values[max(k - 1, 0)]) for k in good]
    return float(cuts[good[int(np.argmax(room))]])


def _calibrate(m: Model, docs, y) -> None:
    """One threshold for each language with ten documents of either label set aside, and one for all the others."""
    if not len(docs):
        return
    borders = np.concatenate([[0], np.cumsum([len(d[0]) for d in docs])])
    z = m.logits(m.features(np.concatenate([d[0] for d in docs]), np.concatenate([d[1] for d in docs]), borders))
    lang = np.array([d[2] for d in docs])
    if len(np.unique(y)) == 2:
        m.thresholds[:] = _cut(z, y)
    for k in range(len(LANGS)):
        own = lang == k
        if min((own & (y == 0)).sum(), (own & (y == 1)).sum()) >= 10:
            m.thresholds[k] = _cut(z[own], y[own])


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_name: str = "doc_id", text: str = "text", longest: int = SAMPLE_BYTES) -> Model:
    """Train on every row with a label (``labels``: id, label 0 or 1; null labels are left out, of several labels of one id
    the largest counts).

    What reaches the driver is bounded: for the first weights at most ``sample`` ids of each label, those with the smallest
    hash, one text an id, that with the smallest hash, of at most ``longest`` bytes (256 MB as it stands). If that is all there
    is, the model is ready; else all rows are learned from by :func:`_refine`, whole and however many. Null texts count as
    empty; without rows or labels the model gives every text the same score. Other columns are ignored.
    """
    each = labels.where("label in (0, 1)").groupBy(F.col(f"`{id_name}`").alias("_id")).agg(F.max("label").cast("int").alias("label")).where("_id is not null")
    d = docs.select(F.col(f"`{id_name}`").alias("_id"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("_text")).where("_id is not null")
    size = F.octet_length("_text")
    stats = d.select("_id", size.cast("long").alias("size")).join(each, "_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("size").alias("bytes"), F.count_if(F.col("size") > longest).alias("long"),
        F.count_if(F.col("label") == 0).alias("zeros"), F.count_distinct("_id").alias("ids")).first()
    whole = stats["n"] == stats["ids"] and not stats["long"] and stats["zeros"] <= sample and stats["n"] - stats["zeros"] <= sample
    if whole:
        first = d.join(each, "_id").collect()
    else:
        picked = None
        for v in (0, 1):
            part = each.where(F.col("label") == v).orderBy(F.xxhash64("_id"), "_id").limit(sample)
            picked = part if picked is None else picked.union(part)
        # at most 2 x sample ids: small enough to send to every task
        short = d.withColumn("_hash", F.xxhash64("_id", "_text")).where((size <= longest) & ~_aside())
        first = short.join(F.broadcast(picked), "_id").groupBy("_id", "label").agg(F.min_by("_text", F.xxhash64("_text")).alias("_text")).collect()
    first = sorted(first, key=lambda r: (r["_id"], r["_text"]))
    model = train([r["_text"] for r in first], np.array([r["label"] for r in first]))
    if not whole and 0 < stats["zeros"] < stats["n"]:
        model = _refine(model, d, each, max(1, -(-stats["bytes"] // PART_BYTES)))
    model.state = None
    return model


def _aside():
    """Rows set aside to calibrate: a quarter."""
    return F.pmod(F.xxhash64("_hash"), F.lit(4)) == 0


def _tokens(batches):
    """_id, _hash, language, word and head buckets (unsigned 16-bit) of each row of batches (_id, _hash, _text)."""
    for b in batches:
        for i, w, h, lang, borders in _hashed(b.column(2)):
            n, at = len(borders) - 1, pa.array(2 * borders, pa.int64()).buffers()[1]
            w, h = (pa.LargeBinaryArray.from_buffers(pa.large_binary(), n, [None, at, pa.py_buffer(x.astype(np.uint16).tobytes())]) for x in (w, h))
            yield pa.RecordBatch.from_arrays([b.column(0).slice(i, n), b.column(1).slice(i, n), pa.array(_guess(lang, borders).astype(np.int64)),
                                              w.cast(pa.binary()), h.cast(pa.binary())], ["_id", "_hash", "lang", "words", "heads"])


def _documents(batches):
    """(words, heads, language, label) of each row of batches (words, heads, lang, label)."""
    for b in batches:
        for w, h, lang, y in zip(*(b.column(k) for k in range(4))):
            yield *(np.frombuffer(x.as_buffer(), np.uint16).astype(np.int64) for x in (w, h)), lang.as_py(), y.as_py()


def _batches(rows, n: int = BATCH):
    """Lists of ``n`` documents."""
    rows = iter(rows)
    while some := list(itertools.islice(rows, n)):
        yield some


def _refine(m: Model, d: DataFrame, labels: DataFrame, parts: int) -> Model:
    """The model after rounds over all rows of ``d`` (_id, _text) with a label (``labels``: _id, label).

    Texts are hashed once; their buckets, some half of the text, are shuffled to their labels once and kept on the executors'
    disks for the rounds. What the driver gets is as large as the model.
    """
    spark, kind = d.sparkSession, d.schema["_id"].dataType.simpleString()
    hashed = d.select("_id", F.xxhash64("_id", "_text").alias("_hash"), "_text").mapInArrow(_tokens, f"_id {kind}, _hash long, lang long, words binary, heads binary")
    none = [F.lit(None).cast(t).alias(c) for c, t in (("_hash", "long"), ("lang", "long"), ("words", "binary"), ("heads", "binary"))]
    both = hashed.withColumn("label", F.lit(None).cast("int")).unionByName(labels.select("_id", *none, "label"))
    # as many partitions as there are bytes for, whatever the session's width: a task's rows have to suffice to learn from
    known = both.repartition(parts, "_id").withColumn("label", F.max("label").over(Window.partitionBy("_id")))
    rows = known.where("words is not null and label is not null").sortWithinPartitions("_hash", "_id")
    rows = rows.persist(StorageLevel.DISK_ONLY)
    try:
        return _rounds(spark, m, rows)
    finally:
        rows.unpersist()


def _rounds(spark: SparkSession, m: Model, rows: DataFrame) -> Model:
    columns = ["words", "heads", "lang", "label"]
    fit_rows, held = rows.where(~_aside()).select(*columns), rows.where(_aside()).select(*columns)

    def count(batches):
        used = np.zeros((2, WORD_BUCKETS + HEAD_BUCKETS), np.int64)
        n = np.zeros(2, np.int64)
        for w, h, _, y in _documents(batches):
            used[y, np.unique(w)] += 1
            used[y, WORD_BUCKETS + np.unique(h)] += 1
            n[y] += 1
        at = np.flatnonzero(used.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(used[0, at], n[0])), pa.array(np.append(used[1, at], n[1]))], ["at", "zeros", "ones"])

    counts = fit_rows.mapInArrow(count, "at long, zeros long, ones long").groupBy("at").agg(F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones")).toArrow()
    at, zeros, ones = (counts.column(c).to_numpy() for c in ("at", "zeros", "ones"))
    total = at == -1
    n, share = int((zeros + ones)[total].sum()), float(ones[total].sum() / max(1, (zeros + ones)[total].sum()))
    if not n or share in (0.0, 1.0):
        return m
    if m.state is None:                                    # nothing was learned from the sample
        m = train(["", ""], np.array([0, 1]))
    used, one = np.zeros(WORD_BUCKETS + HEAD_BUCKETS, np.int64), np.zeros(WORD_BUCKETS + HEAD_BUCKETS, np.int64)
    used[at[~total]], one[at[~total]] = (zeros + ones)[~total], ones[~total]
    rng = np.random.default_rng(11)
    for table, a, b in ((m.words, 0, WORD_BUCKETS), (m.heads, WORD_BUCKETS, WORD_BUCKETS + HEAD_BUCKETS)):
        telling = _telling(used[a:b], one[a:b], share)
        new = telling & ~table.any(axis=1)
        table[new] = rng.normal(0, 0.1, (int(new.sum()), DIM)).astype(np.float32)
        table[~telling] = 0

    for rate in RATES:
        shared = spark.sparkContext.broadcast(m)

        def learn(batches, rate=rate, shared=shared):
            own = copy.deepcopy(shared.value)
            before = np.hstack([own.matrix(own.parameters()), own.matrix(own.state)])
            seen = 0
            for docs in _batches(_documents(batches)):
                _descend(own, docs, np.array([d[3] for d in docs], np.float64), rate, share)
                seen += len(docs)
            if seen:
                change = np.hstack([own.matrix(own.parameters()), own.matrix(own.state)]) - before
                at = np.flatnonzero(change.any(axis=1))
                fixed = np.rint(change[at] * (seen * GRAIN)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(np.full(len(at), seen))] + [pa.array(fixed[:, k]) for k in range(2 * DIM)], ["at", "n", *names])

        names = [f"c{k}" for k in range(2 * DIM)]
        changes = fit_rows.mapInArrow(learn, "at long, n long, " + ", ".join(f"{c} long" for c in names)).groupBy("at").agg(
            F.sum("n").alias("n"), *[F.sum(c).alias(c) for c in names]).toArrow()
        mean = np.zeros((len(m.matrix(m.parameters())), 2 * DIM))
        mean[changes.column("at").to_numpy()] = np.stack([changes.column(c).to_numpy() for c in names], axis=1) / (changes.column("n").to_numpy()[:, None] * float(GRAIN))
        params, state = m.matrix(m.parameters()) + mean[:, :DIM], m.matrix(m.state) + mean[:, DIM:]
        state = m.arrays(np.maximum(state, 0))
        m.assign(m.arrays(params))
        m.state = state
        shared.unpersist()

    shared = spark.sparkContext.broadcast(m)

    def place(batches):
        for docs in _batches(_documents(batches), 256):
            borders = np.concatenate([[0], np.cumsum([len(d[0]) for d in docs])])
            z = shared.value.logits(shared.value.features(np.concatenate([d[0] for d in docs]), np.concatenate([d[1] for d in docs]), borders))
            step = np.rint(np.clip(z, -1000, 1000) * STEP).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array([d[2] for d in docs]), pa.array(step), pa.array([d[3] for d in docs])], ["lang", "step", "label"])

    spots = held.mapInArrow(place, "lang long, step long, label long").groupBy("lang", "step").agg(
        F.count_if(F.col("label") == 0).alias("zeros"), F.count_if(F.col("label") == 1).alias("ones")).toArrow()
    lang, step, zeros, ones = (spots.column(c).to_numpy() for c in ("lang", "step", "zeros", "ones"))
    if zeros.sum() and ones.sum():
        m.thresholds[:] = _cut_counts(step / STEP, zeros, ones)
    for k in range(len(LANGS)):
        own = lang == k
        if min(zeros[own].sum(), ones[own].sum()) >= 10:
            m.thresholds[k] = _cut_counts(step[own] / STEP, zeros[own], ones[own])
    return m


def score(docs: DataFrame, model: Model, id_name: str = "doc_id", text: str = "text") -> DataFrame:
    """id and score (0 to 1) of every row; null texts count as empty, repeated rows get equal scores."""
    shared = docs.sparkSession.sparkContext.broadcast(model)       # fixed size, whatever the corpus
    kind = docs.schema[id_name].dataType.simpleString()

    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(shared.value.score(b.column(1)), pa.float64())], [id_name, "score"])

    d = docs.select(F.col(f"`{id_name}`"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("_text"))
    return d.mapInArrow(run, f"`{id_name}` {kind}, score double")
