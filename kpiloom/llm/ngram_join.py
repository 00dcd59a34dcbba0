"""N-gram Jaccard join with prefix trees.

A document's set holds the hashes of its distinct word n-grams, globally ordered by hash.  Two documents link when
100 * shared >= percent * union.  The join is exact: no link is lost, whatever the sizes of groups.

1. One pass over the texts gives each document the size of its set, a 128-bit name of the whole set, and its prefix.
   Documents with equal sets are one class from here on (an aggregation, combined on the map side), so copies are never
   paired with each other.
2. Prefixes.  A partner shares at least t = ceil(percent% of n) of a set's n n-grams, so of its first n - t + l it shares
   l at least.  With l growing with n (``extra``), a class goes on only if enough of its prefix stands in prefixes of other
   classes, which chance and single shared passages do not reach.  This is counting and joining by n-gram.
3. Blocks.  All classes with an n-gram in common, within a ratio of sizes that links allow, meet in the block of the
   smallest of them.  A class stays in a block only if enough of its shared prefix leads there.
4. In a block, the sets stand in a trie, most common n-gram first.  A walk carries for each set of the block how
   much it shares with the path so far: sets that begin alike share that work, and a subtree is left when what its sets and
   a partner still can share is not enough.  Blocks of more than ``cell`` sets are cut into cells of pairs of parts, so
   memory is bounded and a group with a third of all rows is spread over many tasks.
5. Links make components (each cell only sends a forest of its links); copies get the component of their class.

64-bit hashes: within a pair of sets of a million n-grams each, two different ones fall together with odds of 1 in
10 million; no other approximation is made.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiloom.llm.common import components, materialize
from kpiloom.llm.textbytes import U, inside, mix, ngrams, slices

EXTRA = 0.05
CELL = 2048
I64 = np.int64


def _need(n, percent: int):
    """Least number of shared n-grams of a set of n with any partner."""
    return -(-n * percent // 100)


def _sets(texts: pa.Array, k: int):
    """(row, sorted distinct hashes) of each text; texts with fewer than k words, but some, have one n-gram."""
    for i, _, b in slices(texts):
        b = b.lower()
        start, end, borders = b.words()
        h = b.hash_spans(start, end)
        ok, doc = inside(borders, k)
        g, d = ngrams(h, k)[ok], doc[: len(ok)][ok]
        size = np.diff(borders)
        short = np.flatnonzero((size > 0) & (size < k))
        if len(short):
            one = np.concatenate([ngrams(h[borders[r]: borders[r + 1]], int(size[r])) for r in short])
            g, d = np.concatenate([g, mix(one + size[short].astype(U))]), np.concatenate([d, short])
        order = np.lexsort((g, d))
        g, d = g[order], d[order]
        if len(g):
            new = np.concatenate([[True], (d[1:] != d[:-1]) | (g[1:] != g[:-1])])
            g, d = g[new], d[new]
        at = np.searchsorted(d, np.arange(len(size) + 1))
        for r in range(len(size)):
            yield i + r, g[at[r]: at[r + 1]]


def _summaries(k: int, percent: int, extra: float):
    def run(batches):
        for b in batches:
            ids = b.column(0).to_pylist()
            out = [[], [], [], [], []]
            for r, s in _sets(b.column(1), k):
                n = len(s)
                a = int(mix(s).sum(dtype=U)) if n else 0
                c = int(mix(s ^ U(0x5851F42D4C957F2D)).sum(dtype=U)) if n else 0
                for col, v in zip(out, (ids[r], n, np.uint64(a).astype(I64), np.uint64(c).astype(I64),
                                        s[: min(n, n - _need(n, percent) + 1 + int(extra * n))].view(I64) if n else np.zeros(0, I64))):
                    col.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, (
                pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64())))], ["doc_id", "n", "sig_a", "sig_b", "prefix"])

    return run


def _payload(k: int):
    """Adds the whole set to the rows (rep, blocks, text)."""
    def run(batches):
        for b in batches:
            sets = [None] * len(b)
            for r, s in _sets(b.column(1), k):
                sets[r] = s.tobytes()
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), b.column(3), pa.array(sets, pa.binary())], ["rep", "copies", "blocks", "grams"])

    return run


def _walk(sets: list[np.ndarray], sides: np.ndarray, percent: int):
    """Pairs (i, partners) of linked sets of a cell, found by a walk over the trie of its sets; i before its partners.

    ``sides``: bit 1 for the first part of the cell, bit 2 for the second; a pair has one of each.
    """
    n = np.array([len(s) for s in sets])
    every = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), n)
    grams, code, df = np.unique(every, return_inverse=True, return_counts=True)
    # most common first; what only one set has cannot be shared and is left out (sizes still count it)
    rank = np.empty(len(grams), I64)
    rank[np.lexsort((grams, -df))] = np.arange(len(grams))
    common = df[code] > 1
    own, tok = owner[common], rank[code[common]]
    order = np.lexsort((tok, own))
    own, tok = own[order], tok[order]
    at = np.searchsorted(own, np.arange(len(sets) + 1))
    paths = [tok[at[i]: at[i + 1]] for i in range(len(sets))]
    posts = np.argsort(tok, kind="stable")
    members = own[posts]                                     # sets that hold each n-gram
    p_at = np.searchsorted(tok[posts], np.arange(int((df > 1).sum()) + 1))
    left = [len(p) for p in paths]
    seq = sorted(range(len(sets)), key=lambda i: paths[i].tolist())
    # the trie as the sorted list of paths: how far each agrees with the one before
    agree = [0] * len(seq)
    for x in range(1, len(seq)):
        a, b = paths[seq[x - 1]], paths[seq[x]]
        m = min(len(a), len(b))
        diff = np.flatnonzero(a[:m] != b[:m])
        agree[x] = int(diff[0]) if len(diff) else m
    out = []
    total = len(sets)

    def down(lo: int, hi: int, depth: int, shared: np.ndarray, alive: np.ndarray):
        """Paths lo..hi agree up to ``depth``; ``shared`` of each of the sets ``alive`` with that part."""
        while True:
            below = np.array([n[seq[x]] for x in range(lo, hi)]) if hi - lo > 1 else n[seq[lo]: seq[lo] + 1]
            rest = max(left[seq[x]] for x in range(lo, hi)) - depth
            small, large = int(below.min()), int(below.max())
            m = n[alive]
            # a partner of m n-grams shares at least percent / (100 + percent) of both sizes, and no more than is left
            bound = np.minimum(shared + rest, m)
            fits = (bound * (100 + percent) >= percent * (m + small)) & (m * 100 >= percent * small) & (large * 100 >= percent * m)
            if not fits.all():
                alive, shared = alive[fits], shared[fits]
            if not len(alive) or (len(alive) == 1 and hi - lo == 1 and alive[0] == seq[lo]):
                return
            if hi - lo == 1:
                i = seq[lo]
                if len(paths[i]) > depth:
                    count = np.zeros(total, np.int32)
                    tail = paths[i][depth:]
                    count += np.bincount(np.concatenate([members[p_at[t]: p_at[t + 1]] for t in tail.tolist()]), minlength=total).astype(np.int32)
                    shared = shared + count[alive]
                both = shared * (100 + percent) >= percent * (n[alive] + n[i])
                j = alive[both]
                j = j[(j > i) & (((sides[i] & 1) & (sides[j] >> 1 & 1)) | ((sides[i] >> 1 & 1) & (sides[j] & 1))).astype(bool)]
                if len(j):
                    out.append((i, j))
                return
            stop = min(agree[x] for x in range(lo + 1, hi))          # all below agree so far
            if stop > depth:
                steps = paths[seq[lo]][depth:stop]
                count = np.bincount(np.concatenate([members[p_at[t]: p_at[t + 1]] for t in steps.tolist()]), minlength=total).astype(np.int32)
                shared, depth = shared + count[alive], stop
                continue
            first = lo
            for x in range(lo + 1, hi + 1):
                if x == hi or agree[x] == depth:
                    stack.append((first, x, depth, shared, alive))
                    first = x
            return

    if len(sets) > 1:
        stack = [(0, len(seq), 0, np.zeros(total, np.int32), np.arange(total))]
        while stack:
            lo, hi, depth, shared, alive = stack.pop()
            if hi - lo > 1 and min(agree[x] for x in range(lo + 1, hi)) == depth:
                # a node with several children: each child on its own
                first = lo
                for x in range(lo + 1, hi + 1):
                    if x == hi or agree[x] == depth:
                        children = (first, x, depth, shared, alive)
                        if x - first == hi - lo:
                            raise AssertionError("a child is its parent")
                        if x - first == 1:
                            down(*children)
                        else:
                            stack.append(children)
                        first = x
            else:
                down(lo, hi, depth, shared, alive)
    return out


def _cells(percent: int):
    """Rows of cells, sorted by cell, to rows (rep, other, links): a forest of the links found, and each class's links.

    A pair that shares several blocks counts in the first of them only."""
    schema = ["rep", "other", "links"]

    def finish(rows):
        if len(rows) < 2:
            return [], [], []
        reps, sides = np.array([r[0] for r in rows], I64), np.array([r[3] for r in rows])
        copies = np.array([r[1] for r in rows], I64)
        sets = [np.frombuffer(r[4], U) for r in rows]
        here = rows[0][5]
        # blocks before this one that a class is also in
        earlier = [[x for x in r[2] if x < here] for r in rows]
        by_block: dict = {}
        for i, e in enumerate(earlier):
            for x in e:
                by_block.setdefault(x, []).append(i)
        mates = {x: np.array(v) for x, v in by_block.items() if len(v) > 1}
        parent, links = list(range(len(rows))), np.zeros(len(rows), I64)

        def root(x):
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x
        for i, partners in _walk(sets, sides, percent):
            skip = [mates[x] for x in earlier[i] if x in mates]
            if skip:
                partners = partners[~np.isin(partners, np.concatenate(skip))]
            links[i] += copies[partners].sum()
            links[partners] += copies[i]
            a = root(i)
            for j in partners.tolist():
                b = root(j)
                if a != b:
                    low, high = (a, b) if reps[a] < reps[b] else (b, a)
                    parent[high] = low
                    a = low
        got = np.flatnonzero(links)
        return reps[got].tolist(), [int(reps[root(x)]) for x in got.tolist()], links[got].tolist()

    def run(batches):
        key, rows = None, []
        out = [[], [], []]
        for b in batches:
            for hub, band, i, j, rep, copies, blocks, side, grams in zip(*[c.to_pylist() for c in b.columns]):
                if (hub, band, i, j) != key:
                    for o, v in zip(out, finish(rows)):
                        o += v
                    key, rows = (hub, band, i, j), []
                rows.append((rep, copies, [(x["hub"], x["band"]) for x in blocks], side, grams, (hub, band)))
            if len(out[0]) > 10000:
                yield pa.RecordBatch.from_arrays([pa.array(o, pa.int64()) for o in out], schema)
                out = [[], [], []]
        for o, v in zip(out, finish(rows)):
            o += v
        yield pa.RecordBatch.from_arrays([pa.array(o, pa.int64()) for o in out], schema)

    return run


def jaccard_join(docs: DataFrame, k: int = 5, percent: int = 80, id_name: str = "doc_id", text: str = "text",
                 extra: float = EXTRA, cell: int = CELL) -> DataFrame:
    """One row per document: id, n_shingles (size of its set), component_id (smallest id reachable by links, its own
    included) and n_links (documents that link with it).

    A-Z count as lower case.  Null texts and texts without words have an empty set and no links, rows of an equal id count as
    documents that are linked by it, a null id stays null and takes no part; other columns are ignored.
    """
    spark = docs.sparkSession
    d = docs.select(F.col(f"`{id_name}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    # 1. summaries and classes
    all_rows = d.mapInArrow(_summaries(k, percent, extra), "doc_id long, n long, sig_a long, sig_b long, prefix array<long>")
    all_rows = materialize(all_rows, "ngram-sets")
    sig = ["n", "sig_a", "sig_b"]
    classes = (all_rows.where("n > 0 and doc_id is not null").groupBy(*sig)
               .agg(F.min(F.struct("doc_id", "prefix")).alias("m"), F.count("*").alias("copies"))
               .select(*sig, F.col("m.doc_id").alias("rep"), "copies", F.col("m.prefix").alias("prefix")))
    classes = materialize(classes, "ngram-classes")
    # 2. n-grams that stand in several prefixes, and the classes that have enough of them
    gram = classes.select("rep", F.col("n"), F.explode("prefix").alias("gram"))
    least = 1 + F.floor(F.lit(extra * percent / 100) * F.col("n")).cast("long")

    def shared(gram: DataFrame) -> DataFrame:
        again = gram.groupBy("gram").agg(F.count("*").alias("c")).where("c > 1").select("gram")
        return (gram.join(again, "gram", "left_semi").groupBy("rep", "n").agg(F.collect_list("gram").alias("grams"))
                .where(F.size("grams") >= least))

    first = materialize(shared(gram), "ngram-shared")
    second = materialize(shared(first.select("rep", "n", F.explode("grams").alias("gram"))), "ngram-shared")
    # 3. blocks: by n-gram and band of sizes; sets of neighbouring bands only can link
    band = F.floor(F.log(F.col("n").cast("double")) / F.lit(float(-np.log(percent / 100))) + 1e-9).cast("int")
    g = second.select("rep", "n", band.alias("own"), F.explode("grams").alias("gram")).select(
        "*", F.explode(F.array(F.col("own"), F.col("own") + 1)).alias("band"))
    hubs = (g.groupBy("gram", "band").agg(F.min("rep").alias("hub"), F.count("*").alias("c"), F.max("own").alias("top"))
            .where("c > 1 and top = band").select("gram", "band", "hub"))
    member = g.join(hubs, ["gram", "band"]).groupBy("rep", "n", "hub", "band").agg(F.count("*").alias("c"))
    kept = (member.groupBy("rep", "n").agg(F.collect_list(F.struct("hub", "band", "c")).alias("m"))
            .select("rep", F.filter("m", lambda x: x["c"] * F.size("m") >= 1 + F.floor(F.lit(extra * percent / 100) * F.col("n"))).alias("m")))
    kept = materialize(kept.where(F.size("m") > 0), "ngram-blocks")
    places = kept.select("rep", F.explode("m").alias("x")).select("rep", "x.hub", "x.band")
    sizes = places.groupBy("hub", "band").agg(F.count("*").alias("size")).where("size > 1")
    parts = F.ceil(F.col("size") / cell).cast("int")
    blocks = (places.join(sizes, ["hub", "band"]).select("rep", F.struct("hub", "band", parts.alias("parts")).alias("x"))
              .groupBy("rep").agg(F.sort_array(F.collect_list("x")).alias("blocks")))
    # 4. whole sets, computed anew for the classes that are left, to the cells of their blocks
    need = blocks.join(classes.select("rep", "copies"), "rep")
    texts = d.join(need, d["doc_id"] == need["rep"]).select("rep", "text", "copies", "blocks")
    block_type = "array<struct<hub:bigint,band:int,parts:int>>"
    sets = texts.mapInArrow(_payload(k), f"rep long, copies long, blocks {block_type}, grams binary")
    at = sets.select("rep", "copies", "blocks", "grams", F.explode("blocks").alias("x"))
    own = F.pmod(F.xxhash64("rep"), F.col("x.parts")).cast("int")
    at = at.withColumn("_own", own).select("*", F.explode(F.sequence(F.lit(0), F.col("x.parts") - 1)).alias("_other"))
    i, j = F.least("_own", "_other"), F.greatest("_own", "_other")
    # in a cell (i, j) a set of part i is on side 1, of part j on side 2, in (i, i) on both
    side = F.when(i == j, 3).when(F.col("_own") == i, 1).otherwise(2)
    cells = at.select(F.col("x.hub").alias("hub"), F.col("x.band").alias("band"), i.alias("i"), j.alias("j"), "rep", "copies",
                      F.transform("blocks", lambda y: F.struct(y["hub"].alias("hub"), y["band"].alias("band"))).alias("blocks"),
                      side.alias("side"), "grams")
    cells = cells.repartition("hub", "band", "i", "j").sortWithinPartitions("hub", "band", "i", "j", "rep")
    links = materialize(cells.mapInArrow(_cells(percent), "rep long, other long, links long"), "ngram-links")
    # 5. components of classes, then of documents
    comp = components(links.where("rep <> other"), "rep", "other")
    degree = links.groupBy("rep").agg(F.sum("links").alias("links"))
    known = (classes.select(*sig, "rep", "copies").join(degree, "rep", "left").join(comp, F.col("rep") == F.col("node"), "left")
             .select(*sig, "copies", F.coalesce("component", "rep").alias("component"), F.coalesce("links", F.lit(0)).alias("links")))
    rows = all_rows.select("doc_id", *sig).join(known, sig, "left")
    return rows.select(F.col("doc_id").alias(id_name), F.col("n").alias("n_shingles"),
                       F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"),
                       F.when(F.col("doc_id").isNotNull(), F.coalesce(F.col("links") + F.col("copies") - 1, F.lit(0))).cast("long").alias("n_links"))


def keep_representatives(docs: DataFrame, k: int = 5, percent: int = 80, id_name: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of ``docs`` for each component of linked texts: that of the smallest id.

    Rows of one id with different texts are documents of their own (they go under a 64-bit hash of id and text).  Rows with a
    null id are kept, as are texts without words; of rows with equal id and text, one stays: that whose JSON has the smaller
    hash.  Columns of any type and name pass through; an empty table gives no rows.
    """
    cols = docs.columns
    rows = docs.select(F.struct(*[F.col(f"`{x}`") for x in cols]).alias("row"), F.col(f"`{id_name}`").cast("long").alias("id"),
                       F.col(f"`{text}`").cast("string").alias("text"))
    several = materialize(rows.groupBy("id").agg(F.count("*").alias("rows")).where("rows > 1 and id is not null").select(F.col("id").alias("again")), "repeated-ids")
    nameless = docs.where(F.col(f"`{id_name}`").cast("long").isNull())
    rows = rows.where("id is not null")
    if not several.take(1):                                     # ids name rows
        best = jaccard_join(rows.select(F.col("id").alias("doc_id"), "text"), k, percent).where("doc_id = component_id").select(F.col("doc_id").alias("id"))
        return rows.join(best, "id", "left_semi").select("row.*").unionByName(nameless)
    rows = rows.join(several, F.col("id") == F.col("again"), "left")
    rows = rows.select("row", "id", "text", F.when(F.col("again").isNull(), F.col("id")).otherwise(F.xxhash64("id", "text")).alias("name"))
    linked = jaccard_join(rows.select(F.col("name").alias("doc_id"), "text"), k, percent).select(F.col("doc_id").alias("name"), "component_id").distinct()
    linked = linked.join(rows.select("id", "name").distinct(), "name")
    best = linked.groupBy("component_id").agg(F.min(F.struct("id", "name")).alias("best")).select(F.col("best.name").alias("name"))
    good = rows.join(best, "name", "left_semi").groupBy("name").agg(F.min_by("row", F.xxhash64(F.to_json("row"))).alias("row"))
    return good.select("row.*").unionByName(nameless)
