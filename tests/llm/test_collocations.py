"""Phrase collocations against plain Python; windows folded at any batch edge keep all sums."""

import random
import re
from collections import Counter

import pyarrow as pa
import pytest

from kpiloom.llm import collocations as co

AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def corpus(seed=4):
    r = random.Random(seed)
    words = [f"w{i}" if i % 4 else f"Wör{i}" for i in range(40)]
    docs = []
    for i in range(400):
        t = " ".join(r.choice(words[: r.choice([4, 12, 40])]) + r.choice(["", "", "", ".", ",\t", "\n", "! ?"]) for _ in range(r.randint(0, 60)))
        docs.append((i, t, r.choice(["en", "en", "en", "de", None, "und"])))
    docs += [(500, None, "en"), (501, "", "en"), (502, " .;\n ", "xx"), (503, "hot pair " * 3000, "en"), (504, "a\x01b\x1fc\xa0d a\x01b " * 30, None), (500, "X y z." * 20, "en\n")]
    return docs


def brute(docs, longest=3, least=10, share=50, top=2000):
    f, n = {}, Counter()
    for _, t, lang in docs:
        c = f.setdefault(lang or "und", Counter())
        for piece in re.split("[.,;:!?\x0a-\x0d]", (t or "").translate(AZ)):
            w = [x for x in re.split("[\x20\x09]+", piece) if x]
            n[lang or "und"] += len(w)
            c.update(" ".join(w[i:i + k]) for k in range(1, longest + 1) for i in range(len(w) - k + 1))
    out = []
    for lang, c in f.items():
        cand, kept = {p: a for p, a in c.items() if " " in p and a >= least}, []
        for p, a in cand.items():
            w = p.split(" ")
            if any(100 * b >= share * a for q, b in cand.items() if len(q) > len(p) and f" {p} " in f" {q} "):
                continue
            score, _, l, r = min((10**6 * a * a // (c[" ".join(w[:k])] * c[" ".join(w[k:])]), k, c[" ".join(w[:k])], c[" ".join(w[k:])]) for k in range(1, len(w)))
            kept.append((-score, -a, p.encode(), a, l, r, score))
        out += [(lang, i + 1, x[2].decode(), *x[3:6], n[lang], x[6]) for i, x in enumerate(sorted(kept)[:top])]
    return sorted(out)


@pytest.mark.parametrize("longest,least,share,top", [(3, 10, 50, 2000), (2, 3, 50, 5), (4, 3, 80, 50)])
def test_against_brute_force(spark, longest, least, share, top):
    docs = corpus()
    df = spark.createDataFrame([(*d, 1, "x") for d in docs], "doc_id long, text string, lang string, n int, w0 string").repartition(6)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "37")     # many batch edges
    try:
        got = sorted(tuple(x) for x in co.collocations(df, longest, least, share, top).collect())
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == brute(docs, longest, least, share, top)


def test_fold_keeps_all_sums():
    r = random.Random(1)
    words = sorted({" ".join(r.choice("abcdefgh") if k < depth else "" for k in range(3)) for depth in (1, 2, 3) for _ in range(300)})
    batch = pa.record_batch([pa.array(["en"] * len(words)), pa.array(words), pa.array([r.randint(1, 6) for _ in words], pa.int64())], names=["lang", "window", "n"])
    out = co.fold(batch, 3, 10).to_pydict()
    before, after = Counter(), Counter()
    for w, n in zip(words, batch.column(2).to_pylist()):
        for k in range(4):
            before[tuple(w.split(" ")[:k])] += n
    for *w, n in zip(out["w0"], out["w1"], out["w2"], out["n"]):
        for k in range(4):
            after[tuple(w[:k])] += n
    assert all(after[p] == n for p, n in before.items() if n >= 10 and "" not in p) and len(out["n"]) < len(words)


def test_large_products_are_exact(spark):
    """a, l and r of 10^12: 10^6 a a passes 64 bits by far."""
    a = 10**12 + 7
    row = spark.createDataFrame([(a, a + 1, a + 3)], "a long, l long, r long").selectExpr(
        "(decimal(1000000) * cast(a as decimal(19,0)) * cast(a as decimal(19,0))) div (cast(l as decimal(19,0)) * cast(r as decimal(19,0))) AS s").first()
    assert row.s == 10**6 * a * a // ((a + 1) * (a + 3))


def test_empty_table(spark):
    assert co.collocations(spark.createDataFrame([], "text string, lang string")).count() == 0
