"""N-gram join, phrase automata and run-length index against plain Python."""

import hashlib
import random
from collections import Counter

import brute
import numpy as np
import pytest

from kpiloom.llm import ngram_join, phrase_automata, run_length_index

ODD = [(20000, None), (20001, ""), (20002, " \t\n"), (20003, "One"), (20004, "one"), (20005, "one one one"), (20006, "One one ONE"),
       (20007, "x" * 3000), (20008, "ab " * 500)]
SCHEMA = "doc_id long, text string"


def near_copies(seed=5):
    r = random.Random(seed)
    vocabulary, docs = [f"w{i}" for i in range(3000)], []
    for _ in range(14):
        base = [r.choice(vocabulary) for _ in range(r.choice([3, 6, 20, 60, 150, 300]))]
        for _ in range(r.choice([1, 1, 4, 25])):
            w = list(base)
            for _ in range(r.randint(0, max(1, len(w) // 25))):
                w[r.randrange(len(w))] = r.choice(vocabulary)
            docs.append((len(docs) * 3 + 1, " ".join(w + [r.choice(vocabulary) for _ in range(r.choice([0, 0, 5]))])))
    shared = " ".join(r.choice(vocabulary) for _ in range(40))
    docs += [(10000 + i, " ".join(r.choice(vocabulary) for _ in range(60)) + " " + shared) for i in range(30)]
    docs += ODD + [(30000, docs[5][1]), (30001, docs[5][1].upper())]
    r.shuffle(docs)
    return docs


def passages(size, seed=6):
    r = random.Random(seed)
    vocabulary = [f"wörd{i}" if i % 5 == 0 else f"w{i}" for i in range(300)]
    common, docs = [" ".join(r.choice(vocabulary) for _ in range(r.randint(size // 8, size // 2))) for _ in range(12)], []
    for i in range(120):
        parts = [r.choice(common) if r.random() < .5 else " ".join(r.choice(vocabulary) for _ in range(r.randint(1, 60))) for _ in range(r.randint(0, 5))]
        docs.append((i * 2, " ".join(parts).replace(" ", "\n", 1)))
    docs += ODD + [(1001, docs[7][1]), (1003, docs[7][1] + " "), (1007, "abc" * 500), (1008, "xyz" * 100)]
    r.shuffle(docs)
    return docs


@pytest.mark.parametrize("k,percent,cell", [(4, 85, 2048), (4, 85, 7), (5, 80, 11)])
def test_join_is_exact(spark, k, percent, cell):
    docs = near_copies()
    got = ngram_join.jaccard_join(spark.createDataFrame(docs, SCHEMA), k, percent, cell=cell).collect()
    assert {x.doc_id: (x.n_shingles, x.component_id, x.n_links) for x in got} == brute.join(docs, k, percent)


def test_representatives_keep_columns_and_odd_rows(spark):
    docs = [(1, "a b c d e f g", "x", 1.0), (2, "A B C D E F G", "y", 2.0), (3, None, "z", 3.0), (4, "", None, 4.0), (None, "a b c d e f g", "n", 5.0)]
    df = spark.createDataFrame(docs, "doc_id long, text string, component_id string, rep double")
    got = ngram_join.keep_representatives(df)
    assert got.columns == df.columns
    assert sorted(got.collect(), key=str) == sorted([x for x in df.collect() if x.doc_id != 2], key=str)
    assert ngram_join.keep_representatives(df.limit(0)).count() == 0


def test_representatives_of_equal_ids(spark):
    """Different texts under one id are different documents; maps and clashing names pass."""
    near = " ".join(f"n{i}" for i in range(60))
    docs = [(1, "a b c d e f g", {"k": 1}, "x"), (1, "totally other words h i j", {"k": 2}, "y"), (1, "a b c d e f g", {"k": 1}, "x"),
            (2, "A b c d e f G", None, "z"), (3, near, None, None), (3, near + " tail", None, None), (4, None, None, None), (4, "", None, None)]
    df = spark.createDataFrame(docs, "doc_id long, text string, `row` map<string,int>, `name` string")
    got = ngram_join.keep_representatives(df)
    assert got.columns == df.columns
    kept = sorted(((x.doc_id, x.text) for x in got.collect()), key=str)
    assert len(kept) == 5 and (1, "totally other words h i j") in kept and (1, "a b c d e f g") in kept and sum(x[0] == 3 for x in kept) == 1
    assert (4, None) in kept and (4, "") in kept


@pytest.mark.parametrize("options", [{}, {"hot": 3}, {"phrases": 5}])
def test_phrases(spark, options):
    docs = passages(60)
    got = phrase_automata.remove_repeats(spark.createDataFrame(docs, SCHEMA), **options).collect()
    assert {x.doc_id: (x.n_words, x.n_removed, hashlib.sha256(x.kept_text.encode()).hexdigest()) for x in got} == brute.repeats(docs)


def test_phrases_odd_ids(spark):
    text = " ".join(f"w{i}" for i in range(20))
    docs = [(5, text), (5, text), (5, "x " + text), (7, text + " y"), (None, text), (9, None)]
    got = [(x.doc_id, x.n_removed) for x in phrase_automata.remove_repeats(spark.createDataFrame(docs, SCHEMA)).collect()]
    assert Counter(got) == Counter([(5, 0), (5, 0), (5, 0), (7, 20), (None, 0), (9, 0)])
    assert phrase_automata.remove_repeats(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("size,gram,options", [(40, 8, {}), (40, 8, {"part": 3}), (400, 32, {}), (400, 32, {"text_bytes": 3000})])
def test_bytes(spark, size, gram, options):
    docs = passages(size) + [(None, "same " * 30), (None, "same " * 30), (14, "other text " * 9)]
    got = run_length_index.remove_repeats(spark.createDataFrame(docs, SCHEMA), size=size, gram=gram, **options).collect()
    assert Counter((x.doc_id, x.n_bytes, x.n_removed, x.n_spans, hashlib.sha256(x.kept_bytes).hexdigest()) for x in got) == Counter(brute.byte_repeats(docs, size))
    assert Counter((x.doc_id, x.longest_repeat) for x in got) == Counter(brute.longest_repeats(docs, size * 5 // 8))


def test_boilerplate_in_many_documents(spark):
    """10,000 documents with one passage: each of its segments is one row of a cell, whatever the number of places."""
    r = random.Random(8)
    passage = " ".join(f"licence{r.randrange(10**6)}" for _ in range(40))
    docs = [(i, f"{r.random()} {passage} {r.random()}") for i in range(10_000)] + [(-1, passage[:300] + "x" * 50), (-2, "alone " * 5), (-3, "ab" * 5000)]
    d = spark.createDataFrame(docs, SCHEMA).repartition(6)
    got = {x.doc_id: x for x in run_length_index.remove_repeats(d).collect()}
    assert len(got) == len(docs) and all(got[i].n_removed >= len(passage) for i in range(10_000))
    assert (got[-1].n_removed, got[-1].longest_repeat >= 299, got[-2].longest_repeat, got[-3].n_removed) == (0, True, 0, 10_000)
    cells = []
    inner = run_length_index._index

    def spy(*args):
        cells.append(args)
        return inner(*args)
    run_length_index._index = spy
    try:
        _, spans = run_length_index.find_repeats(d)
    finally:
        run_length_index._index = inner
    assert len(cells) == 2 and spans.count() >= 10_000


def test_run_length_index_against_all_pairs():
    r = np.random.default_rng(3)
    parts = [bytes(r.integers(97, 99, n).astype(np.uint8)) for n in (60, 45, 1, 80)] + [b"abab" * 12]
    index = run_length_index.RunLengthIndex(parts)
    whole = [(p, i) for p, t in enumerate(parts) for i in range(len(t))]

    def agree(x, y):
        a, b = parts[x[0]][x[1]:], parts[y[0]][y[1]:]
        n = 0
        while n < min(len(a), len(b)) and a[n] == b[n]:
            n += 1
        return n
    assert index.statistics().tolist() == [max(agree(x, y) for y in whole if y != x) for x in whole]
    assert len(index.heads) < len(whole)
