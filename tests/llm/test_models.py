"""Decontamination, toxicity, token files and the whole pipeline."""

import random
import zlib

import brute
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from kpiloom.llm import decontamination, textbytes, toxicity, wavelet

SCHEMA = "doc_id long, text string"


def prose(r, n):
    return " ".join(r.choice("abcdefghij") + r.choice("klmnop") + r.choice("aeiou") + r.choice("rstuvw") for _ in range(n))


def smith_waterman(a, b):
    best, prev = 0, [0] * (len(b) + 1)
    for x in a:
        cur = [0]
        for j, y in enumerate(b):
            cur.append(max(0, prev[j] + (2 if x == y else -1), prev[j + 1] - 1, cur[j] - 1))
        best, prev = max(best, max(cur)), cur
    return best


def test_alignment_scores():
    r = random.Random(1)
    pairs = [([r.randrange(6) for _ in range(r.randint(1, 12))], [r.randrange(6) for _ in range(r.randint(1, 30))]) for _ in range(80)]
    score, first, last = decontamination.smith_waterman([np.array(a, np.int32) for a, _ in pairs], [np.array(b, np.int32) for _, b in pairs])
    assert score.tolist() == [smith_waterman(a, b) for a, b in pairs]
    assert all(0 <= f <= e <= len(b) for f, e, (_, b) in zip(first.tolist(), last.tolist(), pairs))


def test_leaks(spark):
    r = random.Random(2)
    items = [(i, prose(r, 25)) for i in range(8)] + [(8, None), (9, ""), (10, "short one"), (0, prose(r, 25))]
    edited = items[3][1].split()
    for k in (4, 11, 19):
        edited[k] = "changed"
    docs = [(1, prose(r, 300)), (2, prose(r, 40) + " " + items[2][1].upper() + ", " + prose(r, 50)), (3, prose(r, 9) + " " + " ".join(edited[:8] + edited[9:])),
            (4, None), (5, ""), (6, prose(r, 50) + " " + " ".join(items[4][1].split()[:6])), (7, "x. Short, one! y"), (7, "x. Short, one! y"), (None, items[5][1])]
    df = spark.createDataFrame([(*d, "clash") for d in docs], SCHEMA + ", score string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(x.doc_id, x.item_id): x for x in decontamination.find_leaks(df, bench).collect()}
    assert set(got) == {(2, 2), (3, 3), (7, 10), (None, 5)}
    assert got[2, 2].score == 1 and (got[2, 2].first_word, got[2, 2].end_word) == (40, 65) and 0.6 < got[3, 3].score < 1
    kept = decontamination.drop_contaminated(df, bench)
    assert kept.columns == df.columns and sorted(x.doc_id for x in kept.collect()) == [1, 4, 5, 6]
    assert decontamination.find_leaks(df, bench.limit(0)).count() == 0 and decontamination.find_leaks(df.limit(0), bench).count() == 0


def test_leaks_in_accented_capitals(spark):
    r = random.Random(4)
    item = " ".join(w[:2] + r.choice("éóñüßçø") + w[2:] for w in prose(r, 25).split())
    df = spark.createDataFrame([(1, prose(r, 30) + " " + item.upper() + " " + prose(r, 30)), (2, prose(r, 60))], SCHEMA)
    for bench in (item, item.upper()):
        got = decontamination.find_leaks(df, spark.createDataFrame([(7, bench)], "item_id long, text string")).collect()
        assert [(x.doc_id, x.item_id, x.score, x.first_word, x.end_word) for x in got] == [(1, 7, 1.0, 30, 55)]


def test_toxicity_on_held_out_rows(spark):
    r, bad = random.Random(3), ["vileword", "nastyterm", "uglyname", "meanphrase"]
    rows = []
    for i in range(900):
        w = prose(r, r.randint(15, 120)).split()
        toxic = i % 3 == 0
        if toxic:
            w[r.randrange(len(w))] = r.choice(bad) + r.choice(["", "s", "en", "!"])
        rows.append((i, " ".join(w), int(toxic)))
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows] + [(2000, None), (2001, ""), (None, "vileword")], SCHEMA)
    labels = spark.createDataFrame([(i, y) for i, _, y in rows if i % 4] + [(5, None)], "doc_id long, label int")
    got = {x.doc_id: x.score for x in toxicity.score(docs, toxicity.fit(docs, labels)).collect()}
    held = [(got[i] >= 0.5) == bool(y) for i, _, y in rows if i % 4 == 0]
    assert sum(held) / len(held) > 0.93 and all(0 <= s <= 1 for s in got.values())
    assert got[2000] == got[2001] < 0.5


def test_toxicity_without_labels(spark):
    docs = spark.createDataFrame([(1, "a b")], SCHEMA)
    none = spark.createDataFrame([], "doc_id long, label int")
    assert [x.score < 0.5 for x in toxicity.score(docs, toxicity.fit(docs, none)).collect()] == [True]


def test_toxicity_of_odd_tables(spark):
    """Repeated ids bring one text each to the driver, very long texts none; all are scored; columns may clash."""
    r = random.Random(9)
    rows = [(i % 40, prose(r, 30) + (" vileword" if i % 40 % 2 else ""), "c", 0.5) for i in range(400)] + [(50, "vileword " * 200_000, None, None), (None, None, None, None)]
    docs = spark.createDataFrame(rows, SCHEMA + ", label string, score double")
    labels = spark.createDataFrame([(i, i % 2, "x") for i in range(40)] + [(50, 0, "x")], "doc_id long, label int, text string")
    taken = []
    train = toxicity.train
    toxicity.train = lambda texts, y: (taken.append((len(texts), max(map(len, texts)))), train(texts, y))[1]
    try:
        model = toxicity.fit(docs, labels)
    finally:
        toxicity.train = train
    assert taken[0][0] == 40 and taken[0][1] <= toxicity.SAMPLE_BYTES
    got = toxicity.score(docs, model)
    assert got.columns == ["doc_id", "score"] and got.count() == len(rows) and got.where("score is null or score < 0 or score > 1").count() == 0
    assert toxicity.score(docs.limit(0), model).count() == 0


def test_token_files_in_another_session(spark, tokenizer):
    """What is needed to read a folder lies beside it; the number of ranges is bounded."""
    df = spark.createDataFrame([(i, f"text {i}") for i in range(50)], SCHEMA)
    folder = wavelet.scratch_path(spark, "other")
    wavelet.write(df, folder, tokenizer, per_shard=20)
    got = wavelet.read(spark.newSession(), folder).orderBy("doc_id").collect()
    assert [x.doc_id for x in got] == list(range(50))
    assert [x.start for x in got] == [sum(y.n_tokens for y in got[:k]) for k in range(50)]
    assert -(-100 * 10 ** 12 // wavelet.BYTES_PER_RANGE) > wavelet.MAX_RANGES


def test_wavelet_matrix():
    a = np.random.default_rng(1).integers(0, 300, 5000)
    w, docs, counts = wavelet.from_bytes(wavelet.to_bytes(wavelet.WaveletMatrix.build(a), [None, 3], np.array([2000, 3000])))
    assert docs == [None, 3] and counts.tolist() == [2000, 3000]
    assert (w.decode() == a).all() and (w.access(np.arange(0, 5000, 7)) == a[::7]).all()
    assert w.rank(17, 3000) == (a[:3000] == 17).sum() and w.count(9999) == 0 and w.select(17, 10 ** 6) == -1
    assert (w.locate(17) == np.flatnonzero(a == 17)).all() and w.select(17, 2) == np.flatnonzero(a == 17)[2]
    assert wavelet.WaveletMatrix.build(np.zeros(0, int)).decode().tolist() == []


@pytest.fixture(scope="module")
def tokenizer():
    pytest.importorskip("public_tokenizers")
    return wavelet.default_tokenizer()


def test_pieces_encode_as_whole_texts(tokenizer):
    from tokenizers import Tokenizer
    r, signs = random.Random(3), " .,!\n\n \t   aeiouxyz.,'’sétüß日本🙂12  　<|endoftext|>'ll"
    texts = ["".join(r.choice(signs) for _ in range(r.randint(0, 60))) for _ in range(1500)] + ["<|endoftext|> a <|endoftext|>b", "", "  ", " a"]
    whole, got = Tokenizer.from_file(tokenizer), []
    for ids, at in wavelet.encode(pa.array(texts, pa.large_string()), tokenizer):
        got += [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])]
    assert got == [whole.encode(t, add_special_tokens=False).ids for t in texts]


class Counted:
    """A tokenizer that notes how many texts it is given."""

    def __init__(self, real):
        self.real, self.texts = real, 0

    def encode_batch_fast(self, texts, **kw):
        self.texts += len(texts)
        return self.real.encode_batch_fast(texts, **kw)


def ids_of(texts, known):
    out = []
    for ids, at in wavelet.encode(pa.array(texts, pa.large_string()), known):
        out += [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])]
    return out


def test_new_pieces_share_texts(tokenizer, monkeypatch):
    """Distinct pieces reach the tokenizer many in a text, and none twice; the tables of known ones stay small."""
    from tokenizers import Tokenizer
    r, whole = random.Random(8), Tokenizer.from_file(tokenizer)
    texts = ["\n".join(f"{prose(r, 6)}. It's (é) {r.random()} ".capitalize() for _ in range(30)) for _ in range(60)] + ["y" * 500, "🙂 a", None, "\n b", "日本 c"]
    want = [whole.encode(t or "", add_special_tokens=False).ids for t in texts]
    wavelet._loaded.clear()
    known = wavelet._encoder(tokenizer)
    known.tokenizer = Counted(known.tokenizer)
    assert ids_of(texts, tokenizer) == want
    assert len(known.pieces) > 3000 and known.tokenizer.texts < len(known.pieces) / 100
    known.tokenizer.texts = 0
    assert ids_of([t for t in texts if t and len(t) > 1000], tokenizer) == want[:60] and known.tokenizer.texts == 0
    monkeypatch.setattr(wavelet, "CACHED", 100)
    for k in range(0, len(texts), 7):
        assert ids_of(texts[k: k + 7], tokenizer) == want[k: k + 7]
        assert len(known.pieces) == len(known.ids) == len(known.uses) <= 100


def test_pieces_of_a_tokenizer_that_changes_bytes(tokenizer, tmp_path):
    """Where tokens do not spell the text's bytes, joined pieces cannot be told apart, and each is encoded by itself."""
    from tokenizers import Tokenizer, normalizers
    whole = Tokenizer.from_file(tokenizer)
    whole.normalizer = normalizers.Replace("o", "ooo")
    whole.save(str(tmp_path / "t.json"))
    r = random.Random(9)
    texts = [prose(r, 50) for _ in range(20)]
    assert ids_of(texts, str(tmp_path / "t.json")) == [whole.encode(t, add_special_tokens=False).ids for t in texts]
    wavelet._loaded.clear()


def test_token_files(spark, tokenizer):
    from tokenizers import Tokenizer
    r = random.Random(4)
    docs = [(i * 3, prose(r, r.randint(0, 80))) for i in range(60)] + [(7, None), (8, ""), (9, "x" * 20000), (None, "null id"), (3, "same id")]
    df = spark.createDataFrame([(*d, "c") for d in docs], SCHEMA + ", start string").repartition(5)
    folder = f"{wavelet.scratch_path(spark, 'test')}"
    files = wavelet.write(df, folder, tokenizer, per_shard=500, per_range=4000)
    got = wavelet.read(spark, folder).orderBy("start").collect()
    assert files.count() > 3 and len(got) == len(docs)
    enc, at = Tokenizer.from_file(tokenizer), 0
    for x, (i, t) in zip(got, sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0, d[1] or ""))):
        ids = enc.encode(t or "", add_special_tokens=False).ids + [0]
        assert (x.doc_id, x.start, x.n_tokens, x.ids_crc32) == (i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    assert wavelet.write_and_read(df.limit(0)).count() == 0


def test_words_and_hashes_of_slices():
    texts = ["a b", None, " c\td ", "", "é\n\x0be", "x" * 50, "a b"]
    got = []
    for limit in (1, 7, 10 ** 6):
        rows = []
        for _, _, b in textbytes.slices(pa.array(texts, pa.string()), limit):
            s, e, at = b.words()
            h = b.hash_spans(s, e)
            rows += [([b.data[x:y].tobytes().decode() for x, y in zip(s[lo:hi], e[lo:hi])], h[lo:hi].tolist()) for lo, hi in zip(at[:-1], at[1:])]
        assert [w for w, _ in rows] == [brute.words(t) for t in texts]
        got.append(rows)
    assert got[0] == got[1] == got[2] and got[0][0] == got[0][6]
    v = np.random.default_rng(1).integers(0, 1000, 60)
    for w in (1, 2, 5, 9, 60):
        assert textbytes.window_minima(v, w).tolist() == [v[i: i + w].min() for i in range(61 - w)]


def test_pipeline(spark, tokenizer):
    """Junk, copies and leaks go, clean documents stay, and the mix ends in the token files."""
    import corpus_pipeline
    r = random.Random(7)
    clean = "the of and to in is that it was for on as with are this".split()

    def text():
        return " ".join(w for x in prose(r, 60).split() for w in ((x, r.choice(clean)) if r.random() < .3 else (x,)))
    leak = prose(r, 30)
    docs = [(i, text(), "en", f"s{i % 3}", 1) for i in range(40)]
    docs += [(100 + i, docs[i][1], "en", "s0", 1) for i in range(5)] + [(200, text() + " " + leak, "en", "s1", 1), (300, "spam " * 60, "en", "s1", 1), (301, None, "en", "s1", 1)]
    import os
    import tempfile
    d = tempfile.mkdtemp(prefix="pipeline-")
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(os.path.join(d, "documents.parquet"))
    spark.createDataFrame([(1, leak)], "item_id long, text string").write.parquet(os.path.join(d, "benchmark.parquet"))
    at, seen = spark.read.parquet(f"{d}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES[:3]:
        at = stage(spark, at, d)
        assert at.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        seen[name] = {x.doc_id for x in at.collect()}
    assert seen["quality_rules"] == {x[0] for x in docs} - {300, 301}
    assert seen["ngram_jaccard_join"] == seen["quality_rules"] - {100, 101, 102, 103, 104}
    assert seen["decontamination"] == set(range(40))
    out = corpus_pipeline.run(spark, d)
    assert {x.doc_id for x in out.collect()} <= set(range(40)) and abs(out.count() - 60) <= 12
    assert out.agg(F.sum("n_tokens")).first()[0] == out.agg(F.max(F.col("start") + F.col("n_tokens"))).first()[0]


def test_stages_on_odd_tables(spark, tmp_path, tokenizer):
    """Each stage takes nulls, repeated rows and ids, a very long text, clashing columns and an empty table."""
    from kpiloom.llm import stages
    r = random.Random(12)
    item = prose(r, 40)
    spark.createDataFrame([(1, item), (2, None), (3, "")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    text = prose(r, 80)
    rows = [(1, text, "a", {"k": 1}), (1, text, "a", {"k": 1}), (1, prose(r, 70), "a", None), (None, prose(r, 60), None, None), (None, None, None, None),
            (2, "", "b", None), (3, " \n", "b", None), (4, prose(r, 30_000), "b", None), (5, prose(r, 30) + " " + item + " " + prose(r, 30), "c", None)]
    df = spark.createDataFrame([(*x, "c") for x in rows], "doc_id long, text string, source string, `row` map<string,int>, `_text` string")
    for stage in (stages.quality_rules, stages.near_duplicates, stages.decontamination, stages.mixing):
        got = stage(spark, df, str(tmp_path))
        assert got.columns == df.columns and stage(spark, df.limit(0), str(tmp_path)).count() == 0
        kept = [(x.doc_id, x.text) for x in got.collect()]
        if stage is stages.near_duplicates:
            assert len(kept) == 8 and kept.count((1, text)) == 1
        if stage is stages.decontamination:
            assert len(kept) == 8 and not any(x[0] == 5 for x in kept)
    files = stages.token_files(spark, df, str(tmp_path))
    assert files.count() == len(rows) and stages.token_files(spark, df.limit(0), str(tmp_path)).count() == 0


def test_toxicity_learns_from_every_labelled_row(spark):
    """Words that only rows beyond the first sample hold, one of them in very long texts, are learned; reruns agree."""
    r = random.Random(21)
    rows = []
    for i in range(600):
        w = prose(r, 40).split()
        if i % 2:
            w[r.randrange(40)] = ["vileword", "nastyterm", "uglyname"][i % 3]
        rows.append((i, " ".join(w), i % 2))
    rows += [(1000 + i, prose(r, 60) + (" hiddenslur" if i % 2 else ""), i % 2) for i in range(60)]
    rows = [(i, t + " " + " ".join(prose(r, 20).split() * 150) if i >= 1000 else t, y) for i, t, y in rows]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], SCHEMA)
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, label int")
    new = spark.createDataFrame([(i, prose(r, 40) + (" hiddenslur" if i % 2 else "")) for i in range(60)], SCHEMA)
    fitted = [toxicity.fit(docs, labels, sample=100, longest=2000) for _ in range(2)]
    a, b = ({x.doc_id: x.score for x in toxicity.score(new, m).collect()} for m in fitted)
    assert a == b and sum((s >= 0.5) == bool(i % 2) for i, s in a.items()) > 54
