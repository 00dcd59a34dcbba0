"""Quality rules, urls, pseudonyms and mixing."""

import re

import brute
import pytest
from pyspark.sql import functions as F

from kpiloom.llm import mixing, pseudonyms, quality_rules, url_rules

TEXTS = [None, "", " \n\t", "a b c\na b c\n\n#*$%&|<>", "x " * 40, "one two three four five six seven eight nine " * 3, "ü\u00a0b c\x0bd\x1ce", "\n".join(["same line"] * 5),
         " ".join(str(i) for i in range(30)) + " " + " ".join(str(i) for i in range(12))]


def test_measures(spark):
    rows = [(i, t, "clash") for i, t in enumerate(TEXTS)] + [(3, TEXTS[3], None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, measures string")
    got = quality_rules.judge(df).select("doc_id", "measures.*", "base_failed", "kept").collect()
    assert len(got) == len(rows)
    for x in got:
        assert (x.n_words, x.word_chars, x.n_symbols, x.n_dup_lines, x.n_repeat_words) == brute.quality(TEXTS[x.doc_id])
        assert x.base_failed == (x.n_words < 20 or 100 * x.n_repeat_words > 30 * x.n_words)
        assert not (x.base_failed and x.kept)
    kept = quality_rules.keep_good(df)
    assert kept.columns == df.columns and kept.limit(0).count() == 0


def test_clean_prose_stays_and_junk_goes(spark):
    good = "The house of the old man is in the valley and it was built of stone by people that nobody knows any more, " \
           "but the garden behind it is full of light on most days of the year, as everyone says who was there for a visit."
    df = spark.createDataFrame([(1, good), (2, "word | " * 60), (3, "Buy Buy Buy Buy Buy now now now now now " * 8)], "doc_id long, text string")
    assert [x.doc_id for x in quality_rules.keep_good(df).collect()] == [1]


LISTED = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")]


def test_listed_url_rules(spark):
    urls = {"http://A.example.org/es/1": ("a.example.org", "/es/1", "example.org/es/", "block"), "http://example.org/en/2?x#y": ("example.org", "/en/2", "org/", "allow"),
            "http://notexample.org/es/": ("notexample.org", "/es/", "org/", "allow"), "https://x.com/de/": ("x.com", "/de/", "com/de/", "block"),
            "https://x.com": ("x.com", "", None, "allow"), "no url": ("", "", None, "allow"), None: ("", "", None, "allow"), "": ("", "", None, "allow"),
            "a://b?c/d://e": ("b", "", None, "allow"), "http://org": ("org", "", None, "allow"), "http://com/fr/#/de/": ("com", "/fr/", "com/fr/", "allow")}
    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate(urls)] + [(None, "http://org/", "h")], "page_id long, url string, host string")
    none = spark.createDataFrame([], "url string, blocked boolean")
    got = url_rules.judge_urls(pages, none, LISTED).collect()
    assert len(got) == len(urls) + 1
    keys = list(urls)
    for x in got:
        if x.page_id is not None:
            assert (x.host, x.path, x.rule, x.verdict) == urls[keys[x.page_id]]


def test_mined_url_rules(spark):
    """Blocked urls share a host part and a path; neither alone is enough."""
    rows = []
    for i in range(400):
        ads, shop = i % 2 == 0, i % 4 < 2
        rows.append((f"http://{'ads' if ads else 'www'}.h{i % 7}.net/{'shop' if shop else 'news'}/{i}", ads and shop))
    labelled = spark.createDataFrame(rows, "url string, blocked boolean")
    pages = spark.createDataFrame([(1, "http://ads.new.net/shop/9"), (2, "http://www.new.net/shop/9"), (3, "http://ads.new.net/news/9")], "page_id long, url string")
    got = {x.page_id: (x.verdict, x.mined_rule) for x in url_rules.judge_urls(pages, labelled, []).collect()}
    assert got == {1: ("block", "path=shop & sub=ads"), 2: ("allow", None), 3: ("allow", None)}


def test_url_rules_of_rare_tokens(spark, monkeypatch):
    """Urls with more tokens than FP-growth is given: what tells the blocked ones are their rarest tokens."""
    monkeypatch.setattr(url_rules, "MAX_TOKENS", 6)
    keys, rows = "&".join(f"k{j}=1" for j in range(8)), []
    for i in range(400):
        hot, bad, worse = i % 2 == 0, i % 4 == 0, i % 8 < 3
        extra = ("&bad=1" if bad else "") + ("&worse=1" if worse else "")
        rows.append((f"http://hot.net/p?{keys}{extra}" if hot else f"http://www.h{i % 7}.org/n", hot and bad and worse))
    pages = spark.createDataFrame([(1, "http://hot.net/p?bad=1&worse=2"), (2, "http://hot.net/p?bad=1"), (3, "http://hot.net/p?worse=1")], "page_id long, url string")
    got = {x.page_id: (x.verdict, x.mined_rule, x.confidence) for x in url_rules.judge_urls(pages, spark.createDataFrame(rows, "url string, blocked boolean"), []).collect()}
    assert got == {1: ("block", "key=bad & key=worse", 1.0), 2: ("allow", None, None), 3: ("allow", None, None)}


def brute_rules(lists, least, min_confidence, min_lift):
    """All rules over the whole token sets, by enumeration."""
    from itertools import combinations
    total, share, rules = len(lists), sum(b for _, b in lists) / len(lists), {}
    for s in {c for tokens, b in lists if b for k in range(1, len(tokens) + 1) for c in combinations(sorted(tokens), k)}:
        held = [b for tokens, b in lists if set(s) <= tokens]
        if sum(held) >= least and sum(held) / len(held) >= min_confidence and sum(held) / len(held) / share >= min_lift:
            rules[s] = (sum(held) / total, sum(held) / len(held))
    return {s: v for s, v in rules.items() if not any(rules.get(tuple(x for x in s if x != t), (0, -1))[1] >= v[1] for t in s)}


@pytest.mark.parametrize("seed,most", [(1, 24), (1, 3), (2, 2), (3, 4)])
def test_rules_of_any_length_against_enumeration(spark, monkeypatch, seed, most):
    """Support and confidence of every rule equal a count over all lists, also where lists are longer than FP-growth is given."""
    import random
    r = random.Random(seed)
    monkeypatch.setattr(url_rules, "MAX_TOKENS", most)
    monkeypatch.setattr(url_rules, "MIN_URLS", 8)
    lists = []
    for _ in range(300):
        tokens = {t for t in "abcdefgh" if r.random() < .45}
        bad = {"a", "b", "c"} <= tokens or {"d", "e"} <= tokens and r.random() < .9 or {"e", "f", "g", "h"} <= tokens or r.random() < .05
        if "a" in tokens:
            tokens.add("always with a")
        lists.append((tokens, bad))
    df = spark.createDataFrame([(sorted(t), b) for t, b in lists], "tokens array<string>, blocked boolean")
    got = url_rules.mine(df, 0.03, 0.7, 1.5).collect()
    want = brute_rules(lists, max(0.03 * 300, 8), 0.7, 1.5)
    # tokens that always stand together make equally good rules of one size: FP-growth and the levels keep all of them
    assert {tuple(x.tokens): (round(x.support, 9), round(x.confidence, 9)) for x in got} == {k: (round(a, 9), round(b, 9)) for k, (a, b) in want.items()}
    assert any(len(x.tokens) > 2 for x in got)


def test_listed_verdicts_are_labels(spark):
    """Rules mined from the list's own verdicts carry over to hosts that the list does not name; odd urls do no harm."""
    urls = [f"http://h{i % 9}.com/{'fr' if i % 3 else 'de'}/{i}" for i in range(300)] + [f"http://h.net/{p}/1" for p in ("de", "fr")] + [None, "", "http://x.com/" + "a/" * 20_000]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {x.page_id: (x.rule, x.verdict, x.mined_rule) for x in url_rules.judge_urls(pages, url_rules.labels_by_list(pages, LISTED), LISTED).collect()}
    assert len(got) == len(urls)
    assert got[300][:2] == (None, "block") and "path=de" in got[300][2] and got[301] == (None, "allow", None)
    assert got[0][:2] == ("com/de/", "block") and got[1][:2] == ("com/fr/", "allow")
    assert url_rules.judge_urls(pages.limit(0), url_rules.labels_by_list(pages, LISTED), LISTED).count() == 0


def test_permutations(spark):
    d = spark.range(3000).withColumn("p", pseudonyms.permute_number(F.col("id"), 60, 50, "k", "t"))
    d = d.withColumn("b", pseudonyms.permute_number(F.col("p"), 60, 50, "k", "t", True))
    assert tuple(d.agg(F.countDistinct("p"), F.min("p"), F.max("p"), F.sum((F.col("b") != F.col("id")).cast("int"))).first()) == (3000, 0, 2999, 0)
    d = spark.range(1000).select(F.lpad(F.col("id").cast("string"), 3, "0").alias("id")).withColumn("p", pseudonyms.permute_text(F.col("id"), "k", "t"))
    d = d.withColumn("b", pseudonyms.permute_text(F.col("p"), "k", "t", True))
    assert tuple(d.agg(F.countDistinct("p"), F.sum((F.col("b") != F.col("id")).cast("int"))).first()) == (1000, 0)


def luhn(s):
    d = [int(c) for c in s if c.isdigit()][::-1]
    return sum(d[0::2]) + sum(sum(divmod(2 * x, 10)) for x in d[1::2])


def test_pseudonyms(spark):
    a = "card 4041894974608795 or 4041-8949-7460-8795, not 4041894974608796; +1 (274) 555-9629; 42.144.35.254 300.1.1.1; on 2020-02-29 25/12/1999 2020-02-30"
    b = "4041 8949 7460 8795 and 123-45-6789, 000-12-1234, DE89370400440532013000, Bob.42@mail1.example.com"
    rows = [(1, a, 7), (2, b, 7), (3, None, 7), (4, "", 7), (5, "nothing here", 7), (1, a, 7), (6, "7" * 5000, 7)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_replaced int")
    got = pseudonyms.pseudonymize(df, "key").collect()
    by = {x.doc_id: x for x in got}
    assert len(got) == 7 and (by[3].text, by[4].text, by[5].text, by[6].text) == (None, "", "nothing here", "7" * 5000)
    shape = lambda t: re.sub("[a-z]", "a", re.sub("[A-Z]", "A", re.sub("[0-9]", "9", re.sub(r"(\d+\.){3}\d+", "IP", t))))
    assert shape(by[1].text) == shape(a) and shape(by[2].text) == shape(b)
    cards = re.findall(r"(?<!\d)\d(?:[ -]?\d){15}(?!\d)", by[1].text + " | " + by[2].text)
    same = {re.sub("[ -]", "", c) for c in cards if "4041894974608796" not in c}
    assert len(same) == 1 and luhn(same.pop()) % 10 == 0 and "4041894974608796" in by[1].text
    assert "300.1.1.1" in by[1].text and "2020-02-30" in by[1].text and "000-12-1234" in by[2].text
    for leak in ("4041894974608795", "274", "42.144.35.254", "2020-02-29", "25/12/1999"):
        assert leak not in by[1].text
    iban = re.search(r"DE\d{20}", by[2].text).group()
    assert int(re.sub("[A-Z]", lambda m: str(ord(m.group()) - 55), iban[4:] + iban[:4])) % 97 == 1
    assert pseudonyms.pseudonymize(df, "other key").where("doc_id = 2").first().text != by[2].text


def test_values_without_a_digit_pair(spark):
    ip, card = "dns 8.8.8.8 it is", "card 4 0 4 1 8 9 4 9 7 4 6 0 8 7 9 5 it is"
    df = spark.createDataFrame([(1, ip), (2, ip + ", 2020"), (3, card), (4, "1. a 2) b 3")], "doc_id long, text string")
    by = {x.doc_id: x for x in pseudonyms.pseudonymize(df, "key").collect()}
    assert [by[i].n_replaced for i in (1, 2, 3, 4)] == [1, 1, 1, 0] and by[4].text == "1. a 2) b 3"
    assert "8.8.8.8" not in by[1].text and by[2].text == by[1].text + ", 2020" and by[3].text != card


def test_numbers_next_to_cards_and_phones(spark):
    card, phone, uk = "4041 8949 7460 8795", "+1 (274) 555-9629", "+44 20 7946 0958"
    texts = [(f"pay {card} 12/27 ok", [card], 1), ("4041894974608795 123", ["4041894974608795"], 1), ("12 4041894974608795", ["4041894974608795"], 1),
             (f"{card} {card} 3", [card], 2), (f"{card} 2020-02-29 x", [card, "2020-02-29"], 2), (f"{card} 42.144.35.254", [card, "42.144.35.254"], 2),
             ("7 4041-894974-60879 5 8", [], None), ("4041 8949 7460 8796", [], 0), ("1 " * 4000 + "a", [], None),
             (f"call {phone} 2024", [phone], 1), (f"call {phone}", [phone], 1), (f"{uk} 2024", [uk], 1), (uk, [uk], 1), (f"{phone} {card}", [phone, card], 2)]
    df = spark.createDataFrame([(i, t) for i, (t, _, _) in enumerate(texts)], "doc_id long, text string")
    by = {x.doc_id: x for x in pseudonyms.pseudonymize(df, "key").collect()}
    for i, (t, values, n) in enumerate(texts):
        got = by[i]
        assert n is None or got.n_replaced == n, (t, got)
        assert all(v not in got.text for v in values) and re.sub(r"[0-9.]", "", got.text) == re.sub(r"[0-9.]", "", t)
    digits = {re.sub("[ -]", "", by[i].text[a:b]) for i, a, b in ((0, 4, 23), (1, 0, 16), (2, 3, 19), (3, 0, 19), (3, 20, 39))}
    assert len(digits) == 1 and luhn(digits.pop()) % 10 == 0
    assert by[0].text.endswith(" 12/27 ok") and by[1].text.endswith(" 123") and by[2].text.startswith("12 ") and by[3].text.endswith(" 3")
    assert by[9].text == by[10].text + " 2024" and by[11].text == by[12].text + " 2024"


def test_no_python_in_native_plans(spark):
    df = spark.createDataFrame([(1, "4041894974608795 a", "s")], "doc_id long, text string, source string")
    for d in (pseudonyms.pseudonymize(df, "k"), mixing.mix_table(df), quality_rules.judge(df)):
        plan = d._jdf.queryExecution().toString()
        assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))


def targets(size, weights=(5, 2, 1)):
    """Sizes by source -> targets, sharing anew what is over the cap until none is."""
    names = sorted(size, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, fixed, free = 1.5 * sum(size.values()), {}, list(names)
    while free:
        share = {s: left * w[s] / sum(w[x] for x in free) for s in free}
        over = [s for s in free if share[s] > 2 * size[s]]
        if not over:
            return {**fixed, **share}
        for s in over:
            fixed[s] = 2.0 * size[s]
            left -= fixed[s]
        free = [s for s in free if s not in over]
    return fixed


def test_mix(spark):
    rows, k = [], 0
    for s, n in (("a", 700), ("b", 300), ("Z", 90), (None, 40), ("ü", 5), ("empty", 3)):
        for i in range(n):
            rows.append((k, None if s == "empty" and i else "w " * (0 if s == "empty" else 1 + (i * 37) % 90), s, "clash"))
            k += 1
    rows.append(rows[0])
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, taken string")
    got = mixing.mix_table(df).collect()
    assert len(got) == len(rows) and sorted(map(tuple, got)) == sorted(map(tuple, mixing.mix_table(df.repartition(7)).collect()))
    source = {r[0]: r[2] for r in rows}
    size, taken, longest = {}, {}, {}
    for x in got:
        s = source[x.doc_id]
        size[s], taken[s] = size.get(s, 0) + x["size"], taken.get(s, 0) + x.taken
        longest[s] = max(longest.get(s, 0), x["size"])
        assert x["size"] == len((rows[x.doc_id][1] or "").split()) and x.taken in (0, x["size"], 2 * x["size"])
    want = targets(size)
    for x in got:
        s = source[x.doc_id]
        assert x.source_size == size[s] and abs(x.target - want[s]) < 1e-6
    shortest = {s: min((x["size"] for x in got if source[x.doc_id] == s and x["size"]), default=0) for s in size}
    for s in size:
        assert abs(taken[s] - want[s]) <= shortest[s] + 1e-6
    assert mixing.mix_table(df.limit(0)).count() == 0


@pytest.mark.parametrize("head", [0, 10, 1000])
def test_mix_keeps_expectation(spark, head):
    """Over many seeds, documents are taken as often as their source's rate says, long and short ones alike."""
    df = spark.createDataFrame([(i, "w " * (1 + i % 9), "ab"[i % 2]) for i in range(60)], "doc_id long, text string, source string")
    items = mixing.materialize(mixing._items(df, F.col("doc_id"), "text", "source"), "t")
    t = mixing.materialize(mixing.source_targets(items, weights=(1.0, 1.0), share=0.9), "t")
    total = {}
    for seed in range(12):
        for x in mixing.allocate(items, t, fanout=8, seed=seed, head=head).collect():
            total[x.id] = total.get(x.id, 0) + x.copies
    rate = {x._source: x.target / x.source_size for x in t.collect()}
    for s, name in enumerate("ab"):
        own = [total[i] / 12 for i in range(60) if i % 2 == s]
        assert abs(sum(own) / len(own) - rate[name]) < 0.12


def test_mix_is_near_its_targets(spark):
    """Every source within 2 % or its shortest document, at several seeds; a head smaller than the source leaves a body."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "source")
    items = mixing.materialize(mixing._items(docs, F.col("doc_id"), "text", "source"), "t")
    t = mixing.materialize(mixing.source_targets(items), "t")
    want = {(x._none, x._source): x.target for x in t.collect()}
    shortest = {(x._none, x._source): x.m for x in items.where("size > 0").groupBy("_none", "_source").agg(F.min("size").alias("m")).collect()}
    for seed in range(10):
        c = mixing.allocate(items.where("size > 0"), t, seed=seed)
        got = c.groupBy("_none", "_source").agg(F.sum(F.col("size") * F.col("copies")).alias("w"), F.count("*").alias("n")).collect()
        for x in got:
            s = (x._none, x._source)
            assert abs(x.w - want[s]) <= max(0.02 * want[s], shortest[s]), (seed, s, x.w, want[s])


def test_very_long_text_in_a_mix(spark):
    """One text of 200,000 words among short ones: taken or not, the others make up for it as far as they can."""
    df = spark.createDataFrame([(0, "w " * 200_000, "a")] + [(i, "w " * 400, "a") for i in range(1, 1201)] + [(2000 + i, "w", "b") for i in range(9)], "doc_id long, text string, source string")
    for x in mixing.mix_table(df).groupBy("target").agg(F.sum("taken").alias("w")).collect():
        assert abs(x.w - x.target) <= 400


def test_mixed_rows(spark):
    rows = [(i, "w " * (1 + i % 5), "ab"[i % 2], 1.5) for i in range(50)] + [(1, "w w", "b", 1.5)] * 2 + [(99, None, "a", None), (None, "w", None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, copies double")
    got = mixing.mixed(df)
    assert got.columns == df.columns
    assert set(map(tuple, got.collect())) <= set(rows) and got.where("doc_id = 99").count() == 0
    assert abs(got.count() - 1.5 * len(rows)) < 25


def test_clashing_names_and_maps_pass(spark):
    """Columns named like the operators' own ones, and maps, come out as they came in."""
    names = ["_words", "_lines", "_n_symbols", "_hash", "_win", "_by_hash", "_chars", "_found", "_new", "_row", "_text", "row", "id"]
    text = "The card 4041 8949 7460 8795 and some more words of the text that are long enough to be kept, with a few of the most common words in it."
    df = spark.createDataFrame([(1, text, "a", {"k": 1}, *names), (2, None, None, None, *names)],
                               "doc_id long, text string, source string, m map<string,int>, " + ", ".join(f"`{n}` string" for n in names))
    for out in (quality_rules.judge(df), pseudonyms.pseudonymize(df, "k"), quality_rules.keep_good(df), mixing.mixed(df)):
        assert out.columns[:len(df.columns)] == df.columns
        assert all(x[n] == n for x in out.collect() for n in names)
    assert pseudonyms.pseudonymize(df.limit(0), "k").count() == 0 and quality_rules.judge(df.limit(0)).count() == 0
