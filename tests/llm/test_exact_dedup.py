"""Exact duplicates against plain Python."""

import hashlib
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from kpiloom.llm import exact_dedup

AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def corpus(seed=2):
    r = random.Random(seed)
    docs = [(i, r.choice(["Hot text.", "hot TEXT.", "HOT text."])) for i in range(400)]
    docs += [(1000 + i, f"text {r.randrange(200)}" if i % 2 else f"Text {r.randrange(200)}") for i in range(300)]
    docs += [(2000, None), (2001, ""), (2002, " "), (2003, "É"), (2004, "é"), (2005, "é".upper() + "X" * 200_000), (2006, "Éx" + "x" * 199_999), (2007, "İ")]
    docs += [(None, "Hot text."), (None, "alone"), (None, None), (1001, "twin"), (1001, "TWIN"), (1001, "twin")]
    r.shuffle(docs)
    return docs


def brute(docs):
    """Multiset of (doc_id, keep_id, group_size, kept, digest); of equal ids it is open which row stays."""
    groups = defaultdict(list)
    for i, t in docs:
        groups[(t or "").translate(AZ)].append(i)
    out = []
    for t, ids in groups.items():
        ids.sort(key=lambda i: (i is not None, i or 0))
        out += [(i, ids[-1], len(ids), k == len(ids) - 1, hashlib.sha256(t.encode()).hexdigest()) for k, i in enumerate(ids)]
    return sorted(out, key=str)


@pytest.mark.parametrize("least", [2, 64, 10_000])
def test_against_brute_force(spark, least):
    docs = corpus()
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(7)
    got = exact_dedup.annotate(df, keep_text=False, least=least)
    assert sorted((tuple(x) for x in got.select("row.doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()), key=str) == brute(docs)


def test_heavy_digests_are_found(spark):
    df = spark.createDataFrame([(i % 3 and i or 7,) for i in range(30_000)], "h long").repartition(5)
    assert [x.h for x in exact_dedup.frequent(df, "h").collect()] == [7]


def test_no_shuffle_of_heavy_rows(spark):
    """Rows of verified digests are decided by a broadcast join: their branch has no exchange of rows."""
    df = spark.createDataFrame([(i, "same") for i in range(500)], "doc_id long, text string")
    plan = exact_dedup.annotate(df)._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" in plan
    assert "Python" not in plan and "Arrow" not in plan


def test_columns_pass_and_ties_are_settled(spark):
    rows = [(5, "A", "x", 1, {"k": 1}), (5, "a", "y", 2, {"k": 2}), (5, "a", "y", 2, {"k": 2}), (6, "b", "z", 3, None), (None, None, None, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, digest string, `group_size` int, h map<string,int>")
    for _ in range(2):
        got = exact_dedup.drop_duplicates(df)
        assert got.columns == df.columns and got.schema["h"].dataType == df.schema["h"].dataType
        assert got.count() == 3 and got.where("doc_id = 5").count() == 1
    a, b = (exact_dedup.drop_duplicates(df.orderBy(o)).where("doc_id = 5").first().digest for o in ("digest", F.desc("digest")))
    assert a == b


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert exact_dedup.annotate(df).count() == 0 and exact_dedup.drop_duplicates(df.repartition(4)).columns == df.columns
