"""Shared parts of the two operators that remove repeated passages: classes of equal texts, and the final cut."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VERDICT = "array<struct<sig:bigint,whole:boolean,spans:array<struct<a:bigint,b:bigint>>>>"


def verdicts(whole: DataFrame, spans: DataFrame) -> DataFrame:
    """doc_id -> what to cut, for each text (named by its hash ``sig``) that a row of this id can have.

    ``whole``: (doc_id, sig) of texts that go altogether; ``spans``: (doc_id, sig, a, b).  An array of bounded length: a
    document's spans are disjoint, or merged in its own task.
    """
    parts = spans.groupBy("doc_id", "sig").agg(F.collect_list(F.struct("a", "b")).alias("spans")).select(
        "doc_id", F.struct("sig", F.lit(False).alias("whole"), "spans").alias("v"))
    all_of = whole.distinct().select("doc_id", F.struct("sig", F.lit(True).alias("whole"), F.array().cast(
        "array<struct<a:bigint,b:bigint>>").alias("spans")).alias("v"))
    return parts.unionByName(all_of).groupBy("doc_id").agg(F.collect_list("v").alias("verdict"))


def removed(n: int, sig: int, verdict) -> np.ndarray:
    """Which of n units go."""
    gone = np.zeros(n + 1, np.int64)
    for v in verdict or ():
        if v["sig"] == sig:
            if v["whole"]:
                return np.ones(n, bool)
            for s in v["spans"]:
                gone[s["a"]] += 1
                gone[s["b"]] -= 1
    return np.cumsum(gone[:n]) > 0


def cut(docs: DataFrame, verdict: DataFrame, run, schema: str) -> DataFrame:
    """Join each document with its verdict and cut it in place."""
    return docs.join(verdict, "doc_id", "left").select("doc_id", "text", "verdict").mapInArrow(run, schema)


def rows_of(batch: pa.RecordBatch):
    """(id, text or None, verdict) of each row."""
    return zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist())
