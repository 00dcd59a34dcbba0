"""Exact duplicates with a heavy-hitter split, in Spark's own functions only.

Texts are equal when they are the same after lower-casing A-Z.  Each row gets the SHA-256 of that text once; everything
after works on the digests (some 40 bytes a row), never on texts.

1. Misra-Gries: a fixed number of counters finds the digests that may be frequent, in one pass without a shuffle of rows.
   Spark's ``approx_top_k`` functions are that summary (frequent-items sketch: counters that are all lowered when they
   run out; summaries merge).  It is built per task, merged in ``MERGES`` groups and once more.
2. Verification: the candidates, at most ``COUNTERS`` of them, are broadcast; their rows are counted exactly and give each
   one's winner.  Those with ``LEAST`` rows or more are frequent; a summary's mistake costs nothing.
3. The winners of frequent digests are broadcast and decide their rows where they are: map-side removal, no shuffle.
4. All other digests take the ordinary way: a combined aggregation for the winner, and a join.  None of them can hold more
   than a small share of the rows, as the summary would have found it; the join key has the digest's hash in front, so that
   both sides are shuffled and a partition that is still large is split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpiloom.llm.common import materialize

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
COUNTERS, TRACKED, MERGES, LEAST = 512, 4096, 256, 64


def normalised(text: Column) -> Column:
    """The text with A-Z lower-cased, no other letter; null counts as empty."""
    t = F.coalesce(text.cast("string"), F.lit(""))
    return F.when(F.length(t) == F.octet_length(t), F.lower(t)).otherwise(F.translate(t, UPPER, LOWER))


def frequent(rows: DataFrame, column: str, counters: int = COUNTERS, tracked: int = TRACKED) -> DataFrame:
    """At most ``counters`` values of a long column, every one among them that holds more than 4/``tracked`` of all rows
    (by the summary's error bound, 3.5/``tracked`` a side); the counts in it are not used."""
    # merged under a key: without one, an empty partition would bring a summary that knows no type
    each = rows.select(F.col(column).alias("v"), F.pmod(F.spark_partition_id(), F.lit(MERGES)).alias("g"))
    each = each.groupBy("g").agg(F.expr(f"approx_top_k_accumulate(v, {tracked})").alias("s"))
    whole = each.withColumn("all", F.lit(0)).groupBy("all").agg(F.expr(f"approx_top_k_estimate(approx_top_k_combine(s, {tracked}), {counters})").alias("top"))
    return whole.select(F.explode("top").alias("t")).select(F.col("t.item").alias(column))


def annotate(rows: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep_text: bool = True, tracked: int = TRACKED, least: int = LEAST) -> DataFrame:
    """``row`` (a struct of the row's columns, without its text unless ``keep_text``) with keep_id, group_size, kept and
    text_sha256.

    Of equal texts the row with the largest id stays.  A null id is smaller than all others; of rows with equal ids the
    one stays whose other columns, as JSON, have the larger hash; rows that are equal throughout are told apart by their place, so
    exactly one row of each group stays.  Null texts are empty texts, and empty texts are equal.  Very long texts are
    hashed in one piece.  An empty table gives no rows; columns of any type and name pass through in ``row``.
    """
    cols = [c for c in rows.columns if keep_text or c != text_col]
    other = [c for c in cols if c not in (id_col, text_col)]
    tie = F.xxhash64(F.to_json(F.struct(*[F.col(f"`{c}`") for c in other]))) if other else F.lit(0).cast("long")
    digest = F.unhex(F.sha2(normalised(F.col(f"`{text_col}`")).cast("binary"), 256))
    t = rows.select(F.struct(*[F.col(f"`{c}`") for c in cols]).alias("row"), F.col(f"`{id_col}`").alias("id"), tie.alias("tie"), digest.alias("digest"))
    t = materialize(t.select("row", "id", "tie", "digest", F.xxhash64("digest").alias("h"), F.monotonically_increasing_id().alias("place")), "digests")
    candidates = materialize(frequent(t, "h", tracked=tracked), "frequent")
    order = F.struct(F.col("id").isNotNull().alias("known"), "id", "tie", "place").alias("order")

    def winners(r: DataFrame) -> DataFrame:
        found = r.select("digest", order).groupBy("digest").agg(F.count("*").alias("group_size"), F.max("order").alias("best"))
        return found.withColumn("h", F.xxhash64("digest"))

    hot = materialize(winners(t.join(F.broadcast(candidates), "h")).where(F.col("group_size") >= least), "winners")
    decided = t.join(F.broadcast(hot), ["h", "digest"])
    rest = t.join(F.broadcast(hot.select("h", "digest")), ["h", "digest"], "left_anti")
    rest = rest.join(winners(rest).where("group_size > 1"), ["h", "digest"], "left")
    single = F.col("group_size").isNull()
    out = [decided.select("row", "digest", "group_size", F.col("best.id").alias("keep_id"), (F.col("place") == F.col("best.place")).alias("kept")),
           rest.select("row", "digest", F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"), F.when(single, F.col("id")).otherwise(F.col("best.id")).alias("keep_id"),
                       F.when(single, True).otherwise(F.col("place") == F.col("best.place")).alias("kept"))]
    return out[0].unionByName(out[1]).select("row", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def drop_duplicates(rows: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each group of equal texts, with its columns as they came."""
    return annotate(rows, id_col, text_col).where("kept").select("row.*")
