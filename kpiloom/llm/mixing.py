"""Mixing sources to target weights by pivotal dependent rounding, in Spark's own functions.

A source's rate is its target over its size, so each of its documents is taken floor(rate) times, and once more with
the probability that is left.  Rounding those probabilities one by one would miss the target by chance.

1. Head: a source's longest documents, up to ``HEAD`` (1,000) of them, are rounded one after the other, the longest first.
   Each one trades with all that come after it: it ends at 0 or 1, and their common probability takes what it lost or
   gained, so the words still to take are always right.  A source of up to ``HEAD`` documents misses its target by less than
   its shortest one, as long as no document is longer than what is left to take and all shorter ones together.  Where one
   of the two outcomes would make the target unreachable, the other one is taken.
2. Body: two documents trade words, one gains what the other loses, in such a measure and with such odds that one of them
   ends at exactly 0 or 1 and each keeps its expected copies.  In a trade the shorter one mostly ends, so the last one left
   is a long one of the body; it is drawn on its own.  It is no longer than any of the head, so the miss is at most a
   ``HEAD``-th of the source's words (the head is found by buckets of sizes 1.1 % apart, so nearly that many).

Distributed: the head is one array of bounded length a source, found by a histogram of its sizes.  In the body, documents
meet in chunks of about ``FANOUT`` by a hash of their id, each chunk trades until one is left, those meet in chunks of
chunks, and so on: a reduction tree of log(n) levels to base FANOUT.  No task sees more than a chunk; a source with a
third of all rows only has more chunks.  Draws are hashes of the two ids, the level and a seed, so a rerun, or a task done
twice, takes the same documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kpiloom.llm.common import GAP, materialize

WEIGHTS = (5.0, 2.0, 1.0)
SHARE, MOST, FANOUT, SEED, HEAD = 1.5, 2.0, 64, 20240607, 1000
STEPS = 64                                # size buckets for each doubling


def n_words(text: Column) -> Column:
    """Number of words of a text; 0 for null."""
    t = F.btrim(F.coalesce(text, F.lit("")), F.lit(" \t\n\x0b\f\r"))
    return F.when(t == "", 0).otherwise(F.size(F.split(t, GAP))).cast("long")


def source_targets(items: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """One row per source: ``_none`` and ``_source`` (its key), n, source_size, target.

    Sources in code-point order, null last, get the weights in turn and share ``share`` times all words by them; no
    target passes ``most`` times its source's words, what is beyond is shared anew by weight.  So there is one level
    with target = least(cap, level * weight): with sources in order of cap / weight, it is the first quotient of what is
    left by the weights that are left which does not pass the own ratio.  The windows run over sources, not documents.
    """
    s = items.groupBy("_none", "_source").agg(F.count("*").alias("n"), F.sum("size").alias("source_size"))
    by_name, everything = Window.orderBy("_none", "_source"), Window.orderBy("_ratio", "_none", "_source")
    s = s.withColumn("_w", F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                                        ((F.row_number().over(by_name) - 1) % len(weights) + 1)))
    s = s.withColumn("_cap", most * F.col("source_size").cast("double")).withColumn("_ratio", F.col("_cap") / F.col("_w"))
    total = F.sum("source_size").over(Window.partitionBy()).cast("double")
    s = s.withColumn("_level", (share * total - F.coalesce(F.sum("_cap").over(everything.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
                     / F.sum("_w").over(everything.rowsBetween(0, Window.unboundedFollowing)))
    level = F.first(F.when(F.col("_level") <= F.col("_ratio"), F.col("_level")), True).over(
        everything.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return s.select("_none", "_source", "n", "source_size",
                    F.least("_cap", F.coalesce(level, F.lit(float("inf"))) * F.col("_w")).alias("target"))


def _let(value: Column, body) -> Column:
    """``body`` of ``value``, computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _uniform(*parts) -> Column:
    return F.shiftrightunsigned(F.xxhash64(*parts), 11) / F.lit(float(1 << 53))


def _trade(level: int, seed: int):
    """One step of a chunk's fold: the document left over so far (``rest``) trades with the next one."""
    def step(acc: Column, j: Column) -> Column:
        i = acc["rest"]
        have = F.struct((i["p"] * i["size"]).alias("i"), ((1 - i["p"]) * i["size"]).alias("i_room"),
                        (j["p"] * j["size"]).alias("j"), ((1 - j["p"]) * j["size"]).alias("j_room"),
                        _uniform(i["id"], j["id"], F.lit(level), F.lit(seed)).alias("u"))

        def drawn(h: Column) -> Column:
            up, down = F.least(h["i_room"], h["j"]), F.least(h["i"], h["j_room"])
            rise = h["u"] * (up + down) < down            # i rises by ``up`` words with odds that keep its expectation
            return F.struct(rise.alias("rise"), F.when(rise, up).otherwise(down).alias("words"),
                            F.when(rise, h["i_room"] <= h["j"]).otherwise(h["i"] <= h["j_room"]).alias("i_ends"))

        def ended(d: Column) -> Column:
            one = d["rise"] == d["i_ends"]                # the one that ends, ends at 1
            done = F.when(d["i_ends"], i["id"]).otherwise(j["id"])
            size = F.when(d["i_ends"], i["size"]).otherwise(j["size"])
            sign = F.when(d["rise"] == d["i_ends"], -1.0).otherwise(1.0)     # the other one moves the opposite way
            rest = F.when(d["i_ends"], j).otherwise(i)
            p = F.greatest(F.lit(0.0), F.least(F.lit(1.0), rest["p"] + sign * d["words"] / rest["size"]))
            return F.struct(
                F.struct(rest["size"].alias("size"), rest["id"].alias("id"), p.alias("p")).alias("rest"),
                F.concat(acc["done"], F.array(F.struct(done.alias("id"), size.alias("size"), one.cast("int").alias("extra")))).alias("done"))

        return _let(_let(have, drawn), ended)

    return step


def _round_longest(rows: DataFrame, head: int, seed: int) -> tuple[DataFrame, DataFrame]:
    """(rows of the head with ``extra`` 0 or 1, rows of the body with their new p) of ``rows`` whose p is between 0 and 1."""
    key = ["_none", "_source"]
    rows = rows.withColumn("_bucket", F.floor(F.log2(F.col("size").cast("double")) * STEPS))
    sums = rows.groupBy(*key, "_bucket").agg(F.count("*").alias("c"), F.sum("size").alias("words"), F.max("p").alias("p"))
    longer = Window.partitionBy(*key).orderBy(F.desc("_bucket"))      # some thousand buckets a source, however many rows
    sums = sums.withColumn("above", F.sum("c").over(longer))
    bound = materialize(sums.groupBy(*key).agg(F.min(F.when(F.col("above") <= head, F.col("_bucket"))).alias("_from"),
                                               F.sum("words").cast("double").alias("_all"), F.max("p").alias("_p")), "mix-head")
    rows = rows.join(bound, key).withColumn("_long", F.coalesce(F.col("_bucket") >= F.col("_from"), F.lit(False)))

    def one(acc: Column, d: Column) -> Column:
        """One document of the head: acc holds the words to take and the words of all that are not settled."""
        def drawn(x: Column) -> Column:
            return F.struct((acc["want"] - x * d["size"]).alias("want"), (acc["left"] - d["size"]).alias("left"),
                            F.concat(acc["done"], F.array(F.struct(d["id"].alias("id"), d["size"].alias("size"), x.alias("extra")))).alias("done"))
        after = acc["left"] - d["size"]
        yes, no = acc["want"] >= d["size"] - 1e-6, acc["want"] <= after + 1e-6       # the target stays within reach
        by_odds = _uniform(d["id"], acc["left"], F.lit(-1), F.lit(seed)) * acc["left"] < acc["want"]
        nearer = d["size"] - acc["want"] < acc["want"] - after
        return _let(F.when(F.when(yes & no, by_odds).when(yes, True).when(no, False).otherwise(nearer), 1).otherwise(0), drawn)

    kind = rows.schema["id"].dataType.simpleString()
    start = F.expr(f"named_struct('want', _all * _p, 'left', _all, 'done', cast(array() as array<struct<id:{kind},size:double,extra:int>>))")
    fold = (rows.where("_long").groupBy(*key, "_base", "_all", "_p").agg(F.sort_array(F.collect_list(F.struct(F.col("size").cast("double").alias("size"), "id")), False).alias("docs"))
            .withColumn("out", F.aggregate("docs", start, one)).select(*key, "_base", "out"))
    fold = materialize(fold, "mix-head")
    done = fold.select(*key, "_base", F.explode("out.done").alias("d")).select("d.id", F.col("d.size").cast("long").alias("size"), *key, "_base", "d.extra")
    rate = fold.select(*key, F.when(F.col("out.left") > 0, F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("out.want") / F.col("out.left")))).otherwise(0.0).alias("_now"))
    body = rows.where("not _long").join(rate, key, "left").withColumn("p", F.coalesce("_now", "p"))
    return done, body.select("id", "size", *key, "n", "_base", "p")


def allocate(items: DataFrame, targets: DataFrame, fanout: int = FANOUT, seed: int = SEED, head: int = HEAD) -> DataFrame:
    """Copies of each row of ``items`` (id, _none, _source, size > 0): rows (id, size, _none, _source, copies).

    ``id`` names a row (any type that hashes); equal rows are drawn each for itself.
    """
    spark = items.sparkSession
    rate = F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(MOST)))
    t = targets.select("_none", "_source", "n", rate.alias("_rate"))
    rows = items.join(t, ["_none", "_source"]).withColumns({
        "_base": F.floor(F.col("_rate") + 1e-9).cast("int"), "p": F.greatest(F.col("_rate") - F.floor(F.col("_rate") + 1e-9), F.lit(0.0))})
    rows = materialize(rows.select("id", "size", "_none", "_source", "n", "_base", "p"), "mix-rows")
    kind = rows.schema["id"].dataType.simpleString()
    done = [rows.where("p < 1e-9").select("id", "size", "_none", "_source", F.col("_base").alias("copies"))]
    longest, body = _round_longest(rows.where("p >= 1e-9"), head, seed)
    body = materialize(body, "mix-body")
    done.append(longest.select("id", "size", "_none", "_source", (F.col("_base") + F.col("extra")).alias("copies")))
    sure = (F.col("p") < 1e-9) | (F.col("p") > 1 - 1e-9)
    done.append(body.where(sure).select("id", "size", "_none", "_source", (F.col("_base") + F.round("p").cast("int")).alias("copies")))
    chunks = F.ceil(F.col("n") / fanout)
    left = body.where(~sure).select("_none", "_source", "_base", F.pmod(F.xxhash64("id", F.lit(seed)), chunks).alias("_chunk"),
                                          F.struct(F.col("size").cast("double").alias("size"), "id", "p").alias("doc"))
    most = targets.agg(F.max("n")).first()[0] or 0
    level, count = 0, -(-most // fanout)
    while True:
        start = F.expr(f"named_struct('rest', docs[0], 'done', cast(array() as array<struct<id:{kind},size:double,extra:int>>))")
        fold = (left.groupBy("_none", "_source", "_base", "_chunk").agg(F.sort_array(F.collect_list("doc"), False).alias("docs"))
                .withColumn("out", F.aggregate(F.slice("docs", F.lit(2), F.greatest(F.size("docs") - 1, F.lit(0))), start, _trade(level, seed)))
                .select("_none", "_source", "_base", "_chunk", "out"))
        fold = materialize(fold, f"mix-level{level}")
        done.append(fold.select("_none", "_source", "_base", F.explode("out.done").alias("d"))
                    .select("d.id", F.col("d.size").cast("long").alias("size"), "_none", "_source", (F.col("_base") + F.col("d.extra")).alias("copies")))
        if count <= 1:
            break
        left = fold.select("_none", "_source", "_base", F.floor(F.col("_chunk") / fanout).alias("_chunk"), F.col("out.rest").alias("doc"))
        level, count = level + 1, -(-count // fanout)
    last = _uniform(F.col("out.rest.id"), F.lit(level + 1), F.lit(seed)) < F.col("out.rest.p")
    done.append(fold.select(F.col("out.rest.id").alias("id"), F.col("out.rest.size").cast("long").alias("size"), "_none", "_source",
                            (F.col("_base") + last.cast("int")).alias("copies")))
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out


def _items(docs: DataFrame, id_col: Column, text: str, source: str) -> DataFrame:
    s = F.col(f"`{source}`").cast("string")
    return docs.select(id_col.alias("id"), s.isNull().alias("_none"), F.coalesce(s, F.lit("")).alias("_source"), n_words(F.col(f"`{text}`").cast("string")).alias("size"))


def mix_table(docs: DataFrame, id_name: str = "doc_id", text: str = "text", source: str = "source", seed: int = SEED) -> DataFrame:
    """One row per row of ``docs``: id, size, source_size, target, taken.

    Null and empty texts have size 0 and take 0; a null source is a source of its own; equal rows are drawn one by one;
    an empty table gives no rows; other columns are ignored.
    """
    items = materialize(_items(docs, F.col(f"`{id_name}`"), text, source), "mix-items")
    targets = materialize(source_targets(items), "mix-targets")
    copies = allocate(items.where("size > 0"), targets, seed=seed)
    rows = copies.select("id", "size", "_none", "_source", (F.col("copies") * F.col("size")).alias("taken")).unionByName(
        items.where("size = 0").withColumn("taken", F.lit(0).cast("long")))
    return rows.join(targets, ["_none", "_source"]).select(
        F.col("id").alias(id_name), F.col("size").cast("long").alias("size"), F.col("source_size").cast("long").alias("source_size"),
        "target", F.col("taken").cast("long").alias("taken"))


def mixed(docs: DataFrame, text: str = "text", source: str = "source", seed: int = SEED) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it; texts without words are not taken.

    A row is named by two hashes of all its columns (maps as JSON), so rows that are equal throughout count as one document
    whose copies are repeated alike: they never multiply each other.
    """
    cols = docs.columns
    every = [F.col(f"`{c}`") for c in cols]
    hashed = [F.to_json(F.struct(c)) if "map<" in kind or "variant" in kind else c for c, (_, kind) in zip(every, docs.dtypes)]
    name = F.struct(F.xxhash64(*hashed).alias("a"), F.xxhash64(F.lit(1), *hashed[::-1]).alias("b"))
    items = _items(docs, name, text, source).where("size > 0").groupBy("id", "_none", "_source").agg(F.sum("size").alias("size"))
    items = materialize(items, "mix-items")
    copies = allocate(items, materialize(source_targets(items), "mix-targets"), seed=seed).where("copies > 0").select("id", "copies")
    named = docs.select(name.alias("_id"), F.struct(*every).alias("_row"))
    return (named.join(copies.withColumnRenamed("id", "_id"), "_id")
            .select("_row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("_row.*"))
