"""Phrase collocations by top-order marginalisation: only the longest windows are counted, shorter phrases are their sums.

Every word starts exactly one window: itself and the words that lead after it (lead columns), padded at the end of its
piece.  So the windows that begin with a phrase are that phrase's occurrences, and a ROLLUP over the window's columns
sums all shorter phrases, single words and the language's total from one count, instead of an explosion per length.

1. Tasks read whole texts, count the windows of a few megabytes at a time and give them out in order.
2. Windows meet by range of (language, window) and are sorted: all windows under a prefix stand together, and a frequent
   prefix only spans more ranges.  A window that is counted whole and found fewer than ``least`` times is no candidate,
   nor is any phrase that holds it: it is padded back to its longest prefix that may be one.  The occurrences stay, so
   all sums stay exact; what touches the edge of a batch is left as it is, for its count may go on elsewhere.
3. ROLLUP sums what is left, small by now, into the counts of all phrases that can matter.
4. Candidates look up the two parts of each cut; the worst cut counts.

Exact at all sizes.  No task holds more than a batch; a language, word or pair with a third of all words is counted
before it is shuffled and is split by range.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kpiloom.llm.common import materialize

UPPER, LOWER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz"
BREAKS = b".,;:!?\n\x0b\x0c\r"            # fixed value: where pieces end
TO_WORDS = bytes.maketrans(UPPER + BREAKS, LOWER + b"." * len(BREAKS))
SLICE = 4 << 20                           # bytes of text that are counted at once
SALTS = 64                                # parts of a language in the first round of its ranking


def count_windows(lang: str, texts: list[bytes], longest: int) -> pa.RecordBatch:
    """The padded windows of some texts of one language: (lang, window, n), in order.  A window is ``longest`` words joined
    by blanks, empty ones at the end of a piece."""
    words = b".".join(texts).translate(TO_WORDS).replace(b".", b" . ").split()
    coded = pa.array([*words, b"."], pa.binary()).dictionary_encode()
    names, codes = coded.dictionary, coded.indices.to_numpy()
    order = pc.sort_indices(names).to_numpy()
    names = names.take(pa.array(order))
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(1, len(order) + 1)
    stop = int(pc.index(names, pa.scalar(b".", pa.binary())).as_py()) + 1
    first = rank[codes]
    starts = np.flatnonzero(first != stop)
    first = np.concatenate([first, np.full(longest, stop)])
    columns, live, key = [first[starts]], np.ones(len(starts), bool), first[starts]
    for i in range(1, longest):
        lead = first[starts + i]
        live &= lead != stop
        columns.append(np.where(live, lead, 0))
        if i > 1:
            key = np.unique(key, return_inverse=True)[1]      # keeps the order, and the product within 64 bits
        key = key * (len(names) + 1) + columns[-1]
    _, at, n = np.unique(key, return_index=True, return_counts=True)
    texts_of = pa.concat_arrays([pa.array([b""], pa.binary()), names])
    window = pc.binary_join_element_wise(*[texts_of.take(pa.array(c[at])) for c in columns], b" ")
    return pa.record_batch([pa.repeat(pa.scalar(lang, pa.string()), len(at)), window.cast(pa.string()), pa.array(n, pa.int64())],
                           names=["lang", "window", "n"])


def _windows(longest: int):
    def run(batches):
        for batch in batches:
            held: dict[str, list] = {}
            size = 0
            langs, texts = batch.column(0).to_pylist(), batch.column(1).cast(pa.binary())
            for lang, text in zip(langs, texts):
                held.setdefault(lang, []).append(text.as_py())
                size += len(held[lang][-1])
                if size >= SLICE:
                    yield from (count_windows(k, v, longest) for k, v in held.items())
                    held, size = {}, 0
            yield from (count_windows(k, v, longest) for k, v in held.items())
    return run


def fold(batch: pa.RecordBatch, longest: int, least: int) -> pa.RecordBatch:
    """Pad the windows of a sorted batch back to their longest prefix that may be found ``least`` times."""
    parts = pc.split_pattern(batch.column(1).cast(pa.binary()), b" ").flatten()
    words = [parts.take(pa.array(np.arange(i, len(parts), longest))) for i in range(longest)]
    n = batch.column(2).to_numpy()
    change = np.ones(batch.num_rows, bool)
    change[1:] = pc.not_equal(batch.column(0)[1:], batch.column(0)[:-1]).to_numpy(zero_copy_only=False)
    new = []                                                  # by level: whether a row starts another prefix
    for w in words:
        change = change.copy()
        change[1:] |= pc.not_equal(w[1:], w[:-1]).to_numpy(zero_copy_only=False)
        new.append(change)
    length = np.full(len(n), longest)
    for level in range(longest, 1, -1):
        at = np.flatnonzero(new[level - 1])
        rare = np.add.reduceat(n, at) < least
        rare[[0, -1]] = False
        length[np.repeat(rare, np.diff(np.append(at, len(n))))] = level - 1
    words = [pc.if_else(pa.array(length > i), w, pa.scalar(b"", pa.binary())) for i, w in enumerate(words)]
    # rows that became equal stand next to each other but for the padding: sum runs of equal ones
    change = np.ones(len(n), bool)
    change[1:] = pc.not_equal(batch.column(0)[1:], batch.column(0)[:-1]).to_numpy(zero_copy_only=False)
    for w in words:
        change[1:] |= pc.not_equal(w[1:], w[:-1]).to_numpy(zero_copy_only=False)
    at = np.flatnonzero(change)
    return pa.record_batch([batch.column(0).take(pa.array(at)), *[w.take(pa.array(at)).cast(pa.string()) for w in words],
                            pa.array(np.add.reduceat(n, at))], names=["lang", *[f"w{i}" for i in range(len(words))], "n"])


def _folds(longest: int, least: int):
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                yield fold(batch, longest, least)
    return run


def phrase_counts(docs: DataFrame, longest: int = 3, least: int = 10, lang: str = "lang", text: str = "text") -> DataFrame:
    """(lang, phrase, words, n): the language's words (``words`` 0, phrase null) and all phrases of up to ``longest`` words
    found ``least`` times or more, with exact counts."""
    t = docs.select(F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit("und")).alias("lang"), F.col(f"`{text}`").cast("string").alias("text"))
    windows = t.where("text <> ''").mapInArrow(_windows(longest), "lang string, window string, n long")
    columns = [f"w{i}" for i in range(longest)]
    near = windows.repartitionByRange("lang", "window").sortWithinPartitions("lang", "window")
    rest = near.mapInArrow(_folds(longest, least), ", ".join(["lang string", *[f"{c} string" for c in columns], "n long"]))
    # fields of the ROLLUP: null where summed over, '' where the window was padded
    sums = rest.rollup("lang", *columns).agg(F.sum("n").alias("n"))
    whole = F.lit(True)
    for c in columns:
        whole = whole & (F.col(c).isNull() | (F.col(c) != ""))
    words = sum((F.col(c).isNotNull().cast("int") for c in columns), F.lit(0))
    sums = sums.where(F.col("lang").isNotNull() & whole & ((F.col("n") >= least) | F.col(columns[0]).isNull()))
    return sums.select("lang", F.when(F.col(columns[0]).isNotNull(), F.concat_ws(" ", *columns)).alias("phrase"), words.alias("words"), "n")


def _exact(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(19,0)")


def collocations(docs: DataFrame, longest: int = 3, least: int = 10, share: int = 50, top: int = 2000, lang: str = "lang", text: str = "text") -> DataFrame:
    """The best ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score.

    a, l and r count the phrase and the two parts of its worst cut, n the language's words; score is
    floor(1000000 a a / (l r)).  A phrase goes if a longer candidate holds it and has at least ``share`` percent of its
    count.  Null texts have no words, a null language counts as ``und``; repeated rows and ids count each; ties end with
    the phrase in byte order, so the ranking is total; an empty table gives no rows; other columns are ignored, whatever
    their names.  A text is split in one piece in memory, so a single text should stay below some 100 MB.
    """
    counts = materialize(phrase_counts(docs, longest, least, lang, text), "phrases")
    known = counts.where("words > 0").select("lang", "phrase", "n")
    candidates = counts.where("words > 1").select("lang", "phrase", "words", F.col("n").alias("a"), F.split("phrase", " ").alias("w"))
    cuts = candidates.select("lang", "phrase", "a", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"), "w", "words")
    cuts = cuts.select("lang", "phrase", "a", "k", F.array_join(F.slice("w", F.lit(1), F.col("k")), " ").alias("first"),
                       F.array_join(F.slice("w", F.col("k") + 1, F.col("words") - F.col("k")), " ").alias("rest"))
    for part, name in (("first", "l"), ("rest", "r")):
        cuts = cuts.join(known.select("lang", F.col("phrase").alias(part), F.col("n").alias(name)), ["lang", part])
    score = F.expr("(decimal(1000000) * cast(a as decimal(19,0)) * cast(a as decimal(19,0))) div (cast(l as decimal(19,0)) * cast(r as decimal(19,0)))")
    worst = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct(score.cast("long").alias("score"), "k", "l", "r")).alias("cut"))
    # phrases that a longer candidate holds: the largest count of such a one
    inner = (candidates.where("words > 2")
             .select("lang", "a", "w", "words", F.explode(F.sequence(F.lit(2), F.col("words") - 1)).alias("size"))
             .select("lang", "a", "w", "size", F.explode(F.sequence(F.lit(1), F.col("words") - F.col("size") + 1)).alias("at"))
             .groupBy("lang", F.array_join(F.slice("w", F.col("at"), F.col("size")), " ").alias("phrase")).agg(F.max("a").alias("longer")))
    kept = (worst.join(inner, ["lang", "phrase"], "left").where(F.col("longer").isNull() | (100 * _exact("longer") < share * _exact("a")))
            .select("lang", "phrase", "a", "cut.score", "cut.l", "cut.r"))
    # two rounds: a language's candidates are ranked in parts before its best meet
    best = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part = kept.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    part = part.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*best))).where(F.col("rank") <= top)
    ranked = part.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best))).where(F.col("rank") <= top)
    totals = counts.where("words = 0").select("lang", "n")
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
