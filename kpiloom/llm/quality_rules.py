"""Quality rules: a table of thresholds compiled into one projection of Spark's own functions.

``measures`` names every figure as a column expression over one text, ``RULES`` is the table (measure, lower bound,
upper bound, least number of words for the rule to count), ``compile_rules`` turns it into a verdict column.  No user
function, no shuffle: a document is judged where it is read, whatever its length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpiloom.llm.common import GAP

# Frequent function words of the four languages of the corpus.
STOP_WORDS = {
    "en": ["the", "of", "and", "to", "in", "is", "that", "it", "was", "for", "on", "as", "with", "are", "this"],
    "de": ["der", "die", "und", "in", "den", "von", "zu", "das", "mit", "ist", "des", "ein", "für", "nicht", "im"],
    "fr": ["de", "la", "le", "et", "les", "des", "en", "un", "du", "une", "que", "est", "pour", "qui", "dans"],
    "es": ["de", "la", "que", "el", "en", "y", "los", "del", "se", "las", "por", "un", "para", "con", "no"],
}

#: (measure, least, most, words needed): a text with that many words or more is kept only within the bounds;
#: ``None`` leaves a side open.  Ratios are per word, per line or per character of the whole text.
RULES = [
    ("mean_word_chars", 2.0, 20.0, 20),
    ("symbol_ratio", None, 0.04, 20),
    ("dup_line_ratio", None, 0.50, 20),
    ("stop_word_ratio", 0.02, None, 50),
    ("distinct_word_ratio", 0.15, None, 50),
]
MIN_WORDS, MAX_REPEAT_PERCENT, WINDOW = 20, 30, 8


def _joined(hashes: str, step: int) -> Column:
    """Each hash combined with the one ``step`` places on."""
    return F.transform(hashes, lambda h, i: F.xxhash64(h, F.get(hashes, i + step)))


def measures(docs: DataFrame, text: str = "text", window: int = WINDOW) -> DataFrame:
    """``docs`` with one struct column ``measures`` of counts and ratios of each whole text.

    Null and empty texts: all counts 0, ratios null (a rule passes where its ratio is null).  A former column
    ``measures`` is replaced.  Only Spark functions: words once, then 64-bit hashes of all windows, then, for texts where a
    window repeats, a sort of (hash, place) that brings equal windows together.
    """
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    out = docs.drop("measures").withColumns({
        "_words": F.array_remove(F.split(t, GAP), ""),
        "_lines": F.filter(F.split(t, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")),
        "_n_symbols": F.size(F.split(t, r"[#*$%&|<>]")) - 1,
    })
    out = out.withColumn("_hash", F.transform("_words", lambda w: F.xxhash64(w)))
    # hashes of 2, 4, .. consecutive words from those of half as many
    out, have = out.withColumn("_win", F.col("_hash")), 1
    while have < window:
        step = min(have, window - have)
        out = out.withColumn("_win", _joined("_win", step))
        have += step
    last = F.size("_words") - (window - 1)
    out = out.withColumn("_win", F.when(last > 1, F.slice("_win", 1, F.greatest(last, F.lit(0)))))
    # (hash, place) in order; null where no window repeats
    out = out.withColumn("_by_hash", F.when(
        F.size(F.array_distinct("_win")) < F.size("_win"),
        F.array_sort(F.transform("_win", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    twice = F.filter("_by_hash", lambda p, i: F.coalesce(F.get("_by_hash", i - 1)["h"] == p["h"], F.lit(False))
                     | F.coalesce(F.get("_by_hash", i + 1)["h"] == p["h"], F.lit(False)))
    places = F.array_sort(F.transform(twice, lambda p: p["i"]))
    # a place covers ``window`` words, or as many as lie between it and the place before
    covered = F.aggregate(
        places, F.struct(F.lit(0).alias("n"), F.lit(-window).alias("at")),
        lambda a, p: F.struct((a["n"] + F.least(F.lit(window), p - a["at"])).alias("n"), p.alias("at")),
        lambda a: a["n"])
    n = F.size("_words")
    stop = sorted({x for ws in STOP_WORDS.values() for w in ws for x in (w, w.capitalize())})
    chars = F.length(F.array_join("_words", ""))
    dup = F.size("_lines") - F.size(F.array_distinct("_lines"))
    words = F.when(n > 0, n)
    out = out.withColumn("_chars", chars)
    chars, symbols = F.col("_chars"), F.col("_n_symbols")
    m = {
        "n_words": n.cast("long"), "word_chars": chars.cast("long"), "n_symbols": symbols.cast("long"),
        "n_dup_lines": dup.cast("long"), "n_repeat_words": F.coalesce(covered, F.lit(0)).cast("long"),
        "mean_word_chars": chars / words, "symbol_ratio": symbols / F.when(chars > 0, chars),
        "dup_line_ratio": dup / F.when(F.size("_lines") > 0, F.size("_lines")),
        "stop_word_ratio": F.size(F.filter("_words", lambda w: w.isin(stop))) / words,
        "distinct_word_ratio": F.size(F.array_distinct("_hash")) / words,
    }
    return (out.withColumn("measures", F.struct(*[c.alias(k) for k, c in m.items()]))
            .drop("_words", "_lines", "_n_symbols", "_hash", "_win", "_by_hash", "_chars"))


def base_failed(m: str = "measures", min_words: int = MIN_WORDS, max_repeat_percent: int = MAX_REPEAT_PERCENT) -> Column:
    n, r = F.col(f"{m}.n_words"), F.col(f"{m}.n_repeat_words")
    return (n < min_words) | (100 * r > max_repeat_percent * n)


def compile_rules(rules=RULES, m: str = "measures") -> Column:
    """Array of the names of the rules a text breaks, in the table's order."""
    broken = []
    for name, least, most, words in rules:
        x, bad = F.col(f"{m}.{name}"), F.lit(False)
        if least is not None:
            bad = bad | (x < least)
        if most is not None:
            bad = bad | (x > most)
        broken.append(F.when(F.coalesce(bad, F.lit(False)) & (F.col(f"{m}.n_words") >= words), F.lit(name)))
    return F.array_compact(F.array(*broken)) if broken else F.array().cast("array<string>")


JUDGED = ["measures", "base_failed", "broken_rules", "kept"]


def judge(docs: DataFrame, text: str = "text", rules=RULES) -> DataFrame:
    """``docs`` with ``measures``, ``base_failed``, ``broken_rules`` and ``kept`` (columns of these names are replaced; all others
    pass through, whatever their names)."""
    cols = docs.columns
    inner = docs.select(F.struct(*[F.col(f"`{c}`") for c in cols]).alias("row"), F.col(f"`{text}`").alias("text"))
    out = measures(inner, "text").withColumns({"base_failed": base_failed(), "broken_rules": compile_rules(rules)})
    out = out.withColumn("kept", ~F.col("base_failed") & (F.size("broken_rules") == 0))
    return out.select(*[F.col("row")[c].alias(c) for c in cols if c not in JUDGED], *JUDGED)


def keep_good(docs: DataFrame, text: str = "text", rules=RULES) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with their own columns."""
    cols = docs.columns
    inner = docs.select(F.struct(*[F.col(f"`{c}`") for c in cols]).alias("_row"), F.col(f"`{text}`").alias("_text"))
    # not a filter: the optimizer would push it below the measures and write their expressions out again and again
    judged = judge(inner, "_text", rules).select(F.explode(F.when(F.col("kept"), F.array("_row"))).alias("_row"))
    return judged.select("_row.*")
