"""URL filters: association rules mined by Spark's FP-growth, matched by an inverted index.

A url becomes a set of tokens: registered-domain and host parts, path segments, query keys, scheme and shape marks.  Labelled
urls add the token of their label; FP-growth finds the token combinations that occur often enough together, and those
that lead to the label ``block`` with enough confidence and lift are the rules.  A rule with a subset that is at least
as confident is pruned.  A url is judged by the rules whose tokens it has all: an index from each rule's rarest token
to the rule keeps that an equi-join, whatever the number of rules.

A list of (host, path) rules set by hand goes before: it fits the host and all its subdomains, if the path starts with
the rule's; the longest fitting rule wins.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kpiloom.llm.common import materialize

BLOCK = "label=block"
MIN_SUPPORT, MIN_CONFIDENCE, MIN_LIFT = 0.005, 0.6, 2.0
MIN_URLS = 25            # a combination that fewer labelled urls hold says nothing
MAX_TOKENS = 24


def url_parts(url: Column) -> tuple[Column, Column, Column]:
    """(host, path, query) of a url.

    Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; path: then up to ``?``, ``#`` or
    the end; both empty for null and for a text without ``://``.
    """
    at = F.coalesce(F.locate("://", url), F.lit(0))
    rest = F.when(at > 0, F.substr(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    after = F.substr(rest, F.length(host) + 1, F.length(rest))
    path = F.regexp_extract(after, r"(?s)^([^?#]*)", 1)
    query = F.regexp_extract(F.substr(after, F.length(path) + 1, F.length(after)), r"(?s)^\?([^#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path, query


def list_verdict(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """The longest fitting rule of ``rules`` (verdict, host, path) as struct(rule, verdict); null where none fits.

    Equally long rules: the one listed first.
    """
    ordered = sorted(rules, key=lambda r: -len(r[1] + r[2]))
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, h, p in reversed(ordered):
        fits = ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p))
        out = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def url_tokens(url: Column) -> Column:
    """The set of tokens of a url; empty for null, without ``://`` too.  Numbers count as their length."""
    host, path, query = url_parts(url)
    parts = F.filter(F.split(host, r"\."), lambda x: x != "")
    n = F.size(parts)
    domain = F.array_join(F.slice(parts, F.greatest(n - 1, F.lit(1)), F.lit(2)), ".")
    shape = F.regexp_replace(path, "[0-9]+", "0")
    segments = F.filter(F.split(shape, "/"), lambda x: x != "")
    keys = F.filter(F.transform(F.split(query, "&"), lambda x: F.regexp_extract(x, "^[^=]*", 0)), lambda x: x != "")
    digits = F.length(F.regexp_extract(path, "[0-9]+", 0))
    one = F.array(
        F.concat(F.lit("scheme="), F.regexp_extract(url, "^([A-Za-z][A-Za-z0-9+.-]*)://", 1)), F.concat(F.lit("domain="), domain),
        F.concat(F.lit("host="), host), F.concat(F.lit("digits="), digits.cast("string")),
        F.when(F.endswith(path, F.lit("/")), F.lit("end=/")), F.when(F.contains(url, F.lit("#")), F.lit("fragment")))
    every = F.concat(
        one, F.transform(F.slice(parts, F.lit(1), F.greatest(n - 2, F.lit(0))), lambda x: F.concat(F.lit("sub="), x)),
        F.transform(segments, lambda x: F.concat(F.lit("path="), x)), F.transform(keys, lambda x: F.concat(F.lit("key="), x)))
    return F.when((F.locate("://", url) > 0) & (host != ""), F.array_distinct(F.array_compact(every))).otherwise(
        F.array().cast("array<string>"))


def _short(lists: DataFrame, least: float) -> DataFrame:
    """The combinations (tokens) of one and two tokens that at least ``least`` blocked urls hold."""
    pairs = F.flatten(F.transform("tokens", lambda x, i: F.transform(
        F.slice("tokens", i + 1, F.size("tokens")), lambda y: F.array_sort(F.array_distinct(F.array(x, y))))))
    return lists.where("blocked").select(F.explode(pairs).alias("tokens")).groupBy("tokens").count().where(F.col("count") >= least).select("tokens")


def recount(lists: DataFrame, candidates: DataFrame, often: DataFrame) -> DataFrame:
    """(tokens, n, hits): how many of ``lists`` (tokens, blocked), and how many blocked ones, hold each of ``candidates``.
    Each candidate stands under its rarest token (``often``: token, count), so a list meets it at most once."""
    parts = candidates.select("tokens", F.explode("tokens").alias("token")).join(often, "token")
    index = parts.groupBy("tokens").agg(F.min(F.struct("count", "token"))["token"].alias("token"))
    own = lists.select(F.col("tokens").alias("own"), "blocked", F.explode("tokens").alias("token"))
    held = own.join(index, "token").where(F.size(F.array_except("tokens", "own")) == 0)
    return held.groupBy("tokens").agg(F.count("*").alias("n"), F.sum(F.col("blocked").cast("long")).alias("hits"))


def generators(lists: DataFrame, often: DataFrame, least: float) -> DataFrame:
    """(tokens, n, hits): every combination that at least ``least`` blocked lists hold and that is held by fewer lists than each
    combination with one token less.

    A combination without that property is held by the very lists of a smaller one, so as a rule it is as confident and goes;
    so do all that contain it.  Level by level: pairs from the lists themselves, longer ones by joining two that differ in
    their last token only, if all their parts were kept; counted by the inverted index.
    """
    known = level = materialize(recount(lists, _short(lists, least), often).where(F.col("hits") >= least), "url-level")
    size = 2
    single = level.where(F.size("tokens") == 1)
    level = materialize(_fewer(level.where(F.size("tokens") == 2), single, 2), "url-level")
    known = single.unionByName(level)
    while level.take(1):
        a = level.select(F.slice("tokens", 1, size - 1).alias("begin"), F.element_at("tokens", -1).alias("x"))
        b = a.select("begin", F.col("x").alias("y"))
        longer = a.join(b, "begin").where("x < y").select(F.concat("begin", F.array("x", "y")).alias("tokens"))
        parts = longer.select("tokens", F.explode("tokens").alias("t")).select(F.col("tokens").alias("whole"), F.array_remove("tokens", F.col("t")).alias("tokens"))
        size += 1
        longer = (parts.join(level.select("tokens"), "tokens").groupBy(F.col("whole").alias("tokens")).agg(F.count("*").alias("c"))
                  .where(F.col("c") == size).select("tokens"))
        counted = recount(lists, longer, often).where(F.col("hits") >= least)
        level = materialize(_fewer(counted, level, size), "url-level")
        known = known.unionByName(level)
    return known


def _fewer(counted: DataFrame, level: DataFrame, size: int) -> DataFrame:
    """Those of ``counted`` that fewer lists hold than each of their parts, all of which are in ``level``."""
    parts = counted.select(F.col("tokens").alias("whole"), "n", "hits", F.explode("tokens").alias("t")).withColumn("tokens", F.array_remove("whole", F.col("t")))
    held = parts.join(level.select("tokens", F.col("n").alias("n_part")), "tokens")
    good = held.groupBy("whole", "n", "hits").agg(F.min("n_part").alias("least"), F.count("*").alias("c")).where((F.col("least") > F.col("n")) & (F.col("c") == size))
    return good.select(F.col("whole").alias("tokens"), "n", "hits")


def mine(labelled: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE,
         min_lift: float = MIN_LIFT) -> DataFrame:
    """Rules (rule_id, tokens, support, confidence, lift) from ``labelled`` (tokens, blocked boolean).

    Tokens below the support can be in no rule and are left out before FP-growth, as are those in nine of ten urls; of a
    url FP-growth sees the ``MAX_TOKENS`` most frequent that remain, as the combinations double with each token.  Where a
    url has more, the combinations of all its tokens are found level by level (:func:`generators`) and all figures are
    counted anew over the whole token sets.  Rules of any length and their figures are exact either way.  Without blocked
    urls there are no rules.
    """
    total = labelled.count()
    schema = "rule_id long, tokens array<string>, support double, confidence double, lift double"
    if not total:
        return labelled.sparkSession.createDataFrame([], schema)
    min_support = min(1.0, max(min_support, MIN_URLS / total))
    rows = labelled.withColumn("_id", F.monotonically_increasing_id())
    each = rows.select("_id", "blocked", F.explode("tokens").alias("token"))
    often = each.groupBy("token").count().where(F.col("count").between(int(min_support * total) + 1, int(0.9 * total)))
    lists = (each.join(often, "token").groupBy("_id").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("count", "token")), False), lambda x: x["token"]).alias("tokens"),
        F.max("blocked").alias("blocked")))
    lists = materialize(lists, "url-items")
    cut = F.slice("tokens", 1, MAX_TOKENS)
    items = lists.select(F.when(F.col("blocked"), F.array_append(cut, F.lit(BLOCK))).otherwise(cut).alias("items"))
    freq = FPGrowth(itemsCol="items", minSupport=min(1.0, min_support * total / max(1, items.count())), minConfidence=0.0).fit(items).freqItemsets
    freq = materialize(freq, "url-itemsets")
    share = labelled.where("blocked").count() / total
    alone = freq.where(~F.array_contains("items", BLOCK)).select(F.array_sort("items").alias("tokens"), F.col("freq").alias("n"))
    both = freq.where(F.array_contains("items", BLOCK) & (F.size("items") > 1)).select(
        F.array_sort(F.array_remove("items", BLOCK)).alias("tokens"), F.col("freq").alias("hits"))
    counted = alone.join(both, "tokens")
    if (lists.agg(F.max(F.size("tokens"))).first()[0] or 0) > MAX_TOKENS:
        counted = materialize(generators(lists, often, min_support * total), "url-generators")
    rules = counted.withColumns({"support": F.col("hits") / total, "confidence": F.col("hits") / F.col("n")})
    rules = rules.withColumn("lift", F.col("confidence") / share if share else F.lit(0.0))
    rules = rules.where((F.col("confidence") >= min_confidence) & (F.col("lift") >= min_lift))
    # a rule goes if leaving out one token leaves a rule that is as confident
    smaller = (rules.select(F.col("tokens").alias("whole"), F.col("confidence").alias("c"), F.explode("tokens").alias("t"))
               .withColumn("tokens", F.array_remove("whole", F.col("t"))))
    beaten = smaller.join(rules.select("tokens", "confidence"), "tokens").where("confidence >= c").select(F.col("whole").alias("tokens"))
    rules = rules.join(beaten, "tokens", "left_anti")
    return materialize(rules.select(F.xxhash64("tokens").alias("rule_id"), "tokens", "support", "confidence", "lift"), "url-rules")


def match(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(url_id, rule_tokens, confidence) of the most confident rule each of ``urls`` (url_id, tokens) has all tokens of.

    Inverted index: each rule stands under its token that fewest rules use; a url looks up its tokens, and a candidate
    counts if all its tokens are there.  Ties go to the rule with fewer tokens, then by token order.
    """
    tokens = rules.select("rule_id", F.explode("tokens").alias("token"))
    use = tokens.groupBy("token").agg(F.count("*").alias("n"))
    key = tokens.join(use, "token").groupBy("rule_id").agg(F.min(F.struct("n", "token"))["token"].alias("token"))
    index = key.join(rules.select("rule_id", F.col("tokens").alias("needed"), "confidence"), "rule_id")
    found = (urls.select("url_id", F.col("tokens").alias("own"), F.explode("tokens").alias("token")).join(index, "token")
             .where(F.size(F.array_except("needed", "own")) == 0))
    best = F.min(F.struct((-F.col("confidence")).alias("c"), F.size("needed").alias("n"), F.col("needed").alias("needed")))
    return found.groupBy("url_id").agg(best.alias("b")).select("url_id", F.array_join("b.needed", " & ").alias("rule_tokens"), (-F.col("b.c")).alias("confidence"))


def judge_urls(pages: DataFrame, labelled: DataFrame, listed: list[tuple[str, str, str]], id_name: str = "page_id", url: str = "url") -> DataFrame:
    """id, host, path, rule, verdict, mined_rule, confidence for every row of ``pages``.

    ``labelled`` has url and blocked; a listed rule, where one fits, goes before what was mined.  An empty table of pages gives
    no rows, and one of labels no rules; a very long url only has many tokens.  Null urls and those without ``://`` have empty host and path, no tokens, and are
    allowed.  Rows are judged by their url alone, so repeated and tied rows agree, and null ids do no harm.
    """
    u = F.col(f"`{url}`").cast("string")
    distinct = pages.select(u.alias("url")).where(u.isNotNull()).distinct()
    learn = labelled.where("url is not null and blocked is not null").select(url_tokens(F.col("url")).alias("tokens"), "blocked").where(F.size("tokens") > 0)
    rules = mine(learn)
    hits = match(distinct.select(F.col("url").alias("url_id"), url_tokens(F.col("url")).alias("tokens")), rules)
    host, path, _ = url_parts(u)
    rows = pages.select(F.col(f"`{id_name}`").alias(id_name), u.alias("_url"), host.alias("host"), path.alias("path"))
    rows = rows.withColumn("_list", list_verdict(F.col("host"), F.col("path"), listed))
    out = rows.join(hits, F.col("_url") == F.col("url_id"), "left")
    verdict = F.coalesce(F.col("_list.verdict"), F.when(F.col("rule_tokens").isNotNull(), F.lit("block")).otherwise(F.lit("allow")))
    return out.select(id_name, "host", "path", F.col("_list.rule").alias("rule"), verdict.alias("verdict"), F.col("rule_tokens").alias("mined_rule"), "confidence")


def labels_by_list(pages: DataFrame, listed: list[tuple[str, str, str]]) -> DataFrame:
    """(url, blocked) of the pages that a listed rule fits: its verdict is their label."""
    url = F.col("url").cast("string")
    host, path, _ = url_parts(url)
    fit = pages.select(url.alias("url"), host.alias("h"), path.alias("p")).select("url", list_verdict(F.col("h"), F.col("p"), listed)["verdict"].alias("v"))
    return fit.where("v is not null").select("url", (F.col("v") == "block").alias("blocked"))


def labels_by_id(pages: DataFrame, labels: DataFrame, id_name: str = "page_id", label_id: str = "doc_id") -> DataFrame:
    """(url, blocked) of labelled pages: a page is to be blocked if its document is labelled toxic or of low quality.
    Rows with no label or a null one are left out; several labels of a page: the worst counts."""
    bad = F.greatest((1 - F.col("quality")), F.col("toxic"))
    worst = labels.groupBy(F.col(label_id).alias("_id")).agg(F.max(bad).alias("bad")).where("bad is not null")
    return pages.select(F.col(f"`{id_name}`").alias("_id"), F.col("url")).join(worst, "_id").select("url", (F.col("bad") > 0).alias("blocked"))
