"""The registered queries of this subpackage: each applies an operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiloom.llm.common import documents, workers_import
from kpiloom.llm.oracle import ORACLE  # noqa: F401


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kpiloom.llm.quality_rules import judge
    d = judge(documents(spark, sf_dir).select("doc_id", "text"))
    base = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return d.select("doc_id", *[F.col(f"measures.{c}").alias(c) for c in base], "base_failed", "kept")


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kpiloom.llm.mixing import mix_table
    return mix_table(documents(spark, sf_dir).select("doc_id", "text", "source"))


def op5_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kpiloom.llm.ngram_join import jaccard_join
    return jaccard_join(documents(spark, sf_dir), k=4, percent=85)


def op6_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kpiloom.llm.pseudonyms import DEMO_KEY, pseudonymize
    key = spark.conf.get("llm.pseudonym.key", DEMO_KEY)      # a secret of the cluster; the demo key serves the test tables
    return pseudonymize(documents(spark, sf_dir).select("doc_id", "text"), key)


# The rules that op3's contract sets by hand (verdict, host, path).
LISTED = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")]


def op3_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kpiloom.llm.url_rules import judge_urls, labels_by_id, labels_by_list
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    # the table's labels say nothing of the url here; the verdicts of the listed rules do, and what is mined extends them
    by_list = labels_by_list(pages, LISTED)
    by_id = labels_by_id(pages, spark.read.parquet(f"{sf_dir}/labels.parquet")).join(by_list.select("url").distinct(), "url", "left_anti")
    return judge_urls(pages, by_list.unionByName(by_id), LISTED)


def op7_phrase_automata(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kpiloom.llm.phrase_automata import remove_repeats
    d = remove_repeats(documents(spark, sf_dir))
    return d.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def op8_run_length_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kpiloom.llm.run_length_index import remove_repeats
    d = remove_repeats(documents(spark, sf_dir))
    return d.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept_bytes", 256).alias("kept_sha256"), "longest_repeat")


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kpiloom.llm.wavelet import write_and_read
    return write_and_read(documents(spark, sf_dir).select("doc_id", "text")).select("doc_id", "start", "n_tokens", "ids_crc32")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kpiloom.llm.decontamination import find_leaks
    return find_leaks(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kpiloom.llm.toxicity import fit, score
    docs = documents(spark, sf_dir).select("doc_id", "text")
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 0
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(~held_out).select("doc_id", F.col("toxic").alias("label"))
    rows = score(docs, fit(docs.where(~held_out), labels))
    return rows.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


def damaged(conversations: DataFrame) -> DataFrame:
    """op11's damage: by crc32(`conv_id:turn`) % 20 a row is dropped, emptied, stripped of `[.!?]`, repeated or made the user's."""
    c = conversations.select("conv_id", "turn", *[F.coalesce(F.col(x), F.lit(" ")).alias(x) for x in ("role", "text")])
    name = F.concat_ws(":", *[F.coalesce(F.col(x).cast("string"), F.lit(" ")) for x in ("conv_id", "turn")])
    c = c.withColumn("harm", F.crc32(name.cast("binary")) % 20).where("harm <> 0")
    text = F.when(F.col("harm") == 1, "").when(F.col("harm") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    return c.select("conv_id", "turn", F.when(F.col("harm") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
                    F.explode(F.when(F.col("harm") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy")).drop("copy")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kpiloom.llm.conversation_repair import fingerprints, repair
    workers_import(spark)
    conversations = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    summary, turns = repair(damaged(conversations))
    ids = conversations.select("conv_id").distinct()
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    s = summary.join(fingerprints(turns), "conv", "left").select(F.col("conv_id").alias("id"), *numbers, "audit", "sha")
    return ids.join(s, F.col("conv_id").eqNullSafe(F.col("id")), "left").select(
        "conv_id", *[F.coalesce(n, F.lit(0)).cast("long").alias(n) for n in numbers], F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("sha", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kpiloom.llm.collocations import collocations
    return collocations(documents(spark, sf_dir))


def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kpiloom.llm.exact_dedup import annotate
    d = annotate(documents(spark, sf_dir).select("doc_id", "text"), keep_text=False)
    return d.select("row.doc_id", "keep_id", "group_size", "kept", "text_sha256")


QUERIES = {
    "op1_decontamination": op1_decontamination,
    "op2_toxicity": op2_toxicity,
    "op3_url_rules": op3_url_rules,
    "op4_quality_rules": op4_quality_rules,
    "op5_ngram_jaccard_join": op5_ngram_jaccard_join,
    "op6_pseudonyms": op6_pseudonyms,
    "op7_phrase_automata": op7_phrase_automata,
    "op8_run_length_index": op8_run_length_index,
    "op9_token_files": op9_token_files,
    "op10_mixing": op10_mixing,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_collocations": op12_collocations,
    "op13_exact_dedup": op13_exact_dedup,
}
