"""The stages of the corpus pipeline; each takes (spark, docs, sf_dir) and returns a DataFrame.

All read ``doc_id``, ``text`` and ``source`` of any rows: null and repeated ids are rows like any other, null texts count as empty, very
long texts are read whole, an empty table gives an empty one, and all but the last return every column of ``docs`` as it
came, whatever its name or type.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kpiloom.llm.common import workers_import


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the quality rules keep.  Empty and null texts go (no words), repeated rows are judged alike."""
    from kpiloom.llm.quality_rules import keep_good
    return keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, similarity 0.8 or more): the smallest id.

    Equal rows become one; different texts under one id are different documents; rows without an id or without words stay.
    """
    workers_import(spark)
    from kpiloom.llm.ngram_join import keep_representatives
    return keep_representatives(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold no passage of the benchmark; null and empty texts hold none, all copies of a text fare alike."""
    workers_import(spark)
    from kpiloom.llm.decontamination import drop_contaminated
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows repeated as often as the mix takes them.  Texts without words are not taken; a null source is one of its own; rows
    that are equal throughout are taken alike."""
    from kpiloom.llm.mixing import mixed
    return mixed(docs)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token files of the mix, read back: one row per document copy.  Null and empty texts hold the end id only; null ids come
    first, equal ids in the order of their texts."""
    workers_import(spark)
    from kpiloom.llm.wavelet import write_and_read
    return write_and_read(docs)
