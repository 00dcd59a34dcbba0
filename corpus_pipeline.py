"""The corpus pipeline: documents -> quality rules -> near duplicates -> decontamination -> mixing -> token files.

Each stage takes (spark, docs, sf_dir) and works on all rows that the stage before it kept; its result is written as
Parquet to the shared folder and read again, so a lost executor never costs more than one stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kpiloom.llm.common import documents, materialize
from kpiloom.llm import stages

STAGES = [
    ("quality_rules", stages.quality_rules),
    ("ngram_jaccard_join", stages.near_duplicates),
    ("decontamination", stages.decontamination),
    ("mixing", stages.mixing),
    ("token_files", stages.token_files),
]

# Mixing draws at random and the token files hold tokenizer output: not SQL. tests/llm holds the run against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
