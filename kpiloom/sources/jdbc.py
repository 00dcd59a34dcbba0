"""Operational tables read straight from their database over JDBC (A1, A3).

Not exercised by the tests: no database may be started in this build
environment. The code uses only ``spark.read.jdbc`` and the incremental
extract operator, whose comparison Spark pushes into each partition's query.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kpiloom.operators.ingest import WATERMARK_COLUMN, extract_incremental


def key_bounds(spark: SparkSession, url: str, table: str, key: str, properties: dict | None = None) -> tuple[int, int]:
    """min and max of a numeric key, computed by the database (one row back)."""
    q = f"(SELECT MIN({key}) AS lo, MAX({key}) AS hi FROM {table}) bounds"
    r = spark.read.jdbc(url, q, properties=properties or {}).first()
    return int(r["lo"] or 0), int(r["hi"] or 0)


def read_source_jdbc(spark: SparkSession, url: str, table: str, key: str, num_partitions: int,
                     mark: str | None = None, watermark_column: str = WATERMARK_COLUMN,
                     properties: dict | None = None, fetch_size: int = 10_000) -> DataFrame:
    """One source table as ``num_partitions`` parallel range reads on ``key``.

    With ``mark`` the result is the incremental batch: ``watermark_column >
    mark`` is pushed to the database in every partition's WHERE clause, so
    only changed rows leave the source.
    """
    props = {"fetchsize": str(fetch_size), **(properties or {})}
    lo, hi = key_bounds(spark, url, table, key, props)
    df = spark.read.jdbc(url, table, column=key, lowerBound=lo, upperBound=hi + 1,
                         numPartitions=num_partitions, properties=props)
    return extract_incremental(df, mark, watermark_column) if mark is not None else df
