"""Read the driver's parquet tables (one file per table)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# The input contract: the columns read from each driver table, with their types.
# Declaring them skips schema inference (a footer read per table per query) and
# fails fast if an input changes shape.
SCHEMAS = {
    "nation": "n_nationkey int, n_name string",
    "customer": "c_custkey bigint, c_nationkey int",
    "part": "p_partkey bigint, p_name string, p_type string, p_retailprice double",
    "orders": ("o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
               "o_orderdate timestamp_ntz, o_orderpriority string"),
    "events": "event_id bigint, user_id bigint, event_type string",
}


def table_path(sf_dir: str, name: str) -> str:
    """Path of one driver table (one parquet file per table)."""
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str, columns: list[str] | None = None) -> DataFrame:
    """Parquet scan; naming the columns keeps ReadSchema minimal.

    Tables with a declared schema are read with it (no inference); the
    requested columns must be part of it.
    """
    reader = spark.read.schema(SCHEMAS[name]) if name in SCHEMAS else spark.read
    df = reader.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df


def raw_folder(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The seven raw tables of a folder, one Parquet table each (``name`` or ``name.parquet``)."""
    from pyspark.errors import AnalysisException

    from kpiloom.functions.vocabulary import TABLES

    out = {}
    for name in TABLES:
        try:
            out[name] = spark.read.parquet(f"{folder}/{name}.parquet")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            out[name] = spark.read.parquet(f"{folder}/{name}")
    return out
