"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

import os
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"        # fixed value: what counts as a word
GAP = r"[\x20\x09-\x0D]+"
_unset: dict[str, str] = {}        # shared folder of applications that name none
_scratch: dict[str, str] = {}      # scratch folder by application


def shared_dir(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``, which the driver and all executors share.

    Only where nothing is set and Spark runs on one machine (``local[...]``, as in tests) a scratch folder takes its
    place; on a cluster the setting is required.
    """
    d = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir is not set: name a folder that the driver and all executors share")
        app = spark.sparkContext.applicationId
        d = _unset.setdefault(app, "") or tempfile.mkdtemp(prefix="llm-shared-")
        _unset[app] = d
    return d.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path for an intermediate table.  All paths of an application lie in one folder of its own, which its file
    system removes when the application ends."""
    app = spark.sparkContext.applicationId
    if app not in _scratch:
        folder = f"{shared_dir(spark)}/llm-{app}-{uuid.uuid4().hex}"
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        fs.mkdirs(path)
        fs.deleteOnExit(path)
        _scratch[app] = folder
    return f"{_scratch[app]}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: cuts the lineage, survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def workers_import(spark: SparkSession) -> None:
    """Let Spark's Python workers import this package from where the driver has it (a cluster installs it there, or ships
    it by --py-files)."""
    env, root = spark.sparkContext.environment, str(Path(__file__).resolve().parents[2])
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *paths])


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    workers_import(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def components(edges: DataFrame, left: str = "u", right: str = "v") -> DataFrame:
    """(node, component) for every node of the undirected ``edges``; the component is its smallest node.

    Alternating large-star and small-star steps: every node links its larger neighbours (then itself and its smaller
    ones) to its smallest, until nothing changes.  Each step is one aggregation for the minima and one join; a node
    with very many links is combined on the map side and split by the skew join.  Edges with a null end are ignored.
    """
    e = edges.select(F.col(left).alias("u"), F.col(right).alias("v")).where("u <> v").distinct()
    e = materialize(e, "edges")
    nodes = e.select(F.col("u").alias("node")).union(e.select(F.col("v").alias("node"))).distinct()

    def star(e: DataFrame, large: bool) -> DataFrame:
        both = e.union(e.select("v", "u")) if large else e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        j = both.join(low, "u")
        if large:
            out = j.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        else:
            out = j.select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v")))
        return out.where("u <> v").distinct()

    def state(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())

    now = state(e)
    while now[0]:
        e = materialize(star(star(e, True), False), "edges")
        was, now = now, state(e)
        if was == now:
            break
    # every edge now leads from a node to the smallest of its component
    low = e.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("m"))
    return nodes.join(low, "node", "left").select("node", F.coalesce("m", "node").alias("component"))
