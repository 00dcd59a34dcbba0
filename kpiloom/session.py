"""SparkSession helpers. Nothing here runs on import."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Settings every job relies on. Timestamps are naive (TIMESTAMP_NTZ) end to
# end, but UTC keeps any LTZ conversion a no-op. ANSI stays on so that bad
# text raises instead of silently becoming null.
SQL_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
}
# Unless the session names its own: the bytes up to which AQE joins shuffle partitions. Keys compress to a few bytes each
# and take some 300 in the hash map of an aggregate, so Spark's 64 MB would be 2 GB in one task.
ADVISORY = ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "8MB")


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings to an existing session (idempotent)."""
    for k, v in SQL_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    if spark.conf.get(ADVISORY[0], None) is None:
        spark.conf.set(*ADVISORY)
    return spark


def get_session(master: str | None = None, app_name: str = "kpiloom",
                shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings above. The UI stays off."""
    b = (SparkSession.builder.appName(app_name).config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false"))
    if master:
        b = b.master(master)
    for k, v in SQL_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named in ``spark.checkpoint.dir`` (a path every executor can reach).

    It must be set when the session is built; there is no machine-local default.
    """
    sc = spark.sparkContext
    d = sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        raise ValueError("spark.checkpoint.dir is not set: name a folder that all executors share")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d


def scale_settings(shuffle_bytes: int, total_cores: int, input_bytes: int | None = None,
                   max_width: int = 20_000) -> dict:
    """Settings for a job that shuffles about ``shuffle_bytes`` (after pruning) in its widest exchange.

    * scan splits: 256 MB, and up to 1 GB once the input would otherwise give
      more than 100,000 tasks;
    * shuffle width: shuffle bytes / 256 MB, at least 2 x cores, at most
      ``max_width`` -- the driver keeps a status for each map task and reducer, so
      100 TB must not give hundreds of thousands of each. Beyond it partitions
      grow (5 GB at 100 TB) and spill instead; AQE coalesces what is small, as
      rollups of a few thousand rows, and splits what is skewed;
    * a partition counts as skewed when it is 5 x the median and over 512 MB.
    Apply at session build (``get_session(extra=scale_settings(...))``).
    """
    mb = 1024 ** 2
    split = min(1024 * mb, max(256 * mb, -(-(input_bytes or shuffle_bytes) // 100_000)))
    width = min(max_width, max(2 * total_cores, -(-shuffle_bytes // (256 * mb))))
    return {
        "spark.sql.files.maxPartitionBytes": str(split),
        "spark.sql.shuffle.partitions": str(width),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(width),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * mb),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 * mb),
    }
