"""Incremental raw loading as a Structured Streaming job.

The same upsert as the batch loader, driven by ``readStream`` over a folder
where the operational system lands change files. ``foreachBatch`` hands each
micro-batch to :func:`kpiloom.operators.ingest.extract_load` as landed rows:
every row takes part, the newest ``updated_at`` wins per key, so the result does
not depend on how files fall into micro-batches. The batch id is derived from
the stream's own identity (kept in its checkpoint) and the epoch, so a replayed epoch (driver restart, lost
executor) rewrites its own paths and, once its log partition exists, is
skipped: the effect is exactly-once. ``availableNow`` processes what is there
and stops, which is how a scheduled incremental load runs; a plain
``processingTime`` trigger keeps it running.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from kpiloom.operators.ingest import extract_load


def start_incremental_load(spark: SparkSession, source_dir: str, schema: T.StructType, root: str, table: str,
                           key: str, checkpoint: str | None = None, available_now: bool = True,
                           processing_time: str = "1 minute", max_files_per_trigger: int | None = None,
                           ) -> StreamingQuery:
    """Stream change files of one table into its raw snapshots.

    ``checkpoint`` defaults to a fixed folder under ``root``: a restart, also in
    a new application, goes on where the last one ended.
    """
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    stream = reader.parquet(source_dir)

    def load_batch(batch_df, epoch_id: int) -> None:
        session = batch_df.sparkSession
        query = session.sparkContext.getLocalProperty("sql.streaming.queryId") or "stream"
        extract_load(session, {table: batch_df}, root, tables={table: key}, landed=True,
                     batch_id=f"s{table}-{query}-{epoch_id:012d}")

    ckpt = checkpoint or f"{root.rstrip('/')}/meta/streams/{table}"
    w = stream.writeStream.foreachBatch(load_batch).option("checkpointLocation", ckpt)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time)
    return w.start()
