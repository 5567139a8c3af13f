"""Incremental ingestion of observations into the store (Structured Streaming).

The stream form of the store's bulk append: new files in a source folder are
read with ``readStream``, canonicalised and appended batch by batch with
``foreachBatch``.  A micro-batch claims its number in the store's commit log like any other write, and the
number is recorded per (stream, batch) before the batch is written: a batch replayed after a
failure replaces its own rows, so every batch counts once.
Progress lives in a checkpoint below the shared checkpoint folder.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..session import scratch_path
from ..sources import store as st


def _writer(store: st.SeriesStore, stream: str, series_col, ts_col, value_col, metadata_col):
    def write(batch: DataFrame, batch_id: int) -> None:
        name = f"_batches/{stream}/{batch_id}"
        seq = store.constant(name, store.claim())
        store.append(batch, series_col, ts_col, value_col, metadata_col, seq=seq)
    return write


def ingest(spark: SparkSession, source_dir: str, schema, store: st.SeriesStore, *,
           series_col: str, ts_col: str, value_col: str, metadata_col: str | None = None,
           glob: str | None = None, checkpoint: str | None = None,
           max_files_per_trigger: int | None = None, available_now: bool = True) -> StreamingQuery:
    """Start the ingestion stream; with ``available_now`` it stops once caught up."""
    reader = spark.readStream.schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    src = reader.parquet(source_dir)
    checkpoint = checkpoint or scratch_path(spark, "ingest-ckpt")
    stream = hashlib.sha256(checkpoint.rstrip("/").encode()).hexdigest()[:16]
    w = (src.writeStream.foreachBatch(_writer(store, stream, series_col, ts_col, value_col, metadata_col))
            .option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()
