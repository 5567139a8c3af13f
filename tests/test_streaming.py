"""Streaming ingestion: every file once, replays idempotent under last-write-wins."""

from tidecast.session import scratch_path
from tidecast.sources import tables
from tidecast.sources.store import SeriesStore
from tidecast.streaming import ingest
from smalltables import SMALL


def test_stream_ingest_idempotent(spark):
    store = SeriesStore(spark, scratch_path(spark, "t-stream"), n_buckets=4)
    ckpt = scratch_path(spark, "t-stream-ckpt")
    schema = tables.table(spark, SMALL, "events").schema
    for _ in range(2):  # second run: nothing new, checkpoint remembers the files
        q = ingest.ingest(spark, SMALL, schema, store, series_col="event_type", ts_col="ts",
                          value_col="value", metadata_col="props", glob="events.parquet",
                          checkpoint=ckpt)
        q.awaitTermination()
    n_events = tables.table(spark, SMALL, "events").count()
    assert store.raw().count() == n_events
    assert store.read().count() == n_events
    assert store.read().where("size(metadata) > 0").count() == n_events
