"""Observation store: append, last-write-wins upsert, pruned and inclusive scans."""

import pytest
from pyspark.sql import functions as F

from tidecast.session import scratch_path
from tidecast.sources.store import SeriesStore
from tidecast.streaming import ingest


def test_upsert_last_wins(spark):
    st = SeriesStore(spark, scratch_path(spark, "t-store"), n_buckets=4)
    df = spark.createDataFrame([("a", "2024-01-01", 1.0), ("a", "2024-01-02", 2.0), ("b", "2024-01-01", 5.0)],
                               "s string, t string, v double")
    assert st.append(df, series_col="s", ts_col="t", value_col="v") == 3
    st.upsert(spark.createDataFrame([("a", "2024-01-02", 20.0)], "s string, t string, v double"),
              series_col="s", ts_col="t", value_col="v")
    got = {(r.series_id, str(r.timestamp)[:10]): r.value for r in st.read().collect()}
    assert got[("a", "2024-01-02")] == 20.0 and len(got) == 3
    rng = st.query_range("a", "2024-01-01 00:00:00", "2024-01-02 00:00:00").collect()
    assert len(rng) == 2  # inclusive at both ends
    assert st.query_series("zzz").count() == 0
    assert st.query_series("a").collect()[0].metadata == {}
    assert {r.series_id: r.n_rows for r in st.row_count().collect()} == {"a": 2, "b": 1}


def test_series_scan_prunes_buckets(spark):
    st = SeriesStore(spark, scratch_path(spark, "t-store"), n_buckets=8)
    df = spark.range(200).select((F.col("id") % 20).cast("string").alias("series_id"),
                                 F.timestamp_seconds(F.col("id") * 3600).cast("timestamp_ntz").alias("timestamp"),
                                 F.col("id").cast("double").alias("value"))
    st.append(df)
    plan = st.query_series("3")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "bucket" in plan
    assert st.query_series("3").count() == 10


def test_drop_duplicates_ignores_map_column(spark):
    from tidecast.sources.store import canonicalise, drop_duplicates
    df = spark.createDataFrame([("a", "2024-01-01", 1.0, '{"k": 1}'), ("a", "2024-01-01", 1.0, '{"k": 1}'),
                                ("a", "2024-01-02", 2.0, None)], "s string, t string, v double, m string")
    c = canonicalise(df, "s", "t", "v", metadata_col="m")
    assert drop_duplicates(c).count() == 2


def test_range_scan_pushes_filters(spark):
    st = SeriesStore(spark, scratch_path(spark, "t-store"), n_buckets=4)
    df = spark.range(100).select((F.col("id") % 5).cast("string").alias("series_id"),
                                 F.timestamp_seconds(F.col("id") * 86400).cast("timestamp_ntz").alias("timestamp"),
                                 F.col("id").cast("double").alias("value"))
    st.append(df)
    q = st.query_range("2", "1970-01-10 00:00:00", "1970-02-10 00:00:00")
    plan = q._jdf.queryExecution().executedPlan().toString()
    scan = [line for line in plan.splitlines() if "FileScan" in line][0]
    part = scan.split("PartitionFilters: [", 1)[1].split("]", 1)[0]
    pushed = scan.split("PushedFilters: [", 1)[1]
    assert "bucket" in part and "=" in part  # one bucket directory is read
    assert "GreaterThanOrEqual(timestamp" in pushed and "LessThanOrEqual(timestamp" in pushed
    assert "EqualTo(series_id" in pushed
    got = [r.value for r in q.collect()]
    assert got == [v for v in range(100) if v % 5 == 2 and 9 <= v <= 40]


ROW = "s string, t timestamp_ntz, v double"
COLS = dict(series_col="s", ts_col="t", value_col="v")


def _stream(spark, store, value, ckpt, source):
    spark.sql(f"SELECT 'a' AS s, TIMESTAMP_NTZ'2024-01-01' AS t, {value}D AS v").write.mode("append").parquet(source)
    ingest.ingest(spark, source, ROW, store, checkpoint=ckpt, **COLS).awaitTermination()
    return {r.series_id: r.value for r in store.read().collect()}


def test_append_stream_compact_share_one_write_order(spark):
    root = scratch_path(spark, "t-store")
    store = SeriesStore(spark, root, n_buckets=4)
    first = spark.sql("SELECT s, TIMESTAMP_NTZ'2024-01-01' AS t, 1.0D AS v FROM VALUES ('a'), ('b') AS x(s)")
    store.append(first, **COLS)
    ckpt, source = scratch_path(spark, "t-ckpt"), scratch_path(spark, "t-src")
    assert _stream(spark, store, 99.0, ckpt, source) == {"a": 99.0, "b": 1.0}
    small = SeriesStore(spark, root).compact(scratch_path(spark, "t-store"))
    assert small.n_buckets == 4 and small.raw().count() == 2
    assert {r.series_id: r.value for r in small.read().collect()} == {"a": 99.0, "b": 1.0}
    # a stream that begins anew comes after what was compacted, and a later append after that
    assert _stream(spark, small, 5.0, scratch_path(spark, "t-ckpt"), scratch_path(spark, "t-src")) == {"a": 5.0, "b": 1.0}
    small.append(first, **COLS)
    assert [r.value for r in small.query_series("a").collect()] == [1.0]


def test_reopened_store_keeps_its_bucket_count(spark):
    root = scratch_path(spark, "t-store")
    df = spark.range(80).select((F.col("id") % 8).cast("string").alias("series_id"),
                                F.timestamp_seconds(F.col("id") * 3600).cast("timestamp_ntz").alias("timestamp"),
                                F.col("id").cast("double").alias("value"))
    SeriesStore(spark, root, n_buckets=16).append(df)
    again = SeriesStore(spark, root)
    assert [again.query_series(str(i)).count() for i in range(8)] == [10] * 8
    with pytest.raises(ValueError, match="16 buckets"):
        SeriesStore(spark, root, n_buckets=64)


def _frame(spark, rows):
    return spark.createDataFrame(rows, "s string, t string, v double").selectExpr("s", "cast(t as timestamp_ntz) as t", "v")


def test_a_compacted_store_is_read_without_aggregation(spark):
    store = SeriesStore(spark, scratch_path(spark, "t-store"), n_buckets=4)
    assert store.read().count() == 0 and store.compact().read().count() == 0
    store.append(_frame(spark, [("a", "2024-01-01", 1.0), ("b", "2024-01-01", 2.0)]), **COLS)
    store.append(_frame(spark, [("a", "2024-01-01", 3.0)]), **COLS)
    assert "Aggregate" in store.query_series("a")._jdf.queryExecution().executedPlan().toString()
    store.compact()
    plan = store.query_series("a")._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in plan and "Join" not in plan and "PartitionFilters" in plan
    assert store.raw().count() == 2
    store.append(_frame(spark, [("b", "2024-01-01", 9.0), ("c", "2024-01-01", 4.0)]), **COLS)
    want = {"a": 3.0, "b": 9.0, "c": 4.0}
    assert {r.series_id: r.value for r in store.read().collect()} == want
    assert {r.series_id: r.n_rows for r in store.row_count().collect()} == dict.fromkeys("abc", 1)
    assert {r.series_id for r in store.list_series().collect()} == set("abc")
    store.compact()
    assert store.vacuum() == 4 and {r.series_id: r.value for r in store.read().collect()} == want
    assert {r.series_id: r.value for r in SeriesStore(spark, store.root).read().collect()} == want


def test_order_comes_from_the_log_and_not_from_clocks(spark, monkeypatch):
    import time

    root = scratch_path(spark, "t-store")
    early, late = SeriesStore(spark, root, n_buckets=2), SeriesStore(spark, root)
    early.append(_frame(spark, [("a", "2024-01-01", 1.0)]), **COLS)
    monkeypatch.setattr(time, "time", lambda: 0.0)  # a writer whose clock lags
    late.append(_frame(spark, [("a", "2024-01-01", 2.0)]), **COLS)
    assert [r.value for r in early.read().collect()] == [2.0]
    numbers = [s.claim() for s in (early, late, early)]
    assert numbers == sorted(set(numbers))


def test_a_write_that_was_lost_is_not_read_and_its_number_can_be_written_again(spark):
    store = SeriesStore(spark, scratch_path(spark, "t-store"), n_buckets=2)
    store.append(_frame(spark, [("a", "2024-01-01", 1.0)]), **COLS)
    seq = store.claim()
    half = f"{store.root}/delta/_seq={seq}/bucket=0"
    _frame(spark, [("a", "2024-01-01", 7.0)]).selectExpr("s as series_id", "t as timestamp", "v as value").write.parquet(half)
    fs, path = store._fs(f"delta/_seq={seq}/_SUCCESS")
    assert not fs.exists(path) and [r.value for r in store.read().collect()] == [1.0]
    for v in (5.0, 6.0):  # a replay replaces
        store.append(_frame(spark, [("a", "2024-01-01", v)]), seq=seq, **COLS)
    assert [r.value for r in store.read().collect()] == [6.0] and store.raw().count() == 2


def test_a_constant_is_kept_once(spark):
    store = SeriesStore(spark, scratch_path(spark, "t-store"), n_buckets=2)
    assert [store.constant("_x", 7), store.constant("_x", 8)] == [7, 7]
    store._create("_lost", "00")  # ended too early
    assert store.constant("_lost", 9) == 9 and store.constant("_lost", 1) == 9
