"""Grid operators: forward fill across empty blocks, month-end spines, frequency codes."""

from pyspark.sql import functions as F

from tidecast.operators import grid


def test_ffill_carries_across_empty_blocks(spark):
    df = spark.createDataFrame([("a", "2024-01-01 00:00:00", 1.0), ("a", "2024-01-01 20:00:00", 5.0),
                                ("b", "2024-01-01 00:00:00", 7.0), ("b", "2024-01-01 02:00:00", None)],
                               "series_id string, timestamp string, value double") \
        .withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))
    out = grid.regularise(df, "H", block=3, with_position=True).orderBy("series_id", "timestamp").collect()
    a = [r for r in out if r.series_id == "a"]
    assert len(a) == 21 and [r.value for r in a[:20]] == [1.0] * 20 and a[20].value == 5.0
    assert [r.pos for r in a] == list(range(1, 22)) and a[0].n_rows == 21
    assert sum(r.filled for r in a) == 19
    b = [r for r in out if r.series_id == "b"]
    assert [r.value for r in b] == [7.0, 7.0, 7.0]


def test_month_end_spine_clamps(spark):
    df = spark.createDataFrame([("m", "2024-01-31 00:00:00", 1.0)], "series_id string, timestamp string, value double") \
        .withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))
    sp = {r.step: str(r.timestamp)[:10] for r in grid.future_spine(df, 3, freq="M").collect()}
    assert sp == {1: "2024-02-29", 2: "2024-03-31", 3: "2024-04-30"}


def test_frequency_codes(spark):
    rows = ([("h", f"2024-01-01 {i:02d}:00:00", 1.0) for i in range(5)] +
            [("ms", f"2024-{i:02d}-01 00:00:00", 1.0) for i in range(1, 6)] +
            [("w", f"2024-01-{d:02d} 00:00:00", 1.0) for d in (1, 8, 15, 22)] +
            [("short", "2024-01-01 00:00:00", 1.0), ("short", "2024-01-05 00:00:00", 1.0)])
    df = spark.createDataFrame(rows, "series_id string, timestamp string, value double") \
        .withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))
    f = {r.series_id: (r.freq, r.seasonal_period) for r in grid.infer_frequency(df).collect()}
    assert f == {"h": ("H", 24), "ms": ("MS", 12), "w": ("W", 52), "short": ("D", 7)}


def _series(spark, rows):
    return spark.createDataFrame(rows, "series_id string, timestamp string, value double") \
        .withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))


def test_values_between_steps_are_carried(spark):
    df = _series(spark, [("a", "2024-01-01 00:00:00", 1.0), ("a", "2024-01-02 12:00:00", 5.0), ("a", "2024-01-02 09:00:00", 4.0),
                         ("a", "2024-01-04 00:00:00", 7.0), ("one", "2024-01-01 10:00:00", 2.0)])
    out = grid.regularise(df, "D").orderBy("series_id", "timestamp").collect()
    assert [(r.series_id, r.value, r.filled) for r in out] == [
        ("a", 1.0, 0), ("a", 1.0, 1), ("a", 5.0, 1), ("a", 7.0, 0), ("one", 2.0, 0)]
    plain = grid.regularise(df.where("series_id = 'a'"), "D", fill="none").orderBy("timestamp").collect()
    assert [r.value for r in plain] == [1.0, None, None, 7.0]


def test_month_grids_have_anchors_and_times(spark):
    df = _series(spark, [("a", "2024-01-30 10:30:00", 1.0), ("a", "2024-03-01 10:30:00", 3.0), ("a", "2024-04-02 10:30:00", 4.0),
                         ("one", "2024-01-30 10:30:00", 9.0)])
    starts = grid.regularise(df, "MS").orderBy("series_id", "timestamp").collect()
    assert [(r.series_id, str(r.timestamp), r.value) for r in starts] == [
        ("a", "2024-02-01 10:30:00", 1.0), ("a", "2024-03-01 10:30:00", 3.0), ("a", "2024-04-01 10:30:00", 3.0),
        ("one", "2024-02-01 10:30:00", 9.0)]
    one = df.where("series_id = 'one'")
    assert [str(r.timestamp) for r in grid.future_spine(one, 2, freq="MS").orderBy("step").collect()] == ["2024-02-01 10:30:00", "2024-03-01 10:30:00"]
    assert [str(r.timestamp) for r in grid.future_spine(one, 2, freq="M").orderBy("step").collect()] == ["2024-01-31 10:30:00", "2024-02-29 10:30:00"]
