import os
import sys
import tempfile

import numpy as np
import pandas as pd
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    from tidecast.session import checkpoint_root, tune
    s = (SparkSession.builder.master("local[8]").appName("tidecast-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    if not s.conf.get("spark.checkpoint.dir", None):
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tidecast-test-ckpt-"))
    tune(s)
    checkpoint_root(s)
    yield s


@pytest.fixture(scope="session")
def sample_daily_df(spark):
    """365 days from 2023-01-01: 500 + 0.3t + 80 sin(2πt/7) + N(0, 20), seed 123."""
    rng = np.random.default_rng(123)
    t = np.arange(365)
    v = np.round(500 + 0.3 * t + 80 * np.sin(2 * np.pi * t / 7) + rng.normal(0, 20, 365), 2)
    pdf = pd.DataFrame({"series_id": "test_series",
                        "timestamp": pd.date_range("2023-01-01", periods=365, freq="D"),
                        "value": v})
    return spark.createDataFrame(pdf).selectExpr(
        "series_id", "cast(timestamp as timestamp_ntz) as timestamp", "value")


@pytest.fixture(scope="session")
def short_daily_df(spark):
    """90 days from 2024-01-01: 100 + 0.5t + N(0, 5), seed 456."""
    rng = np.random.default_rng(456)
    t = np.arange(90)
    v = np.round(100 + 0.5 * t + rng.normal(0, 5, 90), 2)
    pdf = pd.DataFrame({"series_id": "short_series",
                        "timestamp": pd.date_range("2024-01-01", periods=90, freq="D"),
                        "value": v})
    return spark.createDataFrame(pdf).selectExpr(
        "series_id", "cast(timestamp as timestamp_ntz) as timestamp", "value")


@pytest.fixture(scope="session")
def tree_edges(spark):
    """total → region_A, region_B; region_A → store_1, store_2; region_B → store_3."""
    return spark.createDataFrame(
        [("total", "region_A"), ("total", "region_B"), ("region_A", "store_1"),
         ("region_A", "store_2"), ("region_B", "store_3")], "parent string, child string")
