"""Session helpers: one place that builds a SparkSession and finds shared storage.

On a cluster the session is created by the platform and ``spark.checkpoint.dir``
names a shared folder (HDFS/S3/ABFS).  Every table this library writes for
lineage cutting or staging lives below that folder.  Only when it is unset (unit
tests, a laptop) do we fall back to a fresh local directory.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"


def get_spark(master: str | None = None, app: str = "tidecast",
              shuffle_partitions: int | None = None) -> SparkSession:
    """Return the active session or build a local one sized for tests/bench."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    cores = os.cpu_count() or 8
    builder = (
        builder.config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cores))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.showConsoleProgress", "false")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    if (master or "").startswith("local") and not spark.conf.get(_CHECKPOINT_KEY, None):
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tidecast-ckpt-"))
    tune(spark)
    checkpoint_root(spark)
    return spark


# Session settings the plans here rely on.  Constraint propagation infers
# predicates from every aliased expression; on the wide feature plans (dozens of
# window columns over self-joined position tables) its cost grows combinatorially
# and planning, not execution, dominates.  The plans state their filters explicitly.
SESSION_SETTINGS = {
    "spark.sql.constraintPropagation.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply :data:`SESSION_SETTINGS` (runtime SQL confs) to a session."""
    for k, v in SESSION_SETTINGS.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and staged tables.

    Reads ``spark.checkpoint.dir`` from the session and fails where it is unset
    (:func:`get_spark` on a local master and the tests then set a folder of their own).  The SparkContext checkpoint dir is aligned
    with it so that ``DataFrame.checkpoint()`` writes there as well.
    """
    context = spark.sparkContext
    root = spark.conf.get(_CHECKPOINT_KEY, None) or context.getConf().get(_CHECKPOINT_KEY, None) or context.getCheckpointDir()
    if not root:
        raise RuntimeError(f"{_CHECKPOINT_KEY} is not set: name a folder that the driver and all executors share")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the shared checkpoint folder."""
    return f"{checkpoint_root(spark)}/tidecast/{name}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable checkpoint (survives executor loss); never a local checkpoint."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=eager)


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared folder and read it back: cuts the lineage, and the planner knows the size."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.written_at = path
    return out


def discard(*frames: DataFrame) -> None:
    """Delete tables of :func:`written` that nothing reads any more."""
    for df in frames:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df.written_at)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
