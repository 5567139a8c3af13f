"""Observation store on partitioned Parquet (the canonical table D1).

Layout below ``<root>``:

* ``delta/_seq=<n>/bucket=<k>/``: one folder for each write, in the order of the store's own commit log;
* ``base/<n>/bucket=<k>/``: one version of every key, of all writes up to ``n`` (the latest one counts);
* ``_log/<n>``: the log; a write claims its number by creating the file, which only one writer can;
* ``_based/<n>``: says that ``base/<n>`` is whole.

``bucket = pmod(xxhash64(series_id), n_buckets)``.  A series lives in exactly one bucket, so a scan for one series
prunes every other partition directory (the bucket predicate is constant-folded from the literal series id).

Key conflicts ``(series_id, timestamp)`` resolve at read time, last write wins: of the writes since the base the latest
version of each key is kept (``max_by`` over the sequence, ties broken by value: a partial aggregation keyed by the full
key, so no hot series ever lands in one task), and the base rows of other keys are added as they are.  Right
after ``compact`` nothing is aggregated.
"""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import METADATA, OBSERVATION_SCHEMA, SERIES, TS, VALUE
from ..session import discard, written

BUCKET = "bucket"
SEQ = "_seq"
DEFAULT_BUCKETS = 64


def _empty_map() -> F.Column:
    return F.create_map().cast("map<string,string>")


def bucket_of(series: F.Column, n_buckets: int) -> F.Column:
    return F.pmod(F.xxhash64(series), F.lit(n_buckets)).cast("int")


def canonicalise(df: DataFrame, series_col: str = SERIES, ts_col: str = TS,
                 value_col: str = VALUE, metadata_col: str | None = None) -> DataFrame:
    """Rename and coerce caller columns to the canonical schema.

    ``str(series)``, timestamp, ``float(value)``; metadata that is NULL or not a
    map becomes the empty map; rows without series or timestamp are rejected.
    """
    if metadata_col and metadata_col in df.columns:
        m = df.schema[metadata_col].dataType
        if m.typeName() == "map":
            meta = F.coalesce(F.col(metadata_col).cast("map<string,string>"), _empty_map())
        elif m.typeName() == "string":
            meta = F.coalesce(F.from_json(F.col(metadata_col), "map<string,string>"), _empty_map())
        else:
            meta = _empty_map()
    else:
        meta = _empty_map()
    out = df.select(
        F.col(series_col).cast("string").alias(SERIES),
        F.col(ts_col).cast("timestamp_ntz").alias(TS),
        F.col(value_col).cast("double").alias(VALUE),
        meta.alias(METADATA),
    )
    return out.where(F.col(SERIES).isNotNull() & F.col(TS).isNotNull())


def stack(*frames: DataFrame) -> DataFrame:
    """Append series frames (``pd.concat``): union by column name."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def drop_duplicates(df: DataFrame) -> DataFrame:
    """Keep one copy of rows equal in every comparable column (map columns such as
    ``metadata`` cannot be compared and are left out of the key)."""
    keys = [f.name for f in df.schema.fields if not isinstance(f.dataType, T.MapType)]
    return df.dropDuplicates(keys)


class SeriesStore:
    """Append / upsert / scan of canonical observations under ``root``."""

    def __init__(self, spark: SparkSession, root: str, n_buckets: int | None = None):
        """Open or create the store.  Its bucket count is written once, below ``root``; a reopened
        store takes it from there, and another ``n_buckets`` is an error."""
        self.spark = spark
        self.root = root.rstrip("/")
        self.n_buckets = self.constant("_buckets", n_buckets or DEFAULT_BUCKETS)
        if n_buckets not in (None, self.n_buckets):
            raise ValueError(f"{self.root} has {self.n_buckets} buckets, not {n_buckets}")

    # -------------------------------------------------------------- commit log
    def _fs(self, name: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def _numbers(self, folder: str, prefix: str = "", marker: str = "") -> list[int]:
        """Numbers of the entries of a folder; with ``marker`` only of those that hold such a file."""
        fs, path = self._fs(folder)
        if not fs.exists(path):
            return []
        names = [x.getPath().getName() for x in fs.listStatus(path)]
        own = sorted(int(n[len(prefix):]) for n in names if n.startswith(prefix) and n[len(prefix):].isdigit())
        return [n for n in own if not marker or fs.exists(self._fs(f"{folder}/{prefix}{n}/{marker}")[1])]

    def _create(self, name: str, text: str = "") -> bool:
        """Create a small file; False if it is there already."""
        fs, path = self._fs(name)
        try:
            out = fs.create(path, False)
        except Py4JJavaError:
            if not fs.exists(path):
                raise
            return False
        out.write(bytearray(text.encode()))
        out.close()
        return True

    def claim(self) -> int:
        """The next number of the commit log.  Later claims have larger numbers, whatever the writers' clocks say."""
        n = max([0, *self._numbers("_log"), *self._numbers("_based")]) + 1
        while not self._create(f"_log/{n}"):
            n += 1
        return n

    def constant(self, name: str, value: int) -> int:
        """The number kept under ``name`` beside the data; ``value`` is kept where there is none yet."""
        if self._create(name, f"{value:020d}"):
            return value
        fs, path = self._fs(name)
        file = fs.open(path)
        try:
            text = bytes(file.readNBytes(20)).decode()
        finally:
            file.close()
        if len(text) < 20:  # its writer was lost before it ended
            fs.delete(path, False)
            return self.constant(name, value)
        return int(text)

    # -------------------------------------------------------------- write
    def _write(self, rows: DataFrame, path: str) -> int:
        """Write rows by bucket, series and time, sorted; returns how many.

        A bucket holding a hot series is split over several write tasks.  The rows are written
        before their ranges are sampled, so what leads to them runs once.
        """
        once = written(rows.withColumn(BUCKET, bucket_of(F.col(SERIES), self.n_buckets)), "store")
        obs = Observation("store_write")
        (once.repartitionByRange(BUCKET, SERIES, TS).sortWithinPartitions(BUCKET, SERIES, TS)
             .observe(obs, F.count(F.lit(1)).alias("rows"))
             .write.mode("overwrite").partitionBy(BUCKET).parquet(path))
        discard(once)
        return int(obs.get["rows"])

    def append(self, df: DataFrame, series_col: str = SERIES, ts_col: str = TS,
               value_col: str = VALUE, metadata_col: str | None = None, seq: int | None = None) -> int:
        """Append rows; returns the number written (counted while writing).

        ``seq`` is a number claimed before; writing it again replaces what it wrote.
        """
        rows = canonicalise(df, series_col, ts_col, value_col, metadata_col)
        return self._write(rows, f"{self.root}/delta/{SEQ}={self.claim() if seq is None else seq}")

    def upsert(self, df: DataFrame, **cols) -> int:
        """Insert-or-replace by ``(series_id, timestamp)``: a later write wins."""
        return self.append(df, **cols)

    # -------------------------------------------------------------- read
    def _base(self) -> int:
        """Number of the last write in the current base; 0 without a base."""
        return max([0, *self._numbers("_based")])

    def _of_base(self, n: int) -> DataFrame:
        schema = T.StructType([*OBSERVATION_SCHEMA.fields, T.StructField(BUCKET, T.IntegerType())])
        if not n:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.root}/base/{n}")

    def _of_writes(self, numbers: list[int]) -> DataFrame:
        schema = T.StructType([*OBSERVATION_SCHEMA.fields, T.StructField(SEQ, T.LongType()), T.StructField(BUCKET, T.IntegerType())])
        if not numbers:
            return self.spark.createDataFrame([], schema)
        top = f"{self.root}/delta"
        return self.spark.read.schema(schema).option("basePath", top).parquet(*[f"{top}/{SEQ}={n}" for n in numbers])

    def _newer(self, than: int) -> list[int]:
        """Finished writes after the base."""
        return [n for n in self._numbers("delta", f"{SEQ}=", "_SUCCESS") if n > than]

    def raw(self) -> DataFrame:
        """All versions that are kept: the base (``_seq`` is that of its last write) and the writes since."""
        base = self._base()
        return self._of_base(base).withColumn(SEQ, F.lit(base).cast("long")).unionByName(self._of_writes(self._newer(base)))

    def read(self, where: F.Column | None = None) -> DataFrame:
        """Current version of every key (last write wins), canonical columns."""
        number = self._base()
        newer = self._newer(number)
        base, writes = self._of_base(number), self._of_writes(newer)
        if where is not None:
            base, writes = base.where(where), writes.where(where)
        base = base.select(SERIES, TS, VALUE, F.coalesce(METADATA, _empty_map()).alias(METADATA))
        if not newer:
            return base
        latest = self._latest(writes).drop(SEQ)
        return latest.unionByName(base.join(latest.select(SERIES, TS), [SERIES, TS], "left_anti")) if number else latest

    @staticmethod
    def _latest(raw: DataFrame) -> DataFrame:
        latest = (raw.groupBy(SERIES, TS)
                     .agg(F.max_by(F.struct(VALUE, METADATA),
                                   F.struct(F.col(SEQ), F.col(VALUE))).alias("_v"),
                          F.max(SEQ).alias(SEQ)))
        return latest.select(SERIES, TS, F.col("_v." + VALUE).alias(VALUE),
                             F.coalesce(F.col("_v." + METADATA), _empty_map()).alias(METADATA), SEQ)

    def _series_pred(self, series_id: str) -> F.Column:
        lit = F.lit(series_id)
        return (F.col(BUCKET) == bucket_of(lit, self.n_buckets)) & (F.col(SERIES) == lit)

    def query_series(self, series_id: str) -> DataFrame:
        """All observations of one series, ascending by time (empty frame if unknown)."""
        return self.read(self._series_pred(series_id)).orderBy(TS)

    def query_range(self, series_id: str, start, end) -> DataFrame:
        """Observations with ``start ≤ timestamp ≤ end`` (inclusive at both ends)."""
        lo = F.lit(start).cast("timestamp_ntz")
        hi = F.lit(end).cast("timestamp_ntz")
        pred = self._series_pred(series_id) & F.col(TS).between(lo, hi)
        return self.read(pred).orderBy(TS)

    def list_series(self) -> DataFrame:
        base = self._base()
        return self._of_base(base).select(SERIES).unionByName(self._of_writes(self._newer(base)).select(SERIES)).distinct()

    def row_count(self, series_id: str | None = None) -> DataFrame:
        """Rows per series (current versions)."""
        r = self.read(self._series_pred(series_id) if series_id else None)
        return r.groupBy(SERIES).agg(F.count(F.lit(1)).alias("n_rows"))

    def compact(self, target: str | None = None) -> "SeriesStore":
        """Write a new base of the current versions; with ``target`` as the base of a new store there.

        Reads before it ends use the old base.  The writes it holds are no longer read; their files stay until
        :meth:`vacuum`, for readers that began before.
        """
        out = self if target is None else SeriesStore(self.spark, target, self.n_buckets)
        number = max([self._base(), *self._newer(self._base())])
        if number and (target is not None or self._newer(self._base())):
            self._write(self.read(), f"{out.root}/base/{number}")
            out._create(f"_based/{number}")
        return out

    def vacuum(self) -> int:
        """Delete the writes and bases that the current base replaces; returns how many folders went."""
        base = self._base()
        old = [f"delta/{SEQ}={n}" for n in self._numbers("delta", f"{SEQ}=") if n <= base]
        old += [f"base/{n}" for n in self._numbers("base") if n < base]
        for name in old:
            fs, path = self._fs(name)
            fs.delete(path, True)
        return len(old)
