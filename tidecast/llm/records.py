"""Token ids as length-delimited binary records with a separate offset index.

A file is a sequence of frames:

    length of the payload   unsigned 64 bits
    masked CRC of the length's eight bytes   unsigned 32 bits
    payload
    masked CRC of the payload   unsigned 32 bits

all little-endian.  The payload is the document id (signed 64 bits), a byte that is 0 for
a null id, a byte with the width of an id (2 or 4), and the ids.  The CRC is CRC-32; it is
masked (rotated right by 15, plus a constant) so that a checksum over data that holds
checksums stays sound.  Files are cut at ``FILE_BYTES``; documents ascend by id within and
across files.

Tasks write files of their own names below the shared folder; only the files that the
committed index (Parquet: file, offset, length of every record) lists are part of the data
set, so that retried or lost tasks leave nothing behind that is read.
"""

from __future__ import annotations

import os
import re
import struct
import uuid
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import prefix_sums, process_cache

FILE_BYTES = 16 << 20
#: Words whose ids a Python worker remembers; the frequent ones come first.
CACHE_WORDS = 800_000
_MASK = 0xA282EAD8
_HEAD = "<qBB"
INDEX = "part int, seq int, file string, record long, offset long, length long, id long, n_tokens long"


def masked_crc(data: bytes) -> int:
    c = zlib.crc32(data)
    return (((c >> 15) | (c << 17)) + _MASK) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    length = struct.pack("<Q", len(payload))
    return b"".join((length, struct.pack("<I", masked_crc(length)), payload, struct.pack("<I", masked_crc(payload))))


def read_frame(stream) -> bytes | None:
    """The next payload, None at the end; raises ValueError on damage."""
    head = stream.read(12)
    if not head:
        return None
    if len(head) < 12 or masked_crc(head[:8]) != struct.unpack("<I", head[8:])[0]:
        raise ValueError("damaged record length")
    n = struct.unpack("<Q", head[:8])[0]
    body = stream.read(n + 4)
    if len(body) < n + 4 or masked_crc(body[:n]) != struct.unpack("<I", body[n:])[0]:
        raise ValueError("damaged record")
    return body[:n]


def pack_ids(doc_id: int | None, ids: np.ndarray, width: int) -> bytes:
    return struct.pack(_HEAD, doc_id or 0, doc_id is not None, width) + ids.astype(f"<u{width}").tobytes()


def unpack_ids(payload: bytes) -> tuple[int | None, np.ndarray]:
    doc_id, has, width = struct.unpack_from(_HEAD, payload)
    return (doc_id if has else None), np.frombuffer(payload, dtype=f"<u{width}", offset=struct.calcsize(_HEAD)).astype("<u4")


def _open(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path if re.match(r"\w+:/", path) else os.path.abspath(path))


#: Where a cut before a space would not be a cut between the tokenizer's words.
_LONG_SPACE = re.compile(r"\s\s\s|\s\Z")


class WordEncoder:
    """Encodes with a byte-level BPE whose words never span "x y" before the space.

    Cutting a text before its spaces leaves the tokenizer's own words whole unless
    white space comes in threes or at the end; such texts, and those that hold an
    added token of the vocabulary (it becomes its own id, wherever it stands), go to the
    tokenizer as they are.  The tokenizer encodes each distinct word; its ids are remembered.
    """

    def __init__(self, path: str, width: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.whole = re.compile("|".join([_LONG_SPACE.pattern, *map(re.escape, sorted(added))]))
        self.dtype, self.known = f"<u{width}", {}

    def _ask(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, dtype=self.dtype).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Of each text, its ids as little-endian unsigned integers."""
        known, cut = self.known, []
        new: dict = {}
        for t in texts:
            if self.whole.search(t):
                cut.append([t])
                continue
            words = t.split(" ")
            words = words[:1] + [" " + w for w in words[1:]] if words[0] else [" " + w for w in words[1:]]
            cut.append(words)
            new.update(dict.fromkeys(w for w in words if w not in known))
        plain = [w[0] for w in cut if len(w) == 1 and w[0] not in known]
        new.update(dict.fromkeys(plain))
        full, ask = len(known) >= CACHE_WORDS, list(new)
        known.update(zip(ask, self._ask(ask)))
        out = [b"".join([known[w] for w in words]) for words in cut]
        for w in ask if full else plain:
            known.pop(w, None)
        return out


def _writer(root: str, tokenizer: str, end_id: int, width: int, file_bytes: int):
    def write(batches):
        from pyspark import TaskContext

        cache, key = process_cache(), ("encoder", tokenizer, width)
        if key not in cache:
            cache[key] = WordEncoder(tokenizer, width)
        encoder, end = cache[key], np.array([end_id], dtype=f"<u{width}").tobytes()
        part, run, seq, out, at, name = TaskContext.get().partitionId(), uuid.uuid4().hex[:12], 0, None, 0, ""
        store, base = _open(root)
        store.create_dir(base, recursive=True)
        record = 0
        try:
            for batch in batches:
                ids = [None if pd.isna(i) else int(i) for i in batch["id"]]
                texts = batch["text"].tolist()
                rows, lo = [], 0
                while lo < len(texts):
                    hi, size = lo, 0  # a few million characters at a time
                    while hi < len(texts) and (hi == lo or size + len(texts[hi] or "") < 4_000_000):
                        size += len(texts[hi] or "")
                        hi += 1
                    for doc_id, raw in zip(ids[lo:hi], encoder.encode([t or "" for t in texts[lo:hi]])):
                        if out is None:
                            name = f"part-{part:06d}-{seq:05d}-{run}.rec"
                            out, at, record = store.open_output_stream(f"{base}/{name}"), 0, 0
                        data = frame(struct.pack(_HEAD, doc_id or 0, doc_id is not None, width) + raw + end)
                        out.write(data)
                        rows.append((part, seq, name, record, at, len(data), doc_id, len(raw) // width + 1))
                        at, record = at + len(data), record + 1
                        if at >= file_bytes:
                            out.close()
                            out, seq = None, seq + 1
                    lo = hi
                if rows:
                    yield pd.DataFrame(rows, columns=["part", "seq", "file", "record", "offset", "length", "id", "n_tokens"]).astype({"id": "Int64"})
        finally:
            if out is not None:
                out.close()

    return write


def write_records(df: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 2,
                  vocabulary: int = 1 << 16, file_bytes: int = FILE_BYTES, path: str | None = None) -> str:
    """Encode ``df`` in ascending id order (null ids first, then by text) and write records and index.

    Returns the data set's folder: ``data/`` has the files, ``index/`` the offset index.
    A null text is empty; an added token of the vocabulary in a text becomes its id; every document ends with ``end_id``.  An empty table gives an empty index.
    """
    spark = df.sparkSession
    path = path or scratch_path(spark, "records")
    width = 2 if vocabulary <= 1 << 16 and end_id < 1 << 16 else 4
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    rows = rows.repartitionByRange("id", F.hash("text")).sortWithinPartitions("id", F.hash("text"))
    rows.mapInPandas(_writer(f"{path}/data", tokenizer, end_id, width, file_bytes), INDEX).write.parquet(f"{path}/index")
    return path


def _reader(root: str):
    def read(batches):
        store, base = _open(root)
        for batch in batches:
            for part, seq, name in zip(batch["part"], batch["seq"], batch["file"]):
                rows, start, n = [], 0, 0
                with store.open_input_stream(f"{base}/{name}", buffer_size=1 << 20) as stream:
                    while (payload := read_frame(stream)) is not None:
                        doc_id, ids = unpack_ids(payload)
                        rows.append((part, seq, n, doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
                        start, n = start + len(ids), n + 1
                yield pd.DataFrame(rows, columns=["part", "seq", "record", "id", "before", "n_tokens", "ids_crc32"]).astype({"id": "Int64"})

    return read


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Rows ``(id, start, n_tokens, ids_crc32)`` read back from the files, checksums verified.

    ``start`` counts the ids of all records before, in file order.
    """
    index = spark.read.schema(INDEX).parquet(f"{path}/index")
    files = index.groupBy("part", "seq", "file").agg(F.sum("n_tokens").alias("tokens"))
    # one file a task or so; the file list itself is too short for Spark to see how much they hold
    rows = files.repartition(max(1, min(files.count(), 10_000)), "file").mapInPandas(
        _reader(f"{path}/data"), "part int, seq int, record long, id long, before long, n_tokens long, ids_crc32 long")
    # files are few; their order number is a rank within the part plus the files of the parts before
    order = files.select("part", "seq", "tokens").withColumn("at", F.col("part").cast("long") * (1 << 20) + F.col("seq"))
    first = prefix_sums(order, "at", "tokens", "base", width=1 << 20).select("part", "seq", "base")
    return rows.join(first.hint("merge"), ["part", "seq"]).select(
        "id", (F.col("base") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")


def read_shuffled(spark: SparkSession, path: str, seed: int) -> DataFrame:
    """Records ``(id, ids)`` in an order drawn from ``seed``, read through the offset index."""
    def fetch(batches):
        store, base = _open(f"{path}/data")
        for batch in batches:
            out, files = [], {}
            for name, offset in zip(batch["file"], batch["offset"]):
                if name not in files:
                    files[name] = store.open_input_file(f"{base}/{name}")
                files[name].seek(int(offset))
                doc_id, ids = unpack_ids(read_frame(files[name]))
                out.append((doc_id, ids.astype(np.int64)))
            for f in files.values():
                f.close()
            yield pd.DataFrame(out, columns=["id", "ids"]).astype({"id": "Int64"})

    index = spark.read.schema(INDEX).parquet(f"{path}/index")
    key = F.xxhash64(F.lit(seed), "file", "record")
    return index.repartitionByRange(key).sortWithinPartitions(key).mapInPandas(fetch, "id long, ids array<long>")
