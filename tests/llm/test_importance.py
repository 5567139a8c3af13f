"""op11: buckets, gains, scores and draws against a plain computation."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

from pyspark.sql import functions as F

from tidecast.llm import importance
from tidecast.llm.importance import Head, slices

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(low)
    return len(words), [" ".join(words[i:i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]


def bucket(f):
    return zlib.crc32(f.encode()) % 10000


def brute(docs, bench, percent=5):
    s, t = Counter(bucket(f) for _, x in docs for f in features(x)[1]), Counter(bucket(f) for x in bench for f in features(x)[1])
    S, T = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (S + 10000) / ((s[b] + 1) * (T + 10000)))) for b in range(10000)]
    rows = []
    for i, x in docs:
        n, own = features(x)
        weight = sum(gain[bucket(f)] for f in own)
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append([i, len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n])
    able = sorted((r for r in rows if r[4] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    for k, r in enumerate(able, 1):
        r[4] = k if k <= percent * len(able) // 100 else None
    for r in rows:
        if not any(r is a for a in able):
            r[4] = None
    return sorted(map(tuple, rows), key=str)


def got(docs, bench, **more):
    out = importance.resample(docs, bench, **more).select("doc_id", "n_features", "weight", "score", "rank")
    return sorted((tuple(r) for r in out.collect()), key=str)


def texts_of(seed, n, words=60):
    rng = random.Random(seed)
    vocab = ["".join(rng.choice("abcdeéß1ÄZ") for _ in range(rng.choice((1, 2, 4, 9)))) for _ in range(300)] + ["x" * 70, "é" * 40]
    marks = [" ", "  ", ", ", "\n", "-", "' "]
    return ["".join(rng.choice(vocab) + rng.choice(marks) for _ in range(rng.randint(0, words))) for _ in range(n)]


def test_equals_brute_force(spark, docs_of):
    docs, bench = texts_of(1, 300), texts_of(2, 20)
    made = docs_of(docs)
    assert got(made, made.sparkSession.createDataFrame([(i, t) for i, t in enumerate(bench)], "item_id int, text string")) == brute(
        list(enumerate(docs)), bench)


def test_odd_rows(spark, odd, empty):
    bench = spark.createDataFrame([(0, None), (1, ""), (2, "one two"), (2, "one two")], "item_id int, text string")
    pairs = [(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()]
    assert got(odd, bench, percent=50) == brute(pairs, [None, "", "one two", "one two"], percent=50)
    assert got(odd, bench.where("false")) == brute(pairs, [])
    assert got(empty, bench) == []


def test_ties_and_hot_ids(spark, docs_of):
    """A third of all rows without an id and with one text: ranks have no gap and the limit holds."""
    same = " ".join(["word"] * 25)
    rows = [(None, same)] * 100 + [(i, t) for i, t in enumerate(texts_of(3, 200))]
    out = got(docs_of(rows), spark.createDataFrame([(0, "word word")], "item_id int, text string"), percent=60)
    assert out == brute(rows, ["word word"], percent=60)
    ranks = sorted(r[4] for r in out if r[4] is not None)
    assert ranks == list(range(1, len(ranks) + 1)) and len(ranks) > 100


def test_slices_cut_anywhere(monkeypatch):
    """Texts longer than a slice, with words longer than a slice and than the tables: every feature once."""
    monkeypatch.setattr(importance, "SLICE", 50)
    texts = texts_of(7, 80) + [None, "", "y" * 300 + " z " + "é" * 90, " . ", "a", "a b"]
    every = Counter(w.encode() for t in texts for w in features(t)[1] if " " not in w)
    head = Head([w for w, _ in every.most_common(20) if len(w) <= importance.HEAD_BYTES], [0, 1, 512, 1025])
    total, per = Counter(), Counter()
    for w in slices(texts):
        b, at = head.buckets(w, 10000)
        total.update(b.tolist())
        per.update(w.of[at].tolist())
    assert total == Counter(bucket(f) for t in texts for f in features(t)[1])
    assert per == Counter({i: len(features(t)[1]) for i, t in enumerate(texts) if features(t)[1]})


def test_ranks_over_many_ranges(spark):
    df = spark.range(5000).withColumn("score", F.col("id") % 7)
    rows = importance.ranked(df.repartition(20), [F.col("score").desc(), F.col("id")], F.lit(3000)).collect()
    want = {i: k for k, i in enumerate(sorted(range(5000), key=lambda i: (-(i % 7), i)), 1)}
    assert len(rows) == 5000 and all(r.rank == (want[r.id] if want[r.id] <= 3000 else None) for r in rows)
