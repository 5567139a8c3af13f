import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from tidecast.llm import simhash
from tidecast.llm.common import components


def brute_fp(text, n=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    grams = [" ".join(words[i:i + n]) for i in range(len(words) - n + 1)] or [" ".join(words)]
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(items, d):
    """items: (id, fp) list -> component of each."""
    fps = sorted({f for _, f in items})
    root = {f: f for f in fps}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    for i, a in enumerate(fps):
        for b in fps[i + 1:]:
            if (a ^ b).bit_count() <= d:
                root[find(a)] = find(b)
    least = {}
    for i, f in items:
        if i is not None:
            least[find(f)] = min(least.get(find(f), i), i)
    return [(i, f, least.get(find(f))) for i, f in items]


def rows(df):
    return sorted(((r[0], r[1] % (1 << 64), r[2]) for r in df.collect()), key=str)


@pytest.mark.parametrize("d,cell", [(2, 256), (2, 2), (1, 2), (0, 256), (3, 4)])
def test_components_match_brute_force(spark, d, cell):
    rng = random.Random(d)
    fps = {0, (1 << 64) - 1, 1 << 63}
    for _ in range(25):  # chains and clouds around random centres
        f = rng.getrandbits(64)
        for _ in range(8):
            fps.add(f)
            for _ in range(rng.randint(0, d + 1)):
                f ^= 1 << rng.randrange(64)
    signed = lambda f: f - (1 << 64) if f >> 63 else f
    df = spark.createDataFrame([(signed(f),) for f in fps], "fp long")
    got = {r[0] % (1 << 64): r[1] for r in components(simhash.links(df, d, cell)).collect()}
    want = brute_components([(f, f) for f in fps], d)
    classes = {}
    for f, _, c in want:
        classes.setdefault(c, set()).add(f)
    mine = {}
    for f in fps:
        mine.setdefault(got.get(f, signed(f)), set()).add(f)
    assert sorted(map(sorted, classes.values())) == sorted(map(sorted, mine.values()))


def test_small_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    items = [(r[0], brute_fp(r[1])) for r in docs.select("doc_id", "text").collect()]
    assert rows(simhash.near_duplicates(docs)) == sorted(brute_components(items, 2), key=str)


def test_manhattan_bounds_hamming(spark):
    rng = random.Random(1)
    pairs = [(rng.getrandbits(63), rng.getrandbits(63)) for _ in range(200)]
    e = lambda c: simhash._embedding(F.col(c))
    for a, b, m in spark.createDataFrame(pairs, "a long, b long").select("a", "b", simhash._manhattan(e("a"), e("b"))).collect():
        lanes = [((a >> i) & 3, (b >> i) & 3) for i in range(0, 64, 2)]
        assert m == sum(abs(x.bit_count() - y.bit_count()) for x, y in lanes) <= (a ^ b).bit_count()


def test_odd_rows(odd, empty):
    want = sorted(brute_components([(r[0], brute_fp(r[1])) for r in odd.select("doc_id", "text").collect()], 2), key=str)
    assert rows(simhash.near_duplicates(odd)) == want
    assert simhash.near_duplicates(empty).count() == 0
    assert simhash.drop_near_duplicates(empty).count() == 0


def test_one_document_of_each_group_stays(docs_of):
    text = " ".join(f"word{i}" for i in range(300))
    docs = docs_of([text, text, "quite another text about something", text + " end", (None, text)])
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    ids = {r.doc_id for r in kept.collect()}
    assert {0, 2, None} <= ids and 1 not in ids
