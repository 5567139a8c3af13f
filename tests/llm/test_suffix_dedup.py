import hashlib
import random

import pytest

from tidecast.llm import suffix_dedup


def brute(texts, k):
    seen = {}
    raw = [(t or "").encode() for t in texts]
    for t in raw:
        for i in range(len(t) - k + 1):
            seen[t[i:i + k]] = seen.get(t[i:i + k], 0) + 1
    out = []
    for t in raw:
        gone = bytearray(len(t))
        for i in range(len(t) - k + 1):
            if seen[t[i:i + k]] > 1:
                gone[i:i + k] = b"\1" * k
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        kept = bytes(b for b, g in zip(t, gone) if not g)
        out.append((len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest(), kept))
    return out


def corpus(seed, n=60):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 8)))
    shared = [" ".join(word() for _ in range(80)) for _ in range(4)]
    out = []
    for _ in range(n):
        parts = [" ".join(word() for _ in range(rng.randint(0, 60)))]
        for _ in range(rng.randint(0, 3)):
            s = rng.choice(shared)
            a = rng.randrange(len(s))
            parts += [s[a:a + rng.randint(50, 450)], " ".join(word() for _ in range(rng.randint(0, 30)))]
        out.append("".join(parts))
    return out + ["x" * 700, "xy" * 350, "", None, "short", out[0], out[0], "a" * 199, "a" * 200, "ab" * 100 + "c"]


@pytest.mark.parametrize("k,group", [(200, 2000), (200, 2), (200, 1), (101, 2000), (101, 7), (50, 3)])
def test_matches_brute_force(docs_of, k, group):
    texts = corpus(k)
    got = suffix_dedup.remove_repeats(docs_of(texts), min_len=k, group=group).orderBy("doc_id").collect()
    assert [tuple(r[1:5]) + (bytes(r[5]),) for r in got] == brute(texts, k)


@pytest.mark.parametrize("length", [260, 420])
def test_rows_grow_with_the_documents_around_one_passage(docs_of, monkeypatch, length):
    """No jump where an anchor becomes crowded: ranges stay a few for each document, and the result stays right."""
    rng = random.Random(length)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    passage = " ".join(word() for _ in range(80))[:length]
    texts = [" ".join([word() for _ in range(30)] + [passage] + [word() for _ in range(30)]) for _ in range(400)]
    rows = {}
    keep = suffix_dedup.staged

    def counted(df, name):
        out = keep(df, name)
        rows[name] = rows.get(name, 0) + out.count()
        return out

    monkeypatch.setattr(suffix_dedup, "staged", counted)
    for n in (100, 400):
        rows.clear()
        got = suffix_dedup.remove_repeats(docs_of(texts[:n]), group=16).orderBy("doc_id").collect()
        assert [tuple(r[1:5]) + (bytes(r[5]),) for r in got] == brute(texts[:n], 200)
        assert rows["found"] <= 12 * n and rows["pieces"] <= 40 * n, rows


def test_long_texts_are_cut_with_an_overlap(docs_of, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "PIECE", 300)
    monkeypatch.setattr(suffix_dedup, "BATCH", 2000)
    texts = corpus(5)
    got = suffix_dedup.remove_repeats(docs_of(texts)).orderBy("doc_id").collect()
    assert [tuple(r[1:5]) + (bytes(r[5]),) for r in got] == brute(texts, 200)


def test_odd_rows(odd, empty):
    long = [tuple(r[:4]) for r in suffix_dedup.remove_repeats(odd).collect() if r[0] == 5]
    assert long == [(5, 240_000, 240_000, 1)] * 2
    assert suffix_dedup.remove_repeats(empty).count() == 0


def test_cut_repeats_keeps_clean_texts(docs_of):
    p = " ".join(f"passage{i}" for i in range(60))
    docs = docs_of(["start one " + p, p + " end é", "clean text", None, p])
    got = {r.doc_id: r.text for r in suffix_dedup.cut_repeats(docs).collect()}
    assert got == {0: "start one ", 1: " end é", 2: "clean text", 3: None}
    assert suffix_dedup.cut_repeats(docs).columns == docs.columns


def test_texts_of_one_id_are_told_apart_where_a_short_hash_is_not(spark, docs_of):
    passage = " ".join(f"passage{i}" for i in range(30))
    texts = [passage + " 745", " ".join(f"clean{i}" for i in range(60)) + " 140750", "other start " + passage, "short"]
    docs = docs_of([(None, texts[0]), (None, texts[1]), (1, texts[2]), (None, texts[3])])
    hashes = [r[0] for r in docs.selectExpr("hash(text)").collect()]
    assert hashes[0] == hashes[1]
    got = {(r.doc_id, r.n_bytes): tuple(r[1:5]) + (bytes(r[5]),) for r in suffix_dedup.remove_repeats(docs).collect()}
    assert sorted(got.values()) == sorted(brute(texts, 200))
    assert {(r.doc_id, r.text) for r in suffix_dedup.cut_repeats(docs).collect()} == {
        (None, " 745"), (None, texts[1]), (1, "other start "), (None, "short")}
