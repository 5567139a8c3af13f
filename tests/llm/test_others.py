import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidecast.llm import fingerprints, language, packing, pieces, queries, records, sharding, topk

SMALL = "/root/testdata/sf0.001"


def test_top_k_matches_brute_force(spark, monkeypatch):
    monkeypatch.setattr(topk, "SHARD_ROWS", 60)
    monkeypatch.setattr(topk, "BLOCK_QUERIES", 10)
    rng = random.Random(3)
    rows = [(i, [rng.choice([-0.5, 0.25, 0.5, rng.random()]) for _ in range(4)]) for i in range(300)] + [
        (900, None), (901, []), (902, [1.0, None, 1.0, 1.0]), (903, [1.0, float("nan"), 1.0, 1.0]), (None, [1.0] * 4)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {(r.query_id, r.rank): (r.vec_id, r.score) for r in topk.top_k(df, F.col("vec_id") % 20 == 0, k=5).collect()}
    v = {i: np.floor(64 * np.array(x)) for i, x in rows[:300]}
    for q in range(0, 300, 20):
        want = sorted((-int(v[q] @ v[c]), c) for c in v if c != q)[:5]
        assert [got[q, r + 1] for r in range(5)] == [(c, -s) for s, c in want]
    assert topk.top_k(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_top_k_of_repeated_ids_lengths_and_clashing_columns(spark, tmp_path):
    """Operator and SQL agree where rows repeat ids or differ in length; own rows alone are left out."""
    import duckdb

    rng = random.Random(4)
    rows = [(rng.randrange(0, 60), [rng.choice([-0.5, 0.25, 1.0]) for _ in range(rng.choice([3, 3, 3, 5]))]) for _ in range(200)]
    rows += [(0, [1.0, 1.0]), (7, [0.5, 0.5]), (7, [3.0, 3.0]), (8, [2.0, 2.0]), (20, [1e6] * 3), (21, [1e6] * 3), (None, [1.0, 1.0]), (40, None), (40, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    path = str(tmp_path / "embeddings.parquet")
    df.toPandas().to_parquet(path)
    con = duckdb.connect()
    con.execute(f"create view embeddings as select cast(vec_id as bigint) as vec_id, embedding from read_parquet('{path}')")
    want = con.execute(queries.SQL["op1_exact_top_k"].replace("vec_id % 20", "vec_id % 20")).fetchall()
    for name in ("id", "rid", "v", "shard", "data", "kth", "part", "dim"):
        df = df.withColumn(name, F.lit("clash"))
    got = [tuple(r) for r in topk.top_k(df, F.col("vec_id") % 20 == 0, k=20).collect()]
    assert sorted(got) == sorted(want)
    assert (0, 1, 7, 24576) in got


def test_shards(spark, odd, empty, monkeypatch):
    monkeypatch.setattr(sharding, "BLOCK_GROUPS", 20)
    monkeypatch.setattr(sharding, "BLOCK_PARTS", 3)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = sharding.shard_by_bytes(docs, shards=4).collect()
    assert sorted(r.doc_id for r in rows) == list(range(200))
    sizes = [sum(r.size for r in rows if r.shard == s) for s in range(4)]
    assert max(sizes) - min(sizes) < 0.02 * sum(sizes)
    for s in range(4):
        own = sorted(r.slot for r in rows if r.shard == s)
        assert own == list(range(len(own)))
    shard = {r.doc_id: r.shard for r in rows}
    for texts in docs.groupBy("text").agg(F.collect_list("doc_id").alias("ids")).collect():
        assert len({shard[i] for i in texts.ids}) == 1
    assert sharding.shard_by_bytes(odd).count() == odd.count()
    assert sharding.shard_by_bytes(empty).count() == 0


def test_records_round_trip(spark, odd, empty):
    from tokenizers import Tokenizer

    path = queries.vocabulary("byte_bpe_50k.json")
    tok = Tokenizer.from_file(path)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").union(
        spark.createDataFrame([(900, None), (901, "a  b\t\n x   y "), (902, "")], "doc_id long, text string"))
    data = records.write_records(docs, path, file_bytes=20_000)
    got = {r.id: r for r in records.read_records(spark, data).collect()}
    start = 0
    for r in docs.orderBy("doc_id").collect():
        ids = np.array(tok.encode(r.text or "", add_special_tokens=False).ids + [2], dtype="<u4")
        assert tuple(got[r.doc_id]) == (r.doc_id, start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert records.read_shuffled(spark, data, 1).count() == 203
    assert records.read_records(spark, records.write_records(odd, path)).count() == odd.count()
    assert records.read_records(spark, records.write_records(empty, path)).count() == 0


def test_records_of_texts_with_added_tokens(spark):
    from tokenizers import Tokenizer

    path = queries.vocabulary("byte_bpe_50k.json")
    tok, end = Tokenizer.from_file(path), "<|endoftext|>"
    texts = [f"a {end} b", f"two spaces  {end}  and after", end, f"{end}{end} x", f"in{end}side a word", f"ends with {end}", f"<|endoftext {end[:-1]} |>"]
    want = [np.array(tok.encode(t, add_special_tokens=False).ids, dtype="<u2").tobytes() for t in texts]
    assert records.WordEncoder(path, 2).encode(texts) == want
    data = records.write_records(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), path)
    got, start = {r.id: r for r in records.read_records(spark, data).collect()}, 0
    for i, t in enumerate(texts):
        ids = np.array(tok.encode(t, add_special_tokens=False).ids + [2], dtype="<u4")
        assert (50256 in ids) == (end in t)
        assert tuple(got[i]) == (i, start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_damage_is_found():
    import io

    data = bytearray(records.frame(b"payload"))
    assert records.read_frame(io.BytesIO(bytes(data))) == b"payload"
    data[14] ^= 1
    with pytest.raises(ValueError):
        records.read_frame(io.BytesIO(bytes(data)))


def test_best_fit_matches_a_plain_scan():
    rng = random.Random(4)
    for _ in range(20):
        bins, room, held = packing.Bins(), [], []
        for _ in range(400):
            size, s, c = rng.randint(1, 60), 1 << rng.randrange(6), rng.choice([0, 1 << rng.randrange(9)])
            fit = sorted((r, b) for b, r in enumerate(room) if r >= size and not (held[b][0] & s or held[b][1] & c))
            want = fit[0][1] if fit else len(room)
            if not fit:
                room.append(100)
                held.append((0, 0))
            assert bins.place(size, s, c, 100) == (want, 100 - room[want])
            room[want] -= size
            held[want] = (held[want][0] | s, held[want][1] | c)


def test_packing_of_odd_rows(odd, empty):
    rows = packing.pack(odd, "octet_length(coalesce(text, '')) + 1", 8192, cluster=packing.text_cluster()).collect()
    assert sum(r.length for r in rows) == sum(len((r.text or "").encode()) + 1 for r in odd.select("text").collect())
    assert packing.pack(empty, "1", 8192).count() == 0


def test_language_held_out_and_odd(spark, odd, empty):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = language.identify(docs).where("_held_out").select("lang", "_lang_pred").collect()
    assert sum(a == b for a, b in rows) >= 0.95 * len(rows)
    found = {r.doc_id: r for r in language.identify(odd).collect()}
    assert all((found[i]._lang_pred, found[i]._score) == ("und", 0.0) for i in (0, 1, 2, 7))
    assert language.identify(empty).count() == 0


def test_fingerprints(spark, odd, empty):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = fingerprints.edited_fingerprints(docs).collect()
    grams = lambda t: {tuple(w[i:i + 5]) for w in [t.lower().split()] for i in range(len(w) - 4)} or {tuple(t.lower().split())}
    error = []
    for r in rows:
        t, nxt = texts[r.doc_id], texts[(r.doc_id - 1) % 200]
        half = len(t) // 2
        edited = t[:len(t) - half] + nxt[:half]
        import hashlib

        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest() and r.n_chars == len(t)
        a, b = grams(t), grams(edited)
        error.append(abs(r.near_edited - len(a & b) / len(a | b)))
    assert np.mean(error) < 0.05 and max(error) < 0.25
    assert fingerprints.edited_fingerprints(odd).count() == odd.count()
    assert fingerprints.edited_fingerprints(empty).count() == 0


def test_pieces():
    import sentencepiece

    path = queries.vocabulary("piece_bpe_32k.model")
    model = pieces.load(path)
    codec, lib = pieces.Codec(model), sentencepiece.SentencePieceProcessor(model_file=path)
    texts = ["", "plain words", "  two  spaces ", "ñandú 漢字 \U0001f600 \x07", "the " * 50]
    by_text = {p: i for i, p in enumerate(model.pieces) if model.kinds[i] == 1}
    for t, ids in zip(texts, codec.encode(texts)):
        assert codec.decode(ids.tolist()) == t == lib.decode(ids.tolist())
    for word in ("▁plain", "▁words", "▁ñandú", "▁the"):
        best = [0.0] + [-np.inf] * len(word)
        for j in range(1, len(word) + 1):
            best[j] = max([best[i] + model.scores[by_text[word[i:j]]] for i in range(j) if word[i:j] in by_text], default=-np.inf)
        ids = pieces.viterbi(model, [word.encode()])[0]
        assert sum(model.scores[ids]) == pytest.approx(best[-1])


def test_language_equals_plain_binding_and_bundling(docs_of):
    """op7: letters bound by place, trigrams added, prototypes without their mean, largest cosine."""
    rng = random.Random(5)
    texts = ["".join(rng.choice("abcéñ xyz,1" if i % 3 else "defüß ghi.2") for _ in range(rng.randint(0, 60))) for i in range(90)]
    docs = docs_of([(i, t) for i, t in enumerate(texts)]).withColumn("lang", F.when(F.col("doc_id") % 3 == 0, "b").otherwise("a"))
    dim, symbol = 256, language._tables(256)[0]
    letters = [np.asarray(x, dtype=np.float64) for x in language._tables(256)[1]]

    def vector(text):
        s, out = [0], np.zeros(dim)
        for c in text.lower():
            k = int(symbol[ord(c)])
            if k or s[-1]:
                s.append(k)
        if s[-1]:
            s.append(0)
        for a, b, c in zip(s, s[1:], s[2:]):
            out += letters[0][a] * letters[1][b] * letters[2][c]
        n = np.linalg.norm(out)
        return out / n if n else out

    teach = [i for i in range(90) if zlib.crc32(str(i).encode()) % 4 != 2]
    protos = {}
    for lang in "ab":
        own = sum(vector(texts[i]) for i in teach if (i % 3 == 0) == (lang == "b"))
        protos[lang] = own / np.linalg.norm(own)
    mean = (protos["a"] + protos["b"]) / 2
    got = {r.doc_id: r for r in language.identify(docs, dimensions=dim).collect()}
    sure = 0
    for i, t in enumerate(texts):
        v = vector(t) - mean
        cos = {k: v @ (p - mean) / np.linalg.norm(v) / np.linalg.norm(p - mean) for k, p in protos.items()}
        if any(c.isalpha() for c in t):
            if abs(cos["a"] - cos["b"]) > 1e-5:
                assert got[i]._lang_pred == max(cos, key=cos.get)
                sure += 1
            assert got[i]._score == pytest.approx((1 + max(cos.values())) / 2, abs=1e-5)
        else:
            assert (got[i]._lang_pred, got[i]._score) == ("und", 0.0)
        assert got[i]._held_out == (i not in teach)
    assert sure > 70


def test_shards_digest_and_groups(spark, docs_of):
    """op2: size and CRC of every row, equal texts in one shard, loads as even as differencing makes them."""
    texts = ["é" * i for i in range(40)] + [None, "", "é" * 7, "é" * 7]
    rows = sharding.shard_by_bytes(docs_of(texts), shards=4).collect()
    want = {i: (len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in enumerate(texts)}
    assert {r.doc_id: (r.size, r.text_crc32) for r in rows} == want
    shard = {r.doc_id: r.shard for r in rows}
    assert shard[7] == shard[42] == shard[43] and shard[0] == shard[40] == shard[41]
    # plain Karmarkar-Karp: the two partial partitions of largest spread are joined, oppositely ordered
    groups = {}
    for i, t in enumerate(texts):
        groups[t or ""] = groups.get(t or "", 0) + want[i][0]
    parts = [sorted([size, 0, 0, 0], reverse=True) for size in groups.values()]
    while len(parts) > 1:
        parts.sort(key=lambda p: p[-1] - p[0])
        a, b = parts[0], parts[1]
        parts = parts[2:] + [sorted((x + y for x, y in zip(a, reversed(b))), reverse=True)]
    loads = sorted((sum(r.size for r in rows if r.shard == k) for k in range(4)), reverse=True)
    assert loads[0] - loads[-1] <= max(parts[0][0] - parts[0][-1], 2)


def test_piece_roundtrip_of_odd_rows(spark, odd, empty):
    """op10: null, empty and repeated rows, and a text without spaces."""
    path = queries.vocabulary("piece_bpe_32k.model")
    got = odd.select("doc_id", "text", pieces.digest(F.col("text"), path).alias("p")).collect()
    assert len(got) == odd.count()
    by = {}
    for r in got:
        by.setdefault(r.text, set()).add(tuple(r.p))
    assert all(len(v) == 1 for v in by.values())  # a text has one result, in whatever row
    assert empty.select(pieces.digest(F.col("text"), path)).count() == 0
