"""The pipeline's stages against brute force, each on what the stage before kept."""

import random
from collections import Counter

import corpus_pipeline
import pytest
from pyspark.sql import functions as F
from test_simhash import brute_components, brute_fp
from test_suffix_dedup import brute

from tidecast.llm import language
from tidecast.llm.common import staged

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def made(rng):
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8)))
    prose = lambda n: " ".join(word() for _ in range(n))
    passage = prose(60) + " é"
    texts = [prose(rng.randint(5, 120)) for _ in range(30)]
    texts += [texts[3], texts[3], texts[7] + "!", prose(20) + " " + passage + " " + prose(20), passage + prose(30), passage,
              "12 34 !?", "", None, "x " * 6_000]
    return texts


@pytest.fixture(scope="module")
def stages(spark, docs_of):
    docs = docs_of(made(random.Random(11)))
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(staged(stage(spark, out[-1], "unused"), name))
    return [sorted(d.collect(), key=str) for d in out], [d.columns for d in out]


def test_order_and_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "simhash_near_dedup", "suffix_array_dedup", "best_fit_packing"]
    assert all(c == COLUMNS for c in stages[1][1:4])


def test_language_rejects_only_texts_without_a_letter(spark, stages):
    before, after = stages[0][0], stages[0][1]
    assert {r.doc_id for r in after} == {r.doc_id for r in before if any(c.isalpha() for c in r.text or "")}
    assert {r.lang for r in after} == {"en"}
    text = {r.doc_id: r.text for r in before}
    assert all(r.text == text[r.doc_id] for r in after)


def test_one_document_of_each_simhash_group_stays(stages):
    before, after = stages[0][1], stages[0][2]
    found = brute_components([(r.doc_id, brute_fp(r.text)) for r in before], 2)
    assert {r.doc_id for r in after} == {c for _, _, c in found}
    assert len(after) < len(before)


def test_repeats_are_cut(stages):
    before, after = stages[0][2], stages[0][3]
    kept = {r.doc_id: b[4].decode("utf-8", "ignore") for r, b in zip(before, brute([r.text for r in before], 200))}
    assert {r.doc_id: r.text for r in after} == {i: t for i, t in kept.items() if t}
    assert all(r.n_chars == len(r.text) for r in after)
    assert sum(len(t) for t in kept.values()) < sum(len(r.text) for r in before)


def test_bins_hold_all_and_no_conflict(stages):
    before, bins = stages[0][3], stages[0][4]
    placed = Counter()
    for r in bins:
        placed[r.doc_id] += r.length
    assert placed == {r.doc_id: len(r.text.encode()) + 1 for r in before}
    source, held = {r.doc_id: r.source for r in before}, {}
    for r in bins:
        held.setdefault(r.bin, []).append(r)
    for rows in held.values():
        rows.sort(key=lambda r: r.offset)
        assert all(a.offset + a.length == b.offset for a, b in zip(rows, rows[1:])) and rows[0].offset == 0
        assert rows[-1].offset + rows[-1].length <= 8192
        assert len({source[r.doc_id] for r in rows}) == len(rows)


def test_odd_and_empty_documents(spark, odd, empty):
    for docs in (odd, empty):
        for name, stage in corpus_pipeline.STAGES:
            docs = staged(stage(spark, docs, "unused"), name)
        docs.count()
    assert docs.count() == 0


def test_run_reads_the_whole_table(spark, docs_of, tmp_path):
    docs_of([f"some words of text number {i}" for i in range(20)]).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).select("doc_id").distinct().count() > 0
    assert language.identify(spark.read.parquet(str(tmp_path / "documents.parquet"))).count() == 20


def test_a_table_without_labels_keeps_its_texts(spark, docs_of):
    docs = docs_of(["some words", "12 34", None, "é", "other words here", ""]).withColumn("lang", F.lit(None).cast("string"))
    got = corpus_pipeline.identify_language(spark, docs, "unused").collect()
    assert {(r.doc_id, r.lang) for r in got} == {(0, None), (3, None), (4, None)}


def test_a_label_that_is_und_is_a_label(spark, docs_of):
    docs = docs_of(["some words"] * 9).withColumn("lang", F.lit("und"))
    assert corpus_pipeline.identify_language(spark, docs, "unused").count() == 9


def test_identify_keeps_columns_of_its_own_names_apart(docs_of):
    docs = docs_of(["some words", "", "more words"]).withColumn("_p", F.lit("mine")).withColumn("_score", F.lit("old")).withColumn("found", F.lit(1))
    got = language.identify(docs)
    assert got.columns == [*docs.columns[:5], "_p", "found", "_held_out", "_lang_pred", "_score", "_letter"]
    assert {(r.doc_id, r._p, r.found, r._letter) for r in got.collect()} == {(0, "mine", 1, True), (1, "mine", 1, False), (2, "mine", 1, True)}
