"""The registered queries of the corpus operators.  ``SQL`` has the oracle where SQL can express the result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import extract, fingerprints, graphann, importance, language, negatives, packing, pieces, records, sharding, simhash, suffix_dedup, topk
from .common import table

#: Place of the public vocabulary files; a parameter of the functions below.
def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


PACK_CAPACITY = 8192
SHARDS = 16


def op1_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each twentieth vector's 20 largest integer inner products with all others."""
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op2_shard_by_differencing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 16 shards of near equal bytes."""
    out = sharding.shard_by_bytes(table(spark, sf_dir, "documents"), shards=SHARDS)
    return out.withColumn("law", F.lit("bytes")).withColumn("grown_shard", F.lit(None).cast("int"))


def op3_token_records(spark: SparkSession, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    """Token ids of all documents, written as records and read back."""
    path = records.write_records(table(spark, sf_dir, "documents"), tokenizer or vocabulary("byte_bpe_50k.json"), end_id=2)
    return records.read_records(spark, path).withColumnRenamed("id", "doc_id")


def op4_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", extract.extract(F.col("html")).alias("text"))
    return pages.withColumn("n_chars", F.char_length("text").cast("long"))


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed by UTF-8 bytes and an end mark; one source and one text at most once a bin."""
    return packing.pack(table(spark, sf_dir, "documents"), "octet_length(coalesce(text, '')) + 1", PACK_CAPACITY,
                        cluster=packing.text_cluster())


def op6_simhash_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash fingerprints and components at two bits."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, max_distance=2)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), F.col("component").alias("component_id"))


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document."""
    return language.identify(table(spark, sf_dir, "documents")).select(
        "doc_id", F.col("_held_out").alias("held_out"), F.col("_lang_pred").alias("lang_pred"), F.col("_score").alias("score"))


def op8_repeated_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without repeated 200-byte strings."""
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"), min_len=200).drop("kept")


def op9_minhash_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text."""
    return fingerprints.edited_fingerprints(table(spark, sf_dir, "documents"))


def op10_piece_roundtrip(spark: SparkSession, sf_dir: str, model: str | None = None) -> DataFrame:
    """Digest of every document's pieces, and whether decoding gives the text back."""
    path = model or vocabulary("piece_bpe_32k.model")
    return table(spark, sf_dir, "documents").select("doc_id", pieces.digest(F.col("text"), path).alias("p")).select("doc_id", "p.*")


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents weighed against the benchmark texts; five in a hundred are drawn."""
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("n_words")


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of each fiftieth vector's five positives; each seventh row's label is moved on by one."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, label)


def op13_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each hundredth vector's ten nearest neighbours found by the graphs."""
    return graphann.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages of corpus_pipeline.py over documents."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (
    op1_exact_top_k, op2_shard_by_differencing, op3_token_records, op4_main_text, op5_best_fit_packing, op6_simhash_components,
    op7_language, op8_repeated_bytes, op9_minhash_fingerprints, op10_piece_roundtrip,
    op11_importance_resampling, op12_hard_negatives, op13_nearest_neighbours, pipeline)}

SQL = {
    "op1_exact_top_k": """
        with v as (
            select row_number() over () as rid, vec_id, [floor(64 * x::double) for x in embedding] as e from embeddings
            where vec_id is not null and embedding is not null and len(embedding) > 0
              and len([x for x in embedding if x is null or not isfinite(x)]) = 0),
        s as (
            select q.rid as q, q.vec_id as query_id, c.rid, c.vec_id, cast(list_inner_product(q.e, c.e) as bigint) as score
            from v q join v c on c.rid <> q.rid and len(c.e) = len(q.e) where q.vec_id % 20 = 0),
        r as (select *, row_number() over (partition by q order by score desc, vec_id, rid) as rank from s)
        select query_id, cast(rank as integer) as rank, vec_id, score from r where rank <= 20""",
    "op11_importance_resampling": r"""
        with crc as (
            select list(list_reduce([n] || range(8), lambda c, b: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) order by n) as t
            from (select unnest(range(256)) as n)),
        texts as (
            select 'd' as side, row_number() over () as row, doc_id, text from documents union all
            select 'b', row_number() over (), null, text from benchmark),
        words as (
            select side, row, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from texts),
        runs as (
            select side, row, w[i + 1] as a, w[i + 2] as b, w[i + 3] as c from (select side, row, w, unnest(range(len(w))) as i from words)),
        features as (
            select side, row, a as f from runs union all
            select side, row, a || ' ' || b from runs where b is not null union all
            select side, row, a || ' ' || b || ' ' || c from runs where c is not null),
        hashed as (
            select f, xor(list_reduce([4294967295] || [('0x' || substr(h, 2 * i + 1, 2))::bigint for i in range(len(h) // 2)],
                                      lambda s, b: xor(s >> 8, t[(xor(s, b) & 255) + 1])), 4294967295) % 10000 as bucket
            from (select f, hex(f) as h from (select distinct f from features)), crc),
        counted as (
            select side, row, bucket, count(*) as n from features join hashed using (f) group by all),
        totals as (
            select bucket, sum(case when side = 'd' then n else 0 end) as s, sum(case when side = 'b' then n else 0 end) as t from counted group by bucket),
        whole as (select sum(s)::double as s, sum(t)::double as t from totals),
        gain as (
            select bucket, floor(1000 * ln((totals.t + 1)::double * (whole.s + 10000) / ((totals.s + 1)::double * (whole.t + 10000)))) as g
            from totals, whole),
        weighed as (
            select row, sum(n) as n_features, sum(n * g) as weight from counted join gain using (bucket) where side = 'd' group by row),
        scored as (
            select w.row, w.doc_id, len(w.w) as n_words, coalesce(n_features, 0)::bigint as n_features, coalesce(weight, 0)::bigint as weight,
                   ('0x' || sha256('42:' || coalesce(doc_id::varchar, ''))[1:8])::bigint as h
            from words w left join weighed using (row) where w.side = 'd'),
        final as (
            select *, weight + floor(-1000 * ln(-ln((h + 0.5::double) / 4294967296)))::bigint as score from scored),
        drawn as (
            select row, row_number() over (order by score desc, doc_id nulls last, n_features, row) as rank from final where n_words >= 20)
        select doc_id, n_features, weight, score, case when rank <= (select 5 * count(*) // 100 from drawn) then rank end as rank
        from final left join drawn using (row)""",
    "op12_hard_negatives": """
        with v as (
            select row_number() over () as rid, vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
                   [floor(256 * x::double) for x in embedding] as e from embeddings
            where vec_id is not null and label is not null and embedding is not null and len(embedding) > 0
              and len([x for x in embedding if x is null or not isfinite(x)]) = 0),
        s as (
            select a.rid as a, a.vec_id as anchor_id, c.rid as c, c.vec_id, a.label = c.label as same,
                   cast(list_inner_product(a.e, c.e) as bigint) as score
            from v a join v c on a.rid <> c.rid and len(a.e) = len(c.e) where a.vec_id % 50 = 0),
        p as (
            select * from (select *, row_number() over (partition by a order by score desc, vec_id, c) as slot from s where same) where slot <= 5),
        n as (
            select p.a, p.slot, p.anchor_id, p.vec_id as positive_id, p.score as positive_score, s.vec_id as negative_id, s.score as negative_score,
                   row_number() over (partition by p.a, p.slot order by s.score desc, s.vec_id, s.c) as rank
            from p join s on p.a = s.a and not s.same and 50 * p.score <= 100 * s.score and 100 * s.score <= 95 * p.score)
        select anchor_id, positive_id, cast(rank as integer) as rank, negative_id, positive_score, negative_score from n where rank <= 3""",
}
