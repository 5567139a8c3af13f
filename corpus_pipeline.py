"""Corpus pipeline: language ID, SimHash near-dedup, suffix-array dedup, best-fit packing.

Each stage takes ``(spark, docs, sf_dir)``; its result is written as Parquet and read again as
the next stage's ``docs``.  All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidecast.llm import language, packing, simhash, suffix_dedup
from tidecast.llm.common import staged, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _shaped(docs: DataFrame) -> DataFrame:
    return docs.select(*COLUMNS)


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that have a language go on, with the predicted one as ``lang``; texts without a letter go.

    Where the table has no label to learn from, all texts with a letter go on as they are.
    """
    found = language.identify(_shaped(docs)).where("_letter")
    known = F.when((F.col("_lang_pred") == "und") & (F.col("_score") == 0), F.col("lang")).otherwise(F.col("_lang_pred"))
    return found.withColumn("lang", known).select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each SimHash group stays."""
    return simhash.drop_near_duplicates(_shaped(docs), shingle=3, max_distance=2).select(*COLUMNS)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes of repeated 200-byte strings go; so do documents of which nothing is left.

    Where a cut parts a character, its left-over bytes go as well.  ``n_chars`` is counted again; texts without
    a repeat stay as they are.
    """
    return suffix_dedup.cut_repeats(_shaped(docs), min_len=200).withColumn("n_chars", F.char_length("text").cast("long")).select(*COLUMNS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each document lies in bins of 8,192 bytes (every document ends with one mark)."""
    return packing.pack(_shaped(docs), "octet_length(coalesce(text, '')) + 1", 8192, cluster=packing.text_cluster())


STAGES = [
    ("language_id", identify_language),
    ("simhash_near_dedup", drop_near_copies),
    ("suffix_array_dedup", cut_repeats),
    ("best_fit_packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written below the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs


#: SQL can express neither the trained language profiles nor the fixed points of the other stages.
ORACLE_SQL = None
