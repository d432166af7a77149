"""Corpus pipeline: raw documents to packed training sequences.

``STAGES`` lists (name, function).  A function takes ``(spark, docs, sf_dir)`` and returns
a DataFrame, which is written as Parquet and reread as the next stage's ``docs``.  Every
stage but the last returns the columns of ``docs``.  Documents are named by ``doc_id``:
rows that repeat an id stay or go together, and rows without an id always stay.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvid.llm.common import release, stored, table
from corvid.llm.decontaminate import contamination
from corvid.llm.line_dedup import removed_lines, without_lines
from corvid.llm.minhash_dedup import near_duplicates
from corvid.llm.packing import pack_documents
from corvid.llm.quality_knn import quality_scores
from corvid.llm.queries import tokenizer_path
from corvid.plans.joins import broadcast_if_small


def _without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """``docs`` without the documents whose ``doc_id`` is in ``gone`` (broadcast only if its size allows)."""
    ids = stored(gone.select(F.col("doc_id").alias("_gone")).distinct(), "gone")
    small = broadcast_if_small(ids)
    return docs.join(small if small is not None else ids, F.col("doc_id") == F.col("_gone"), "left_anti")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    scores = quality_scores(docs, table(spark, sf_dir, "labels"))
    kept = _without(docs, scores.filter("predicted = 0"))  # the rejected ids are stored there
    scores.shared.destroy()
    return kept


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that repeat an earlier line; ``n_chars`` follows the text."""
    out = without_lines(docs, removed_lines(docs))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest id."""
    return _without(docs, near_duplicates(docs).filter(~F.col("kept")))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated with benchmark text."""
    return _without(docs, contamination(docs, table(spark, sf_dir, "benchmark")).filter("contaminated"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 2048 tokens."""
    return pack_documents(docs, tokenizer_path("word_bpe_49k.json"))


STAGES = [("quality_classifier", quality), ("line_dedup", line_dedup), ("minhash_near_dedup", near_dedup),
          ("benchmark_decontamination", decontaminate), ("best_fit_packing", pack)]

# No stage but line dedup can be said in SQL (a learnt score, signatures, a tokenizer); the stages are tested
# against brute-force versions instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = table(spark, sf_dir, "documents")
    before = None
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
        if before is not None:
            release(before)
        before = docs
    return docs
