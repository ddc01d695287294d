"""Corpus pipeline over ``documents``: quality classifier, quality rules, near duplicates,
shared passages, packing.  Each stage works on all rows that the stage before kept and is
written as Parquet in the shared folder before the next one reads it.

``ORACLE_SQL`` is None: SQL can't express the classifier, the signature-tree join's
components or the tokenizer; ``tests/llm/test_llm_pipeline.py`` holds each stage against a
brute-force version.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reglink.llm import jaccard, packing, quality, resampling, substrings
from reglink.llm.stage import stage

TOKENIZER = "byte_bpe_50k.json"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]

ORACLE_SQL = None


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that importance resampling towards labelled good text selects."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return resampling.keep_selected(docs, resampling.resample(docs, labels))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the repetition rules."""
    return quality.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near duplicates: the one of the smallest id."""
    return jaccard.keep_first(docs, jaccard.near_duplicates(docs))


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that a document of a smaller id holds too; a document
    of which no word stays goes."""
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    held = {c: f"carried_{i}" for i, c in enumerate(others)}        # a column may be named like one of the result's
    named = docs.select("doc_id", "text", *(F.col(f"`{c}`").alias(n) for c, n in held.items()))
    out = substrings.dedup_substrings(named, carry=list(held.values())).where(F.col("n_removed") < F.col("n_words"))
    own = {c: F.col(n) for c, n in held.items()} | {"doc_id": F.col("doc_id"), "text": F.col("kept_text")}
    if "n_chars" in others:
        kind = docs.schema["n_chars"].dataType
        own["n_chars"] = F.when(F.col("n_removed") > 0, F.length("kept_text")).otherwise(own["n_chars"]).cast(kind)
    return out.select(*(own[c].alias(c) for c in docs.columns))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of the remaining documents, packed into sequences of 1,024 ids."""
    return packing.pack_documents(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("quality_classifier", quality_classifier),
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("substring_dedup", substring_dedup),
    ("best_fit_packing", best_fit_packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the rows of the last one."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(COLUMNS)
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name)
    return docs
