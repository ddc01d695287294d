"""Registered queries of this subpackage: ``opN_<name>`` applies operator N, with its
production parameters, to its whole table; ``ORACLE`` has DuckDB SQL where SQL can
express the result."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reglink.llm import jaccard, katz, langid, licenses, packing, quality, ranked, resampling, sentencepiece_lattice, sharding, substrings, topk, variants

SHARDS = 24
BYTE_BPE = "byte_bpe_50k.json"
PIECE_BPE = "piece_bpe_32k.model"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_sentencepiece_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = sentencepiece_lattice.load_model(public_tokenizers.path(PIECE_BPE))
    pieces = sentencepiece_lattice.piece_table(spark, model)
    return sentencepiece_lattice.encode_documents(_table(spark, sf_dir, "documents"), model, pieces)


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE))


def op3_repetition_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(_table(spark, sf_dir, "documents"))


def op4_license_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = licenses.known_digests(spark, licenses.KNOWN_LICENSES)
    return licenses.license_scan(_table(spark, sf_dir, "documents"), known)


def op5_signature_tree_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = jaccard.near_duplicates(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_shingles", "component_id")


def op6_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op7_suffix_tree_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.dedup_substrings(_table(spark, sf_dir, "documents"))


def op8_uniform_threshold_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op9_rendezvous_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(_table(spark, sf_dir, "documents"), [1.0] * SHARDS, grown=[1.0] * (SHARDS + 1))


def op10_katz_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz.score(_table(spark, sf_dir, "documents"), katz.crc_held_out())


def op11_language_bitmask_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(_table(spark, sf_dir, "documents"), langid.held_out()).select("doc_id", "held_out", "lang_pred", "score")


def op12_accumulator_limited_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked.rank_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op13_permuterm_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.spelling_variants(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sentencepiece_lattice": op1_sentencepiece_lattice,
    "op2_best_fit_packing": op2_best_fit_packing,
    "op3_repetition_rules": op3_repetition_rules,
    "op4_license_digests": op4_license_digests,
    "op5_signature_tree_join": op5_signature_tree_join,
    "op6_importance_resampling": op6_importance_resampling,
    "op7_suffix_tree_dedup": op7_suffix_tree_dedup,
    "op8_uniform_threshold_topk": op8_uniform_threshold_topk,
    "op9_rendezvous_shards": op9_rendezvous_shards,
    "op10_katz_backoff": op10_katz_backoff,
    "op11_language_bitmask_filters": op11_language_bitmask_filters,
    "op12_accumulator_limited_search": op12_accumulator_limited_search,
    "op13_permuterm_variants": op13_permuterm_variants,
}

ORACLE: dict[str, str] = {
    "op4_license_digests": licenses.license_sql(),
    "op12_accumulator_limited_search": ranked.ranked_sql(),
}
