"""The operators as named queries over the given tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    byte_bpe, fill_in_middle, ftrl_quality, line_dedup, merkle_manifest, minimax_shards, pii_spans, preference_format, segment_topk, simhash_dedup, sketch_fingerprints,
    source_mixing, subword_toxicity,
)

VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.dedup_lines(_table(spark, sf_dir, "documents"))
    return found.select(F.col("row.doc_id").alias("doc_id"), F.col("clean").alias("text"), "removed_chunks", "removed_lines")


def op2_segment_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segment_topk.top_k(segment_topk.vectors(_table(spark, sf_dir, "embeddings")))


def op3_preference_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preference_format.echo_preferences(_table(spark, sf_dir, "conversations"))


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = byte_bpe.read_ranks(public_tokenizers.path(VOCABULARY))
    return byte_bpe.encode_decode(_table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)


def op5_ftrl_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ftrl_quality.quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op6_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_mixing.taken_words(source_mixing.mix(_table(spark, sf_dir, "documents")))


def op7_subword_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return subword_toxicity.toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op8_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_dedup.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op9_minimax_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minimax_shards.shard(_table(spark, sf_dir, "documents"))


def op10_sketch_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sketch_fingerprints.edited_fingerprints(_table(spark, sf_dir, "documents"))


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fill_in_middle.restore(fill_in_middle.fill_in_middle(_table(spark, sf_dir, "documents")))
    return found.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = merkle_manifest.manifest(_table(spark, sf_dir, "documents"))
    proof = merkle_manifest.proof_digest(F.col("proof")).alias("proof_sha256")
    return found.select("doc_id", "leaf", "subroot", "root", proof, "folded_root", "verified")


def op13_pii_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii_spans.personal_data(_table(spark, sf_dir, "documents"))
    of_kind = F.transform("base", lambda s: s["kind"])
    counts = [(F.size("base") - F.size(F.array_remove(of_kind, k))).cast("long").alias(f"n_{kind.name}") for k, kind in enumerate(pii_spans.KINDS)]
    return found.select("doc_id", *counts, F.sha2(pii_spans.as_text(F.col("base")), 256).alias("base_sha256"), pii_spans.as_text(F.col("spans")).alias("spans"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    named = (op1_line_dedup, op2_segment_topk, op3_preference_format, op4_byte_bpe, op5_ftrl_quality, op6_source_mixing,
             op7_subword_toxicity, op8_simhash_dedup, op9_minimax_shards, op10_sketch_fingerprints, op11_fill_in_middle,
             op12_merkle_manifest, op13_pii_spans, pipeline)
    return {f.__name__: f for f in named}


def oracle_sql() -> dict[str, str]:
    return {"op1_line_dedup": line_dedup.ORACLE_SQL, "op2_segment_topk": segment_topk.ORACLE_SQL,
            "op3_preference_format": preference_format.ORACLE_SQL, "op6_source_mixing": source_mixing.ORACLE_SQL,
            "op11_fill_in_middle": fill_in_middle.ORACLE_SQL, "op12_merkle_manifest": merkle_manifest.ORACLE_SQL}
