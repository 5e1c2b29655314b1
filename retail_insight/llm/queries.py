"""Registered queries of the subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import (
    conversation_repair,
    decontaminate,
    merkle,
    ngram_join,
    packing,
    paragraph_dedup,
    pii,
    quality,
    quality_mil,
    secrets,
    sharding,
    simhash_vptree,
    substring_dedup,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_repetition_coverage(spark, sf_dir):
    return quality.repetition_coverage(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept")


def op2_secret_scan(spark, sf_dir):
    return secrets.scan_secrets(_table(spark, sf_dir, "documents"))


def op3_paragraph_dedup(spark, sf_dir):
    return paragraph_dedup.remove_paragraphs(
        _table(spark, sf_dir, "documents"), run_words=paragraph_dedup.RUN_WORDS,
        piece_words=paragraph_dedup.PIECE_WORDS).drop("kept_text")


def op4_minimax_shards(spark, sf_dir):
    return sharding.shard(_table(spark, sf_dir, "documents"))


def op5_benchmark_hits(spark, sf_dir):
    return decontaminate.scan_benchmark(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op6_attention_quality(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    return quality_mil.score(docs, quality_mil.train(docs, _table(spark, sf_dir, "labels")))


def op7_substring_dedup(spark, sf_dir):
    return substring_dedup.remove_repeats(_table(spark, sf_dir, "documents")).drop("kept")


def op8_best_fit_packing(spark, sf_dir):
    return packing.pack(_table(spark, sf_dir, "documents"))


def op9_surrogates(spark, sf_dir):
    return pii.find_and_replace(_table(spark, sf_dir, "documents"))


def op10_ngram_components(spark, sf_dir):
    return ngram_join.jaccard_components(_table(spark, sf_dir, "documents"))


def op11_conversation_repair(spark, sf_dir):
    return conversation_repair.damaged_and_repaired(_table(spark, sf_dir, "conversations"))


def op12_simhash_vptree(spark, sf_dir):
    return simhash_vptree.near_duplicates(_table(spark, sf_dir, "documents"))


def op13_merkle_manifest(spark, sf_dir):
    return merkle.manifest(_table(spark, sf_dir, "documents"), changed=merkle.lower_case_some())


QUERIES = {f.__name__: f for f in (
    op1_repetition_coverage, op2_secret_scan, op3_paragraph_dedup, op4_minimax_shards, op5_benchmark_hits,
    op6_attention_quality, op7_substring_dedup, op8_best_fit_packing,
    op9_surrogates, op10_ngram_components, op11_conversation_repair, op12_simhash_vptree, op13_merkle_manifest)}
