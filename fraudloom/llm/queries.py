"""The operators as queries over a data folder."""
from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fraudloom.llm import (
    bpe, decontam, divergence, language, licenses, lines, mixing, neardup, quality, rules, secret_scan, tokens, trie,
)
from fraudloom.llm.oracles import ORACLES
from fraudloom.llm.text import read

__all__ = ["ORACLES", "registered"]


def _remainder(by: int) -> Column:
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(by))


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = language.learn(docs.where(_remainder(4) != 2))
    found = language.predict_language(docs, model)
    return found.select("doc_id", F.coalesce(_remainder(4) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")


def op2_quality_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = quality.learn(docs, read(spark, sf_dir, "labels").where(_remainder(5) != 0))
    found = quality.score(docs.select("doc_id", "text"), model).select("doc_id", F.col("__score").alias("score"))
    return found.select(
        "doc_id", F.coalesce(_remainder(5) == 0, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= quality.CUT).cast("int").alias("predicted"),
    )


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.count_tokens(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(read(spark, sf_dir, "documents"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = lines.dedup_lines(docs, min_docs=10, min_chars=1)
    return found.select("doc_id", "lines.n_lines", "lines.n_dropped", "lines.kept_sha256")


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = rules.ledger(read(spark, sf_dir, "documents"))
    base, current = rules.POLICIES["base"], rules.POLICIES["v2"]
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (~rules.verdict(base)).alias("base_failed"),
        (rules.verdict(base) & rules.verdict(current)).alias("kept"),
        F.col("failed").alias("failed_rules"),
    )


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.judge(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.select(F.col("id").alias("doc_id"), "contaminated", "n_items", "first_item", "best_share")


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = neardup.near_duplicates(read(spark, sf_dir, "documents"), neardup.EXACT_85)
    return found.select(F.col("id").alias("doc_id"), "n_shingles", "component_id", "kept")


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


def _plus_if(kind: str) -> Callable[[Column, Column], Column]:
    return lambda n, span: n + (span["kind"] == kind).cast("long")


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.find_secrets(read(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["base"])
    counts = [
        F.aggregate("spans", F.lit(0).cast("long"), _plus_if(kind)).alias(f"n_{kind}") for kind in ("assign", "access", "hex")
    ]
    return found.select(
        F.col("id").alias("doc_id"), *counts, F.sha2(secret_scan.listed(base), 256).alias("base_sha256"),
        secret_scan.listed(F.col("spans")).alias("spans"),
    )


def op11_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken(read(spark, sf_dir, "documents"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = trie.build_trie(read(spark, sf_dir, "conversations")).nodes
    return found.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(read(spark, sf_dir, "documents"))


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (
        op1_language_id, op2_quality_ranking, op3_token_counts, op4_license_scan, op5_line_dedup, op6_quality_rules,
        op7_decontamination, op8_near_duplicates, op9_byte_bpe, op10_secret_scan,
        op11_source_mixing, op12_prefix_trie, op13_source_divergence,
    )
    return {f.__name__: f for f in found}
