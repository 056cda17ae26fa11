"""From documents to token ids: quality, shared lines, near copies, benchmark passages, encoding.

Each stage takes (spark, docs, sf_dir) and gives a DataFrame, which is written as Parquet and read
again as the next stage's documents. All but the last give the columns of documents.
"""
from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fraudloom.llm import bpe, decontam, lines, neardup, quality
from fraudloom.llm.text import in_batches, read, staged


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ranking, learned from all labels, scores below the cut go."""
    model = quality.learn(docs, read(spark, sf_dir, "labels"))
    return quality.score(docs, model).where(F.col("__score") >= quality.CUT).drop("__score")


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that ten or more documents share go from every document."""
    found = lines.dedup_lines(docs, min_docs=10, out="__lines")
    return _with_text(found, F.col("__lines.kept")).drop("__lines")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document stays of each group linked by five-word shingles at a similarity of 0.8 or more."""
    return neardup.drop_near_duplicates(docs, neardup.FIVE_AT_80)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, re-parameterised or not, go."""
    return decontam.drop_contaminated(docs, read(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and the hash of the bytes they decode to."""
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    made = in_batches(docs).select("doc_id", bpe.encode_ids(path)("text").alias("e"))
    return made.select("doc_id", F.size("e.ids").cast("long").alias("n_tokens"), "e.ids", "e.decoded_sha256")


def _with_text(docs: DataFrame, text: Column) -> DataFrame:
    """Another text, and its length where the table keeps one."""
    changed = {"text": text}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.length(text).cast(docs.schema["n_chars"].dataType)
    return docs.withColumns(changed)


STAGES = [
    ("quality ranking", keep_quality),
    ("line dedup", drop_lines),
    ("near copies", drop_near_copies),
    ("benchmark decontamination", drop_benchmark),
    ("byte-level BPE", encode),
]
#: The ranking, the estimate and the merges have no SQL form; the stages are tested against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
