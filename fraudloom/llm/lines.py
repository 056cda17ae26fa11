"""Line dedup: lines found in many documents go.

Lines are normalised and hashed; documents per hash are counted apart from how often a line stands
in one of them; hashes at or over the threshold go back to the documents that hold them, where the
lines that stay are joined in their old order.

Defined cases: a null or empty text is one empty line and stays; a row without id counts as a
document of its own per distinct text; rows that repeat an id count as one document; lines whose
key is shorter than ``min_chars`` never go; an empty table gives an empty table. Other columns are
not read.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType

from fraudloom.llm.text import in_batches, row_key, struct_array, struct_type

#: Parts into which the rows of one line are dealt for the join, so that no line fills one task.
SALTS = 16
_STRIP = b" \t\n\x0b\x0c\r"
KEPT = struct_type(n_lines=LongType(), n_dropped=LongType(), kept=StringType(), kept_sha256=StringType())


def line_key(line: bytes) -> bytes:
    """Stripped of ASCII white space, A-Z lower-cased (both work on ASCII only for bytes)."""
    return line.strip(_STRIP).lower()


def _hash(key: bytes) -> bytes:
    return xxhash.xxh3_128_digest(key)


def _long_enough(key: bytes, least: int) -> bool:
    return len(key) >= least and (len(key) >= 4 * least or len(key.decode()) >= least)


def line_hashes(docs: DataFrame, min_chars: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc, hi, lo): the distinct 128-bit line hashes of every row."""

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owners, counts, digests = batch.column(0), [], []
            for text in batch.column(1):
                keys = {line_key(line) for line in (text.as_py() or "").encode().split(b"\n")}
                found = [_hash(key) for key in keys if _long_enough(key, min_chars)]
                counts.append(len(found))
                digests += found
            pairs = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
            rows = np.repeat(np.arange(len(counts)), counts)
            yield pa.record_batch(
                [owners.take(pa.array(rows)), pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["doc", "hi", "lo"]
            )

    rows = docs.select(row_key(id_col, text_col).alias("doc"), F.col(text_col).alias("text"))
    return rows.mapInArrow(explode, "doc long, hi long, lo long")


def frequent_lines(hashes: DataFrame, min_docs: int) -> DataFrame:
    """Hashes found in at least ``min_docs`` documents; counted in parts before they meet."""
    return (
        hashes.groupBy("hi", "lo").agg(F.count_distinct("doc").alias("docs"))
        .where(F.col("docs") >= min_docs).select("hi", "lo")
    )


@F.arrow_udf(KEPT)
def _reassemble(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    for texts, drops in batches:
        n_lines, n_dropped, kept, digests = [], [], [], []
        for text, drop in zip(texts, drops):
            lines = (text.as_py() or "").encode().split(b"\n")
            gone = drop.as_py()
            stay = lines
            if gone:
                hit = {(x["hi"], x["lo"]) for x in gone}
                stay = [x for x in lines if tuple(np.frombuffer(_hash(line_key(x)), "<i8").tolist()) not in hit]
            joined = b"\n".join(stay)
            n_lines.append(len(lines))
            n_dropped.append(len(lines) - len(stay))
            kept.append(joined.decode())
            digests.append(hashlib.sha256(joined).hexdigest())
        yield struct_array({
            "n_lines": pa.array(n_lines, pa.int64()), "n_dropped": pa.array(n_dropped, pa.int64()),
            "kept": pa.array(kept, pa.string()), "kept_sha256": pa.array(digests, pa.string()),
        })


def dedup_lines(
    docs: DataFrame, min_docs: int = 10, min_chars: int = 1, id_col: str = "doc_id", text_col: str = "text",
    out: str = "lines",
) -> DataFrame:
    """``docs`` with a struct column ``out``: n_lines, n_dropped, kept (the new text), kept_sha256.

    ``out`` must not be the name of a column of ``docs``.
    """
    if out.lower() in (c.lower() for c in docs.columns):
        raise ValueError(f"the documents have a column {out!r}")
    hashes = line_hashes(in_batches(docs), min_chars, id_col, text_col)
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    frequent = frequent_lines(hashes, min_docs).withColumn("salt", salts)
    drops = (
        hashes.withColumn("salt", F.pmod(F.xxhash64("doc"), F.lit(SALTS)).cast("int"))
        .join(frequent, ["hi", "lo", "salt"], "left_semi")
        .groupBy(F.col("doc").alias("__line_doc")).agg(F.collect_set(F.struct("hi", "lo")).alias("__line_drops"))
    )
    left = docs.withColumn("__line_key", row_key(id_col, text_col))
    joined = left.join(drops, F.col("__line_key") == F.col("__line_doc"), "left")
    return joined.select(*[F.col(f"`{c}`") for c in docs.columns], _reassemble(text_col, "__line_drops").alias(out))
