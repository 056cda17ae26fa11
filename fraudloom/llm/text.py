"""Helpers the operators share: reading, row keys, and words of many texts as arrays.

Word arrays work on the UTF-8 bytes of a block of texts joined by line feeds. A block holds
``BLOCK_BYTES`` at most unless a single text is longer, and bytes are hashed ``PIECE_BYTES`` at a
time, so memory beyond that grows with the words of the longest text only.
"""
from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fraudloom.session import scratch_folder

BLOCK_BYTES = 1 << 19
PIECE_BYTES = 1 << 18
BATCH_BYTES = "8m"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
#: Bytes of words between ASCII white space, and of words of ASCII letters, digits and non-ASCII.
SPACED = ~_SPACE
ALNUM = np.array([b >= 128 or chr(b).isalnum() for b in range(256)])

_RANDOM = np.random.default_rng(20240229)
_BYTE_CODES = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of a data folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def in_batches(docs: DataFrame) -> DataFrame:
    """The same rows; what Python workers get of them at once is bounded by bytes from here on."""
    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return docs


def row_key(id_col: str = "doc_id", text_col: str = "text") -> Column:
    """What tells documents apart: the id, or for rows without one the text's hash."""
    return F.coalesce(F.col(id_col).cast("long"), F.xxhash64(F.col(text_col)))


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit integers; one to one."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def blocks(texts: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[list[bytes]]:
    """The texts as UTF-8, null as empty, in runs of about ``limit`` bytes."""
    run, size = [], 0
    for value in texts:
        text = value.as_py()
        raw = text.encode() if text else b""
        if run and size + len(raw) > limit:
            yield run
            run, size = [], 0
        run.append(raw)
        size += len(raw)
    if run:
        yield run


@dataclass
class Words:
    """Words of several texts in order: a hash for each, and where each text's words begin."""

    hashes: np.ndarray
    bounds: np.ndarray  # one more than texts

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    def owners(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.bounds) - 1), self.counts)

    def windows(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash and first word of each window of ``width`` words that lies within a text."""
        n = len(self.hashes) - width + 1
        if n <= 0:
            return np.empty(0, np.uint64), np.empty(0, np.int64)
        joined = self.hashes[:n].copy()
        for k in range(1, width):
            joined *= _BASE
            joined += self.hashes[k : k + n]
        owner = self.owners()
        first = np.flatnonzero(owner[:n] == owner[width - 1 :])
        return mix(joined[first]), first


def _piece_hashes(data: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of every word of bytes that neither begin nor end within a word."""
    mask = inside[data]
    starts = np.flatnonzero(mask & ~np.concatenate(([False], mask[:-1])))
    if not len(starts):
        return starts, np.empty(0, np.uint64)
    gaps = np.diff(np.append(starts, len(data)))
    place = np.arange(starts[0], len(data)) - np.repeat(starts, gaps)
    powers = np.multiply.accumulate(np.full(int(gaps.max()), _BASE))
    codes = np.where(inside, _BYTE_CODES, np.uint64(0))[data[starts[0] :]]
    codes *= powers[place]
    return starts, mix(np.add.reduceat(codes, starts - starts[0]))


def words(texts: list[bytes], inside: np.ndarray = SPACED) -> Words:
    """Words of the texts; equal words have equal hashes, others differ but for chance of 2**-64."""
    blob = b"\n".join(texts)
    data = np.frombuffer(blob, np.uint8)
    starts, hashes, at = [], [], 0
    while at < len(data):
        end = min(len(data), at + PIECE_BYTES)
        while end < len(data):  # a piece ends where no word does
            outside = np.flatnonzero(~inside[data[end : end + PIECE_BYTES]])
            if len(outside):
                end += int(outside[0])
                break
            end = min(len(data), end + PIECE_BYTES)
        begun, made = _piece_hashes(data[at:end], inside)
        starts.append(begun + at)
        hashes.append(made)
        at = end
    places = np.concatenate(starts) if starts else np.empty(0, np.int64)
    firsts = np.cumsum([0] + [len(t) + 1 for t in texts])
    return Words(
        np.concatenate(hashes) if hashes else np.empty(0, np.uint64), np.searchsorted(places, firsts)
    )


def per_text(flags: np.ndarray, texts: list[bytes]) -> np.ndarray:
    """Sum of a value per byte (of the texts joined by line feeds) for each text."""
    ends = np.cumsum([len(t) + 1 for t in texts])
    total = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
    starts = np.concatenate(([0], ends[:-1]))
    return total[ends - 1] - total[starts]


def struct_type(**kinds: T.DataType) -> T.StructType:
    """A struct type; unlike its text form it can be made where no session runs."""
    return T.StructType([T.StructField(name, kind) for name, kind in kinds.items()])


def struct_array(fields: dict[str, pa.Array]) -> pa.Array:
    return pa.StructArray.from_arrays(list(fields.values()), list(fields))


def staged(rows: DataFrame, name: str) -> DataFrame:
    """The rows, written to the shared folder and read again: lineage ends there."""
    spark = rows.sparkSession
    path = scratch_folder(spark, name.replace(" ", "-"))
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)
