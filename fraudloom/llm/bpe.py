"""Byte-level BPE with a hierarchical-bitmap rank queue; exact encoding and decoding.

Pairs of neighbours wait in a bucket per merge rank. A bitmap of two levels marks the buckets that
hold anything, so find-first-set on one word per level gives the lowest rank; within a bucket the
leftmost position goes first. Neighbours are linked lists, and an entry whose pair has changed
since is skipped when it comes up. A pre-token of n bytes takes O(n log n) at most, however long.
Short pre-tokens met before come from a bounded cache in each worker.

Defined cases: null is an empty text with no ids; rows are encoded one by one, so repeated rows get
equal results; special strings are ordinary text; an empty table gives an empty one. Other columns
are not read. Hashes are fed in pieces, so a text's ids are never held as Python numbers at once.
"""
from __future__ import annotations

import base64
import functools
import hashlib
import itertools
import struct
from collections.abc import Callable, Iterable, Iterator
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType

from fraudloom.llm.text import in_batches, struct_array, struct_type
from fraudloom.llm.tokens import PATTERN

LONGEST_CACHED = 64
CACHE_ENTRIES = 1_200_000
KEPT_ENTRIES = 500_000
PIECES_AT_ONCE = 1 << 16
_SHIFT = 8
_WORD = 1 << _SHIFT  # ranks to a word of the bitmap
_MASK = _WORD - 1
ENCODED = struct_type(ids=ArrayType(IntegerType()), decoded_sha256=StringType())
ROUND_TRIP = struct_type(n_tokens=LongType(), ids_sha256=StringType(), decoded_sha256=StringType())


class Pieces(dict):
    """Packed ids of short pre-tokens met before. When half of the bound is new, the older half goes."""

    def __init__(self, merge: Callable[[bytes], list[int]]):
        super().__init__()
        self.merge, self.older = merge, {}

    def __missing__(self, piece: str) -> bytes:
        packed = self.older.get(piece)
        if packed is None:
            ids = self.merge(piece.encode())
            packed = struct.pack(f"<{len(ids)}I", *ids)
        if len(piece) <= LONGEST_CACHED:
            if len(self) >= CACHE_ENTRIES // 2:
                self.older = dict(self)
                self.clear()
            self[piece] = packed
        return packed


    def rest(self) -> None:
        """Keep a part for the worker's next task: what was met first since half of it went, so mostly the frequent ones."""
        kept = dict(itertools.islice(self.items(), KEPT_ENTRIES))
        self.clear()
        self.older = kept


class ByteBPE:
    """A rank file's encoder and decoder."""

    def __init__(self, path: str, pattern: str = PATTERN):
        with open(path, "rb") as file:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        size = max(self.ranks.values()) + 1
        self.vocabulary = [b""] * size
        for token, rank in self.ranks.items():
            self.vocabulary[rank] = token
        self.split = regex.compile(pattern)
        self.first = [self.ranks.get(bytes(divmod(pair, 256)), -1) for pair in range(1 << 16)]
        self.words = [0] * (-(-size // _WORD))  # lower level of the bitmap: a bit per rank; zero between merges
        self.bits = [1 << k for k in range(max(_WORD, len(self.words)))]
        self.pieces = Pieces(self.merge)

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one pre-token."""
        rank_of = self.ranks.get
        whole = rank_of(piece)
        if whole is not None:
            return [whole]
        n, first, words, bits = len(piece), self.first, self.words, self.bits
        pair = [first[a << 8 | b] for a, b in zip(piece, piece[1:])]
        pair += (-1, -1)
        after, before = list(range(1, n + 2)), list(range(-1, n + 1))
        buckets: dict[int, int | list[int]] = {}  # one position, or a heap of several
        filled = 0  # upper level of the bitmap: a bit per word

        made = [(i, rank) for i, rank in enumerate(pair) if rank >= 0]
        while True:
            for i, rank in made:
                if rank in buckets:
                    bucket = buckets[rank]
                    if bucket.__class__ is int:
                        buckets[rank] = [bucket, i] if bucket < i else [i, bucket]
                    else:
                        heappush(bucket, i)
                else:
                    buckets[rank] = i
                    at = rank >> _SHIFT
                    words[at] |= bits[rank & _MASK]
                    filled |= bits[at]
            if not filled:
                break
            at = (filled & -filled).bit_length() - 1
            word = words[at]
            rank = at << _SHIFT | (word & -word).bit_length() - 1
            i = buckets[rank]
            if i.__class__ is int:
                del buckets[rank]
                word &= word - 1
                words[at] = word
                if not word:
                    filled &= filled - 1
            else:
                bucket, i = i, heappop(i)
                if len(bucket) == 1:
                    buckets[rank] = bucket[0]
            made = ()
            if pair[i] != rank:
                continue  # stale
            j = after[i]
            k = after[j]
            after[i], before[k], pair[j] = k, i, -1
            h = before[i]
            if k < n and (right := rank_of(piece[i : after[k]])) is not None:
                pair[i] = right
                made = ((i, right),)
            else:
                pair[i] = -1
            if h >= 0:
                if (left := rank_of(piece[h:k])) is not None:
                    pair[h] = left
                    made = ((h, left), *made)
                else:
                    pair[h] = -1
        ids, i = [], 0
        while i < n:
            k = after[i]
            ids.append(self.ranks[piece[i:k]])
            i = k
        return ids

    def encode(self, text: str) -> Iterator[bytes]:
        """Packed ids of a text as little-endian unsigned 32-bit integers, in parts."""
        ids = self.pieces.__getitem__
        if len(text) <= 1 << 20:
            yield b"".join(map(ids, self.split.findall(text)))
            return
        for run in itertools.batched((m.group() for m in self.split.finditer(text)), PIECES_AT_ONCE):
            yield b"".join(map(ids, run))

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.vocabulary.__getitem__, ids))


@functools.cache
def codec(path: str) -> ByteBPE:
    """One codec per worker."""
    return ByteBPE(path)


def encode_ids(path: str):
    """Column function: text to its ids and the hash of the bytes they decode to."""

    @F.arrow_udf(ENCODED)
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        bpe = codec(path)
        for texts in batches:
            parts, decoded = [], []
            for text in texts:
                own, back = [], hashlib.sha256()
                for packed in bpe.encode(text.as_py() or ""):
                    own.append(packed)
                    back.update(bpe.decode(np.frombuffer(packed, "<u4").tolist()))
                parts.append(b"".join(own))
                decoded.append(back.hexdigest())
            offsets = np.cumsum([0] + [len(p) // 4 for p in parts])
            ids = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.frombuffer(b"".join(parts), "<i4")))
            yield struct_array({"ids": ids, "decoded_sha256": pa.array(decoded, pa.string())})
        bpe.pieces.rest()

    return encode


def decode_ids(path: str):
    """Column function: array of ids to bytes; null ids give no bytes."""

    @F.arrow_udf("binary")
    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        bpe = codec(path)
        for rows in batches:
            yield pa.array([bpe.decode(x.as_py() or ()) for x in rows], pa.binary())

    return decode


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_tokens, hash of the ids, hash of the bytes decoded from the ids, of every row."""

    @F.arrow_udf(ROUND_TRIP)
    def both(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        bpe = codec(path)
        for texts in batches:
            counts, encoded, decoded = [], [], []
            for text in texts:
                n, ids_hash, text_hash = 0, hashlib.sha256(), hashlib.sha256()
                for packed in bpe.encode(text.as_py() or ""):
                    n += len(packed) // 4
                    ids_hash.update(packed)
                    text_hash.update(bpe.decode(np.frombuffer(packed, "<u4").tolist()))
                counts.append(n)
                encoded.append(ids_hash.hexdigest())
                decoded.append(text_hash.hexdigest())
            yield struct_array({
                "n_tokens": pa.array(counts, pa.int64()), "ids_sha256": pa.array(encoded, pa.string()),
                "decoded_sha256": pa.array(decoded, pa.string()),
            })
        bpe.pieces.rest()

    return in_batches(docs).select(F.col(id_col), both(F.col(text_col)).alias("__t")).select(id_col, "__t.*")
