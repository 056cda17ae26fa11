"""Token counts by a two-tier lookup on the map side.

Tier one is a table of frequent pre-tokens and their token counts, built from a hash sample of
``SAMPLE_ROWS`` documents and broadcast (``TABLE_SIZE`` entries of at most ``LONGEST`` characters,
which bounds its size). Tier two is a cache in each worker, filled by the library itself; pieces
longer than ``LONGEST`` are encoded each time. No pre-token crosses a shuffle, and the counts
depend on neither tier.

The lookup holds for tokenizers that split texts by the byte-level pattern; any other tokenizer
encodes whole texts. So do texts with characters that Python's Unicode tables don't know, because
libraries disagree on what is a letter there.

Defined cases: null is an empty text with 0 bytes and 0 tokens; rows are counted one by one, so
repeated rows get equal results; special strings inside texts count as the library counts them by
default; an empty table gives an empty one. Other columns are not read.
"""
from __future__ import annotations

import collections
import functools
import json
import os
import re
import unicodedata
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from fraudloom.llm.text import in_batches, struct_array, struct_type

SAMPLE_ROWS = 2_000
TABLE_SIZE = 50_000
LONGEST = 64
CACHE_ENTRIES = 400_000
COUNTED = struct_type(n_bytes=LongType(), n_tokens=LongType())
#: The pattern of byte-level pre-tokens (fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_LATER = re.compile("[^\x00-ԯ]")


@functools.cache
def _unassigned() -> frozenset[str]:
    return frozenset(c for c in map(chr, range(0x530, 0x110000)) if unicodedata.category(c) == "Cn")


def _unknown_letters(text: str) -> bool:
    """Whether a text has characters that are unassigned in Python's Unicode tables."""
    return bool(_LATER.search(text)) and not _unassigned().isdisjoint(text)


class Lengths(dict):
    """Token counts of pieces: the frequent ones and, up to a bound, others met before."""

    def __init__(self, frequent: dict[str, int], encode: Callable[[str], int]):
        super().__init__(frequent)
        self.frequent, self.encode = frequent, encode

    def __missing__(self, piece: str) -> int:
        n = self.encode(piece)
        if len(piece) <= LONGEST:
            if len(self) >= len(self.frequent) + CACHE_ENTRIES:
                self.clear()
                self.update(self.frequent)
            self[piece] = n
        return n


class Counter:
    """Counts tokens of whole texts with the tokenizer in a file."""

    def __init__(self, path: str, frequent: dict[str, int] | None = None):
        self.split = None
        if path.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            self.whole = lambda text: len(model.encode(text, num_threads=1))
            return
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        self.whole = lambda text: len(tokenizer.encode(text, add_special_tokens=False).ids)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        before, added = spec.get("pre_tokenizer") or {}, spec.get("added_tokens") or []
        plain = not spec.get("normalizer") and before.get("type") == "ByteLevel" and before.get("use_regex")
        if plain and not before.get("add_prefix_space") and not any(
            x["lstrip"] or x["rstrip"] or x["single_word"] or x["normalized"] for x in added
        ):
            self.split = regex.compile(PATTERN)
            self.special = re.compile("|".join(re.escape(x["content"]) for x in added)) if added else None
            self.lengths = Lengths(frequent or {}, self.whole)

    def pieces(self, text: str) -> Iterator[str]:
        """Pre-tokens of a text, special strings left out."""
        for part in self.special.split(text) if self.special else [text]:
            yield from (m.group() for m in self.split.finditer(part))

    def count(self, text: str) -> int:
        if not text:
            return 0
        if self.split is None or _unknown_letters(text):
            return self.whole(text)
        if self.special and (parts := self.special.split(text))[1:]:
            return len(parts) - 1 + sum(map(self._plain, parts))
        return self._plain(text)

    def _plain(self, text: str) -> int:
        if len(text) < 1 << 20:
            return sum(map(self.lengths.__getitem__, self.split.findall(text)))
        return sum(self.lengths[m.group()] for m in self.split.finditer(text))


def frequent_lengths(docs: DataFrame, path: str, text_col: str = "text") -> dict[str, int]:
    """Tier one: the most frequent pre-tokens of a bounded sample, with their token counts.

    The sampled documents, not their pre-tokens, meet in one task, which sends back the table.
    """
    rows = in_batches(docs).select(F.col(text_col).alias("text")).where("text is not null")
    total = rows.count()
    share = min(1.0, SAMPLE_ROWS / max(total, 1))
    sample = rows.where(F.pmod(F.xxhash64("text"), F.lit(1 << 30)) < int(share * (1 << 30))).limit(2 * SAMPLE_ROWS)

    def table(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter, seen = Counter(path), collections.Counter()
        if counter.split is None:
            return
        for batch in batches:
            for text in batch.column(0):
                seen.update(x for x in counter.pieces(text.as_py()) if len(x) <= LONGEST)
        best = sorted(seen, key=lambda x: (-seen[x], x))[:TABLE_SIZE]
        yield pa.record_batch([pa.array(best, pa.string()), pa.array([counter.whole(x) for x in best], pa.int32())], ["piece", "n"])

    found = sample.repartition(1).mapInArrow(table, "piece string, n int").toArrow()
    return dict(zip(found.column("piece").to_pylist(), found.column("n").to_pylist()))


def count_tokens(
    docs: DataFrame, path: str, limit: int = 512, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """id, n_bytes, n_tokens, over_limit of every row."""
    table = frequent_lengths(docs, path, text_col)
    shared = docs.sparkSession.sparkContext.broadcast((list(table), np.array(list(table.values()), np.uint16)))

    table_id = uuid.uuid4().hex

    @F.arrow_udf(COUNTED)
    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        counter = _counter(path, table_id, lambda: dict(zip(shared.value[0], shared.value[1].tolist())))
        for texts in batches:
            values = [x or "" for x in texts.to_pylist()]
            yield struct_array({
                "n_bytes": pa.array([len(x.encode()) for x in values], pa.int64()),
                "n_tokens": pa.array([counter.count(x) for x in values], pa.int64()),
            })

    counted = docs.select(F.col(id_col), count(F.col(text_col)).alias("__n")).select(id_col, "__n.*")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)


_COUNTERS: dict[tuple[str, str], Counter] = {}


def _counter(path: str, table: str, load: Callable[[], dict[str, int]]) -> Counter:
    """One counter per worker and broadcast table, so that its cache outlives a task."""
    if (path, table) not in _COUNTERS:
        _COUNTERS.clear()
        _COUNTERS[path, table] = Counter(path, load())
    return _COUNTERS[path, table]
