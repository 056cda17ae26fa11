"""Language ID: bit-sliced Bloom filters over character n-grams, popcounts decide.

Each language's filter holds the n-grams that at least ``MIN_SHARE`` of its sampled documents
contain. The filters are bit-sliced: one array has, per slot, 64-bit words with one bit per language, so
``PROBES`` lookups and an AND give the mask of all languages that (seem to) contain an n-gram. A
text's n-grams are counted per language bit. A language's filter answers falsely at a known rate f,
so with h hits of n the corrected share is (h/n - f) / (1 - f); the largest share wins.

Filters are learned from about ``SAMPLE_ROWS`` distinct texts of each language at most, those with the
smallest hashes: the share of the hash range is set by an estimate of the distinct texts (off by some
percent), so copies neither fill the sample nor empty it. The filters'  size is fixed by ``SLOTS`` and the number of languages (a word for each 64), so what is
broadcast does not grow with the corpus.

Defined cases: a null text, or one without a letter, is ``und`` with score 0; a text whose n-grams
no filter holds goes to the most frequent learned language with score 0; ties go to the more
frequent, then to the first name; a null language is not learned from; with nothing to learn from,
every text is ``und``. Rows are judged one by one; an empty table gives an empty one.
"""
from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType

from fraudloom.llm.text import in_batches, mix, struct_array, struct_type

WIDTHS = (1, 2, 3, 4)
SLOTS = 1 << 20
PROBES = 3
MIN_SHARE = 0.02
SAMPLE_ROWS = 5_000
WORD = 64
BLOCK_CHARS = 1 << 18
UNKNOWN = "und"
JUDGED = struct_type(lang_pred=StringType(), score=DoubleType())


@functools.cache
def _letters() -> np.ndarray:
    """Which code points are letters."""
    return np.array([chr(c).isalpha() for c in range(0x110000)])


def _grams(codes: np.ndarray, owner: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Hash and text of the n-grams of each width; ``codes`` has 0 between words."""
    for width in WIDTHS:
        n = len(codes) - width + 1
        if n <= 0:
            return
        key = codes[:n].astype(np.uint64)
        whole = owner[:n] == owner[width - 1 :]
        for k in range(1, width):
            key = key * np.uint64(0x110000) + codes[k : k + n]
        for k in range(1, width - 1):
            whole &= codes[k : k + n] != 0  # a space may begin or end an n-gram
        if width == 1:
            whole &= codes[:n] != 0
        yield mix(key[whole] + np.uint64(width * 0x9E3779B97F4A7C15 % 2**64)), owner[:n][whole]


def _normalised(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the lower-cased texts with every run of non-letters as one 0, and each one's text."""
    lowered = [f" {t.lower()} " for t in texts]
    codes = np.frombuffer("".join(lowered).encode("utf-32-le"), np.uint32)
    codes = np.where(_letters()[codes], codes, np.uint32(0))
    owner = np.repeat(np.arange(len(texts)), [len(t) for t in lowered])
    keep = np.ones(len(codes), bool)
    keep[1:] = (codes[1:] != 0) | (codes[:-1] != 0) | (owner[1:] != owner[:-1])
    return codes[keep], owner[keep]


def _runs(texts: list[str]) -> Iterator[tuple[list[int], list[str]]]:
    """Texts in runs of bounded length; a longer text comes in pieces, cut after white space where there is some."""
    rows, parts, size = [], [], 0
    for row, text in enumerate(texts):
        at = 0
        while at < len(text):
            end = min(len(text), at + BLOCK_CHARS)
            if end < len(text):
                cut = max(text.rfind(" ", at, end), text.rfind("\n", at, end))
                end = cut + 1 if cut > at else end
            rows.append(row)
            parts.append(text[at:end])
            size += end - at
            at = end
            if size >= BLOCK_CHARS:
                yield rows, parts
                rows, parts, size = [], [], 0
    if parts:
        yield rows, parts


def _slots(keys: np.ndarray) -> Iterator[np.ndarray]:
    for probe in range(PROBES):
        yield (mix(keys + np.uint64(probe + 1)) & np.uint64(SLOTS - 1)).astype(np.int64)


@dataclass(frozen=True)
class Model:
    """Languages by falling frequency, the bit-sliced filters, and each one's rate of false answers."""

    languages: tuple[str, ...]
    filters: np.ndarray
    false_rate: np.ndarray

    def hits(self, keys: np.ndarray) -> np.ndarray:
        """Masks of the first ``WORD`` languages that seem to contain each n-gram."""
        return self.word_hits(list(_slots(keys)), 0)

    def word_hits(self, probes: list[np.ndarray], word: int) -> np.ndarray:
        """Masks of the languages of one word that seem to contain each n-gram."""
        mask = np.full(len(probes[0]), np.iinfo(np.uint64).max, np.uint64)
        for slots in probes:
            mask &= self.filters[word, slots]
        return mask

    def judge(self, texts: list[str]) -> list[tuple[str, float]]:
        n = np.zeros(len(texts))
        hits = np.zeros((len(self.languages), len(texts)))
        for rows, parts in _runs(texts):
            rows = np.array(rows)
            codes, owner = _normalised(parts)
            for keys, text in _grams(codes, owner):
                probes, row = list(_slots(keys)), rows[text]
                n += np.bincount(row, minlength=len(texts))
                for k in range(len(self.languages)):
                    if k % WORD == 0:
                        mask = self.word_hits(probes, k // WORD)
                    hits[k] += np.bincount(row, (mask >> np.uint64(k % WORD)) & np.uint64(1), len(texts))
        out = []
        for row, total in enumerate(n):
            if not total or not self.languages:
                out.append((UNKNOWN, 0.0))
                continue
            share = np.clip((hits[:, row] / total - self.false_rate) / (1 - self.false_rate), 0, 1)
            best = int(np.argmax(share))
            out.append((self.languages[best], float(share[best] / share.sum()) if share[best] else 0.0))
        return out


def learn(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Model:
    """Filters of the languages in ``lang_col``."""
    rows = docs.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).where("text is not null and lang is not null")
    found = rows.groupBy("lang").agg(F.count("*").alias("n"), F.approx_count_distinct("text").alias("texts"))
    sizes = {r["lang"]: r["texts"] for r in found.orderBy(F.desc("n"), "lang").collect()}
    languages = tuple(sizes)
    if not languages:
        return Model((), np.zeros((1, SLOTS), np.uint64), np.zeros(0))
    kept = F.create_map(*[x for k, n in sizes.items() for x in (F.lit(k), F.lit(min(1 << 30, (SAMPLE_ROWS << 30) // max(1, n))))])
    place = {lang: k for k, lang in enumerate(languages)}
    hashed = rows.withColumn("hash", F.xxhash64("text"))
    sample = hashed.where(F.pmod("hash", F.lit(1 << 30)) < kept[F.col("lang")]).dropDuplicates(["lang", "hash"]).select("text", "lang")

    def holders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(lang, n-gram, documents of this batch that contain it)"""
        for batch in batches:
            langs, grams = [], []
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = [np.empty(0, np.uint64)]
                for _, parts in _runs([text]):
                    own += [keys for keys, _ in _grams(*_normalised(parts))]
                found = np.unique(np.concatenate(own))
                grams.append(found)
                langs.append(np.full(len(found), place[lang]))
            pairs = np.stack([np.concatenate(langs).astype(np.int64), np.concatenate(grams).view(np.int64)]) if langs else np.empty((2, 0), np.int64)
            order = np.lexsort(pairs[::-1])
            pairs = pairs[:, order]
            first = np.ones(pairs.shape[1], bool)
            first[1:] = (pairs[:, 1:] != pairs[:, :-1]).any(0)
            at = np.flatnonzero(first)
            yield pa.record_batch([pa.array(pairs[0, at]), pa.array(pairs[1, at]), pa.array(np.diff(np.append(at, pairs.shape[1])))], ["lang", "gram", "docs"])

    counts = sample.mapInArrow(holders, "lang long, gram long, docs long").groupBy("lang", "gram").agg(F.sum("docs").alias("docs"))
    sampled = {r["lang"]: r["n"] for r in sample.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    least = F.create_map(*[x for k, lang in enumerate(languages) for x in (F.lit(k).cast("long"), F.lit(MIN_SHARE * sampled.get(lang, 0)))])
    # n-grams in 2 % of a bounded sample: at most 50 times the n-grams of one document per language
    table = counts.where(F.col("docs") >= least[F.col("lang")]).select("lang", "gram").toArrow()
    filters = np.zeros((-(-len(languages) // WORD), SLOTS), np.uint64)
    lang, keys = table.column("lang").to_numpy(), table.column("gram").to_numpy().view(np.uint64)
    for slots in _slots(keys):
        np.bitwise_or.at(filters, (lang // WORD, slots), np.uint64(1) << (lang % WORD).astype(np.uint64))
    filled = np.array([np.count_nonzero(filters[k // WORD] >> np.uint64(k % WORD) & np.uint64(1)) / SLOTS for k in range(len(languages))])
    return Model(languages, filters, filled**PROBES)


def predict_language(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, lang_pred, score (the winner's part of all corrected shares) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf(JUDGED)
    def judge(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            found = shared.value.judge([x or "" for x in texts.to_pylist()])
            yield struct_array({
                "lang_pred": pa.array([x for x, _ in found], pa.string()), "score": pa.array([x for _, x in found], pa.float64()),
            })

    return in_batches(docs).select(F.col(id_col), judge(F.col(text_col)).alias("__g")).select(id_col, "__g.*")
