"""Benchmark decontamination: passages are found even if their numbers, names and units were changed.

A text becomes a template: numbers, units after numbers, and names give typed placeholders, other
words their lower-cased selves. Windows of up to ``WINDOW`` template words are hashed and joined with
the windows of the benchmark items; the width falls with the item's length, so that a copy with one
or two changed words still has a window. Where a window is found, the texts are compared word by word
at that offset and up to ``SHIFT`` words aside (words put in or left out); an item's value that
stands in several slots must have one value in the copy: slots with a minority's value do not count,
and without a majority only runs of a window's length with the item's own values do.

A document is contaminated when copies cover ``MIN_WORDS`` of an item's words (at least
``LEAST_COPIED``, or all but one), or ``MIN_SHARE`` of its windows, or when a run at one offset has
``LONG_RUN`` words. Items of fewer than ``WINDOW`` words must be there as a whole, those of fewer than
``LEAST_WORDS`` with their own values and symbols. Characters of scripts without spaces are words;
for ``LONG_RUN`` each is half a word.

Windows of which less than half (``LEAST_PLAIN`` of ``WINDOW``) are different plain words do not
count, nor the words that only they cover, unless an item has no others. A name is a word in title
case that does not begin a sentence; words are hashed and compared a second time with names read as
plain words, so copies in another case or after another sentence break are found. Before the join, documents'
windows pass a bitmap of ``BITS`` bits that is broadcast; it never loses a match, and its size does
not depend on either table. Item windows are salted for the join, so that an item in a third of all
documents does not meet them in one task.

Defined cases: null or empty texts match nothing, items with a null id, or with
nothing but sentence marks and white space, are no passages; items that repeat are matched each, rows that share an id each by
their own text; rows without id are told apart by their text, rows that repeat an id are one document; an empty table on either side matches nothing.
"""
from __future__ import annotations

import collections
import functools
import itertools
import math
import re
from collections.abc import Collection, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fraudloom.llm.text import in_batches, mix, row_key, staged

WINDOW = 8
LEAST_WORDS = 5
LEAST_PLAIN = 4
MIN_SHARE = 0.5
#: Share of an item's words that makes a copy, at least ``LEAST_COPIED`` words or all but one.
MIN_WORDS = 0.6
LEAST_COPIED = 9
#: Words of a run at one offset that are a passage, whatever the length of the item.
LONG_RUN = 13
#: A copy's runs of this length count, and shorter ones at most ``GAP`` words away, up to ``SHIFT`` offsets aside.
LEAST_RUN = 3
GAP = 2
SHIFT = 2
KNOWN_ITEMS = 2_000
BLOCK_CHARS = 1 << 16
BITS = 1 << 24
SALTS = 16
NUMBER, UNIT, NAME = 1, 2, 3
#: Words that are units when a number stands before them (fixed values).
UNITS = frozenset(
    "% percent m cm mm km kg g mg lb lbs oz l ml mile miles meter meters metre metres kilometer kilometers foot feet inch inches "
    "yard yards s sec second seconds min minute minutes h hour hours day days week weeks month months year years "
    "dollar dollars cent cents euro euros pound pounds liter liters litre litres gram grams degree degrees".split()
)
#: Number words (fixed values).
NUMERALS = frozenset(
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen "
    "nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million".split()
)
_TOKEN = re.compile(r"\d+(?:[.,]\d+)*|[^\W\d_]+(?:['’][^\W\d_]+)*|[%.!?:\n]")
#: Scripts without spaces between words: each character is a word.
_UNSPACED = (
    "\u0e00-\u0e4f\u0e5a-\u0ecf\u0eda-\u0eff\u1000-\u103f\u104a-\u108f\u1780-\u17df\u2e80-\u2fdf\u3005-\u3007\u3040-\u30ff\u31f0-\u31ff"
    "\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\uff66-\uff9f\U00020000-\U0003ffff"
)
_ANY_UNSPACED = re.compile(f"[{_UNSPACED}]")
_LETTER = rf"(?:(?![{_UNSPACED}])[^\W\d_])"
_CUT_TOKEN = re.compile(rf"\d+(?:[.,]\d+)*|[{_UNSPACED}]|{_LETTER}+(?:['’]{_LETTER}+)*|[%.!?:\n]")
#: Words, numbers and symbols of items that are too short for a template.
_LITERAL = re.compile(rf"\d+(?:[.,]\d+)*|[{_UNSPACED}]|{_LETTER}+|[^\w\s.!?:]|_")
LITERAL_WINDOW = 16
CACHE_ENTRIES = 150_000
#: What a token may be, in the low bits of its code.
_PLAIN, _NUMBER, _MARK, _TITLE, _UNIT, _TITLE_UNIT = range(6)
_PLACEHOLDERS = {NUMBER: 0x6E756D, UNIT: 0x756E6974, NAME: 0x6E616D65}
_BASE = np.uint64(0x9E3779B97F4A7C15)
FOUND = "doc long, content long, pos int, width int, hash long"


class _Codes(dict):
    """Token to hash of its lower-cased form, with what it may be in the low three bits; bounded."""

    def __missing__(self, token: str) -> int:
        lowered = token.lower()
        title = len(token) > 1 and token[0].isupper() and token[1:].islower()
        if token in ".!?:\n":
            kind = _MARK
        elif token[0].isdigit() or lowered in NUMERALS:
            kind = _NUMBER
        elif lowered in UNITS:
            kind = _TITLE_UNIT if title else _UNIT
        else:
            kind = _TITLE if title else _PLAIN
        if len(self) >= CACHE_ENTRIES:
            self.clear()
        self[token] = code = xxhash.xxh3_64_intdigest(token.casefold().encode()) & ~7 | 1 << 63 | kind
        return code


_codes = _Codes()


@dataclass(frozen=True)
class Template:
    """A code per template word, the kind of its slot (0 for plain words), the words, and codes that read names as words."""

    codes: np.ndarray
    kinds: np.ndarray
    tokens: list[str]
    unnamed: np.ndarray

    def slots(self, at: int, width: int) -> list[str | None]:
        """What stands in each slot of a window; null for plain words."""
        return [f"{k}{t.lower()}" if k else None for k, t in zip(self.kinds[at : at + width].tolist(), self.tokens[at : at + width])]

    def plain(self, at: int, width: int) -> int:
        """Different plain words of a window."""
        return len(set(self.codes[at : at + width][self.kinds[at : at + width] == 0].tolist()))


def template(text: str) -> Template:
    return _templates([text])[0]


def _templates(texts: list[str]) -> tuple[Template, np.ndarray]:
    """The template of several texts in a row, and where each one begins and the last one ends."""
    tokens, ends = [], []
    for text in texts:
        tokens += (_CUT_TOKEN if not text.isascii() and _ANY_UNSPACED.search(text) else _TOKEN).findall(text)
        tokens.append("\n")
        ends.append(len(tokens))
    codes = np.fromiter(map(_codes.__getitem__, tokens), np.uint64, len(tokens))
    may = codes & np.uint64(7)
    before = np.concatenate(([np.uint64(_MARK)], may[:-1]))
    kinds = np.zeros(len(codes), np.int8)
    kinds[((may == _TITLE) | (may == _TITLE_UNIT)) & (before != _MARK)] = NAME
    kinds[((may == _UNIT) | (may == _TITLE_UNIT)) & (before == _NUMBER)] = UNIT
    kinds[may == _NUMBER] = NUMBER
    codes &= ~np.uint64(7)
    unnamed = codes.copy()
    for kind, code in _PLACEHOLDERS.items():
        codes[kinds == kind] = code
        if kind != NAME:
            unnamed[kinds == kind] = code
    stay = may != _MARK
    bounds = np.concatenate(([0], np.cumsum(stay)[np.array(ends) - 1]))
    return Template(codes[stay], kinds[stay], list(itertools.compress(tokens, stay.tolist())), unnamed[stay]), bounds


def literal(text: str) -> list[str]:
    """All words, numbers and symbols of a text, sentence marks left out."""
    return [t.casefold() for t in _LITERAL.findall(text)]


@functools.lru_cache(CACHE_ENTRIES)
def _literal_code(token: str) -> int:
    return xxhash.xxh3_64_intdigest(token.encode(), 1)


def _literal_codes(tokens: list[str]) -> np.ndarray:
    return np.fromiter(map(_literal_code, tokens), np.uint64, len(tokens))


def _each_width(codes: np.ndarray, widths: Collection[int]) -> Iterator[tuple[int, np.ndarray]]:
    """Each of the widths that fits, and the hashes of its windows."""
    joined = spread = mix(codes)
    for width in range(1, min(max(widths, default=0), len(codes)) + 1):
        if width > 1:
            joined = joined[:-1] * _BASE + spread[width - 1 :]
        if width in widths:
            yield width, mix(joined + np.uint64(width))


def _windows(codes: np.ndarray, width: int) -> np.ndarray:
    return next((hashes for _, hashes in _each_width(codes, [width])), np.empty(0, np.uint64))


def seed_width(n: int) -> int:
    """Words of an item's windows: two changed words leave one intact (one, below a dozen words)."""
    return n if n < WINDOW else min(WINDOW, max(4, -(-(n - 2) // 3)))


def _good(found: Template, width: int) -> list[int]:
    """Windows with enough different plain words, or all where there are none."""
    every = range(len(found.codes) - width + 1)
    return [p for p in every if found.plain(p, width) * WINDOW >= LEAST_PLAIN * width] or list(every)


def _runs(same: np.ndarray) -> list[tuple[int, int]]:
    """Begin and end of each run of true values."""
    edges = np.flatnonzero(np.diff(np.concatenate(([0], same.astype(np.int8), [0]))))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist()))


class Passage:
    """An item to compare with places in documents, word by word."""

    def __init__(self, text: str):
        self.found = found = template(text)
        self.n = len(found.codes)
        self.literal = literal(text) if self.n < LEAST_WORDS else None
        if self.literal is not None:
            return
        weights = [0.5 if _ANY_UNSPACED.match(t) else 1.0 for t in found.tokens]  # a character is half a word
        self.before = np.concatenate(([0], np.cumsum(weights)))
        self.values = found.slots(0, self.n)
        self.width = min(WINDOW, self.n)
        self.good = np.array(_good(found, self.width))
        self.counts = np.zeros(self.n, bool)  # words that windows cover
        for p in self.good.tolist():
            self.counts[p : p + self.width] = True
        self.size = int(self.counts.sum())
        self.least = self.n if self.n < WINDOW else max(min(self.size - 1, LEAST_COPIED), math.ceil(MIN_WORDS * self.size))

    def agree(self, doc: Template, offset: int) -> np.ndarray:
        """The item's words that a copy at this offset holds: runs of ``LEAST_RUN`` or more and what is near them."""
        same = np.zeros(self.n, bool)
        low, high = max(0, -offset), min(self.n, len(doc.codes) - offset)
        if high <= low:
            return same
        there = slice(low + offset, high + offset)
        same[low:high] = (self.found.codes[low:high] == doc.codes[there]) | (self.found.unnamed[low:high] == doc.unnamed[there])
        clusters: list[list[tuple[int, int]]] = []
        for run in _runs(same):
            if clusters and run[0] - clusters[-1][-1][1] <= GAP:
                clusters[-1].append(run)
            else:
                clusters.append([run])
        same[:] = False
        for cluster in clusters:
            if max(e - b for b, e in cluster) >= min(LEAST_RUN, self.n):
                for b, e in cluster:
                    same[b:e] = True
        return self.consistent(doc, offset, same)

    def consistent(self, doc: Template, offset: int, same: np.ndarray) -> np.ndarray:
        """These words without slots that hold a minority's value.

        Where an item's value has several values in the copy, the item's own value stays, else that of
        most slots; if no value has most, the copy counts only where it holds the item's own values.
        """
        slots = np.flatnonzero(same & (self.found.kinds > 0)).tolist()
        held: dict[str, collections.Counter] = collections.defaultdict(collections.Counter)
        value = {at: f"{self.found.kinds[at]}{doc.tokens[at + offset].lower()}" for at in slots}
        for at in slots:
            held[self.values[at]][value[at]] += 1
        kept = {}
        for own, values in held.items():
            most, n = values.most_common(1)[0]
            kept[own] = own if own in values else most if 2 * n > values.total() else None
        torn = None in kept.values()
        for at in slots:
            if value[at] != (self.values[at] if torn else kept[self.values[at]]) and value[at] != self.values[at]:
                same[at] = False
        if torn:  # words between slots of other values are no copy by themselves
            for begin, end in _runs(same):
                if end - begin < self.width:
                    same[begin:end] = False
        return same

    def long_run(self, same: np.ndarray) -> bool:
        """Whether a run at one offset is a passage by its length."""
        return any(
            self.before[e] - self.before[b] >= LONG_RUN and self.found.plain(b, e - b) * WINDOW >= LEAST_PLAIN * LONG_RUN for b, e in _runs(same & self.counts)
        )

    def share(self, doc: Template, offsets: list[int], min_share: float) -> float | None:
        """Share of the item's words that the document holds, null if that is no copy."""
        whole, everywhere, near, passage = np.zeros(len(self.good), bool), np.zeros(self.n, bool), [], False
        for offset in sorted(set(offsets)):
            same = self.agree(doc, offset)
            passage |= self.long_run(same)
            intact = np.concatenate(([0], np.cumsum(same)))
            held = intact[self.good + self.width] - intact[self.good] == self.width
            whole |= held
            for p in self.good[held].tolist():
                everywhere[p : p + self.width] = True
            for shift in range(1, SHIFT + 1):  # a word more or less moves the rest
                same = same | self.agree(doc, offset - shift) | self.agree(doc, offset + shift)
            near.append(same)
        best = max(int(((same | everywhere) & self.counts).sum()) for same in near)
        copied = best >= self.least or passage or whole.sum() >= min_share * len(self.good)
        return best / self.size if copied else None


def passages(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item, version, passage) of the rows with an id and a text; version tells the texts of an id apart."""
    text = F.col(text_col)
    rows = benchmark.select(F.col(id_col).cast("long").alias("item"), F.xxhash64(text).alias("version"), text.alias("passage")).distinct()
    return rows.where("item is not null and passage is not null")


def item_windows(items: DataFrame) -> DataFrame:
    """(item, version, at, width, hash) of the windows of every item of ``passages``; literal windows have widths below 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for item, version, text in zip(*(c.to_pylist() for c in batch.columns)):
                found = template(text)
                if len(found.codes) < LEAST_WORDS:
                    exact = _literal_codes(literal(text)[:LITERAL_WINDOW])
                    if len(exact):
                        rows.append((item, version, 0, -len(exact), _windows(exact, len(exact)).view(np.int64).tolist()[0]))
                    continue
                width = seed_width(len(found.codes))
                good = _good(found, width)
                for hashes in {tuple(_windows(codes, width).view(np.int64).tolist()) for codes in (found.codes, found.unnamed)}:
                    rows += [(item, version, p, width, hashes[p]) for p in good]
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64()]
            yield pa.record_batch([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], ["item", "version", "at", "width", "hash"])

    return items.mapInArrow(run, "item long, version long, at int, width int, hash long")


def document_windows(docs: DataFrame, wanted: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc, content, pos, width, hash) of the documents' windows that pass the bitmap of ``wanted``; content tells texts apart."""
    keys = wanted.select(F.pmod("hash", F.lit(BITS)).cast("int").alias("bit"), "width").distinct()
    marked = keys.toArrow()  # at most BITS rows a width, and WINDOW + LITERAL_WINDOW widths
    bitmap = np.zeros(BITS, bool)
    bitmap[marked.column("bit").to_numpy()] = True
    widths = sorted(set(marked.column("width").to_pylist()))
    exact_widths = [-w for w in widths if w < 0]
    widths = [w for w in widths if w > 0]
    shared = docs.sparkSession.sparkContext.broadcast(np.packbits(bitmap))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        for batch in batches:
            doc, content = (batch.column(k).to_numpy() for k in range(2))
            for first, texts in _blocks(batch.column(2)):
                found, bounds = _templates(texts)
                named = np.concatenate(([0], np.cumsum(found.kinds == NAME)))
                forms = [(False, 1, bounds, *w) for w in _each_width(found.codes, widths)]
                forms += [(True, 1, bounds, *w) for w in _each_width(found.unnamed, widths)] if named[-1] else []
                if exact_widths:
                    exact = [literal(t) for t in texts]
                    ends = np.cumsum([0] + [len(t) for t in exact])
                    codes = _literal_codes(list(itertools.chain.from_iterable(exact)))
                    forms += [(False, -1, ends, *w) for w in _each_width(codes, exact_widths)]
                for unnamed, sign, begins, width, hashes in forms:
                    hashes = hashes.view(np.int64)
                    bit = hashes % BITS
                    at = np.flatnonzero(bits[bit >> 3] >> (7 - (bit & 7)).astype(np.uint8) & 1)
                    row = np.searchsorted(begins, at, "right") - 1
                    within = at + width <= begins[row + 1]
                    if unnamed:  # without a name both forms are one
                        within &= named[at + width] > named[at]
                    at, row = at[within], row[within]
                    columns = [doc[first + row], content[first + row], (at - begins[row]).astype(np.int32), np.full(len(at), sign * width, np.int32), hashes[at]]
                    yield pa.record_batch([pa.array(c) for c in columns], ["doc", "content", "pos", "width", "hash"])

    return _texts(docs, id_col, text_col).mapInArrow(run, FOUND)


def _blocks(column: pa.Array) -> Iterator[tuple[int, list[str]]]:
    """Texts in runs of about ``BLOCK_CHARS``, each with the row of its first."""
    first, run, size = 0, [], 0
    for row, value in enumerate(column):
        run.append(value.as_py())
        size += len(run[-1])
        if size >= BLOCK_CHARS or row + 1 == len(column):
            yield first, run
            first, run, size = row + 1, [], 0


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.col(text_col)
    return docs.select(row_key(id_col, text_col).alias("doc"), F.xxhash64(text).alias("content"), text.alias("text")).where("text is not null")


def contaminations(
    docs: DataFrame, benchmark: DataFrame, min_share: float = MIN_SHARE, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """(doc, item, share): the items that a document holds, and the share of their words found."""
    items = passages(in_batches(benchmark), item_col, item_text)
    windows = item_windows(items)
    found = document_windows(docs, windows, id_col, text_col).withColumn("salt", F.pmod(F.xxhash64("doc"), F.lit(SALTS)).cast("int"))
    salted = windows.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    places = found.join(salted, ["hash", "width", "salt"]).groupBy("doc", "content", "item", "version").agg(
        F.collect_set(F.col("pos") - F.col("at")).alias("offsets")
    )
    # the texts of documents with a window in common are read again and compared word by word
    pairs = staged(places.join(items, ["item", "version"]), "places")
    pairs = _texts(docs, id_col, text_col).join(pairs, ["doc", "content"]).select("doc", "item", "text", "passage", "offsets")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        text, doc, exact, known = None, None, None, functools.lru_cache(KNOWN_ITEMS)(Passage)
        for batch in batches:
            rows = []
            for key, item, own, passage, offsets in zip(*(c.to_pylist() for c in batch.columns)):
                if own != text:
                    text, doc, exact = own, template(own), None
                wanted = known(passage)
                if wanted.literal is None:
                    share = wanted.share(doc, offsets, min_share)
                else:
                    exact = exact or literal(own)
                    n = len(wanted.literal)
                    share = 1.0 if any(exact[at : at + n] == wanted.literal for at in offsets) else None
                if share is not None:
                    rows.append((key, item, share))
            yield pa.record_batch([pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.float64()))], ["doc", "item", "share"])

    return pairs.mapInArrow(compare, "doc long, item long, share double").groupBy("doc", "item").agg(F.max("share").alias("share"))


def judge(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc, id, contaminated, n_items, first_item, best_share of every row."""
    found = contaminations(docs, benchmark, id_col=id_col, text_col=text_col).groupBy("doc").agg(
        F.count("*").alias("n_items"), F.min("item").alias("first_item"), F.max("share").alias("best_share")
    )
    rows = docs.select(row_key(id_col, text_col).alias("doc"), F.col(id_col).alias("id")).join(found, "doc", "left")
    return rows.select(
        "doc", "id", F.col("n_items").isNotNull().alias("contaminated"), F.coalesce("n_items", F.lit(0)).alias("n_items"),
        "first_item", F.coalesce("best_share", F.lit(0.0)).alias("best_share"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the documents that hold a benchmark item."""
    bad = contaminations(docs, benchmark, id_col=id_col, text_col=text_col).select(F.col("doc").alias("__bad")).distinct()
    rows = docs.withColumn("__doc", row_key(id_col, text_col))
    return rows.join(bad, F.col("__doc") == F.col("__bad"), "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
