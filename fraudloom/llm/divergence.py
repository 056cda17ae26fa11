"""Source divergence audit: how far the sources of a language lie apart, and by which terms.

Single-pass in-memory indexing. A task counts terms in memory per (language, source) until it holds
``MOST_ENTRIES`` entries, then lets them go as a run: postings sorted by language and term, a posting
being a source with occurrences and documents. Runs are dealt by the hash of language and term; in each
shard Spark's sort merges the runs (a heap over sorted pieces, spilled where memory ends), and one
streaming pass adds up equal terms and keeps those in ``MIN_DOCS`` documents. Divergences are streamed
over the kept postings: for two sources the sum over all kept terms is what it is where neither has
the term, times the number of terms, plus corrections where one has it (from histograms of counts) and
where both have it (from the postings), so no term is paired with sources that lack it.

All numbers are integers and exact: shares are per ``SCALE``, found by long division in steps of a
thousand, up to 9 * 10**15 occurrences of kept terms per language and divergences below 2**63.

Memory: a task holds one block of entries, the distinct terms of one document, or the sources of one
language; corrections of pairs are let go as partial sums once they exceed ``MOST_PAIRS``.

Defined cases: null text, lang and source are empty strings; a row is a document, repeated or not; texts
are read in pieces of ``PIECE_BYTES``, so long ones need no more memory than their distinct terms; ties
are ordered by the UTF-8 bytes of the item; a language without kept terms has divergences of 0 and no
terms; a language with one source has no pairs; an empty table gives an empty one. Other columns are not
read. Sources are told apart in postings by a 64-bit hash whose uniqueness is checked; on a clash the
next seed is taken.
"""
from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fraudloom.llm.text import in_batches, staged

MIN_DOCS = 3
TOP_TERMS = 200
SCALE = 1_000_000_000
MOST_ENTRIES = 300_000
MOST_PAIRS = 2_000_000
PIECE_BYTES = 1 << 20
ROWS_OUT = 20_000
#: Lower-cases A-Z, keeps a-z and bytes of non-ASCII characters, and makes a space of all else.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
RUN = "lang string, term string, sids array<long>, counts array<long>, docs array<long>"
KEPT = "lang string, term string, sids array<long>, counts array<long>"


def pieces(raw: bytes, size: int = PIECE_BYTES) -> Iterator[bytes]:
    """A folded text in parts that end between terms."""
    folded, at = raw.translate(_FOLD), 0
    while at < len(folded):
        end = len(folded) if at + size >= len(folded) else folded.find(b" ", at + size)
        end = len(folded) if end < 0 else end
        yield folded[at:end]
        at = end


class Block:
    """Counts of one block: per (lang, sid), occurrences and documents of every term."""

    def __init__(self) -> None:
        self.counts: dict[tuple, Counter] = defaultdict(Counter)
        self.docs: dict[tuple, Counter] = defaultdict(Counter)
        self.entries = 0

    def add(self, key: tuple, terms: list[bytes], seen: set[bytes]) -> None:
        """Terms of one piece; ``seen`` are the document's terms so far."""
        counts = self.counts[key]
        before = len(counts)
        counts.update(terms)
        fresh = set(terms) - seen if seen else set(terms)
        self.docs[key].update(fresh)
        seen |= fresh
        self.entries += len(counts) - before

    def run(self) -> Iterator[pa.RecordBatch]:
        """The postings sorted by language and term; the block is empty afterwards."""
        by_lang: dict[str, list[int]] = defaultdict(list)
        for lang, sid in self.counts:
            by_lang[lang].append(sid)
        for lang in sorted(by_lang):
            terms, sids, counts, docs = [], [], [], []
            for sid in by_lang[lang]:
                found, held = self.counts.pop((lang, sid)), self.docs.pop((lang, sid))
                terms += found
                sids.append(np.full(len(found), sid, np.int64))
                counts.append(np.fromiter(found.values(), np.int64, len(found)))
                docs.append(np.fromiter(map(held.__getitem__, found), np.int64, len(found)))
            yield from postings(lang, pa.array(terms, pa.large_binary()), *map(np.concatenate, (sids, counts, docs)))
        self.entries = 0


def postings(lang: str, terms: pa.Array, sids: np.ndarray, counts: np.ndarray, docs: np.ndarray) -> Iterator[pa.RecordBatch]:
    """One row per term in order of its bytes, with its entries."""
    coded = terms.dictionary_encode()
    order = pc.sort_indices(coded.dictionary).to_numpy()
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    place = rank[coded.indices.to_numpy()]
    by_term = np.argsort(place, kind="stable")
    offsets = np.concatenate(([0], np.cumsum(np.bincount(place, minlength=len(order)))))
    names = coded.dictionary.take(pa.array(order)).cast(pa.large_string()).cast(pa.string())
    yield from listed(lang, names, offsets, [x[by_term] for x in (sids, counts, docs)], ["sids", "counts", "docs"])


def listed(lang: str, terms: pa.Array, offsets: np.ndarray, values: list[np.ndarray], names: list[str]) -> Iterator[pa.RecordBatch]:
    """Rows of lists, ``ROWS_OUT`` at a time."""
    for at in range(0, len(terms), ROWS_OUT):
        cut = offsets[at : at + ROWS_OUT + 1]
        places = pa.array(cut - cut[0], pa.int32())
        lists = [pa.ListArray.from_arrays(places, pa.array(v[cut[0] : cut[-1]])) for v in values]
        part = terms.slice(at, ROWS_OUT)
        yield pa.record_batch([pa.array([lang] * len(part), pa.string()), part, *lists], ["lang", "term", *names])


def index_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of postings of (text, lang, sid) rows."""
    block = Block()
    for batch in batches:
        for text, lang, sid in zip(batch.column(0), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            seen: set[bytes] = set()
            for piece in pieces((text.as_py() or "").encode()):
                block.add((lang, sid), piece.split(), seen)
                if block.entries >= MOST_ENTRIES:
                    yield from block.run()
    yield from block.run()


def merge_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Kept terms with their counts per source, from rows of runs sorted by language and term."""
    held = None  # the last term of the batches so far, not known to be complete
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        if held is not None:
            table = pa.concat_tables([held, table])
        table = _added_up(table.combine_chunks())
        held = table.slice(table.num_rows - 1)
        yield from _kept(table.slice(0, table.num_rows - 1))
    if held is not None:
        yield from _kept(held)


def _values(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    lists = pa.concat_arrays(column.chunks) if column.num_chunks != 1 else column.chunk(0)
    offsets = lists.offsets.to_numpy()
    return lists.values.to_numpy()[offsets[0] : offsets[-1]], np.diff(offsets)


def _added_up(table: pa.Table) -> pa.Table:
    """One row per run of equal (lang, term), entries of one source added."""
    n = table.num_rows
    fresh = np.ones(n, bool)
    for name in ("lang", "term"):
        column = pa.concat_arrays(table[name].chunks) if table[name].num_chunks != 1 else table[name].chunk(0)
        differs = pc.not_equal(column.slice(1), column.slice(0, n - 1)).to_numpy(zero_copy_only=False)
        fresh[1:] = differs if name == "lang" else fresh[1:] | differs
    group = np.cumsum(fresh) - 1
    sids, sizes = _values(table["sids"])
    owner = np.repeat(group, sizes)
    order = np.lexsort((sids, owner))
    sids, owner = sids[order], owner[order]
    first = np.ones(len(sids), bool)
    first[1:] = (sids[1:] != sids[:-1]) | (owner[1:] != owner[:-1])
    starts = np.flatnonzero(first)
    summed = [np.add.reduceat(_values(table[c])[0][order], starts) for c in ("counts", "docs")]
    offsets = pa.array(np.concatenate(([0], np.cumsum(np.bincount(owner[starts], minlength=int(group[-1]) + 1)))), pa.int32())
    names = table.select(["lang", "term"]).take(pa.array(np.flatnonzero(fresh)))
    made = names
    for name, values in zip(("sids", "counts", "docs"), (sids[starts], *summed)):
        made = made.append_column(name, pa.ListArray.from_arrays(offsets, pa.array(values)))
    return made


def _kept(table: pa.Table) -> Iterator[pa.RecordBatch]:
    if not table.num_rows:
        return
    docs, sizes = _values(table["docs"])
    total = np.add.reduceat(docs, np.concatenate(([0], np.cumsum(sizes)[:-1])))
    yield from table.filter(pa.array(total >= MIN_DOCS)).drop_columns(["docs"]).to_batches(max_chunksize=ROWS_OUT)


def shares(counts: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """1 + floor(SCALE * (count + 1) / whole), exact for whole < 2**63 / 1000."""
    rest = counts + 1
    share = np.zeros(np.broadcast(rest, whole).shape, np.int64)
    for _ in range(3):
        scaled = rest * 1000
        share = share * 1000 + scaled // whole
        rest = scaled % whole
    return share + 1


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    gap = p - q
    return gap * gap // q


class Shard:
    """Sums over the kept terms of one shard of one language."""

    def __init__(self, lang: str, heads: list[tuple[int, int, int]]) -> None:
        heads = sorted(heads)
        self.lang = lang
        self.sids = np.array([s for s, _, _ in heads], np.int64)
        self.whole = np.array([n + v for _, n, v in heads], np.int64)  # occurrences of kept terms plus terms
        terms = heads[0][2]
        self.lang_whole = np.int64(self.whole.sum() - (len(heads) - 1) * terms)
        self.absent = shares(np.zeros(len(heads), np.int64), self.whole) if terms else None
        self.n_terms = 0
        self.histograms: list[Counter] = [Counter() for _ in heads]
        self.both: dict[str, list[np.ndarray]] = {"pair": [], "value": []}
        self.waiting = 0
        self.top: list[tuple[np.ndarray, np.ndarray, pa.Array]] = []
        self.top_rows = 0

    def add(self, terms: pa.Array, sids: np.ndarray, sizes: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.n_terms += len(terms)
        place = np.searchsorted(self.sids, sids)
        for s in np.unique(place):
            values, times = np.unique(counts[place == s], return_counts=True)
            self.histograms[s].update(dict(zip(values.tolist(), times.tolist())))
        p = shares(counts, self.whole[place])
        starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
        self._rank(terms, place, sizes, p, np.add.reduceat(counts, starts))
        yield from self._pair(place, sizes, starts, p)

    def _pair(self, place: np.ndarray, sizes: np.ndarray, starts: np.ndarray, p: np.ndarray) -> Iterator[pa.RecordBatch]:
        """What sources that both have a term add to the sums in which each counts alone."""
        for m in np.unique(sizes[sizes > 1]):
            of = starts[sizes == m]
            step = max(1, MOST_PAIRS // int(m))
            for at in range(0, len(of), step):
                where = of[at : at + step, None] + np.arange(m)
                src, share = place[where], p[where]
                for k in range(1, m):  # each source with the one k further on, round the list
                    a, b, pa_, pb = src, np.roll(src, -k, 1), share, np.roll(share, -k, 1)
                    za, zb = self.absent[a], self.absent[b]
                    value = divergence(pa_, pb) - divergence(pa_, zb) - divergence(za, pb) + divergence(za, zb)
                    self._collect((a * len(self.sids) + b).ravel(), value.ravel())
                    if self.waiting > MOST_PAIRS:
                        yield from self._let_go()

    def _collect(self, pair: np.ndarray, value: np.ndarray) -> None:
        order = np.argsort(pair, kind="stable")
        pair, value = pair[order], value[order]
        first = np.flatnonzero(np.concatenate(([True], pair[1:] != pair[:-1])))
        self.both["pair"].append(pair[first])
        self.both["value"].append(np.add.reduceat(value, first))
        self.waiting += len(first)

    def _let_go(self) -> Iterator[pa.RecordBatch]:
        if self.waiting:
            pair, value = np.concatenate(self.both["pair"]), np.concatenate(self.both["value"])
            self.both, self.waiting = {"pair": [], "value": []}, 0
            self._collect(pair, value)
            if self.waiting > MOST_PAIRS // 2:
                yield from self._pairs(self.both["pair"][0], self.both["value"][0])
                self.both, self.waiting = {"pair": [], "value": []}, 0

    def _rank(self, terms: pa.Array, place: np.ndarray, sizes: np.ndarray, p: np.ndarray, count: np.ndarray) -> None:
        """Keep terms that a source uses more than its language, at most the first ``TOP_TERMS`` of each."""
        q = np.repeat(shares(count, self.lang_whole), sizes)
        above = np.flatnonzero(p > q)
        owner = np.repeat(np.arange(len(terms)), sizes)[above]
        self.top.append((place[above], divergence(p[above], q[above]), terms.take(pa.array(owner))))
        self.top_rows += len(above)
        if self.top_rows > 4 * TOP_TERMS * len(self.sids) + ROWS_OUT:
            self._prune()

    def _prune(self) -> None:
        place = np.concatenate([t[0] for t in self.top])
        value = np.concatenate([t[1] for t in self.top])
        terms = pa.concat_arrays([t[2] for t in self.top])
        coded = terms.dictionary_encode()
        order = pc.sort_indices(coded.dictionary.cast(pa.binary())).to_numpy()
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        by = np.lexsort((rank[coded.indices.to_numpy()], -value, place))
        sorted_place = place[by]
        nth = np.arange(len(by)) - np.searchsorted(sorted_place, sorted_place)
        kept = by[nth < TOP_TERMS]
        self.top = [(place[kept], value[kept], terms.take(pa.array(kept)))]
        self.top_rows = len(kept)

    def _pairs(self, pair: np.ndarray, value: np.ndarray) -> Iterator[pa.RecordBatch]:
        n = len(self.sids)
        for at in range(0, len(pair), ROWS_OUT):
            part = pair[at : at + ROWS_OUT]
            yield self._rows(part // n, value[at : at + ROWS_OUT], other=self.sids[part % n])

    def _rows(self, place: np.ndarray, value: np.ndarray, other: np.ndarray | None = None, terms: pa.Array | None = None) -> pa.RecordBatch:
        n = len(place)
        return pa.record_batch([
            pa.array([self.lang] * n, pa.string()), pa.array(self.sids[place]),
            pa.nulls(n, pa.int64()) if other is None else pa.array(other), pa.nulls(n, pa.string()) if terms is None else terms, pa.array(value),
        ], ["lang", "sid", "other", "term", "value"])

    def finish(self) -> Iterator[pa.RecordBatch]:
        """Every pair's sum over the shard but for what was let go, and the first terms of each source."""
        n = len(self.sids)
        yield from self._let_go()
        pair = np.concatenate(self.both["pair"]) if self.waiting else np.empty(0, np.int64)
        value = np.concatenate(self.both["value"]) if self.waiting else np.empty(0, np.int64)
        alone = [tuple(np.array(x, np.int64) for x in (list(h), list(h.values()))) for h in self.histograms]
        for s in range(n):
            line = np.zeros(n, np.int64)
            if self.n_terms:
                both_absent = divergence(self.absent[s], self.absent)
                line += self.n_terms * both_absent
                counts, times = alone[s]
                mine = shares(counts, self.whole[s])
                line += ((divergence(mine[:, None], self.absent[None, :]) - both_absent) * times[:, None]).sum(0)
                for o in range(n):
                    counts, times = alone[o]
                    line[o] += ((divergence(self.absent[s], shares(counts, self.whole[o])) - both_absent[o]) * times).sum()
                low, high = np.searchsorted(pair, (s * n, (s + 1) * n))
                line[pair[low:high] - s * n] += value[low:high]
            others = np.flatnonzero(np.arange(n) != s)
            for at in range(0, len(others), ROWS_OUT):
                part = others[at : at + ROWS_OUT]
                yield self._rows(np.full(len(part), s), line[part], other=self.sids[part])
        if self.top_rows:
            self._prune()
            place, value, terms = self.top[0]
            for at in range(0, len(place), ROWS_OUT):
                cut = slice(at, at + ROWS_OUT)
                yield self._rows(place[cut], value[cut], terms=terms.slice(at, ROWS_OUT))


SUMS = "lang string, sid long, other long, term string, value long"


def stream_corrections(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of rows sorted by (lang, shard, is_term): each shard's sources come before its terms.

    A source's row holds its hash and its occurrences of kept terms; ``v`` is the language's number of them.
    """
    key, heads, shard = None, [], None
    for batch in batches:
        langs, shards, is_term = (batch.column(c) for c in ("lang", "shard", "is_term"))
        n = batch.num_rows
        if not n:
            continue
        change = np.ones(n, bool)
        change[1:] = False
        for column in (langs, shards, is_term):
            change[1:] |= pc.not_equal(column.slice(1), column.slice(0, n - 1)).to_numpy(zero_copy_only=False)
        starts = np.append(np.flatnonzero(change), n)
        for low, high in zip(starts[:-1].tolist(), starts[1:].tolist()):
            part = batch.slice(low, high - low)
            found = (langs[low].as_py(), shards[low].as_py())
            if found != key:
                if key is not None:
                    yield from (shard or Shard(key[0], heads)).finish()
                key, heads, shard = found, [], None
            sids, sizes = _values(pa.chunked_array([part.column("sids")]))
            counts, _ = _values(pa.chunked_array([part.column("counts")]))
            if not is_term[low].as_py():
                heads += zip(sids.tolist(), counts.tolist(), part.column("v").to_pylist())
                continue
            shard = shard or Shard(key[0], heads)
            yield from shard.add(part.column("term"), sids, sizes, counts)
    if key is not None:
        yield from (shard or Shard(key[0], heads)).finish()


def term_frequencies(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> tuple[DataFrame, DataFrame]:
    """(lang, term, sids, counts) of kept terms, and (lang, source, sid) of all groups."""
    for seed in range(8):
        lang, source = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (lang_col, source_col))
        sid = F.xxhash64(source, F.lit(seed))
        groups = staged(docs.select(lang.alias("lang"), source.alias("source"), sid.alias("sid")).distinct(), "divergence-groups")
        if groups.groupBy("lang", "sid").count().where("count > 1").isEmpty():
            break
    else:
        raise ValueError("names of sources share hashes under every seed")
    rows = in_batches(docs).select(F.col(text_col).cast("string").alias("text"), lang.alias("lang"), sid.alias("sid"))
    runs = rows.mapInArrow(index_blocks, RUN)
    in_order = runs.repartition("lang", "term").sortWithinPartitions("lang", "term")
    return staged(in_order.mapInArrow(merge_runs, KEPT), "divergence-terms"), groups


def audit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """(lang, source, part, item, value, rank): all other sources, and the terms a source stands out by."""
    spark = docs.sparkSession
    kept, groups = term_frequencies(docs, text_col, lang_col, source_col)
    n_shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    totals = kept.select("lang", F.explode(F.arrays_zip("sids", "counts")).alias("e")).groupBy("lang", F.col("e.sids").alias("sid")).agg(F.sum("e.counts").alias("n"))
    terms = kept.groupBy("lang").agg(F.count("*").alias("v"))
    known = staged(
        groups.join(totals, ["lang", "sid"], "left").join(terms, "lang", "left").fillna(0, ["n", "v"]), "divergence-totals")
    # A language's terms go to as many shards as it has terms for, each of which needs all its sources once.
    spread = F.least(F.lit(n_shards), F.expr(f"1 + v div {ROWS_OUT}")).cast("int")
    heads = known.select(
        "lang", F.explode(F.sequence(F.lit(0), spread - 1)).alias("shard"), F.lit(False).alias("is_term"), F.lit("").alias("term"),
        F.array("sid").alias("sids"), F.array("n").alias("counts"), "v")
    spreads = terms.select("lang", spread.alias("spread"))
    bodies = kept.join(spreads, "lang").select(
        "lang", F.pmod(F.xxhash64("term"), F.col("spread")).cast("int").alias("shard"), F.lit(True).alias("is_term"), "term", "sids", "counts",
        F.lit(0).cast("long").alias("v"))
    dealt = heads.unionByName(bodies).repartition("lang", "shard").sortWithinPartitions("lang", "shard", "is_term")
    sums = staged(dealt.mapInArrow(stream_corrections, SUMS), "divergence-sums")
    names = groups.select("lang", "sid", "source")
    others = names.select("lang", F.col("sid").alias("other"), F.col("source").alias("item"))
    pairs = sums.where(F.col("term").isNull()).groupBy("lang", "sid", "other").agg(F.sum("value").alias("value"))
    pairs = pairs.join(names, ["lang", "sid"]).join(others, ["lang", "other"]).select("lang", "source", F.lit("pair").alias("part"), "item", "value")
    found = sums.where(F.col("term").isNotNull()).join(names, ["lang", "sid"]).select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value")
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item"))
    return pairs.withColumn("rank", rank).unionByName(found.withColumn("rank", rank).where(F.col("rank") <= TOP_TERMS))
