"""Near copies by SetSketch registers: band, estimate by likelihood, verify, connect.

A document is the set of its word shingles. Documents with equal sets form a class, and one
representative of each goes on, so copies are never paired. A sketch has one register per hash
function: floor(1 - log_b(x)), truncated to 16 bits, of the smallest exponential value x that an
element takes. Registers are mergeable by maximum and equal more often the more alike two sets are.

1. Bands of registers deal the representatives into buckets.
2. Sets of candidates that have too many elements in no other set link with nothing and leave.
   Members of small buckets are paired. In a large bucket every member is paired with one centre,
   the member with the smallest share of elements of its own.
3. Each pair's similarity is estimated from both sketches jointly: the likelihood of how many
   registers are larger, smaller and equal, given both set sizes. Pairs that would have to be
   ``DOUBT`` log units less likely at the threshold than at the best similarity are let go.
4. The rest is verified on the full sets, and links are connected by smallest labels.
5. What a large bucket then holds outside its largest component is compared with all its members on
   the full sets, block by block, and only links leave a task.

Sets are compared by 64-bit hashes of shingles. A pair at the threshold shares no band with a
probability below 1e-6 for the settings used here. Nothing is capped: bucket sizes only choose
between the ways above.

Defined cases: a document without a shingle is linked with nothing; with fewer words than a shingle
has, its words as a whole are its one shingle; rows without id are told apart by their text;
rows that repeat an id stand for one document, of which one row stays when copies are dropped; the component's id is the smallest id in it (null if it has
none); an empty table gives an empty one.
"""
from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType

from fraudloom.llm.text import blocks, in_batches, mix, row_key, staged, struct_array, struct_type, words

#: Base of the register scale; the truncated range covers sets of up to 10**12 elements.
REGISTER_BASE = 1.05
SMALL_BUCKET = 24
#: Elements and members of a block; a pair of blocks is compared in tables of ``_CELLS`` cells.
CHUNK = 200_000
CHUNK_MEMBERS = 1_000
DOUBT = 14.0
SET = struct_type(hi=LongType(), lo=LongType(), elements=ArrayType(LongType()))
_ELEMENTS_AT_ONCE = 512
_CELLS = 1 << 22


@dataclass(frozen=True)
class Settings:
    """Words of a shingle, percent of similarity that links, bands and registers in each."""

    width: int = 3
    percent: int = 85
    bands: int = 32
    rows: int = 6

    @property
    def registers(self) -> int:
        return self.bands * self.rows


EXACT_85 = Settings()
#: For five words at 0.8: a pair at the threshold is missed with a probability of 1e-7.
FIVE_AT_80 = Settings(width=5, percent=80, bands=40, rows=5)


@functools.cache
def _hashes(n: int) -> tuple[np.ndarray, np.ndarray]:
    dice = np.random.default_rng(1989)
    return dice.integers(0, 2**63, n, np.uint64), dice.integers(0, 2**63, n, np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_sets(run: list[bytes], width: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; A-Z count as a-z."""
    found = words([raw.lower() for raw in run])
    hashes, first = found.windows(width)
    at = np.searchsorted(first, found.bounds)
    sets = []
    for k, n in enumerate(found.counts):
        if n >= width:
            sets.append(np.unique(hashes[at[k] : at[k + 1]]))
        else:  # one shingle that no longer sequence can equal
            own = found.hashes[found.bounds[k] : found.bounds[k + 1]]
            whole = np.uint64(n)
            for x in own:
                whole = mix(np.array([whole ^ x]))[0]
            sets.append(np.array([whole] if n else [], np.uint64))
    return sets


def _name(found: np.ndarray) -> tuple[int, int] | tuple[None, None]:
    """128 bits that tell sets apart; nulls for the empty set."""
    return tuple(np.frombuffer(xxhash.xxh3_128_digest(found.tobytes()), "<i8").tolist()) if len(found) else (None, None)


def sketch(elements: np.ndarray, registers: int) -> np.ndarray:
    """The registers of a set of uniform 64-bit hashes, which is not empty."""
    spread, factor = _hashes(registers)
    least = np.full(registers, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(elements), _ELEMENTS_AT_ONCE):
        values = elements[at : at + _ELEMENTS_AT_ONCE, None] ^ spread
        values *= factor
        np.minimum(least, values.min(0), out=least)
    exponential = -np.log1p(-(least.astype(np.float64) + 0.5) / 2.0**64)
    return np.clip(np.floor(1 - np.log(exponential) / np.log(REGISTER_BASE)), 0, 65535).astype("<u2")


def likelihood_gap(above: np.ndarray, below: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, m: int, level: float) -> np.ndarray:
    """Log likelihood of the best similarity below ``level`` less that of ``level``; infinite if sizes exclude it.

    ``above`` and ``below`` count the registers in which a is larger or smaller than b.
    """
    total = (n_a + n_b).astype(float)
    u, v = n_a / total, n_b / total
    most = np.minimum(n_a, n_b) / np.maximum(n_a, n_b)

    def value(j: np.ndarray) -> np.ndarray:
        step = (REGISTER_BASE - 1) / REGISTER_BASE
        scale = np.log(REGISTER_BASE)
        # a's own part of the union holds the minimum with a lead that the register scale can show
        up = -np.log1p(-np.clip(u - v * j, 0, 1) * step) / scale
        down = -np.log1p(-np.clip(v - u * j, 0, 1) * step) / scale
        same = np.clip(1 - up - down, 1e-12, 1)
        return above * np.log(np.clip(up, 1e-12, 1)) + below * np.log(np.clip(down, 1e-12, 1)) + (m - above - below) * np.log(same)

    # the likelihood has one peak: where it lies at or above the level, no lower similarity does better
    lower = np.max([value(np.minimum(j, most)) for j in np.arange(level % 0.05 + 0.3, level, 0.05)], 0)
    return np.where(most < level - 1e-9, np.inf, lower - value(np.minimum(level, most)))


def _registers(column: pa.Array, m: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<u2").reshape(-1, m)


def sketches(docs: DataFrame, settings: Settings, id_col: str, text_col: str) -> DataFrame:
    """(doc, id, text_key, n, hi, lo, registers) of every row; hi and lo name its set, null if that is empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, names, rows = [], [], []
            for texts in blocks(batch.column(2)):
                for found in shingle_sets(texts, settings.width):
                    n.append(len(found))
                    names.append(_name(found))
                    rows.append(sketch(found, settings.registers).tobytes() if len(found) else None)
            yield pa.record_batch([
                batch.column(0), batch.column(1), batch.column(3), pa.array(n, pa.int64()), pa.array([x for x, _ in names], pa.int64()),
                pa.array([x for _, x in names], pa.int64()), pa.array(rows, pa.binary()),
            ], ["doc", "id", "text_key", "n", "hi", "lo", "registers"])

    text = F.col(text_col)
    rows = docs.select(row_key(id_col, text_col).alias("doc"), F.col(id_col).cast("long").alias("id"), text.alias("text"), F.xxhash64(text).alias("text_key"))
    return rows.mapInArrow(run, "doc long, id long, text_key long, n long, hi long, lo long, registers binary")


def _members(representatives: DataFrame, settings: Settings) -> DataFrame:
    """(bucket, doc): one row per band; the bucket is a hash of the band and its registers."""
    size = 2 * settings.rows
    bands = F.array(*[
        F.xxhash64(F.lit(k), F.substring("registers", k * size + 1, size)) for k in range(settings.bands)
    ])
    return representatives.select(F.explode(bands).alias("bucket"), "doc")


def _ordered(a: str, b: str) -> list:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def _possible(n_a, u_a, n_b, u_b, percent: int):
    """Whether sizes and own elements leave room for a link: what is in no other set is not shared."""
    most = [n_a - u_a, n_b - u_b]
    need = percent * (n_a + n_b)
    return ((100 + percent) * most[0] >= need) & ((100 + percent) * most[1] >= need)


def _likely(pairs: DataFrame, sketched: DataFrame, settings: Settings) -> DataFrame:
    """The pairs that sizes and the estimate let pass."""
    m, level = settings.registers, settings.percent / 100

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = _registers(batch.column(3), m), _registers(batch.column(5), m)
            gap = likelihood_gap(
                (left > right).sum(1), (left < right).sum(1), batch.column(2).to_numpy(), batch.column(4).to_numpy(), m, level
            )
            yield batch.select(["a", "b"]).filter(pa.array(gap <= DOUBT))

    sides = [
        sketched.select(F.col("doc").alias(x), *[F.col(c).alias(f"{c}_{x}") for c in ("n", "u", "registers")]) for x in "ab"
    ]
    first = pairs.distinct().join(sides[0], "a")
    possible = _possible(F.col("n_a"), F.col("u_a"), F.col("n_b"), F.col("u_b"), settings.percent)
    joined = first.join(sides[1], (first["b"] == sides[1]["b"]) & possible).select(
        "a", sides[1]["b"], "n_a", "registers_a", "n_b", "registers_b"
    )
    return joined.mapInArrow(test, "a long, b long")


def _verified(pairs: DataFrame, sets: DataFrame, settings: Settings) -> DataFrame:
    """The pairs that are links: percent * union <= 100 * intersection on the full sets."""

    @F.arrow_udf(LongType())
    def shared(left: pa.Array, right: pa.Array) -> pa.Array:
        return pa.array([
            len(np.intersect1d(x.values.to_numpy(), y.values.to_numpy(), assume_unique=True)) for x, y in zip(left, right)
        ], pa.int64())

    sides = [sets.select(F.col("doc").alias(x), F.col("n").alias(f"n_{x}"), F.col("elements").alias(f"s_{x}")) for x in "ab"]
    joined = pairs.join(sides[0], "a").join(sides[1], "b").withColumn("__both", shared("s_a", "s_b"))
    union = F.col("n_a") + F.col("n_b") - F.col("__both")
    return joined.where(100 * F.col("__both") >= settings.percent * union).select("a", "b")


def components(links: DataFrame) -> DataFrame:
    """(node, label): the smallest node reachable, for every node of a link.

    A round takes the smallest label of the neighbours and then the label's own label, so long
    chains halve; each round is written out, and only counts come to the driver.
    """
    both = staged(links.select("a", "b").union(links.select("b", "a")).distinct(), "links")
    labels = staged(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("label")), "labels")
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        lower = labels.join(near, "node").select("node", F.col("label").alias("was"), F.least("label", "near").alias("label"))
        owners = labels.select(F.col("node").alias("label"), F.col("label").alias("next"))
        after = staged(
            lower.join(owners, "label", "left").select("node", "was", F.least("label", F.coalesce("next", "label")).alias("label")), "labels"
        )
        labels = after.select("node", "label")
        if after.where("was <> label").isEmpty():
            return labels


def _stars(members: DataFrame) -> DataFrame:
    """Each bucket's members paired with its centre, the one with the smallest share of elements of its own."""
    order = F.struct((F.col("u") / F.col("n")).alias("own"), F.xxhash64("doc").alias("o"), F.col("doc").alias("centre"))
    centres = members.groupBy("bucket").agg(F.min(order).alias("c")).select("bucket", "c.centre")
    return members.join(centres, "bucket").where("doc <> centre").select(*_ordered("doc", "centre"))


def _torn(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Members of buckets of several components, with their label, the bucket's largest component and its elements."""
    labelled = members.join(labels.withColumnRenamed("node", "doc"), "doc", "left").withColumn("label", F.coalesce("label", "doc"))
    parts = labelled.groupBy("bucket", "label").agg(F.count("*").alias("size"), F.sum("n").alias("elements"))
    largest = (
        parts.groupBy("bucket").agg(F.max(F.struct("size", "label")).alias("top"), F.count("*").alias("n_parts"), F.sum("elements").alias("elements"), F.sum("size").alias("members"))
        .where("n_parts > 1").select("bucket", F.col("top.label").alias("main"), "members", F.col("elements").alias("all"))
    )
    return labelled.join(largest, "bucket")


def _common(x: list[np.ndarray], y: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections of two lists of sorted sets."""
    left, right = np.concatenate(x), np.concatenate(y)
    both = np.intersect1d(left, right)
    tables = []
    for sets, flat in ((x, left), (y, right)):
        rows, at = np.repeat(np.arange(len(sets)), [len(s) for s in sets]), np.searchsorted(both, flat)
        hit = at < len(both)
        hit[hit] = both[at[hit]] == flat[hit]
        tables.append((rows[hit], at[hit]))
    found, width = np.zeros((len(x), len(y)), np.float32), max(1, _CELLS // max(len(x), len(y)))
    for low in range(0, len(both), width):
        parts = []
        for sets, (rows, at) in zip((x, y), tables):
            here = (at >= low) & (at < low + width)
            part = np.zeros((len(sets), min(width, len(both) - low)), np.float32)
            part[rows[here], at[here] - low] = 1
            parts.append(part)
        found += parts[0] @ parts[1].T
    return np.rint(found).astype(np.int64)


def _rest(torn: DataFrame, sets: DataFrame, settings: Settings) -> DataFrame:
    """Links in torn buckets across components, one side outside the bucket's largest component.

    Members meet in blocks of about ``CHUNK`` elements and at most some ``CHUNK_MEMBERS`` members, which
    are compared on their full sets; a task holds two blocks, and only links leave it.
    """
    rows = torn.join(sets.select("doc", "elements"), "doc")
    n_chunks = F.ceil(F.greatest(F.col("all") / CHUNK, F.col("members") / CHUNK_MEMBERS)).cast("long")
    chunk = F.pmod(F.xxhash64("doc"), n_chunks)

    def packed(rows: DataFrame, side: str) -> DataFrame:
        members = F.collect_list(F.struct("doc", "label", "n", "u", "elements"))
        return rows.groupBy("bucket", n_chunks.alias("n_chunks"), chunk.alias("chunk")).agg(members.alias(side))

    # Each block goes to every block of the other side by that block's number, so a bucket's pairs are dealt out.
    others = F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_chunks") - 1)).alias("chunk")
    x = packed(rows.where("label <> main"), "x").select("bucket", "x", others)
    chunks = x.join(packed(rows, "y"), ["bucket", "chunk"]).select("x", "y")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for pair in zip(batch.column(0), batch.column(1)):
                sides = [side.values for side in pair]
                doc, label, n, u = (
                    [side.field(k).to_numpy() for side in sides] for k in ("doc", "label", "n", "u")
                )
                hit = (label[0][:, None] != label[1]) & _possible(n[0][:, None], u[0][:, None], n[1], u[1], settings.percent)
                stay = [np.flatnonzero(hit.any(1)), np.flatnonzero(hit.any(0))]
                if len(stay[0]):
                    found = [[side.field("elements")[int(k)].values.to_numpy() for k in own] for side, own in zip(sides, stay)]
                    common = _common(*found)
                    sizes = n[0][stay[0]][:, None] + n[1][stay[1]]
                    linked = hit[np.ix_(*stay)] & (100 * common >= settings.percent * (sizes - common))
                    a, b = (doc[k][stay[k][at]] for k, at in enumerate(np.nonzero(linked)))
                    yield pa.record_batch([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])

    return chunks.mapInArrow(compare, "a long, b long").distinct()


def _own_elements(sets: DataFrame) -> DataFrame:
    """(doc, u): how many elements of a set are in no other of the sets; counted in parts before they meet."""
    alone = sets.select("doc", F.explode("elements").alias("e")).groupBy("e").agg(F.count("*").alias("c"), F.min("doc").alias("doc"))
    return alone.where("c = 1").groupBy("doc").agg(F.count("*").alias("u"))


def near_duplicates(docs: DataFrame, settings: Settings = EXACT_85, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc (key), id, n_shingles, component_id, kept, and text_key and component of every row.

    ``kept`` is true for the document of each component that stays. An id may have several texts: of one
    component these are copies, of several they are documents that share an id. ``component`` tells
    components apart, and rows without words by their text.
    """
    rows = staged(sketches(in_batches(docs), settings, id_col, text_col), "sketches")
    classes = rows.where("n > 0").groupBy("hi", "lo").agg(
        F.min(F.struct("doc", "n", "registers")).alias("r"), F.min("id").alias("least_id")
    ).select("hi", "lo", F.col("r.doc").alias("least_doc"), "r.n", "r.registers", "least_id")
    # a class goes by its first document, or by its name where an id that has several texts is first twice
    first = classes.groupBy("least_doc").agg(F.min(F.struct("hi", "lo")).alias("f"))
    node = F.when((F.col("f.hi") == F.col("hi")) & (F.col("f.lo") == F.col("lo")), F.col("least_doc")).otherwise(F.xxhash64("hi", "lo"))
    classes = staged(classes.join(first, "least_doc").withColumn("doc", node).drop("f"), "classes")
    sketched = classes.select("doc", "n", "registers")

    members = _members(sketched, settings)
    shared = members.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1").select("bucket")
    members = staged(members.join(shared, "bucket"), "members")
    wanted = classes.select("least_doc", "hi", "lo", "doc").join(members.select("doc").distinct(), "doc", "left_semi")
    sets = staged(full_sets(docs, wanted, settings, id_col, text_col), "sets")

    # sets of which too large a part is in no other set link with nothing
    bounds = sets.select("doc", "n").join(_own_elements(sets), "doc", "left").fillna(0, "u").where(F.col("u") * 100 <= F.col("n") * (100 - settings.percent))
    sketched = staged(sketched.drop("n").join(bounds, "doc"), "candidates")
    members = members.join(sketched.select("doc", "n", "u"), "doc")
    sizes = members.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    members = staged(members.join(sizes, "bucket"), "members")
    small = members.where(F.col("size") <= SMALL_BUCKET)
    large = members.where(F.col("size") > SMALL_BUCKET).drop("size")

    together = small.groupBy("bucket").agg(F.sort_array(F.collect_list("doc")).alias("d"))  # at most SMALL_BUCKET
    each = together.select("d", F.posexplode("d").alias("p", "a"))
    paired = each.select("a", F.explode(F.slice("d", F.col("p") + 2, F.lit(SMALL_BUCKET))).alias("b"))

    likely = staged(_likely(paired.union(_stars(large)), sketched, settings), "likely")
    links = staged(_verified(likely, sets, settings), "links")
    labels = components(links)
    torn = staged(_torn(large, labels), "torn")
    if not torn.isEmpty():
        links = links.union(staged(_rest(torn, sets, settings), "links"))
        labels = components(links)

    named = classes.select("hi", "lo", "doc", "least_id", "least_doc").join(labels.withColumnRenamed("node", "doc"), "doc", "left")
    named = named.withColumn("label", F.coalesce("label", "doc"))
    best = named.groupBy("label").agg(F.min("least_id").alias("component_id"), F.min("least_doc").alias("first_doc"))
    named = named.join(best, "label").select("hi", "lo", "label", "component_id", "first_doc")
    out = rows.select("doc", "id", "text_key", F.col("n").alias("n_shingles"), "hi", "lo").join(named, ["hi", "lo"], "left")
    alone = F.col("n_shingles") == 0
    return out.select(
        "doc", "id", "n_shingles", F.when(alone, F.col("id")).otherwise(F.col("component_id")).alias("component_id"),
        F.when(alone, F.lit(True)).otherwise(
            F.coalesce(F.col("id") == F.col("component_id"), F.col("component_id").isNull() & (F.col("doc") == F.col("first_doc")))
        ).alias("kept"), "text_key", F.when(alone, F.col("text_key")).otherwise(F.col("label")).alias("component"),
    )


def full_sets(docs: DataFrame, wanted: DataFrame, settings: Settings, id_col: str, text_col: str) -> DataFrame:
    """(doc, n, elements): the full set of each wanted class, from the text of its first document."""

    @F.arrow_udf(SET)
    def elements(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            sets = [s for run in blocks(texts) for s in shingle_sets(run, settings.width)]
            flat = np.concatenate(sets).view(np.int64) if sets else np.empty(0, np.int64)
            names = [_name(s) for s in sets]
            yield struct_array({
                "hi": pa.array([x for x, _ in names], pa.int64()), "lo": pa.array([x for _, x in names], pa.int64()),
                "elements": pa.ListArray.from_arrays(pa.array(np.cumsum([0] + [len(s) for s in sets]), pa.int32()), pa.array(flat)),
            })

    texts = docs.select(row_key(id_col, text_col).alias("least_doc"), F.col(text_col).alias("text"))
    found = texts.join(wanted, "least_doc").withColumn("s", elements("text"))
    found = found.where((F.col("s.hi") == F.col("hi")) & (F.col("s.lo") == F.col("lo")))
    return found.select("doc", F.size("s.elements").cast("long").alias("n"), F.col("s.elements").alias("elements")).dropDuplicates(["doc"])


def drop_near_duplicates(docs: DataFrame, settings: Settings, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each component, in the old columns.

    Of equal rows one stays. Unlike texts under one id all stay; of linked ones under one id, the one with the
    smallest hash.
    """
    found = near_duplicates(docs, settings, id_col, text_col).where("kept")
    kept = found.groupBy("doc", "component", F.col("n_shingles") == 0).agg(F.min("text_key").alias("__text"))
    rows = docs.withColumns({"__doc": row_key(id_col, text_col), "__text": F.xxhash64(text_col)})
    kept = kept.select(F.col("doc").alias("__doc"), "__text").distinct()
    stay = rows.join(kept, ["__doc", "__text"], "left_semi").dropDuplicates(["__doc", "__text"])
    return stay.select(*[F.col(f"`{c}`") for c in docs.columns])
