"""Prefix trie of conversations that share heads, from fingerprints alone.

A conversation is rebuilt from the head of its base and its own later turns. Every turn is an affine map
x -> B x + t over four prime fields; a sequence of turns is the product of its maps, and products of
ranges follow from running sums of the original turns. The fingerprint of a rebuilt prefix is the
product of the base's head and of the own suffix, composed without putting the two together: no text
is joined, copied or moved for it. Equal fingerprints at one depth form a node.

Verification makes nodes exact. A group counts as one node only if all its members agree in the
fingerprint of their parent and in the identity of their last turn, and turns of one identity are
compared by role and text wherever a group refers to more than one stored turn. If any
disagree, the whole is hashed anew under the next hashing.

Subtree sums need no walk over levels: a node is owned by its smallest member, each member sums the
nodes it owns from a depth down to its end, and a node's subtree is the sum over its members.

Large groups: the order within a conversation that holds very many turns is found in segments, running
sums go by blocks of ``BLOCK`` turns, and ids of conversations that end in a node are joined by chunks of
``CHUNK`` ids and hashed chunk by chunk as a stream.

Defined cases: null role or text is empty; null turns come first; turns with equal numbers are ordered by
their identity, a hash of role and text; repeated rows are turns of their own; rows without conv_id
belong to no conversation; an empty table gives no node, not even a root; other columns are not read.
"""
from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fraudloom.llm.text import staged
from fraudloom.plans.hot_keys import IS_CONTEXT, SEGMENT, segment_hot_keys

BLOCK = 4096
CHUNK_BITS = 10  # ids of one chunk agree in all but so many bits
SALTS = 16
LANES = range(4)
KEY = ["depth", "hi", "lo"]
_MASK = (1 << 31) - 1


@dataclass(frozen=True)
class Hashing:
    """A salt for turn identities, and a prime field and base for each lane."""

    salt: str
    primes: tuple[int, ...] = (2147483647, 2147483629, 2147483587, 2147483579)
    bases: tuple[int, ...] = (1103515245, 1812433253, 1664525013, 2010881777)


HASHINGS = tuple(Hashing(f"trie-{k}", bases=tuple(b + 7919 * k for b in Hashing("").bases)) for k in range(4))


@dataclass(frozen=True)
class Rebuild:
    """Which conversation lends its head, and how many turns of it, at most ``most``."""

    base: Callable[[Column], Column] = lambda c: c - c % 100
    head: Callable[[Column], Column] = lambda c: (F.crc32(c.cast("string")) % 6).cast("int")
    most: int = 5


@dataclass(frozen=True)
class Trie:
    """``nodes``: one row per node. ``members``: one row per conversation and depth from 1 on, with the
    node's key (depth, hi, lo) and the stored turn (ref_conv, ref_pos) that it ends in."""

    nodes: DataFrame
    members: DataFrame


def _power(exponent: str, base: int, prime: int) -> Column:
    """``base`` to the power of a column mod ``prime``, from tables for each hex digit."""
    made = None
    for k in range(8):
        table = ", ".join(f"{pow(base, d << 4 * k, prime)}L" for d in range(16))
        factor = F.expr(f"get(array({table}), cast(shiftright({exponent}, {4 * k}) & 15 as int))")
        made = factor if made is None else made * factor % prime
    return made


def _identified(turns: DataFrame, salt: str) -> DataFrame:
    """conv_id, turn, role, text (never null but turn) and ``t``, the 128-bit identity of role and text."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = turns.where(F.col("conv_id").isNotNull()).select("conv_id", "turn", role.alias("role"), text.alias("text"))
    return rows.withColumn("t", F.md5(F.concat(F.lit(salt), F.length("role").cast("string"), F.lit(":"), "role", "text")))


def _placed(turns: DataFrame) -> DataFrame:
    """Turns with ``pos``, their place in the conversation from 0."""
    order = ("has_turn", "turn_no", "t")
    rows = turns.select(
        "conv_id", F.col("turn").isNotNull().alias("has_turn"), F.coalesce("turn", F.lit(0)).alias("turn_no"), "t",
        F.length("text").cast("long").alias("len"))
    cut = segment_hot_keys(rows, "conv_id", order, 1, order)
    rank = F.row_number().over(Window.partitionBy(*cut.keys).orderBy(*order)) - 1
    if not cut.split:
        return rows.select("conv_id", rank.cast("long").alias("pos"), "t", "len")
    own = cut.rows.where(~F.col(IS_CONTEXT))
    earlier = Window.partitionBy("conv_id").orderBy(SEGMENT).rowsBetween(Window.unboundedPreceding, -1)
    bases = own.groupBy("conv_id", SEGMENT).count().select("conv_id", SEGMENT, F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("base"))
    return own.withColumn("rank", rank).join(bases, ["conv_id", SEGMENT]).select(
        "conv_id", (F.col("rank") + F.col("base")).cast("long").alias("pos"), "t", "len")


def _running(rows: DataFrame, key: str, place: str, columns: list[str], descending: bool = False) -> DataFrame:
    """``rows`` with each column replaced by its sum up to the row, by blocks of places per key."""
    rows = rows.withColumn("block", F.col(place).bitwiseAND(F.lit(~(BLOCK - 1))))
    order = [F.col(c).desc() if descending else F.col(c) for c in ("block", place)]
    long_ones = rows.groupBy(key, "block").agg(*[F.sum(c).alias(f"{c}_base") for c in columns])
    upto = Window.partitionBy(key).orderBy(order[0]).rowsBetween(Window.unboundedPreceding, -1)
    bases = long_ones.select(key, "block", *[F.sum(f"{c}_base").over(upto).alias(f"{c}_base") for c in columns]).where(F.col(f"{columns[0]}_base").isNotNull())
    inside = Window.partitionBy(key, "block").orderBy(order[1]).rowsBetween(Window.unboundedPreceding, 0)
    summed = rows.withColumns({c: F.sum(c).over(inside) for c in columns}).join(bases, [key, "block"], "left")
    whole = {c: F.col(c) + F.coalesce(F.col(f"{c}_base"), F.lit(0)) for c in columns}
    return summed.withColumns(whole).drop("block", *[f"{c}_base" for c in columns])


def turn_products(turns: DataFrame, how: Hashing) -> DataFrame:
    """(conv_id, pos, t1, t2, len, w0.., a0..): a turn's weighted value, and the sum up to it, per lane."""
    placed = staged(_placed(_identified(turns, how.salt)), "trie-places")
    number = lambda start, width: F.conv(F.substring("t", start, width), 16, 10).cast("long")
    weights = {
        f"w{k}": number(1 + 8 * k, 8) % how.primes[k] * _power("pos", how.bases[k], how.primes[k]) % how.primes[k]
        for k in LANES
    }
    rows = placed.select("conv_id", "pos", number(1, 15).alias("t1"), number(16, 15).alias("t2"), "len", *[w.alias(n) for n, w in weights.items()])
    summed = _running(rows.withColumns({f"a{k}": F.col(f"w{k}") for k in LANES}), "conv_id", "pos", [f"a{k}" for k in LANES])
    return summed.withColumns({f"a{k}": F.col(f"a{k}") % how.primes[k] for k in LANES})


def _packed(lanes: list[Column], hi: str, lo: str) -> list[Column]:
    pair = lambda a, b: F.shiftleft(a, 31).bitwiseOR(b)
    return [pair(lanes[0], lanes[1]).alias(hi), pair(lanes[2], lanes[3]).alias(lo)]


def _keys(after: list[Column], weight: list[Column], primes: tuple[int, ...]) -> list[Column]:
    """Fingerprint of a prefix and, without its last turn, of its parent."""
    before = [F.pmod(a - w, F.lit(p)) for a, w, p in zip(after, weight, primes)]
    return [*_packed(after, "hi", "lo"), *_packed(before, "parent_hi", "parent_lo")]


def rebuilt(turns: DataFrame, how: Hashing, rule: Rebuild) -> tuple[DataFrame, DataFrame]:
    """Members by depth (from 1 on), and every conversation with its rebuilt length."""
    primes = how.primes
    products = staged(turn_products(turns, how), "trie-turns")
    early = F.when(F.col("pos") < rule.most, F.struct("pos", "t1", "t2", "len", *[f"{x}{k}" for x in "wa" for k in LANES]))
    convs = products.groupBy("conv_id").agg(F.count("*").alias("n"), F.sort_array(F.collect_list(early)).alias("first"))
    convs = convs.withColumns({"base": rule.base(F.col("conv_id")), "h": rule.head(F.col("conv_id"))})
    heads = convs.where(F.col("conv_id") == F.col("base")).select("base", F.col("first").alias("heads"))
    convs = convs.join(heads, "base", "left").withColumn("taken", F.least("h", F.coalesce(F.array_size("heads"), F.lit(0))))
    convs = convs.withColumn("length", F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0)))

    e = F.col("e")
    from_head = convs.where("taken > 0").select("conv_id", "base", "length", F.explode(F.slice("heads", F.lit(1), F.col("taken"))).alias("e")).select(
        "conv_id", "length", (e["pos"] + 1).alias("depth"), *_keys([e[f"a{k}"] for k in LANES], [e[f"w{k}"] for k in LANES], primes),
        e["t1"].alias("t1"), e["t2"].alias("t2"), e["len"].alias("len"), F.col("base").alias("ref_conv"), e["pos"].alias("ref_pos"))

    def at(array: str, n: str, lane: int) -> Column:
        return F.coalesce(F.get(F.col(array), F.col(n) - 1)[f"a{lane}"], F.lit(0))

    # The suffix was weighted from place h on and stands from place ``taken`` on: a power of the inverse base.
    shift = lambda k: F.get(F.array(*[F.lit(pow(how.bases[k], -j, primes[k])) for j in range(rule.most + 1)]), F.col("h") - F.col("taken"))
    frames = convs.where(F.col("n") > F.col("h")).select(
        "conv_id", "h", "taken", "length",
        *[at("heads", "taken", k).alias(f"head{k}") for k in LANES], *[at("first", "h", k).alias(f"cut{k}") for k in LANES],
        *[shift(k).cast("long").alias(f"shift{k}") for k in LANES],
        F.explode(F.sequence(F.lit(0).cast("long"), F.shiftright(F.col("n") - 1, 12))).alias("block"))
    own = products.withColumn("block", F.shiftright("pos", 12)).join(frames, ["conv_id", "block"]).where(F.col("pos") >= F.col("h"))
    after = [F.pmod(F.col(f"head{k}") + F.pmod(F.col(f"a{k}") - F.col(f"cut{k}"), F.lit(primes[k])) * F.col(f"shift{k}"), F.lit(primes[k])) for k in LANES]
    weight = [F.col(f"w{k}") * F.col(f"shift{k}") % primes[k] for k in LANES]
    from_own = own.select(
        "conv_id", "length", (F.col("taken") + F.col("pos") - F.col("h") + 1).alias("depth"), *_keys(after, weight, primes),
        "t1", "t2", "len", F.col("conv_id").alias("ref_conv"), F.col("pos").alias("ref_pos"))
    return staged(from_head.unionByName(from_own), "trie-members"), staged(convs.select("conv_id", "length"), "trie-convs")


_AGREE = ("parent_hi", "parent_lo", "t1", "t2", "len")


def _grouped(members: DataFrame) -> DataFrame:
    """One row per fingerprint and depth, and whether all its members agree."""
    same = [F.min(c) == F.max(c) for c in _AGREE]
    one_turn = (F.min("ref_conv") == F.max("ref_conv")) & (F.min("ref_pos") == F.max("ref_pos"))
    agree = same[0]
    for s in same[1:]:
        agree = agree & s
    return members.groupBy(*KEY).agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), *[F.min(c).alias(c) for c in _AGREE],
        agree.alias("agree"), one_turn.alias("one_turn"))


def _texts_agree(turns: DataFrame, groups: DataFrame, salt: str) -> bool:
    """Whether the stored turns of one identity are equal, for groups that refer to more than one."""
    shared = groups.where(~F.col("one_turn")).select("t1", "t2").distinct()
    salted = shared.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    number = lambda start: F.conv(F.substring("t", start, 15), 16, 10).cast("long")
    stored = _identified(turns, salt).select(
        "role", "text", number(1).alias("t1"), number(16).alias("t2"), F.pmod(F.xxhash64("conv_id", "turn"), F.lit(SALTS)).cast("int").alias("salt"))
    found = stored.join(salted, ["t1", "t2", "salt"], "left_semi").groupBy("t1", "t2").agg(
        ((F.min("role") == F.max("role")) & (F.min("text") == F.max("text"))).alias("same"))
    return found.where(~F.col("same")).isEmpty()


def _ends(members: DataFrame, convs: DataFrame) -> DataFrame:
    """SHA-256 of the ids of conversations that end in a node, in numeric order and joined by commas."""
    at_root = convs.where("length = 0").select(F.lit(0).cast("long").alias("depth"), F.lit(0).cast("long").alias("hi"), F.lit(0).cast("long").alias("lo"), "conv_id")
    ended = members.where(F.col("depth") == F.col("length")).select(*KEY, "conv_id").unionByName(at_root)
    chunks = ended.groupBy(*KEY, F.shiftright("conv_id", CHUNK_BITS).alias("chunk")).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("ids"))
    in_order = chunks.repartition(*KEY).sortWithinPartitions(*KEY, "chunk")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state, done = None, None, []

        def rows() -> pa.RecordBatch:
            columns = list(zip(*done)) or [()] * 4
            return pa.record_batch([*[pa.array(c, pa.int64()) for c in columns[:3]], pa.array(columns[3], pa.string())], [*KEY, "ends_sha256"])

        for batch in batches:
            done = []
            for depth, hi, lo, ids in zip(*[batch.column(n).to_pylist() for n in (*KEY, "ids")]):
                if key != (depth, hi, lo):
                    if key:
                        done.append((*key, state.hexdigest()))
                    key, state = (depth, hi, lo), hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            yield rows()
        done = [(*key, state.hexdigest())] if key else []
        yield rows()

    return in_order.mapInArrow(digest, "depth long, hi long, lo long, ends_sha256 string")


def _subtrees(nodes: DataFrame, members: DataFrame) -> DataFrame:
    """Childless nodes and saved characters in the subtree of every node from depth 1 on."""
    owned = nodes.select("conv_id", "depth", F.col("leaf").alias("n_leaves"), F.col("saved").alias("saved_tokens"))
    path = members.select("conv_id", *KEY).join(owned, ["conv_id", "depth"], "left").fillna(0, ["n_leaves", "saved_tokens"])
    below = _running(path, "conv_id", "depth", ["n_leaves", "saved_tokens"], descending=True)
    return below.groupBy(*KEY).agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"))


def _parents(nodes: DataFrame, root_id: int) -> DataFrame:
    """(depth, hi, lo, parent_conv_id) of nodes from depth 1 on.

    A parent has the same owner unless the node is the first that its owner owns; the parents of those
    are looked up, dealt over ``SALTS`` keys as one may have very many such children.
    """
    above = nodes.select("conv_id", (F.col("depth") + 1).alias("depth"), F.lit(True).alias("same_owner"))
    found = nodes.where("depth > 0").join(above, ["conv_id", "depth"], "left")
    first = found.where(F.col("same_owner").isNull() & (F.col("depth") > 1)).withColumn("salt", F.pmod(F.col("hi"), F.lit(SALTS)).cast("int"))
    owners = nodes.where("n_children > 0").select(
        (F.col("depth") + 1).alias("depth"), F.col("hi").alias("parent_hi"), F.col("lo").alias("parent_lo"), F.col("conv_id").alias("parent_conv_id"))
    wanted = first.select("depth", "parent_hi", "parent_lo").distinct()
    owners = owners.join(wanted, ["depth", "parent_hi", "parent_lo"]).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    looked_up = first.join(owners, ["depth", "parent_hi", "parent_lo", "salt"]).select(*KEY, "parent_conv_id")
    same = found.where(F.col("same_owner").isNotNull()).select(*KEY, F.col("conv_id").alias("parent_conv_id"))
    top = found.where(F.col("same_owner").isNull() & (F.col("depth") == 1)).select(*KEY, F.lit(root_id).cast("long").alias("parent_conv_id"))
    return same.unionByName(looked_up).unionByName(top)


def _trie(turns: DataFrame, groups: DataFrame, members: DataFrame, convs: DataFrame) -> DataFrame:
    spark = turns.sparkSession
    whole = convs.agg(F.count("*").alias("n"), F.min("conv_id").alias("least")).first()
    if not whole["n"]:
        return spark.createDataFrame([], "conv_id long, depth long, hi long, lo long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string")
    root = spark.createDataFrame(
        [(0, 0, 0, whole["least"], whole["n"], None, None, 0)],
        "depth long, hi long, lo long, conv_id long, n_convs long, parent_hi long, parent_lo long, len long")
    nodes = groups.select(*root.columns).unionByName(root)
    children = groups.groupBy((F.col("depth") - 1).alias("depth"), F.col("parent_hi").alias("hi"), F.col("parent_lo").alias("lo")).agg(F.count("*").alias("n_children"))
    nodes = nodes.join(children, KEY, "left").fillna(0, ["n_children"])
    nodes = staged(nodes.withColumns({
        "leaf": (F.col("n_children") == 0).cast("long"), "saved": (F.col("n_convs") - 1) * F.col("len")}), "trie-nodes")
    sums = _subtrees(nodes, members)
    total = nodes.agg(F.sum("leaf").alias("n_leaves"), F.sum("saved").alias("saved_tokens")).withColumns({k: F.lit(0).cast("long") for k in KEY})
    made = nodes.join(sums.unionByName(total), KEY, "left").join(_ends(members, convs), KEY, "left").join(_parents(nodes, whole["least"]), KEY, "left")
    return made.select(
        "conv_id", *KEY, "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit(b""), 256)).alias("ends_sha256"))


def build_trie(turns: DataFrame, rule: Rebuild = Rebuild(), hashings: tuple[Hashing, ...] = HASHINGS) -> Trie:
    """The trie of all rebuilt conversations of ``turns`` (conv_id, turn, role, text)."""
    for how in hashings:
        members, convs = rebuilt(turns, how, rule)
        groups = staged(_grouped(members), "trie-groups")
        if groups.where(~F.col("agree")).isEmpty() and _texts_agree(turns, groups, how.salt):
            return Trie(_trie(turns, groups, members, convs), members)
    raise ValueError("unlike conversations share fingerprints under every hashing")
