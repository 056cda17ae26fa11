"""Mixing, prefix trie and divergence audit against plain Python."""
from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from fraudloom.llm import divergence, mixing, trie
from fraudloom.plans import hot_keys

# ---- mixing ---------------------------------------------------------------------------------------------

SPACED = re.compile(r"[^\x20\x09-\x0D]+")


def targets(sizes: dict, weights=(1, 2, 3), cap=3) -> dict:
    """Shares by weight; what is above a cap is shared again among the others, until none is."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    fixed, left = {}, Fraction(sum(sizes.values()))
    while True:
        open_ = [s for s in names if s not in fixed]
        share = {s: left * weight[s] / sum(weight[o] for o in open_) for s in open_}
        over = [s for s in open_ if share[s] > cap * sizes[s]]
        if not over:
            return {**fixed, **share}
        for s in over:
            fixed[s] = Fraction(cap * sizes[s])
            left -= fixed[s]


def checked_mix(rows: list, found: list) -> None:
    """Sizes, targets and copies of a mix; what a source takes is off by one document at most."""
    sizes = Counter({s: 0 for _, s, _ in rows})
    for _, source, text in rows:
        sizes[source] += len(SPACED.findall(text or ""))
    want = targets(sizes)
    assert Counter((i, len(SPACED.findall(t or "")), sizes[s]) for i, s, t in rows) == Counter((r["doc_id"], r["size"], r["source_size"]) for r in found)
    for r in found:
        copies = r["taken"] / r["size"] if r["size"] else 0
        assert copies == int(copies) and copies <= 3 and r["taken"] >= 0


def test_mix_meets_targets_of_every_source(spark):
    rng = random.Random(5)
    rows = [(k, rng.choice(["a", "b", "B", "é", None, "zz"]), " ".join(["w"] * rng.randint(0, 60))) for k in range(6000)]
    rows += [(9000 + k, "hot", "one two three") for k in range(4000)] + [(k, "tiny", "x y") for k in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    found = mixing.taken(docs).collect()
    checked_mix([(i, s, t) for i, s, t in rows], found)
    sizes = Counter()
    for _, s, t in rows:
        sizes[s] += len(SPACED.findall(t))
    want, got, source = targets(sizes), Counter(), {i: s for i, s, _ in rows if i >= 3}
    for r in found:
        if r["doc_id"] >= 3:
            got[source[r["doc_id"]]] += r["taken"]
            assert r["target"] == pytest.approx(float(want[source[r["doc_id"]]]))
    for s in set(sizes) - {"tiny"}:
        assert abs(got[s] - want[s]) <= max(200, float(want[s]) / 100), s
    assert sorted(map(tuple, found), key=str) == sorted(map(tuple, mixing.taken(docs.repartition(7)).collect()), key=str)


def test_share_of_documents_is_the_fraction(spark):
    rows = [(k, "ab"[k % 2], "x " * (1 + k % 7)) for k in range(40_000)]
    found = mixing.taken(spark.createDataFrame(rows, "doc_id long, source string, text string")).collect()
    rate = {r["source_size"]: r["target"] / r["source_size"] for r in found}
    copies = defaultdict(Counter)
    for r in found:
        copies[r["source_size"]][r["taken"] // r["size"]] += 1
    for size, counted in copies.items():
        low = int(rate[size])
        assert set(counted) <= {low, low + 1}
        assert counted[low + 1] / counted.total() == pytest.approx(rate[size] - low, abs=0.02)


def test_mix_emits_whole_documents(spark, awkward, empty):
    found = {r["n_words"] for r in mixing.mix(awkward).collect()}
    assert found == {1}  # a column of the input with the name of an inner one
    counted = Counter(r["doc_id"] for r in mixing.mix(awkward).collect())
    want = Counter()
    for r in mixing.taken(awkward).collect():
        if r["size"]:
            want[r["doc_id"]] += r["taken"] // r["size"]
    sized = {r["doc_id"] for r in awkward.collect() if r["doc_id"] is not None and SPACED.search(r["text"] or "")}
    assert {k: v for k, v in counted.items() if k in sized} == {k: v for k, v in want.items() if v and k in sized}
    checked_mix([(r["doc_id"], r["source"], r["text"]) for r in awkward.collect()], mixing.taken(awkward).collect())
    assert mixing.taken(empty).count() == 0 and mixing.mix(empty).count() == 0


def test_many_sources_are_dealt_not_broadcast(spark, monkeypatch):
    rows = [(k, f"s{k % 50}", "x " * (k % 9)) for k in range(500)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    want = sorted(map(tuple, mixing.taken(docs).collect()))
    monkeypatch.setattr(mixing, "MOST_BROADCAST", 10)
    assert sorted(map(tuple, mixing.taken(docs).collect())) == want


def test_sources_without_words(spark):
    docs = spark.createDataFrame([(1, "a", None), (2, "b", ""), (3, None, " \n")], "doc_id long, source string, text string")
    assert {(r["source_size"], r["target"], r["taken"]) for r in mixing.taken(docs).collect()} == {(0, 0.0, 0)}


# ---- trie -------------------------------------------------------------------------------------------------

TURNS = "conv_id long, turn long, role string, text string"
NODE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def plain_trie(rows: list[tuple]) -> Counter:
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            identity = hashlib.md5(f"trie-0{len(role)}:{role}{text}".encode()).hexdigest()
            convs[c].append(((turn is not None, turn or 0, identity), (role, text)))
    own = {c: [x for _, x in sorted(v, key=lambda y: y[0])] for c, v in convs.items()}
    made = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (abs(c) % 100 if c >= 0 else -(abs(c) % 100))
        made[c] = tuple(own.get(base, [])[:h] + own[c][h:])
    nodes = defaultdict(list)
    for c, turns in made.items():
        for d in range(len(turns) + 1):
            nodes[turns[:d]].append(c)
    children = Counter(s[:-1] for s in nodes if s)
    leaves, saved = Counter(), Counter()
    for s, members in nodes.items():
        value = (len(members) - 1) * len(s[-1][1]) if s else 0
        for d in range(len(s) + 1):
            saved[s[:d]] += value
            leaves[s[:d]] += children[s] == 0
    found = Counter()
    for s, members in nodes.items():
        ends = ",".join(map(str, sorted(c for c in members if len(made[c]) == len(s))))
        found[(min(members), len(s), min(nodes[s[:-1]]) if s else None, len(members), children[s], leaves[s], saved[s],
               hashlib.sha256(ends.encode()).hexdigest())] += 1
    return found


def shared_conversations(rng: random.Random, n: int = 260) -> list[tuple]:
    """Conversations over few texts, so that many prefixes meet; some absent bases, gaps and ties."""
    rows = []
    for c in rng.sample(range(-150, 900), n):
        for turn in range(rng.randint(1, 9)):
            rows.append((c, rng.choice([turn, turn, turn, None, 3]), rng.choice(["user", "assistant", None]), rng.choice(["a", "bb", "", None, "é東"])))
    return rows


def nodes_of(spark, rows, **kw) -> Counter:
    turns = spark.createDataFrame(rows, TURNS).withColumns({"depth": F.lit("x"), "t": F.lit(1), "pos": F.lit(2), "hi": F.lit(None)})
    return Counter(map(tuple, trie.build_trie(turns, **kw).nodes.select(*NODE).collect()))


@pytest.mark.parametrize("seed", [1, 2])
def test_trie_equals_plain_python(spark, seed):
    rows = shared_conversations(random.Random(seed))
    assert nodes_of(spark, rows) == plain_trie(rows)


def test_trie_of_awkward_rows(spark):
    rows = [(None, 1, "user", "x"), (7, None, None, None), (7, None, None, None), (7, 0, "user", "L" * 300_000)]
    rows += [(100, k, "user", f"t{k}") for k in range(400)]  # a long conversation and copies of its head
    rows += [(100 + k, j, "user", f"t{j}") for k in range(1, 60) for j in range(6)]
    rows += [(2**40 + k, 0, "user", "t0") for k in range(50)] + [(-3, 0, "user", "t0")]
    assert nodes_of(spark, rows) == plain_trie(rows)
    assert sum(nodes_of(spark, [(None, 1, "a", "b")]).values()) == 0
    assert sum(nodes_of(spark, []).values()) == 0


def test_long_conversations_and_hot_ones_go_in_parts(spark, monkeypatch):
    monkeypatch.setattr(hot_keys, "MIN_HOT_ROWS", 60)
    rows = [(200, k // 3, "user", f"t{k % 5}") for k in range(9000)] + [(201, k, "user", f"t{k % 5}") for k in range(4100)]
    rows += shared_conversations(random.Random(3), 60)
    turns = spark.createDataFrame(rows, TURNS)
    assert hot_keys.segment_hot_keys(turns.select("conv_id", "turn", "text"), "conv_id", ("turn", "text"), 1, ("turn", "text")).split
    # The plain form needs time in the square of a length; two conversations of the long kind are compared by their nodes' counts.
    found = trie.build_trie(turns).nodes
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        role, text = role or "", text or ""
        convs[c].append(((turn is not None, turn or 0, hashlib.md5(f"trie-0{len(role)}:{role}{text}".encode()).hexdigest()), (role, text)))
    own = {c: [x for _, x in sorted(v, key=lambda y: y[0])] for c, v in convs.items()}
    digests = {}
    for c in (200, 201):
        h = zlib.crc32(str(c).encode()) % 6
        state, want = hashlib.sha256(), []
        for role, text in own[200][:h] + own[c][h:]:
            state.update(f"{len(role)}:{role}{text}".encode())
            want.append(state.hexdigest())
        digests[c] = want
    keys = {(c, d + 1): x for c, v in digests.items() for d, x in enumerate(v)}
    got = {}
    for r in trie.build_trie(turns).members.where("conv_id in (200, 201)").collect():
        got[(r["conv_id"], r["depth"])] = (r["depth"], r["hi"], r["lo"])
    assert set(got) == set(keys)
    assert len(set(got.values())) == len(set(keys.values()))
    assert len({(got[k], keys[k]) for k in keys}) == len(set(keys.values()))
    assert found.where("conv_id = 201").agg(F.max("depth")).first()[0] == len(digests[201])


def test_colliding_fingerprints_are_found_out(spark):
    weak = trie.Hashing("trie-0", primes=(7, 7, 7, 7), bases=(1, 1, 1, 1))
    rows = [(k, j, "user", f"{k}-{j}") for k in range(300) for j in range(3)]
    turns = spark.createDataFrame(rows, TURNS)
    with pytest.raises(ValueError):
        trie.build_trie(turns, hashings=(weak,))
    assert nodes_of(spark, rows, hashings=(weak, trie.HASHINGS[0])) == plain_trie(rows)


def test_one_node_with_many_ends_is_hashed_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(trie, "CHUNK_BITS", 3)
    rows = [(k, 0, "user", "hi") for k in range(0, 3000, 7)]
    assert nodes_of(spark, rows) == plain_trie(rows)


# ---- divergence ---------------------------------------------------------------------------------------------

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_audit(rows: list[tuple]) -> Counter:
    docs, counts = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        found = [w.translate(LOWER) for w in TERM.findall(text or "")]
        counts[lang or "", source or ""].update(found)
        docs[lang or ""].update(set(found))
    out = Counter()
    for lang in {x for x, _ in counts}:
        kept = sorted(t for t, n in docs[lang].items() if n >= 3)
        sources = sorted(s for x, s in counts if x == lang)
        n = {s: sum(counts[lang, s][t] for t in kept) for s in sources}
        p = {s: [1 + 10**9 * (counts[lang, s][t] + 1) // (n[s] + len(kept)) for t in kept] for s in sources}
        q = [1 + 10**9 * (sum(counts[lang, s][t] for s in sources) + 1) // (sum(n.values()) + len(kept)) for t in kept]
        for s in sources:
            pairs = [(o, sum((a - b) ** 2 // b for a, b in zip(p[s], p[o]))) for o in sources if o != s]
            terms = [(t, (a - b) ** 2 // b) for t, a, b in zip(kept, p[s], q) if counts[lang, s][t] and a > b]
            for part, items, most in (("pair", pairs, None), ("term", terms, 200)):
                ranked = sorted(items, key=lambda x: (-x[1], x[0].encode()))[:most]
                out.update((lang, s, part, item, value, k + 1) for k, (item, value) in enumerate(ranked))
    return out


def audited(docs) -> Counter:
    return Counter(map(tuple, divergence.audit(docs).select("lang", "source", "part", "item", "value", "rank").collect()))


def test_audit_equals_plain_python(spark, documents, awkward, empty):
    rows = [(r["text"], r["lang"], r["source"]) for r in documents.collect()]
    assert audited(documents) == plain_audit(rows)
    rows = [(r["text"], r["lang"], r["source"]) for r in awkward.collect()]
    assert audited(awkward) == plain_audit(rows)
    assert divergence.audit(empty).count() == 0


def test_audit_in_small_blocks_pieces_and_batches(spark, monkeypatch):
    """Terms cut over many runs, documents over many pieces, pairs let go before the end.

    The limits are read where the session's Python workers run, so the functions are called here as well.
    """
    rng = random.Random(9)
    words = ["".join(rng.choices("abcé", k=rng.randint(1, 4))) for _ in range(300)]
    rows = [(" ".join(rng.choices(words, k=rng.randint(0, 40))), rng.choice(["x", "y", None]), f"s{rng.randint(0, 12)}") for _ in range(400)]
    rows += [("only once here", "z", "a"), ("Hot HOT hot " * 3000, "x", "s1"), (None, "w", "b")]
    for name, value in (("MOST_ENTRIES", 50), ("PIECE_BYTES", 64), ("MOST_PAIRS", 40), ("ROWS_OUT", 7)):
        monkeypatch.setattr(divergence, name, value)
    docs = spark.createDataFrame(rows, "text string, lang string, source string")
    assert audited(docs) == plain_audit(rows)
    assert list(divergence.pieces(b"ab cd!e " * 40, 16)) and b"".join(divergence.pieces(b"Ab-c" * 40, 16)) == b"ab c" * 40


def test_shares_are_exact():
    import numpy as np

    rng = random.Random(4)
    whole = [rng.randint(1, 9 * 10**15) for _ in range(2000)]
    counts = [rng.randint(0, w - 1) for w in whole]
    want = [1 + 10**9 * (c + 1) // w for c, w in zip(counts, whole)]
    assert divergence.shares(np.array(counts), np.array(whole)).tolist() == want
