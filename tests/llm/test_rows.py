"""Operators that judge one text at a time, against plain Python."""
from __future__ import annotations

import base64
import hashlib
import random
import struct
from collections import Counter

import public_tokenizers
import pytest
import regex
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from fraudloom.llm import bpe, rules, text, tokens

JSON = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def both(documents, awkward):
    return documents.select("doc_id", "text").unionByName(awkward.select("doc_id", "text"))


def keyed(rows):
    return sorted((tuple(r) for r in rows), key=repr)


def test_token_counts_equal_the_library(documents, awkward, empty):
    library = Tokenizer.from_file(JSON)
    rows = both(documents, awkward)
    expected = []
    for r in rows.collect():
        x = r.text or ""
        n = len(library.encode(x, add_special_tokens=False).ids)
        expected.append((r.doc_id, len(x.encode()), n, n > 512))
    assert keyed(tokens.count_tokens(rows, JSON).collect()) == keyed(expected)
    assert tokens.count_tokens(awkward, JSON).count() == awkward.count()
    assert tokens.count_tokens(empty, JSON).count() == 0


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "piece_bpe_32k.model"])
def test_other_tokenizers_encode_whole_texts(awkward, name):
    counter = tokens.Counter(public_tokenizers.path(name))
    got = {(r.doc_id, r.n_bytes): r.n_tokens for r in tokens.count_tokens(awkward, public_tokenizers.path(name)).collect()}
    for r in awkward.collect():
        assert got[r.doc_id, len((r.text or "").encode())] == (counter.whole(r.text) if r.text else 0)


def test_pieces_of_more_than_255_tokens(spark):
    import tokenizers

    text = "\U00010330" * 64
    n = len(tokenizers.Tokenizer.from_file(JSON).encode(text, add_special_tokens=False).ids)
    assert n == 256
    rows = spark.createDataFrame([(1, text), (2, "a b")], "doc_id long, text string")
    assert {r.doc_id: r.n_tokens for r in tokens.count_tokens(rows, JSON).collect()}[1] == n


def test_cache_keeps_its_bound(monkeypatch):
    monkeypatch.setattr(tokens, "CACHE_ENTRIES", 3)
    lengths = tokens.Lengths({"a": 1}, len)
    assert [lengths[x] for x in ("a", "bb", "cc", "dd", "ee", "bb", "x" * 100)] == [1, 2, 2, 2, 2, 2, 100]
    assert len(lengths) <= 4 and "x" * 100 not in lengths


def tiktoken_encoding():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_round_trip_equals_the_library(documents, awkward, empty):
    library = tiktoken_encoding()
    rows = both(documents, awkward)
    expected = []
    for r in rows.collect():
        ids = library.encode_ordinary(r.text or "")
        packed = struct.pack(f"<{len(ids)}I", *ids)
        expected.append((r.doc_id, len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256((r.text or "").encode()).hexdigest()))
    assert keyed(bpe.round_trip(rows, RANKS).collect()) == keyed(expected)
    assert bpe.round_trip(empty, RANKS).count() == 0
    ids = awkward.select("doc_id", "text", bpe.encode_ids(RANKS)("text").alias("e")).select("text", "e.*")
    assert all(r.decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest() for r in ids.collect())
    for r in ids.select("text", "ids", bpe.decode_ids(RANKS)("ids").alias("back")).collect():
        assert r.ids == library.encode_ordinary(r.text or "") and bytes(r.back).decode() == (r.text or "")


def test_merges_of_long_pieces_equal_the_library():
    library, codec, dice = tiktoken_encoding(), bpe.ByteBPE(RANKS), random.Random(5)
    for alphabet in ("a", "ab", "etaoin", "aé東", "-=", "0123456789"):
        for n in (1, 2, 3, 10, 150, 4000):
            piece = "".join(dice.choice(alphabet) for _ in range(n))
            assert codec.merge(piece.encode()) == library._core_bpe.encode_single_piece(piece.encode()), (alphabet, n)
    assert not any(codec.words)


def test_piece_cache_keeps_its_bound(monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_ENTRIES", 4)
    pieces = bpe.Pieces(lambda piece: list(piece))
    for x in ("a", "b", "c", "a", "d", "e", "long" * 30):
        assert pieces[x] == struct.pack(f"<{len(x)}I", *x.encode())
        assert len(pieces) + len(pieces.older) <= 4
    monkeypatch.setattr(bpe, "KEPT_ENTRIES", 1)
    pieces.rest()
    assert len(pieces) + len(pieces.older) == 1


def test_pretoken_pattern_is_the_published_one():
    assert tokens.PATTERN == public_tokenizers.PATTERN


def plain_rules(x: str | None) -> tuple:
    x = x or ""
    words = regex.findall(r"[^\x20\x09-\x0D]+", x)
    lines = [line for line in x.split("\n") if regex.search(r"[^\x20\x09-\x0D]", line)]
    grams = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often = Counter(grams)
    repeated = {i + k for i, g in enumerate(grams) if often[g] > 1 for k in range(5)}
    stuck = sum(a == b for a, b in zip(words, words[1:]))
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in x), len(lines) - len(set(lines)), len(repeated),
        len(lines), sum("A" <= c <= "Z" for c in x), stuck,
    )


@pytest.mark.parametrize("piece", [7, text.PIECE_BYTES])
def test_measurements_equal_plain_python(documents, awkward, empty, monkeypatch, piece):
    monkeypatch.setattr(text, "PIECE_BYTES", piece)
    names = rules.MEASURES
    if piece == 7:  # cut at many places, in this process
        import pyarrow as pa

        texts = [r.text for r in awkward.collect()] + ["ab cd ef gh ij ab cd ef gh ij", "averyveryverylongword x y"]
        got = next(rules.measure.func(iter([pa.array([t if t is None or len(t) < 5000 else t[:900] for t in texts])]))).to_pylist()
        assert [tuple(g[n] for n in names) for g in got] == [plain_rules(t if t is None or len(t) < 5000 else t[:900]) for t in texts]
        return
    rows = both(documents, awkward)
    got = rules.ledger(rows).collect()
    expected = [(r.doc_id, *plain_rules(r.text)) for r in rows.collect()]
    assert keyed((r.doc_id, *(r[n] for n in names)) for r in got) == keyed(expected)
    assert rules.ledger(empty).count() == 0 and rules.ablations(rules.ledger(empty), rules.POLICIES["v3"]).count() == 0


def test_policies_and_ablations_come_from_the_ledger(documents):
    rows, policy = rules.ledger(documents), rules.POLICIES["v3"]
    plain = [{name: bool(r.failed >> k & 1) for k, name in enumerate(rules.RULES)} for r in rows.collect()]
    assert rows.where(rules.verdict(policy)).count() == sum(not any(x.values()) for x in plain)
    for r in rules.ablations(rows, policy).collect():
        assert r.n_failed == sum(x[r.rule] for x in plain)
        assert r.n_only_this == sum(x[r.rule] and sum(x.values()) == 1 for x in plain)
    assert rows.where(F.col("n_words") < 10).where(rules.verdict(rules.POLICIES["base"])).count() == 0
