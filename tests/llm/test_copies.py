"""Near copies, benchmark passages and the pipeline against plain Python."""
from __future__ import annotations

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from fraudloom.llm import decontam, neardup, quality
from fraudloom.llm.neardup import Settings

SPACED = re.compile(r"[^\x20\x09-\x0D]+")


def low(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def shingles(text, width):
    found = SPACED.findall(low(text or ""))
    if len(found) < width:
        return {tuple(found)} if found else set()
    return {tuple(found[i : i + width]) for i in range(len(found) - width + 1)}


def plain_components(rows, settings):
    """(id, n, component, kept) of each row by comparing all pairs."""
    sets = [shingles(r.text, settings.width) for r in rows]
    group = list(range(len(rows)))

    def top(i):
        while group[i] != i:
            i = group[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= settings.percent * len(a | sets[j]):
                group[top(i)] = top(j)
    least = {}
    for i, r in enumerate(rows):
        if r.doc_id is not None:
            least[top(i)] = min(least.get(top(i), r.doc_id), r.doc_id)
    return sorted(
        ((r.doc_id, len(sets[i]), least.get(top(i)), r.doc_id == least.get(top(i))) for i, r in enumerate(rows) if r.doc_id is not None), key=repr
    )


def ours(docs, settings):
    got = neardup.near_duplicates(docs, settings).where("id is not null").collect()
    return sorted(((r.id, r.n_shingles, r.component_id, r.kept) for r in got), key=repr)


@pytest.fixture(scope="module")
def copies(spark):
    """Groups of near copies with chains of edits, and one large group of copies of one text."""
    dice = random.Random(8)
    words = [f"w{k}" for k in range(3000)]
    rows, k = [], 0
    for group in range(6):
        base = [dice.choice(words) for _ in range(dice.choice((4, 30, 120)))]
        for _ in range(12):
            text = list(base)
            for _ in range(dice.randrange(0, 3)):
                text[dice.randrange(len(text))] = dice.choice(words)
            rows.append((k, " ".join(text)))
            k += 1
            if group % 2:
                base = text
    base = [dice.choice(words) for _ in range(150)]
    for _ in range(90):
        text = list(base)
        for _ in range(dice.randrange(0, 7)):
            text[dice.randrange(len(text))] = dice.choice(words)
        rows.append((k, " ".join(text)))
        k += 1
    rows += [(k + i, "The same  TEXT\nof many") for i in range(40)] + [(k + 50, "the same text of many")]
    return spark.createDataFrame(rows, "doc_id long, text string")


@pytest.mark.parametrize("settings", [neardup.EXACT_85, neardup.FIVE_AT_80, Settings(width=2, percent=85)])
def test_components_equal_all_pairs(copies, settings):
    assert ours(copies, settings) == plain_components(copies.collect(), settings)


def test_components_of_documents_and_awkward_rows(documents, awkward, empty):
    rows = documents.select("doc_id", "text").unionByName(awkward.select(F.col("doc_id") + 10_000, "text").toDF("doc_id", "text"))
    assert ours(rows, neardup.EXACT_85) == plain_components(rows.collect(), neardup.EXACT_85)
    assert neardup.near_duplicates(empty, neardup.EXACT_85).count() == 0
    alone = neardup.near_duplicates(awkward, neardup.EXACT_85)
    assert alone.count() == awkward.count()


def test_large_buckets_lose_no_link(copies, monkeypatch):
    monkeypatch.setattr(neardup, "SMALL_BUCKET", 3)
    monkeypatch.setattr(neardup, "CHUNK", 900)
    monkeypatch.setattr(neardup, "CHUNK_MEMBERS", 7)
    monkeypatch.setattr(neardup, "_CELLS", 400)
    assert ours(copies, neardup.EXACT_85) == plain_components(copies.collect(), neardup.EXACT_85)


def test_one_row_of_each_group_stays(spark, awkward, empty):
    rows = spark.createDataFrame(
        [(5, "a b c d e f g h"), (3, "A b c d e f g h"), (3, "A b c d e f g h"), (None, "a b c d e f g h"), (None, "x y"), (None, "x y"), (7, None), (8, "")],
        "doc_id long, text string",
    )
    kept = neardup.drop_near_duplicates(rows, neardup.FIVE_AT_80).collect()
    assert sorted(tuple(r) for r in kept if r.doc_id) == [(3, "A b c d e f g h"), (7, None), (8, "")]
    assert [r.text for r in kept if r.doc_id is None] == ["x y"]
    assert neardup.drop_near_duplicates(awkward, neardup.FIVE_AT_80).columns == awkward.columns
    assert neardup.drop_near_duplicates(empty, neardup.FIVE_AT_80).count() == 0


def test_registers_are_mergeable_and_estimate_similarity():
    dice = np.random.default_rng(6)
    pool = dice.integers(0, 2**63, 6000, np.uint64) * np.uint64(2) + dice.integers(0, 2, 6000).astype(np.uint64)
    a, b = pool[:4000], pool[400:4400]
    one, two = neardup.sketch(a, 2000), neardup.sketch(b, 2000)
    assert (np.maximum(one, two) == neardup.sketch(pool[:4400], 2000)).all()
    above, below = np.array([(one > two).sum()]), np.array([(one < two).sum()])
    n = np.array([4000])
    true = 3600 / 4400
    gaps = {j: neardup.likelihood_gap(above, below, n, n, 2000, j)[0] for j in (0.7, true, 0.95)}
    assert gaps[0.7] < 1 and gaps[true] < 3 and gaps[0.95] > neardup.DOUBT
    assert neardup.likelihood_gap(above, below, np.array([50]), n, 2000, 0.85)[0] == np.inf


def test_components_of_long_chains(spark):
    links = spark.createDataFrame([(k, k + 1) for k in range(1, 60)] + [(100, 101)], "a long, b long")
    got = {r.node: r.label for r in neardup.components(links).collect()}
    assert got == {k: 1 for k in range(1, 61)} | {100: 100, 101: 100}


# Benchmark


ITEMS = [
    (0, "Anna has 12 apples and gives 5 apples to Ben. How many apples does Anna keep after she walks 3 km home with Ben?"),
    (1, "the quick brown fox jumps over the lazy dog near the old stone bridge at dawn"),
    (2, "too short"), (3, None), (None, "a null id item with enough words to be a passage of its own"), (4, "five plain words stand here"),
]
TEXTS = {
    "verbatim": ("lead words " + ITEMS[0][1] + " trailing words", {0}),
    "changed": ("Well. Carl has 40 apples and gives 7 apples to Dora. How many apples does Carl keep after she walks 9 km home with Dora? Done.", {0}),
    "units": ("Anna has 12 apples and gives 5 apples to Ben. How many apples does Anna keep after she walks 3 miles home with Ben?", {0}),
    "torn": ("Carl has 40 apples and gives 7 apples to Dora. How many apples does Eve keep after she walks 9 km home with Fred?", set()),
    "two copies": (ITEMS[0][1] + " and then " + ITEMS[0][1].replace("Anna", "Zoe").replace("12", "99"), {0}),
    "plain": ("xx " + ITEMS[1][1].upper() + " yy", {1}), "part": ("the quick brown fox jumps over the lazy dog", set()),
    "both": (ITEMS[1][1] + ". " + ITEMS[0][1], {0, 1}), "small": ("so five plain words stand here now", {4}),
    "names only": ("He met Anna Ben Carl Dora Eve Fred Gus Hal Ida Jon and 12 13 14 15 16 17 18 19 20", set()), "none": (None, set()), "empty": ("", set()),
}


def test_changed_passages_are_found(spark, awkward, empty):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    docs = spark.createDataFrame([(k, t) for k, (t, _) in enumerate(TEXTS.values())], "doc_id long, text string")
    found = {}
    for r in decontam.contaminations(docs, items).collect():
        found.setdefault(r.doc, set()).add(r.item)
    assert {k: found.get(k, set()) for k in range(len(TEXTS))} == {k: want for k, (_, want) in enumerate(TEXTS.values())}
    judged = decontam.judge(docs, items)
    assert judged.count() == docs.count() and {r.doc for r in judged.where("contaminated").collect()} == set(found)
    kept = decontam.drop_contaminated(awkward, items)
    assert kept.columns == awkward.columns and kept.count() == awkward.count()
    assert decontam.judge(empty, items).count() == 0
    nothing = spark.createDataFrame([], "item_id long, text string")
    assert decontam.judge(docs, nothing).where("contaminated").count() == 0


def test_all_planted_passages_are_found(spark):
    folder = "/root/testdata/sf0.01"
    docs, items = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/benchmark.parquet")
    passages = [r.text for r in items.collect()]
    truth = {r.doc_id for r in docs.collect() if any(p in r.text for p in passages)}
    assert {r.id for r in decontam.judge(docs, items).where("contaminated").collect()} == truth and truth


def flagged(spark, items, texts):
    """(document, item) of each contamination, by place; texts and items may be (id, text)."""
    rows = [[x if isinstance(x, tuple) else (k, x) for k, x in enumerate(xs)] for xs in (items, texts)]
    frames = [spark.createDataFrame(r, f"{name} long, text string") for r, name in zip(rows, ("item_id", "doc_id"))]
    return {(r.doc, r.item) for r in decontam.contaminations(frames[1], frames[0]).collect()}


def test_parts_and_edited_copies_of_items_of_all_lengths(spark):
    dice = random.Random(7)
    lengths = [8, 9, 11, 12, 15, 16, 19, 22, 23, 24, 30, 38, 59, 300]
    items = [[f"w{chr(97 + k)}{''.join(dice.choice('abcdefgh') for _ in range(6))}" for _ in range(n)] for k, n in enumerate(lengths)]
    texts, want = [], set()
    for k, words in enumerate(items):
        n = len(words)
        around = [[f"x{chr(97 + j)}" for j in range(20)], ["yy", "zz"] * 9]
        places = [(n // 2,)] + [(i,) for i in dice.sample(range(n), 3)]
        if n >= 12:
            places += [(n // 3, 2 * n // 3), (2, 5), (1, 3), (n // 2, n // 2 + 1)] + [tuple(dice.sample(range(n), 2)) for _ in range(4)]
        copies = [[("edit" if i in at else w) for i, w in enumerate(words)] for at in places]
        copies += [words[: n // 2] + ["more"] + words[n // 2 :], words[: n // 2] + words[n // 2 + 1 :]]
        if n >= 22:
            copies += [words[i : i + 13] for i in (0, n // 3, n - 13)]
        if n == 300:
            copies.append(words[100:240])
        for copy in copies:
            want.add((len(texts), k))
            texts.append(" ".join(around[0] + copy + around[1]))
        texts.append(" ".join(around[0] + words[: n // 2] + around[1]) if n < 22 else " ".join(words[2:14]))
    assert flagged(spark, [" ".join(x) for x in items], texts) == want


def test_one_changed_value_does_not_remove_a_copy(spark):
    dice = random.Random(3)
    words = ["".join(dice.choice("abcdefgh") for _ in range(7)) for _ in range(60)]
    words[20], words[45] = "2", "2"
    three = list(words)
    three[33] = "2"
    one_changed = list(words)
    one_changed[45] = "3"
    most = [{20: "7", 33: "7", 45: "5"}.get(k, w) for k, w in enumerate(three)]
    word = [{20: "one", 45: "one"}.get(k, w) for k, w in enumerate(words)]
    changed = [{20: "one", 45: "two"}.get(k, w) for k, w in enumerate(words)]
    items = [" ".join(words), " ".join(three), " ".join(word)]
    found = flagged(spark, items, [" ".join(x) for x in (one_changed, most, changed)])
    assert {(0, 0), (1, 1), (2, 2)} <= found
    # rows that share an id do not tear each other's copies, and each item goes by its own size
    short = "the red kite flies over Anna and over Anna to 4 hills and 4 lakes of the far north today"
    torn = short.replace("over Anna to", "over Bea to").replace("4 lakes", "5 lakes")
    assert flagged(spark, [(7, short), (7, " ".join(words))], [(1, torn), (1, short), (2, " ".join(words)), (3, short)]) == {(1, 7), (2, 7), (3, 7)}


def test_copies_in_another_case_are_found(spark):
    german = "Jens sah im Garten von Petra und in der Straße von Petra 3 Hunde und 4 Katzen, die Klaus Weiß gehören"
    break_moved = ITEMS[0][1].replace("to Ben. How", "to Ben, how").replace("Anna has", "There Anna has")
    units = "He drove 3 Miles from Anna past Ben to Carl and Dora"
    texts = [ITEMS[0][1].lower(), ITEMS[0][1].upper(), "so " + ITEMS[0][1].lower() + " end", german.upper(), german.lower(), break_moved, units.lower(), units.upper(), units]
    want = {(0, 0), (1, 0), (2, 0), (3, 1), (4, 1), (5, 0), (6, 2), (7, 2), (8, 2)}
    assert flagged(spark, [ITEMS[0][1], german, units], texts) == want


def test_short_items_and_scripts_without_spaces(spark):
    chinese = "小明有十二个苹果，他把五个苹果送给了小红，请问小明现在还剩下几个苹果，他又买了三个"
    dashes = "=" * 40
    items = ["Too short!", "2 + 2 = 4", chinese, "", "?!", "x ≥ y", dashes, "名前", None]
    texts = [
        "this is too SHORT for most", "too much, short", "so 2+2=4 it is", "2 + 3 = 4 and 2 - 2 = 4", "题目：" + chinese + "。答案是十", chinese.replace("小红", "小兰"),
        "他把五个苹果", "if x ≥ y then", "if x ≤ y then", "", "a " + dashes + " b", "a " + "=" * 39, "私の名前は",
    ]
    want = {(0, 0), (2, 1), (4, 2), (5, 2), (7, 5), (10, 6), (12, 7)}
    assert flagged(spark, items, texts) == want


def test_windows_equal_plain_python():
    text = "Tom paid 3,50 dollars. Two Miles later he, 20% poorer, saw Ann's dog at 5 km: Run Ann"
    found = decontam.template(text)
    assert found.tokens == "Tom paid 3,50 dollars Two Miles later he 20 % poorer saw Ann's dog at 5 km Run Ann".split()
    assert found.kinds.tolist() == [0, 0, 1, 2, 1, 2, 0, 0, 1, 2, 0, 0, 3, 0, 0, 1, 2, 0, 3]
    assert found.slots(2, 2) == ["13,50", "2dollars"] and found.plain(0, 4) == 2
    assert len(decontam._windows(found.codes, 8)) == 12 and len(decontam._windows(found.codes, 30)) == 0


# Pipeline


def test_stages_keep_columns_and_take_effect(spark, awkward):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, sizes = docs.columns, [docs.count()]
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality ranking", "line dedup", "near copies", "benchmark decontamination", "byte-level BPE",
    ]
    passages = [r.text for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        before, docs = docs, stage(spark, docs, folder).cache()
        assert docs.columns == columns and docs.schema["text"].dataType.simpleString() == "string"
        rows = docs.collect()
        sizes.append(len(rows))
        if k == 0:
            gone = {r.doc_id for r in before.collect()} - {r.doc_id for r in rows}
            assert gone and not [x for x in gone if labels.get(x) == 1]
        if k == 2:
            parts = plain_components(before.collect(), neardup.FIVE_AT_80)
            assert sorted(r.doc_id for r in rows) == [x for x, *_, kept in sorted(parts) if kept]
        if k == 3:
            held = {r.doc_id for r in before.collect() if any(p in r.text for p in passages)}
            assert {r.doc_id for r in before.collect()} - {r.doc_id for r in rows} >= held
    assert sizes == sorted(sizes, reverse=True)
    final = corpus_pipeline.STAGES[-1][1](spark, docs, folder)
    assert final.count() == docs.count()
    assert final.join(docs, "doc_id").where("decoded_sha256 <> sha2(text, 256)").count() == 0
    assert {r.doc_id for r in corpus_pipeline.run(spark, folder).collect()} == {r.doc_id for r in docs.collect()}
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, awkward, folder).columns == awkward.columns


def test_quality_stage_learns_like_the_operator(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    model = quality.learn(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    scores = quality.score(docs, model)
    kept = corpus_pipeline.keep_quality(spark, docs, folder)
    assert kept.count() == scores.where(F.col("__score") >= quality.CUT).count()
