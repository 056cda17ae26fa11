"""Results that copies, shared ids and clashing names must not cost."""
from __future__ import annotations

import random
from collections import Counter

import pytest

from fraudloom.llm import language, lines, neardup, queries

COLUMNS = "doc_id long, text string"


def words(rng, n):
    return " ".join("".join(rng.choices("abcdefgh", k=5)) for _ in range(n))


def test_unlike_texts_under_one_id_stay(spark):
    rng = random.Random(2)
    a, b, c = (words(rng, 80) for _ in range(3))
    near = a + " tail"
    rows = [(1, a), (1, b), (1, a), (2, near), (3, c), (None, c), (4, ""), (4, None), (4, ""), (5, c.upper()), (6, "x")]
    kept = neardup.drop_near_duplicates(spark.createDataFrame(rows, COLUMNS), neardup.FIVE_AT_80).collect()
    got = Counter((r["doc_id"], r["text"]) for r in kept)
    assert got == Counter([(1, a), (1, b), (3, c), (4, ""), (4, None), (6, "x")])


def test_linked_texts_under_one_id_leave_one(spark):
    rng = random.Random(3)
    a = words(rng, 100)
    rows = [(1, a), (1, a + " more"), (2, a + " most"), (1, words(rng, 50))]
    kept = neardup.drop_near_duplicates(spark.createDataFrame(rows, COLUMNS), neardup.FIVE_AT_80).collect()
    assert len(kept) == 2 and {r["doc_id"] for r in kept} == {1}


def test_a_language_whose_texts_repeat_is_learned(spark):
    german = "Der schnelle braune Fuchs springt über den faulen Hund und läuft weiter in den Wald"
    english = [f"the quick brown fox number {k} jumps over the lazy dog and runs away through the wood {k * 7}" for k in range(3000)]
    rows = [(german, "de")] * 20_000 + [(t, "en") for t in english]
    docs = spark.createDataFrame(rows, "text string, lang string")
    model = language.learn(docs)
    judged = dict(zip((german, english[0]), model.judge([german, english[0]])))
    assert judged[german][0] == "de" and judged[english[0]][0] == "en"


@pytest.mark.parametrize("name", ["lines", "Lines", "kept"])
def test_line_dedup_beside_a_column_of_the_same_name(spark, tmp_path, name):
    rows = [(k, f"shared\nown {k}", "x") for k in range(12)]
    docs = spark.createDataFrame(rows, f"{COLUMNS}, {name} string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    assert {r["n_dropped"] for r in queries.op5_line_dedup(spark, str(tmp_path)).collect()} == {1}
    if name != "kept":
        with pytest.raises(ValueError):
            lines.dedup_lines(docs)
