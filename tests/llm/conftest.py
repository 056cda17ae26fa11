"""Rows that operators must cope with, and a data folder's documents as plain rows."""
from __future__ import annotations

import pytest

DATA = "/root/testdata/sf0.001"
DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"

LONG = ("Eran thes onon. " * 3 + "x" * 70 + "\n") * 900 + "ab" * 6000


def text_rows() -> list[tuple]:
    """Nulls in any column, empty, very long, repeated rows, ties, odd characters."""
    texts = [
        None, "", " ", "\n\n", "one line", "One Line ", "\tONE LINE\r\n", LONG, "a b c d e a b c d e a b c d e",
        "the the the the the the the the the the the the", "naïve café — 東京 \U0001f600 x͘ ՘ \U00033480", "<|endoftext|> a<|endoftext|>",
        "  spaces   between \x1c\x85  words  ", "1234 5678 $$$ &&& ***", "I'll we've 'S it's", "\x00 nul",
    ]
    rows = [(k, t, "en", "s", len(t or "")) for k, t in enumerate(texts)]
    rows += [(100, "one line\ntwo", None, None, None), (100, "one line\ntwo", None, None, None), (None, "one line", None, None, 8), (None, None, None, None, None)]
    rows += [(200 + k, f"shared\nown {k}\n shared ", "de", "s", 0) for k in range(12)]
    return rows


@pytest.fixture(scope="session")
def awkward(spark):
    """The awkward rows with extra columns named like the operators' own."""
    rows = [(*r, 1, "x", 0.5, True) for r in text_rows()]
    return spark.createDataFrame(rows, DOCUMENTS + ", n_words int, kept string, score double, doc boolean")


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCUMENTS)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet")


def text_of(rows) -> dict:
    return {r["doc_id"]: r["text"] for r in rows}
