"""Line dedup against plain Python."""
from __future__ import annotations

import hashlib
from collections import defaultdict

import pytest

from fraudloom.llm import lines

SPACE = " \t\n\x0b\x0c\r"


def key(line: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(SPACE))


def plain(rows, min_docs, min_chars):
    holders = defaultdict(set)
    for r in rows:
        doc = r.doc_id if r.doc_id is not None else ("text", r.text)
        for line in (r.text or "").split("\n"):
            holders[key(line)].add(doc)
    out = []
    for r in rows:
        all_lines = (r.text or "").split("\n")
        kept = [x for x in all_lines if len(key(x)) < min_chars or len(holders[key(x)]) < min_docs]
        text = "\n".join(kept)
        out.append((r.doc_id, len(all_lines), len(all_lines) - len(kept), text, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=repr)


def ours(docs, **options):
    found = lines.dedup_lines(docs, **options).select("doc_id", "lines.*").collect()
    return sorted((tuple(r) for r in found), key=repr)


@pytest.mark.parametrize("min_docs, min_chars", [(10, 1), (2, 1), (3, 6), (1, 3)])
def test_equals_plain_python(documents, awkward, min_docs, min_chars):
    rows = documents.unionByName(awkward.select(documents.columns))
    assert ours(rows, min_docs=min_docs, min_chars=min_chars) == plain(rows.collect(), min_docs, min_chars)


def test_other_columns_stay_and_rows_do_not_multiply(awkward, empty):
    found = lines.dedup_lines(awkward, min_docs=2)
    assert found.columns == [*awkward.columns, "lines"] and found.count() == awkward.count()
    assert lines.dedup_lines(empty).count() == 0


def test_documents_per_line_are_counted_in_parts(documents):
    plan = lines.frequent_lines(lines.line_hashes(documents), 10)._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan and "SinglePartition" not in plan
