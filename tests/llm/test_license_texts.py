"""Whole license wordings against a matcher made of regular expressions."""
from __future__ import annotations

import random
import re

import pytest

from fraudloom.llm import licenses
from fraudloom.llm.license_texts import BODIES

_MARK = re.compile(r"<<(beginOptional|endOptional|var;[^>]*)>>")


def as_pattern(markup: str) -> re.Pattern:
    """Words each followed by a blank; an optional group; as many words of any kind."""
    made = ""
    for k, part in enumerate(_MARK.split(markup)):
        if k % 2 == 0:
            made += "".join(f"{re.escape(w)} " for w in re.findall(r"[0-9a-z]+", part.lower()))
        elif part == "beginOptional":
            made += "(?:"
        elif part == "endOptional":
            made += ")?"
        else:
            low, high = (re.search(rf"{x}=(\d+)", part).group(1) for x in ("min", "max"))
            made += rf"(?:[0-9a-z]+ ){{{low},{high}}}"
    return re.compile(rf"(?<![0-9a-z]){made}")


def filled(markup: str, rng: random.Random, optional: float) -> list[str]:
    """A text of the template: optional regions by chance, replaceable ones with other words."""
    out, skipping = [], 0
    for k, part in enumerate(_MARK.split(markup)):
        if part == "beginOptional":
            skipping = int(rng.random() >= optional)
        elif part == "endOptional":
            skipping = 0
        elif k % 2:
            low, high = (int(re.search(rf"{x}=(\d+)", part).group(1)) for x in ("min", "max"))
            out += [f"name{j}" for j in range(rng.choice([low, high, rng.randint(low, high)]))]
        elif not skipping:
            out += re.findall(r"[0-9a-z]+", part.lower())
    return out


def labels(words: list[str]) -> set[str]:
    raw = ("Before, Here. " + " ".join(words) + "; After").lower().encode()
    return {label for label, *_ in licenses._scanner(tuple(licenses.PHRASES.items()), tuple(licenses.TEMPLATES.items())).places(raw)}


@pytest.mark.parametrize("label", sorted(BODIES))
def test_accepts_its_wording_and_nothing_else(label):
    rng, pattern = random.Random(label), as_pattern(BODIES[label])
    mandatory = set(licenses.Automaton(label, BODIES[label]).mandatory)
    for round_ in range(12):
        words = filled(BODIES[label], rng, (0, 1, 0.5)[round_ % 3])
        assert label in labels(words)
        for kind in range(4):
            other, at = list(words), rng.randrange(len(words))
            if kind == 0:
                other[at] = "changed"
            elif kind == 1:
                del other[at]
            elif kind == 2:
                other.insert(at, "added")
            else:
                other[at:at] = ["more"] * 20
            want = bool(pattern.search(" ".join(["before", "here", *other, "after", ""])))
            assert (label in labels(other)) == want, (kind, at, other[at - 3:at + 4])
    assert mandatory


def test_licenses_that_share_clauses_are_told_apart():
    rng = random.Random(1)
    two, three = (filled(BODIES[f"bsd-{n}-clause-text"], rng, 1) for n in (2, 3))
    assert "bsd-2-clause-text" in labels(two) and "bsd-3-clause-text" not in labels(two)
    assert "bsd-3-clause-text" in labels(three) and "bsd-2-clause-text" not in labels(three)
    isc, none = filled(BODIES["isc-text"], rng, 1), filled(BODIES["0bsd-text"], rng, 0)
    assert "isc-text" in labels(isc) and "0bsd-text" not in labels(isc)
    assert "0bsd-text" in labels(none) and "isc-text" not in labels(none)


def test_bodies_in_documents(spark):
    rng = random.Random(2)
    rows = [(k, f"x {label} y\n" + " ".join(filled(BODIES[label], rng, 0.5)).upper()) for k, label in enumerate(sorted(BODIES))]
    found = {r["doc_id"]: r["labels"].split(",") for r in licenses.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(label in found[k] for k, label in enumerate(sorted(BODIES)))
