"""License scans: templates with optional and replaceable regions as automata over words.

A template is wording with marks: ``<<beginOptional>> ... <<endOptional>>`` may be left out, and
``<<var;name=...;min=...;max=...>>`` stands for that many words of any kind. It is compiled to an
automaton whose states are found as texts need them. A place of a text is accepted when every
mandatory word stands there in order with nothing else between. Phrases are templates without marks.

A text is only walked for templates whose mandatory words it holds as strings; words are walked in
a stream, so memory does not grow with the text. Threads that reach the same state of a template
go on as one, from the earliest start, if the template has marks.

Defined cases: a null or empty text has no words, no labels and score 0; rows are judged one by
one, so repeated rows get equal results; an empty table gives an empty one. Other columns are not read.
"""
from __future__ import annotations

import functools
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType

from fraudloom.llm.license_texts import BODIES
from fraudloom.llm.text import ALNUM, blocks, in_batches, per_text, struct_array, struct_type

WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_MARK = re.compile(r"<<(beginOptional|endOptional|var;[^>]*)>>")
MOST_STATES = 4096
SCANNED = struct_type(
    n_words=LongType(), n_base=LongType(), first_word=LongType(), last_word=LongType(), base_labels=StringType(),
    labels=StringType(), score=DoubleType(),
)

#: Phrases whose places are all counted, by label (fixed values).
PHRASES = {"cc-by": "cc by", "gpl": "general public license", "reserved": "all rights reserved"}

#: Wording of public license notices, by label, and whole licenses.
TEMPLATES = {
    **BODIES,
    "apache": "licensed under <<beginOptional>>the<<endOptional>> apache license <<beginOptional>>version 2.0<<endOptional>>",
    "apache-2.0-notice": (
        "you may not use this file except in compliance with the license <<var;name=link;min=0;max=20>> unless required by "
        "applicable law or agreed to in writing"
    ),
    "bsd": (
        "redistribution and use in source and binary forms with or without modification are permitted provided that the "
        "following conditions are met"
    ),
    "cc": (
        "licensed under <<beginOptional>>a<<endOptional>><<beginOptional>>the<<endOptional>> creative commons "
        "<<var;name=kind;min=1;max=6>> license"
    ),
    "cc-by-notice": (
        "licensed under cc by <<beginOptional>>nc<<endOptional>> <<beginOptional>>sa<<endOptional>> "
        "<<beginOptional>>nd<<endOptional>> <<var;name=major;min=1;max=1>> 0"
    ),
    "copyright": "copyright <<beginOptional>>c<<endOptional>> <<var;name=holder;min=1;max=12>> all rights reserved",
    "gpl-notice": (
        "<<beginOptional>>licensed<<endOptional>> under the <<beginOptional>>terms of the<<endOptional>> gnu "
        "<<beginOptional>>lesser<<endOptional>> <<beginOptional>>affero<<endOptional>> general public license"
    ),
    "isc": (
        "permission to use copy modify and <<beginOptional>>or<<endOptional>> distribute this software for any purpose with or "
        "without fee is hereby granted"
    ),
    "mit": "under the <<beginOptional>>terms of the<<endOptional>> mit license",
    "mit-notice": "permission is hereby granted free of charge to any person obtaining a copy of this software",
    "mpl-2.0": "subject to the terms of the mozilla public license v 2.0",
    "spdx": "spdx license identifier <<var;name=id;min=1;max=1>>",
    "unlicense": "this is free and unencumbered software released into the public domain",
}


def words_of(text: str) -> list[bytes]:
    return WORD.findall(text.encode().lower())


@dataclass
class Automaton:
    """A template's states: sets of places in its wording, made when first met."""

    label: str
    markup: str
    moves: list[dict] = field(default_factory=list)  # place -> word (None: any) -> next places
    skips: list[list[int]] = field(default_factory=list)  # place -> places reached without a word
    mandatory: tuple[bytes, ...] = ()

    def __post_init__(self):
        open_at, mandatory = [], []
        self._place()
        for k, part in enumerate(_MARK.split(self.markup)):
            if k % 2 == 0:
                for word in words_of(part):
                    self._word(word)
                    if not open_at:
                        mandatory.append(word)
            elif part == "beginOptional":
                open_at.append(len(self.moves) - 1)
            elif part == "endOptional":
                self.skips[open_at.pop()].append(len(self.moves) - 1)
            else:
                bounds = dict(x.split("=") for x in part.split(";")[1:])
                low, high = int(bounds["min"]), int(bounds["max"])
                places = [len(self.moves) - 1] + [self._word(None) for _ in range(high)]
                for place in places[low:-1]:
                    self.skips[place].append(places[-1])
        self.end = len(self.moves) - 1
        self.mandatory = tuple(sorted(set(mandatory), key=lambda w: (-len(w), w)))
        self.marked = "<<" in self.markup
        self.start = self._close({0})
        if self.end in self.start:
            raise ValueError(f"template {self.label} has no mandatory wording")
        self.first = {w for place in self.start for w in self.moves[place]}
        if None in self.first:
            raise ValueError(f"template {self.label} begins with a replaceable region")
        self.known: dict[tuple[frozenset, bytes | None], frozenset] = {}
        self.alphabet = {w for move in self.moves for w in move}

    def _place(self) -> int:
        self.moves.append({})
        self.skips.append([])
        return len(self.moves) - 1

    def _word(self, word: bytes | None) -> int:
        at = len(self.moves) - 1
        self.moves[at][word] = self._place()
        return at + 1

    def _close(self, places: set[int]) -> frozenset:
        found, todo = set(places), list(places)
        while todo:
            for place in self.skips[todo.pop()]:
                if place not in found:
                    found.add(place)
                    todo.append(place)
        return frozenset(found)

    def step(self, state: frozenset, word: bytes) -> frozenset:
        """The state after a word; empty if nothing can match any more."""
        key = (state, word if word in self.alphabet else None)
        after = self.known.get(key)
        if after is None:
            after = self._close({to for place in state for w, to in self.moves[place].items() if w is None or w == key[1]})
            if len(self.known) >= MOST_STATES:
                self.known.clear()
            self.known[key] = after
        return after


class Scanner:
    """Finds the places of phrases and templates in lower-cased texts."""

    def __init__(self, phrases: dict[str, str], templates: dict[str, str]):
        self.automata = [Automaton(k, v) for k, v in phrases.items()] + [Automaton(k, v) for k, v in templates.items()]
        self.phrases = set(phrases)

    def places(self, raw: bytes) -> list[tuple[str, int, int]]:
        """Label, first word and end of each accepted place, ends longest."""
        able = [a for a in self.automata if all(w in raw for w in a.mandatory)]
        if not able:
            return []
        starts: dict[bytes, list[Automaton]] = {}
        for a in able:
            for word in a.first:
                starts.setdefault(word, []).append(a)
        accepted: dict[tuple[str, int], int] = {}
        threads: list[tuple[Automaton, frozenset, int]] = []
        for at, match in enumerate(WORD.finditer(raw)):
            word = match.group()
            begun = starts.get(word)
            if begun:
                threads += [(a, a.start, at) for a in begun]
            if not threads:
                continue
            moved, merged = [], set()
            for a, state, start in threads:
                state = a.step(state, word)
                if not state:
                    continue
                if a.end in state:
                    accepted[a.label, start] = at + 1
                if a.marked:
                    if (a.label, state) in merged:
                        continue
                    merged.add((a.label, state))
                moved.append((a, state, start))
            threads = moved
        return [(label, start, end) for (label, start), end in accepted.items()]

    def scan(self, raw: bytes, n_words: int) -> tuple:
        found = self.places(raw)
        base = sorted(start for label, start, _ in found if label in self.phrases)
        covered, last = 0, 0
        for _, start, end in sorted(found, key=lambda x: x[1:]):
            covered += max(0, end - max(start, last))
            last = max(last, end)
        return (
            len(base), base[0] if base else None, base[-1] if base else None,
            ",".join(sorted({label for label, *_ in found if label in self.phrases})),
            ",".join(sorted({label for label, *_ in found})), covered / n_words if n_words else 0.0,
        )


@functools.cache
def _scanner(phrases: tuple, templates: tuple) -> Scanner:
    """One scanner per worker, so that its states outlive a task."""
    return Scanner(dict(phrases), dict(templates))


def word_starts(run: list[bytes]) -> np.ndarray:
    """Words of each text."""
    mask = ALNUM[np.frombuffer(b"\n".join(run), np.uint8)]
    mask[1:] &= ~mask[:-1].copy()
    return per_text(mask, run)


def scan_licenses(
    docs: DataFrame, phrases: dict[str, str] = PHRASES, templates: dict[str, str] = TEMPLATES, id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """id; n_words; number, first and last start and labels of phrases; all labels; share of words in accepted places."""
    wording = tuple(phrases.items()), tuple(templates.items())

    @F.arrow_udf(SCANNED)
    def scan(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scanner = _scanner(*wording)
        for texts in batches:
            rows = []
            for run in blocks(texts):
                rows += [(n, *scanner.scan(raw.lower(), n)) for raw, n in zip(run, word_starts(run).tolist())]
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
            columns = list(zip(*rows)) or [()] * len(kinds)
            yield struct_array({n: pa.array(x, t) for n, x, t in zip(SCANNED.names, columns, kinds)})

    return in_batches(docs).select(F.col(id_col), scan(F.col(text_col)).alias("__l")).select(id_col, "__l.*")
