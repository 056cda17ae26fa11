"""Secret scans with a trigram index, in DataFrame functions only.

Each rule's pattern is turned into a Boolean query over trigrams that every match must contain: an
OR of ANDs, derived from the pattern's syntax tree. The index has a posting (trigram, document) for
the trigrams that some rule asks for; postings of a document meet in one group, where the queries
are answered. Only documents that satisfy a rule's query are searched for it. A rule without a
mandatory trigram searches every document.

Matches are leftmost and do not overlap within a rule; those whose value is too short are dropped
afterwards. Positions are running sums of the lengths of matches and of the text between them.

Defined cases: null is an empty text without spans; rows are searched one by one, so repeated rows
get equal results; rows without id are told apart by their text in the index, and rows that share
an id share postings, which only widens the search; an empty table gives an empty one. Extra
columns are not read.
"""
from __future__ import annotations

import re._constants as codes
import re._parser as parser
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fraudloom.llm.text import row_key, staged

MOST_STRINGS = 64
SMALL_CLASS = 4


@dataclass(frozen=True)
class Rule:
    """A kind of secret: its pattern, the group whose length counts, and the least length."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0
    base: bool = False


#: Searched kinds in the order in which equal starts are listed.
RULES = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8, True),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 16, True),
    Rule("hex", r"[0-9a-f]{32,}", 0, 32, True),  # the runs of [0-9a-f]+ that are long enough
    Rule("github", r"gh[pousr]_[A-Za-z0-9]+", 0, 24),
    Rule("google", r"AIza[0-9A-Za-z_-]+", 0, 39),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 0, 40),
    Rule("pem", r"-----BEGIN (?:RSA |EC |DSA |OPENSSH )?PRIVATE KEY-----"),
    Rule("slack", r"xox[abpr]-[A-Za-z0-9-]+", 0, 15),
    Rule("stripe", r"sk_live_[0-9A-Za-z]+", 0, 24),
)

Query = list[frozenset[str]]  # any of these sets, all trigrams of it
ANYTHING: Query = [frozenset()]


def _both(a: Query, b: Query) -> Query:
    return _least([x | y for x in a for y in b])


def _least(sets: Query) -> Query:
    """Without the sets that contain another one."""
    return [x for k, x in enumerate(sets) if not any(y < x or (y == x and j < k) for j, y in enumerate(sets))]


def _trigrams(strings: set[str]) -> Query:
    return _least([frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings])


def _walk(tree) -> tuple[set[str] | None, Query]:
    """The strings that the tree can match, if they are few, and what every match must contain."""
    run, query, exact = {""}, ANYTHING, True

    def stop(more: Query = ANYTHING) -> None:
        nonlocal run, query, exact
        query, run, exact = _both(_both(query, _trigrams(run)), more), {""}, False

    for code, value in tree:
        strings, more, ends = None, ANYTHING, False
        if code is codes.LITERAL:
            strings = {chr(value).lower()}
        elif code is codes.IN and all(c is codes.LITERAL for c, _ in value) and len(value) <= SMALL_CLASS + 1:
            strings = {chr(v).lower() for _, v in value}
        elif code is codes.SUBPATTERN:
            strings, more = _walk(value[-1])
        elif code is codes.BRANCH:
            parts = [_walk(x) for x in value[1]]
            if all(s is not None for s, _ in parts):
                strings = set().union(*(s for s, _ in parts))
            else:
                more = _least([x for s, q in parts for x in (_trigrams(s) if s is not None else q)])
        elif code in (codes.MAX_REPEAT, codes.MIN_REPEAT):
            low, high, inner = value
            inner_strings, inner_query = _walk(inner)
            if inner_strings is not None and high == 1:
                strings = inner_strings | ({""} if low == 0 else set())
            elif low and inner_strings is not None:
                strings, ends = inner_strings, True
            elif low:
                more = inner_query
        if strings is None or len(run) * len(strings) > MOST_STRINGS:
            stop(more if strings is None else _trigrams(strings))
            continue
        run = {x + y for x in run for y in strings}
        if ends:
            stop()
    return (run, ANYTHING) if exact else (None, _both(query, _trigrams(run)))


def trigram_query(pattern: str) -> Query:
    """An OR of ANDs of lower-case trigrams that holds for every text with a match."""
    strings, query = _walk(parser.parse(pattern))
    return _least(_trigrams(strings) if strings is not None else query)


def postings(docs: DataFrame, trigrams: list[str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc, trigram): one row for each of the given trigrams that a document contains."""
    lowered = docs.select(row_key(id_col, text_col).alias("doc"), F.lower(text_col).alias("low"))
    present = F.array_compact(F.array(*[F.when(F.contains("low", F.lit(t)), F.lit(t)) for t in trigrams]))
    return lowered.select("doc", F.explode(present).alias("trigram"))


def candidates(index: DataFrame, queries: dict[str, Query]) -> DataFrame:
    """(doc, rules): the rules whose query a document's postings satisfy."""
    found = index.groupBy("doc").agg(F.collect_set("trigram").alias("t"))

    def holds(query: Query) -> Column:
        alternatives = [F.forall(F.array(*map(F.lit, sorted(part))), lambda x: F.array_contains("t", x)) for part in query]
        return F.array_max(F.array(*alternatives))

    rules = F.array_compact(F.array(*[F.when(holds(query), F.lit(kind)) for kind, query in queries.items()]))
    return found.select("doc", rules.alias("rules")).where(F.size("rules") > 0)


def _lengths(text: Column, rule: Rule) -> Column:
    """For each match of a text: characters since the last match, of the match, and of its value."""
    pattern = F.lit(rule.pattern)
    between = F.transform(F.split(text, rule.pattern, -1), F.length)
    whole = F.transform(F.regexp_extract_all(text, pattern, F.lit(0)), F.length)
    value = F.transform(F.regexp_extract_all(text, pattern, F.lit(rule.group)), F.length)
    return F.arrays_zip(F.slice(between, F.lit(1), F.size(whole)).alias("gap"), whole.alias("size"), value.alias("value"))


def find_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, spans (array of start, rank of kind, kind, end, base) of every row."""
    queries = {r.kind: trigram_query(r.pattern) for r in rules}
    scanned = {kind for kind, query in queries.items() if frozenset() in query}
    asked = {kind: query for kind, query in queries.items() if kind not in scanned}
    trigrams = sorted(set().union(*(part for query in asked.values() for part in query)))
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), row_key(id_col, text_col).alias("doc"), F.col(text_col).alias("text"))
    if trigrams:
        index = postings(docs, trigrams, id_col, text_col)
        rows = rows.join(candidates(index, asked), "doc", "left")
    found = [
        F.when(F.rlike(text, F.lit(r.pattern)) if r.kind in scanned else F.array_contains("rules", r.kind), _lengths(text, r)).alias(f"m{k}")
        for k, r in enumerate(rules)
    ]
    # written out, so that the numbers given to the rows stay
    verified = staged(rows.select(F.monotonically_increasing_id().alias("row"), "id", *found), "secrets")
    kinds = F.array(*[
        F.struct(
            F.lit(k).alias("rank"), F.lit(r.kind).alias("kind"), F.lit(r.least).alias("least"), F.lit(r.base).alias("base"),
            F.col(f"m{k}").alias("found"),
        ) for k, r in enumerate(rules)
    ])
    matches = verified.select("row", F.explode(kinds).alias("k")).select("row", "k.*").where(F.size("found") > 0)
    matches = matches.select("row", "rank", "kind", "least", "base", F.posexplode("found").alias("at", "m"))
    until = Window.partitionBy("row", "rank").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("m.gap") + F.col("m.size")).over(until)
    spans = (
        matches.withColumn("end", end).where(F.col("m.value") >= F.col("least"))
        .select("row", F.struct((F.col("end") - F.col("m.size")).alias("start"), "rank", "kind", "end", "base").alias("s"))
        .groupBy("row").agg(F.sort_array(F.collect_list("s")).alias("spans"))
    )
    return verified.select("row", "id").join(spans, "row", "left").select("id", F.coalesce("spans", F.array()).alias("spans"))


def listed(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
