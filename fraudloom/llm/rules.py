"""Quality rules: a ledger of failure bits and measurements, judged afterwards by policies.

Every rule is evaluated once per text. The ledger holds what was measured and one bit per failed
rule, so a new policy version, or the effect of leaving a rule out, needs no second look at a text.

Defined cases: a null or empty text has no words, zero measurements, and fails ``few_words``;
rows are judged one by one, so repeated rows get equal results; an empty table gives an empty one.
Windows are compared by 64-bit hash.
"""
from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from fraudloom.llm.text import SPACED, blocks, in_batches, mix, per_text, struct_array, struct_type, words

WINDOW = 5
MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_stuck_words",
)
MEASURED = struct_type(**dict.fromkeys(MEASURES, LongType()))
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LEAD = np.array([b & 0xC0 != 0x80 for b in range(256)])


def _repeat_words(found, width: int) -> np.ndarray:
    """Words of each text that lie in a window found twice or more in it."""
    hashes, first = found.windows(width)
    covered = np.zeros(len(found.hashes), bool)
    owner = found.owners()
    if len(first):
        keys = mix(hashes ^ mix(owner[first].astype(np.uint64) + np.uint64(1)))
        _, inverse, counts = np.unique(keys, return_inverse=True, return_counts=True)
        again = first[counts[inverse] > 1]
        for k in range(width):
            covered[again + k] = True
    return np.bincount(owner, covered, len(found.bounds) - 1).astype(np.int64)


def _lines(raw: bytes) -> tuple[int, int]:
    """Lines with a word, and those of them equal to an earlier one."""
    filled = [line for line in raw.split(b"\n") if line.strip()]
    return len(filled), len(filled) - len(set(filled))


@F.arrow_udf(MEASURED)
def measure(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """The measurements of each text, in the order of ``MEASURES``."""
    for texts in batches:
        parts: list[list[np.ndarray]] = []
        for run in blocks(texts):
            found = words(run)
            data = np.frombuffer(b"\n".join(run), np.uint8)
            owner = found.owners()
            stuck = np.zeros(len(owner), bool)
            stuck[1:] = (found.hashes[1:] == found.hashes[:-1]) & (owner[1:] == owner[:-1])
            lines = np.array([_lines(raw) for raw in run])
            parts.append([
                found.counts, per_text(SPACED[data] & _LEAD[data], run), per_text(_SYMBOL[data], run), lines[:, 1],
                _repeat_words(found, WINDOW), lines[:, 0], per_text(_UPPER[data], run),
                np.bincount(owner, stuck, len(run)).astype(np.int64),
            ])
        columns = [np.concatenate(x) for x in zip(*parts)] if parts else [np.empty(0, np.int64)] * len(MEASURES)
        yield struct_array({name: pa.array(x, pa.int64()) for name, x in zip(MEASURES, columns)})


#: Rules in the order of their bits; true where a text fails. Integers only, so that every engine agrees.
RULES = {
    "few_words": "n_words < 10",
    "repeated_windows": "100 * n_repeat_words > 20 * n_words",
    "symbols": "100 * n_symbols > 10 * n_words",
    "duplicate_lines": "100 * n_dup_lines > 50 * n_lines",
    "short_words": "word_chars < 2 * n_words",
    "long_words": "word_chars > 20 * n_words",
    "upper_case": "100 * n_upper > 50 * word_chars",
    "stuck_words": "100 * n_stuck_words > 20 * n_words",
}


@dataclass(frozen=True)
class Policy:
    """A version of the verdict: rules of ``reject`` that a text may not fail."""

    version: str
    reject: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(1 << k for k, name in enumerate(RULES) if name in self.reject)


BASE = ("few_words", "repeated_windows")
#: v3 also rejects by word length and case, which suits only texts with spaces between words and little upper case.
POLICIES = {p.version: p for p in (
    Policy("base", BASE), Policy("v1", BASE + ("symbols", "duplicate_lines")),
    Policy("v2", BASE + ("symbols", "duplicate_lines", "stuck_words")), Policy("v3", tuple(RULES)),
)}


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The id, every measurement, and ``failed``, one bit per rule of ``RULES``."""
    measured = in_batches(docs).select(F.col(id_col), measure(F.col(text_col)).alias("__m")).select(id_col, "__m.*")
    bits = [F.expr(rule).cast("long") * F.lit(1 << k) for k, rule in enumerate(RULES.values())]
    return measured.withColumn("failed", sum(bits[1:], bits[0]))


def verdict(policy: Policy, failed: Column | str = "failed") -> Column:
    """True where no rule of the policy fails."""
    return (F.col(failed) if isinstance(failed, str) else failed).bitwiseAND(F.lit(policy.mask)) == 0


def ablations(rows: DataFrame, policy: Policy) -> DataFrame:
    """For each rule of the policy: texts that fail it, and those that only it rejects.

    Rows are first counted by failure bits, so what is exploded is one row per bit pattern.
    """
    patterns = rows.groupBy(F.col("failed").bitwiseAND(F.lit(policy.mask)).alias("bits")).count()
    rules = F.explode(F.array(*[
        F.struct(F.lit(name).alias("rule"), F.lit(1 << k).cast("long").alias("bit"))
        for k, name in enumerate(RULES) if name in policy.reject
    ]))
    return (
        patterns.select("bits", "count", rules.alias("r")).groupBy("r.rule")
        .agg(
            F.sum(F.when(F.col("bits").bitwiseAND(F.col("r.bit")) != 0, F.col("count")).otherwise(0)).alias("n_failed"),
            F.sum(F.when(F.col("bits") == F.col("r.bit"), F.col("count")).otherwise(0)).alias("n_only_this"),
        )
    )
