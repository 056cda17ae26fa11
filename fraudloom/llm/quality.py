"""Quality classifier: Bradley-Terry scores learned from preference pairs.

A text with label 1 is preferred to one with label 0. The score is a weighted sum of features, and
the weights minimise the logistic loss of score differences over preference pairs. The cut is a
quantile of the scores: the share of label 0 among all labels to learn from. The result is put on a
0 to 1 scale on which the cut is ``CUT``.

Every labelled row is learned from. Equal feature rows of one label are one row with a weight, and rows are
dealt by hash into buckets of about ``BUCKET_ROWS``; rows of a rare label go to as many buckets as need them.
In each of ``ROUNDS`` rounds a bucket lays both labels out in a random order and pairs what lies side by side,
so every row is paired in every round, by its weight. The driver gets sums of a bucket (300 numbers a step)
and counts of ranges of scores, never rows; the cut is found exactly by counting ever smaller ranges.

Defined cases: a null or empty text has zero features and a score like any other; null labels and
labels without a document are not learned from; without labels of both kinds every score is 1;
rows are scored one by one, so repeated rows get equal scores; an empty table gives an empty one.
"""
from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from fraudloom.llm.text import SPACED, blocks, in_batches, mix, per_text, staged, words

#: Rows of the more frequent label in a bucket, and the least of the other label.
BUCKET_ROWS = 16_384
LEAST_OTHERS = 64
ROUNDS = 8
#: Ranges counted at once in the search for the cut.
RANGES = 4_096
RIDGE = 1e-3
CUT = 0.3
#: Clipping of standardised features.
REACH = 6.0
FEATURES = (
    "log_words", "symbols", "exclamations", "digits", "upper", "non_ascii", "stops", "commas", "mean_length", "distinct",
    "top_word", "stuck", "repeated", "duplicate_lines", "line_words", "short", "bars",
)


def _table(characters: bytes) -> np.ndarray:
    found = np.zeros(256, bool)
    found[list(characters)] = True
    return found


_LEAD = np.array([b & 0xC0 != 0x80 for b in range(256)])
_TABLES = {
    "symbols": _table(b"#*$%&<>@^~=_{}[]\\/+"), "exclamations": _table(b"!?"), "digits": _table(b"0123456789"),
    "upper": _table(bytes(range(65, 91))), "non_ascii": np.array([b >= 0xC0 for b in range(256)]), "stops": _table(b".:;"),
    "commas": _table(b","), "bars": _table(b"|"),
}


def _repeats(keys: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each text: distinct keys, occurrences of the most frequent, occurrences of those met before."""
    distinct, most = np.zeros(n), np.zeros(n)
    if len(keys):
        _, first, counts = np.unique(mix(keys ^ mix(owner.astype(np.uint64) + np.uint64(7))), return_index=True, return_counts=True)
        distinct = np.bincount(owner[first], minlength=n).astype(float)
        np.maximum.at(most, owner[first], counts)
    return distinct, most, np.bincount(owner, minlength=n) - distinct


def features(run: list[bytes]) -> np.ndarray:
    """One row of ``FEATURES`` per text."""
    n = len(run)
    data = np.frombuffer(b"\n".join(run), np.uint8)
    found = words(run)
    owner = found.owners()
    count = found.counts.astype(float)
    some, chars = np.maximum(count, 1), per_text(SPACED[data] & _LEAD[data], run).astype(float)
    share = {k: per_text(table[data], run) / np.maximum(chars, 1) for k, table in _TABLES.items()}
    distinct, most, _ = _repeats(found.hashes, owner, n)
    grams, first = found.windows(3)
    _, _, again = _repeats(grams, owner[first], n)
    stuck = np.zeros(len(owner), bool)
    stuck[1:] = (found.hashes[1:] == found.hashes[:-1]) & (owner[1:] == owner[:-1])
    filled = [[line for line in raw.split(b"\n") if line.strip()] for raw in run]
    n_lines = np.array([max(len(x), 1) for x in filled], float)
    doubled = np.array([len(x) - len(set(x)) for x in filled], float)
    columns = {
        "log_words": np.log1p(count), "mean_length": np.minimum(chars / some, 40), "distinct": distinct / some,
        "top_word": most / some, "stuck": np.sqrt(np.bincount(owner, stuck, n) / some), "repeated": np.sqrt(again / some),
        "duplicate_lines": doubled / n_lines, "line_words": np.log1p(count / n_lines), "short": (count < 10).astype(float),
    } | {k: np.sqrt(x) if k in ("symbols", "exclamations", "digits", "bars") else x for k, x in share.items()}
    return np.stack([columns[k] for k in FEATURES], 1)


@F.arrow_udf(ArrayType(DoubleType()))
def measure(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """The features of each text."""
    for texts in batches:
        rows = [features(run) for run in blocks(texts)]
        flat = np.concatenate(rows).ravel() if rows else np.empty(0)
        yield pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, len(FEATURES)), pa.int32()), pa.array(flat))


@dataclass(frozen=True)
class Ranking:
    """Feature scale, weights, and the raw score at the cut."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    cut: float

    def raw(self, rows: np.ndarray) -> np.ndarray:
        return np.clip((rows - self.mean) / self.scale, -REACH, REACH) @ self.weights

    def score(self, rows: np.ndarray) -> np.ndarray:
        """0 to 1; ``CUT`` at the cut."""
        away = np.clip(self.raw(rows) - self.cut, -500, 500)
        return 1 / (1 + np.exp(-away) * (1 - CUT) / CUT)


def pair_sums(differences: np.ndarray, mass: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Slope and curvature of the log-likelihood of preferring each pair's first over its second."""
    doubt = 1 / (1 + np.exp(np.clip(differences @ weights, -500, 500)))
    bend = (differences * (mass * doubt * (1 - doubt))[:, None]).T @ differences
    return differences.T @ (mass * doubt), bend


def climb(sums: Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]], width: int, mass: float, steps: int = 50) -> np.ndarray:
    """Weights that minimise the logistic loss, by Newton's steps; ``sums`` gives slope and curvature at weights."""
    weights = np.zeros(width)
    penalty = RIDGE * mass * np.eye(width)
    for _ in range(steps):
        slope, bend = sums(weights)
        step = np.linalg.solve(bend + penalty, slope - penalty @ weights)
        weights = weights + step
        if np.abs(step).max() < 1e-8:
            break
    return weights


def fit_pairs(differences: np.ndarray, steps: int = 50) -> np.ndarray:
    """Weights that minimise the logistic loss of preferring each pair's first over its second."""
    mass = np.ones(len(differences))
    return climb(lambda w: pair_sums(differences, mass, w), differences.shape[1], len(differences), steps)


def side_by_side(good: np.ndarray, bad: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Two rows of weights stretched to one length: index in each, and length, of every stretch they share."""
    length = max(good.sum(), bad.sum())
    ends = [np.cumsum(w) / w.sum() * length for w in (good, bad)]
    cuts = np.union1d(*[e[:-1] for e in ends])
    low, high = np.concatenate(([0.0], cuts)), np.append(cuts, length)
    first, second = (np.minimum(np.searchsorted(e, low, "right"), len(e) - 1) for e in ends)
    return first, second, high - low


def cut_at(scores: np.ndarray, weights: np.ndarray, quantile: float) -> float:
    """The score below which ``quantile`` of the weight lies, midway between two scores."""
    order = np.argsort(scores, kind="stable")
    total = np.cumsum(weights[order])
    at = int(np.searchsorted(total, quantile * total[-1] * (1 + 1e-12), "right"))
    low, high = scores[order[max(at - 1, 0)]], scores[order[min(at, len(order) - 1)]]
    return float((low + high) / 2)


def _unlearned() -> Ranking:
    k = len(FEATURES)
    return Ranking(np.zeros(k), np.ones(k), np.zeros(k), -500.0)


_ROW = np.dtype([("label", "i8"), ("mass", "f8"), ("x", "f8", (len(FEATURES),))])


def _pack(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """A bucket as one value, its rows in an order that does not depend on how they arrive."""
    rows = np.empty(len(table), _ROW)
    rows["label"], rows["mass"] = table.column("label").to_numpy(), table.column("mass").to_numpy()
    rows["x"] = table.column("x").combine_chunks().flatten().to_numpy().reshape(-1, len(FEATURES))
    rows = rows[np.lexsort([*rows["x"].T, rows["label"]])]
    return pa.table({"bucket": pa.array([key[0].as_py()], pa.int64()), "rows": pa.array([rows.tobytes()], pa.binary())})


def _over_buckets(buckets: DataFrame, work: Callable[[int, np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum over buckets, always added in the same order, of what ``work`` gives for a bucket's rows."""
    @F.arrow_udf(ArrayType(DoubleType()))
    def run(numbers: pa.Array, blobs: pa.Array) -> pa.Array:
        made = [work(n, np.frombuffer(b, _ROW)).tolist() for n, b in zip(numbers.to_pylist(), blobs.to_pylist())]
        return pa.array(made, pa.list_(pa.float64()))

    found = in_batches(buckets).select("bucket", run("bucket", "rows").alias("sums")).toArrow().sort_by("bucket")
    return np.sum(np.array(found.column("sums").to_pylist()), 0)


def _dealt(rows: DataFrame, sizes: dict[int, int]) -> DataFrame:
    """``rows`` (distinct by label and features) as one value per bucket; each has rows of both labels."""
    rare = min(sizes, key=lambda k: (sizes[k], k))
    n_buckets = -(-max(sizes.values()) // BUCKET_ROWS)
    times = min(n_buckets, -(-LEAST_OTHERS * n_buckets // sizes[rare]))
    place = F.pmod(F.xxhash64("x"), F.lit(n_buckets))
    copies = F.when(F.col("label") == rare, times).otherwise(1)
    spread = rows.select(
        "label", (F.col("n") / copies).alias("mass"), "x", place.alias("place"),
        F.explode(F.sequence(F.lit(0), copies - 1)).alias("copy"))
    bucket = F.pmod(F.col("place") + F.col("copy"), F.lit(n_buckets)).alias("bucket")
    return spread.select(bucket, "label", "mass", "x").groupBy("bucket").applyInArrow(_pack, "bucket long, rows binary")


def _fit(buckets: DataFrame) -> Ranking:
    """Scale and weights from all rows of all buckets; the cut is still to be set."""
    k = len(FEATURES)
    total = _over_buckets(buckets, lambda _, r: np.append(r["mass"] @ r["x"], r["mass"].sum()))
    mean = total[:k] / total[k]
    scale = np.sqrt(_over_buckets(buckets, lambda _, r: r["mass"] @ (r["x"] - mean) ** 2) / total[k])
    scale = np.where(scale > 1e-9, scale, 1.0)

    def sums(weights: np.ndarray) -> Callable[[int, np.ndarray], np.ndarray]:
        def work(number: int, rows: np.ndarray) -> np.ndarray:
            standard = np.clip((rows["x"] - mean) / scale, -REACH, REACH)
            sides = [np.flatnonzero(rows["label"] == label) for label in (1, 0)]
            dice, out = np.random.default_rng((11, number)), np.zeros(k + k * k + 1)
            if all(map(len, sides)):
                for _ in range(ROUNDS):
                    good, bad = (dice.permutation(side) for side in sides)
                    i, j, mass = side_by_side(rows["mass"][good], rows["mass"][bad])
                    slope, bend = pair_sums(standard[good[i]] - standard[bad[j]], mass, weights)
                    out += np.concatenate([slope, bend.ravel(), [mass.sum()]])
            return out

        return work

    first = _over_buckets(buckets, sums(np.zeros(k)))

    def at(weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        found = _over_buckets(buckets, sums(weights)) if weights.any() else first
        return found[:k], found[k:-1].reshape(k, k)

    return Ranking(mean, scale, climb(at, k, first[-1]), 0.0)


def cut_of(scored: DataFrame, each: dict[int, float], quantile: float) -> float:
    """``cut_at`` for a table of ``label, n, s`` (``n`` rows of score ``s``), where a row of a label weighs ``each``."""
    def weight(row) -> float:
        return each[0] * row["n0"] + each[1] * row["n1"]

    counts = [F.coalesce(F.sum(F.when(F.col("label") == k, F.col("n"))), F.lit(0)).alias(f"n{k}") for k in (0, 1)]
    ends = [F.min("s").alias("low"), F.max("s").alias("high")]
    whole = scored.agg(*counts, *ends).first()
    target, below, found = quantile * weight(whole) * (1 + 1e-12), 0.0, whole
    while found["low"] < found["high"]:
        low, high = found["low"], found["high"]
        place = F.floor((F.col("s") - low) / (high - low) * RANGES).alias("place")
        inside = scored.where(F.col("s").between(low, high))
        for found in sorted(inside.groupBy(place).agg(*counts, *ends).collect(), key=lambda r: r["place"]):
            if below + weight(found) > target or found["high"] == high:
                break
            below += weight(found)
    value = found["low"]
    near = scored.agg(F.max(F.when(F.col("s") < value, F.col("s"))).alias("low"), F.min(F.when(F.col("s") > value, F.col("s"))).alias("high")).first()
    # one row of the value by itself, so that the cut may lie after it
    one = each[0] if found["n0"] else each[1]
    parts = [(value, one), (value, weight(found) - one)]
    if near["low"] is not None:
        parts.insert(0, (near["low"], below))
    if near["high"] is not None:
        parts.append((near["high"], weight(whole) - below - weight(found)))
    values, weights = zip(*[p for i, p in enumerate(parts) if p[1] > 0 or p[0] != value])
    return cut_at(np.array(values), np.array(weights), quantile)


def learn(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality"
) -> Ranking:
    """Rank the labelled documents. ``labels`` holds the rows to learn from."""
    known = labels.select(F.col(id_col).alias("__id"), F.col(label_col).cast("int").alias("label")).where(
        "__id is not null and label in (0, 1)"
    )
    sizes = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(sizes) < 2:
        return _unlearned()
    # features first: they are small, so that the join moves no text
    measured = in_batches(docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text")).where("__id is not null"))
    rows = staged(
        measured.select("__id", measure("__text").alias("x")).join(known, "__id")
        .groupBy("label", "x").agg(F.count("*").alias("n")), "quality-rows")
    distinct, all_rows = {}, {}
    for r in rows.groupBy("label").agg(F.count("*").alias("d"), F.sum("n").alias("n")).collect():
        distinct[r["label"]], all_rows[r["label"]] = r["d"], r["n"]
    if len(distinct) < 2:
        return _unlearned()
    model = _fit(staged(_dealt(rows, distinct), "quality-buckets"))

    @F.arrow_udf(DoubleType())
    def raw(lists: pa.Array) -> pa.Array:
        return pa.array(model.raw(lists.flatten().to_numpy().reshape(-1, len(FEATURES))))

    scored = staged(rows.select("label", "n", raw("x").alias("s")), "quality-scores")
    each = {k: sizes[k] / all_rows[k] for k in sizes}
    return replace(model, cut=cut_of(scored, each, sizes[0] / (sizes[0] + sizes[1])))


def score(docs: DataFrame, model: Ranking, text_col: str = "text") -> DataFrame:
    """``docs`` with the column ``__score``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf(DoubleType())
    def judge(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            rows = [shared.value.score(features(run)) for run in blocks(texts)]
            yield pa.array(np.concatenate(rows) if rows else np.empty(0))

    return in_batches(docs).withColumn("__score", judge(F.col(text_col)))
