"""Mixing sources to target weights.

Words are summed per source, targets follow from the weights, and each source's repetition rate is its
target over its words. A document is taken ``floor(rate)`` times, and once more if its hash falls into the
part of the hash range that holds the fraction. That part is cut where the fraction of the source's words
lies below it, read off a histogram of words over ``BUCKETS`` hash ranges: with many documents the cut is
the fraction itself, with few it takes the luck of the draw out, so sources of every size meet their target
to about one document (or one bucket). A document's share of the cut depends on its hash alone.

Texts are read once to measure and once to emit, and never shuffled: what moves is one row per source
and bucket. Targets are found by rounds of sums over the sources, each giving one row, so the number of
sources is not bounded by the driver.

Defined cases: a null text has no words; a null source is a source of its own, last in order; sources
without words have target, rate and copies of zero; rows with equal id and text share one draw, others
with the same id are drawn apart; a null id is drawn by its text; an empty table gives an empty one.
Columns that share a name with an added one are replaced; others are carried along.
"""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fraudloom.llm.text import staged

#: Weights of the sources in order, repeating; a target is at most ``CAP`` times a source's words.
WEIGHTS = (1, 2, 3)
CAP = 3
BUCKETS = 1 << 12
SEED = "mix"
#: Sources up to this number, with names up to this many bytes in all, are broadcast to the documents.
MOST_BROADCAST, MOST_BROADCAST_BYTES = 20_000, 8 << 20
SALTS = 16
_WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(_WORD)), F.lit(0)).cast("long")


def bucket_of(id_col: str, text_col: str, seed: str = SEED) -> Column:
    """The hash range, 0 to ``BUCKETS`` - 1, into which a document falls."""
    key = F.concat_ws(":", F.lit(seed), F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.coalesce(F.col(text_col), F.lit("")))
    return F.conv(F.substring(F.md5(key), 1, 3), 16, 10).cast("int")


def measured(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """(id, source, size, bucket) of every document."""
    return docs.select(
        F.col(id_col).alias("id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"),
        bucket_of(id_col, text_col).alias("bucket"),
    )


def weighted(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """``sources`` (one row each) with a weight by their place in code point order, null last.

    Places are counted within ranges of names and carried on from range to range, so no task sees all.
    """
    in_order = F.col("source").asc_nulls_last()
    parts = int(sources.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = staged(
        sources.repartitionByRange(parts, in_order).withColumn("part", F.spark_partition_id()), "sources")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    bases = ranged.groupBy("part").count().select("part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("base"))
    place = F.col("base") + F.row_number().over(Window.partitionBy("part").orderBy(in_order)) - 1
    cycle = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.pmod(place, F.lit(len(weights))) + 1).cast("int"))
    return ranged.join(bases, "part").withColumn("weight", cycle.cast("long")).drop("part", "base")


def water_level(sources: DataFrame, cap: int = CAP) -> float | None:
    """Words per unit of weight when no source may hold more than ``cap`` times its words.

    Sources over their cap are set to it and the rest is shared again until none is over; None if all
    are at their cap. Each round is one sum over the sources.
    """
    whole = sources.agg(F.sum("words").alias("words"), F.sum("weight").alias("weight")).first()
    n, words, weight = 0, 0, 0
    while whole["weight"] and whole["weight"] > weight:
        level = (whole["words"] - cap * words) / (whole["weight"] - weight)
        over = F.col("words") * cap < F.col("weight") * F.lit(level)
        got = sources.where(over).agg(F.count("*").alias("n"), F.sum("words").alias("words"), F.sum("weight").alias("weight")).first()
        if got["n"] <= n:
            return level
        n, words, weight = got["n"], got["words"], got["weight"]
    return None


@dataclass(frozen=True)
class Mix:
    """Per source: words, target, whole repetitions and the last hash bucket of the extra copy."""

    rates: DataFrame  # source, source_size, target, times, last_bucket
    broadcast: bool

    def copies(self, rows: DataFrame, source: str, bucket: str) -> DataFrame:
        """``rows`` with ``__source_size``, ``__target`` and ``__copies`` by the source's rate."""
        rates = self.rates.select(F.col("source").alias("__mix_source"), *[F.col(c).alias(f"__{c}") for c in self.rates.columns[1:]])
        match = F.col(source).eqNullSafe(F.col("__mix_source"))
        if self.broadcast:
            joined = rows.join(F.broadcast(rates), match, "left")
        else:
            rates = rates.withColumn("__mix_part", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
            joined = rows.join(rates, match & (F.pmod(F.col(bucket), F.lit(SALTS)) == F.col("__mix_part")), "left").drop("__mix_part")
        extra = (F.col(bucket) <= F.col("__last_bucket")).cast("long")
        return joined.withColumn("__copies", F.col("__times") + extra).drop("__mix_source", "__times", "__last_bucket")


def plan_mix(rows: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> Mix:
    """Rates of the sources of measured ``rows`` (source, size, bucket)."""
    histogram = staged(
        rows.groupBy("source", "bucket").agg(F.sum("size").alias("words"), F.count("*").alias("n")), "mix-histogram")
    sources = staged(weighted(histogram.groupBy("source").agg(F.sum("words").alias("words")), weights), "mix-weights")
    level = water_level(sources, cap)
    capped = (F.col("words") * cap).cast("double")
    target = capped if level is None else F.least(F.col("weight") * F.lit(level), capped)
    rate = F.when(F.col("words") > 0, F.col("target") / F.col("words")).otherwise(0.0)
    rated = sources.withColumn("target", target).withColumn("times", F.floor(rate))
    wanted = F.col("target") - F.col("times") * F.col("words")
    upto = F.sum("words").over(Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0))
    edges = histogram.select("source", F.col("bucket").alias("edge"), upto.alias("upto")).unionByName(
        sources.select("source", F.lit(-1).alias("edge"), F.lit(0).cast("long").alias("upto")))
    wants = rated.select(F.col("source").alias("s"), wanted.alias("wanted"))
    nearest = F.min(F.struct(F.abs(F.col("upto") - F.col("wanted")), F.col("edge")))["edge"]
    cuts = edges.join(wants, F.col("source").eqNullSafe(F.col("s"))).groupBy("s").agg(nearest.alias("last_bucket"))
    rates = staged(
        rated.join(cuts, F.col("source").eqNullSafe(F.col("s")))
        .select("source", F.col("words").alias("source_size"), "target", "times", "last_bucket"), "mix-rates")
    size = rates.agg(F.count("*").alias("n"), F.sum(F.octet_length("source")).alias("bytes")).first()
    return Mix(rates, size["n"] <= MOST_BROADCAST and (size["bytes"] or 0) <= MOST_BROADCAST_BYTES)


def taken(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """(doc_id, size, source_size, target, taken) of every document; ``taken`` counts repeated words."""
    rows = staged(measured(docs), "mix-sizes")
    found = plan_mix(rows, weights, cap).copies(rows, "source", "bucket")
    return found.select(
        F.col("id").alias("doc_id"), "size", F.col("__source_size").alias("source_size"), F.col("__target").alias("target"),
        (F.col("__copies") * F.col("size")).alias("taken"),
    )


def mix(
    docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP, id_col: str = "doc_id",
    source_col: str = "source", text_col: str = "text", copy_col: str = "copy",
) -> DataFrame:
    """The mixed corpus: every document as often as it is taken, numbered from 0 in ``copy_col``."""
    found = plan_mix(measured(docs, id_col, source_col, text_col), weights, cap)
    drawn = docs.drop(copy_col).withColumn("__bucket", bucket_of(id_col, text_col))
    kept = found.copies(drawn, source_col, "__bucket").where(F.col("__copies") > 0)
    number = F.explode(F.sequence(F.lit(0).cast("long"), F.col("__copies") - 1))
    return kept.withColumn(copy_col, number).drop("__bucket", "__copies", "__source_size", "__target")
