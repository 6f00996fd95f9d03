"""Mixing sources to target weights by Poisson replication (operator 6).

Every document is repeated a Poisson number of times whose mean is its source's
rate, ``weight x total / documents of the source``.  The number is the inverse of
the Poisson distribution at a uniform value hashed from seed and document, so it
does not depend on partitioning and can be repeated by any engine.  A rate whose
``exp(-rate)`` doubles cannot hold is the sum of equal smaller ones, each drawn from
its own hash: a sum of Poisson numbers is one.  Copies are put in a global random
order by a second hash.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from pressmill.llm.common import packed, unpacked

SEED = "mix-1"
POWER = 0.5
# sources whose table of probabilities is sent to every task; beyond it, a join
BROADCAST_SOURCES = 10_000
# rates over the first are drawn as sums of draws of at most the second
ONE_DRAW, PART_RATE = 700, 500
# copies of a document that are listed at once
COPIES_AT_ONCE = 1024


def uniform(*key: Column) -> Column:
    """A number in [0, 1) with 52 bits from the MD5 digest of a key."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *key)), 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def _terms(rate: Column) -> Column:
    """Cumulative Poisson probabilities 0, 1, ... as far as doubles tell them from 1."""
    most = (rate + 12 * F.sqrt(rate) + 30).cast("int")
    step = F.aggregate(
        F.sequence(F.lit(1), most),
        F.struct(F.exp(-rate).alias("p"), F.exp(-rate).alias("c"), F.array(F.exp(-rate)).alias("all")),
        lambda s, k: F.struct(
            (s["p"] * rate / k).alias("p"), (s["c"] + s["p"] * rate / k).alias("c"),
            F.concat(s["all"], F.array(s["c"] + s["p"] * rate / k)).alias("all")),
    )
    return step["all"]


def source_rates(docs: DataFrame, source: str = "source", power: float = POWER,
                 weights: dict[str, float] | None = None, total: int | None = None) -> DataFrame:
    """``(source, n, rate)``: how often a document of each source is repeated on average.

    Target weights are given, or grow with the source's size to the ``power``.  A
    source without a weight gets none of the mix.  ``total`` is the expected number
    of copies, by default the number of documents.  Rows without a source are one
    source.
    """
    counts = docs.groupBy(F.col(source).alias("__mix_source")).agg(F.count("*").alias("n"))
    if weights is None:
        counts = counts.withColumn("w", F.pow(F.col("n").cast("double"), F.lit(power)))
    else:
        given = docs.sparkSession.createDataFrame([(k, float(v)) for k, v in weights.items()], "_s string, w double")
        counts = counts.join(given, F.col("__mix_source").eqNullSafe(F.col("_s")), "left").select(
            "__mix_source", "n", F.coalesce("w", F.lit(0.0)).alias("w"))
    sums = counts.agg(F.sum("w"), F.sum("n")).first()
    if not sums[1]:
        return counts.select("__mix_source", "n", F.lit(0.0).alias("rate"))
    share = F.col("w") / F.lit(math.fsum([sums[0]]) or 1.0)
    return counts.select("__mix_source", "n", (share * F.lit(float(total if total is not None else sums[1])) / F.col("n")).alias("rate"))


def poisson_copies(docs: DataFrame, id_col: str = "doc_id", source: str = "source", seed: str = SEED,
                   power: float = POWER, weights: dict[str, float] | None = None,
                   total: int | None = None) -> DataFrame:
    """``docs`` with ``_copy`` (from 1) and ``_order``: one row per copy, not yet shuffled.

    Columns of ``docs`` may have any names.  The draw depends on seed and id only, so repeated rows are repeated alike; a
    null id draws like an empty one.  Rates may be of any size.
    """
    copies = _copies(docs, id_col, source, seed, power, weights, total)
    return copies.select(*unpacked(docs), "_copy", "_order")


def _copies(docs: DataFrame, id_col: str = "doc_id", source: str = "source", seed: str = SEED, power: float = POWER,
            weights: dict[str, float] | None = None, total: int | None = None) -> DataFrame:
    """Rows packed, with ``_copy`` and ``_order``."""
    rates = source_rates(docs, source, power, weights, total)
    sources = rates.count()
    parts = F.when(F.col("rate") > ONE_DRAW, F.ceil(F.col("rate") / PART_RATE)).otherwise(F.lit(1)).cast("int")
    table = rates.withColumn("__mix_parts", parts).select(
        "__mix_source", "__mix_parts", _terms(F.col("rate") / F.col("__mix_parts")).alias("__mix_terms"))
    if sources <= BROADCAST_SOURCES:
        table = F.broadcast(table)
    name = F.coalesce(F.col("__mix_id").cast("string"), F.lit(""))
    several = F.transform(F.sequence(F.lit(1), F.col("__mix_parts")),
                          lambda i: uniform(F.lit(seed), F.lit("draw"), name, i.cast("string")))
    us = F.when(F.col("__mix_parts") == 1, F.array(uniform(F.lit(seed), name))).otherwise(several)
    numbers = F.transform(us, lambda u: F.size(F.filter("__mix_terms", lambda c: c <= u)))
    rows = docs.select(packed(docs), F.col(f"`{id_col}`").alias("__mix_id"), F.col(f"`{source}`").alias("__mix_own"))
    drawn = rows.join(table, F.col("__mix_own").eqNullSafe(F.col("__mix_source"))) \
        .withColumn("__mix_n", F.aggregate(numbers, F.lit(0).cast("long"), lambda s, n: s + n))
    # in two steps, so that no list is as long as the copies of a document
    n, at = F.col("__mix_n"), F.col("__mix_at")
    copies = drawn.where("__mix_n > 0") \
        .withColumn("__mix_at", F.explode(F.sequence(F.lit(1).cast("long"), n, F.lit(COPIES_AT_ONCE).cast("long")))) \
        .withColumn("_copy", F.explode(F.sequence(at, F.least(at + F.lit(COPIES_AT_ONCE - 1), n))))
    order = F.md5(F.concat_ws("|", F.lit(seed), F.lit("order"), name, F.col("_copy").cast("string")))
    return copies.withColumn("_order", order).select("_all", "_copy", "_order")


def mix(docs: DataFrame, **options) -> DataFrame:
    """Copies of ``docs`` in global random order, with the columns of ``docs`` alone.

    Empty tables give empty ones; texts are not looked at.
    """
    return _copies(docs, **options).orderBy("_order").select(*unpacked(docs))
