"""Mixing sources to target weights with a temperature.

A source's share of the tokens is raised to an exponent between 0 (all sources alike) and 1 (as they come) and made to add up to 1.
The exponent is bisected until the weights have a wanted entropy or until no source is repeated more often than a limit
allows. Weights become a budget of tokens for each source, spent in epochs: every epoch is a permutation of the source's blocks of
documents, whole epochs hold each document once, and the last one breaks off where the budget is spent. All of it
is DataFrame operations; a step of the bisection is an aggregation over one row for each source.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from creditloom.llm.common import known, named, numbered, restored, staged

WORD = r"[^\x20\x09-\x0D]+"
BLOCK_DOCS = 1024  # documents that are shuffled within a block; blocks are shuffled within an epoch
STEPS_A_JOB = 5  # steps of the bisection that one aggregation looks ahead
JOBS = 9


@dataclass(frozen=True)
class Mixture:
    """Sources as `source`, `tokens`, `docs`, `weight`, `epochs`; the exponent they were weighted with."""

    exponent: float
    sources: DataFrame


def uniform(*columns: Column) -> Column:
    """A number from 0 to 1, the same for the same values."""
    return F.shiftrightunsigned(F.xxhash64(*columns), 11) / F.lit(float(1 << 53))


def source_sizes(docs: DataFrame, text: str, source: str) -> DataFrame:
    """One row for each source, a null one included: its words and documents."""
    words = F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0))
    return staged(docs.select(F.col(source).alias("source"), words.alias("n")).groupBy("source").agg(F.sum("n").alias("tokens"), F.count("n").alias("docs")))


def _figures(shares: DataFrame, exponents: list[float]) -> dict[float, tuple[float, float, float]]:
    """For each exponent: the sum of the powers, the entropy, and the least and the most that a share is multiplied by."""
    rows = shares.select(F.explode(F.array(*map(F.lit, exponents))).alias("e"), F.log("share").alias("log"))
    power = F.exp(F.col("e") * F.col("log"))
    gain = F.exp((F.col("e") - 1) * F.col("log"))
    sums = rows.groupBy("e").agg(
        F.sum(power).alias("z"), F.sum(power * F.col("e") * F.col("log")).alias("x"), F.min(gain).alias("low"), F.max(gain).alias("high")
    )
    return {r.e: (math.log(r.z) - r.x / r.z, r.low / r.z, r.high / r.z) for r in sums.collect()}


def bisect(shares: DataFrame, enough) -> float:
    """The smallest exponent from 0 to 1 at which `enough` of the figures holds, which it does from there on up to 1.

    One aggregation evaluates all exponents that the next few steps can come to; 45 steps leave nothing to halve.
    """
    low, high = 0.0, 1.0
    if enough(_figures(shares, [0.0])[0.0]):
        return 0.0
    for _ in range(JOBS):
        parts = 1 << STEPS_A_JOB
        grid = [low + (high - low) * k / parts for k in range(1, parts)]
        figures = _figures(shares, grid)
        a, b = 0, parts
        while b - a > 1:
            middle = (a + b) // 2
            a, b = (a, middle) if enough(figures[grid[middle - 1]]) else (middle, b)
        edges = [low, *grid, high]
        low, high = edges[a], edges[b]
    # Sums depend on the order of their terms in the last digits; these are not part of the result.
    return min(1.0, math.ceil(high * 1e9) / 1e9)


def mixture(docs: DataFrame, text: str = "text", source: str = "source", entropy: float | None = None, max_epochs: float | None = None, budget: float | None = None) -> Mixture:
    """Weights of the sources for `budget` tokens, by default as many as let every source be read once at least.

    Either `entropy`, the wanted entropy over that of equal weights, or `max_epochs`, how often a source may be read at most, gives
    the exponent: the smallest that keeps within it, which spreads weight the most. A wanted entropy below that of the shares as they come, or
    a limit that even they break, raises ValueError. Sources without words get no weight.
    """
    if (entropy is None) == (max_epochs is None):
        raise ValueError("give either entropy or max_epochs")
    sizes = source_sizes(docs, text, source)
    total, count = sizes.where("tokens > 0").agg(F.sum("tokens"), F.count("tokens")).first()
    total = total or 0
    if not total:
        return Mixture(1.0, sizes.withColumns({"weight": F.lit(0.0), "epochs": F.lit(0.0)}))
    shares = staged(sizes.where("tokens > 0").withColumn("share", F.col("tokens") / F.lit(total)))
    start = _figures(shares, [1.0])[1.0]
    if entropy is not None:
        wanted = entropy * math.log(count)
        if start[0] > wanted + 1e-12:
            raise ValueError("the shares are closer to equal weights than the wanted entropy")
        # Entropy falls as the exponent grows: go down from equal weights as far as it is wanted.
        exponent = bisect(shares, lambda f: f[0] <= wanted + 1e-12)
    else:
        # A source is read budget / total times its gain; by default the least gain stands for one epoch.
        epochs = (lambda f: f[2] / f[1]) if budget is None else (lambda f: f[2] * budget / total)
        if epochs(start) > max_epochs * (1 + 1e-12):
            raise ValueError("the budget needs more epochs than the limit at any exponent")
        exponent = bisect(shares, lambda f: epochs(f) <= max_epochs)
    _, least, _ = _figures(shares, [exponent])[exponent]
    z = shares.agg(F.sum(F.pow("share", F.lit(exponent)))).first()[0]
    spent = budget if budget is not None else total / least
    weight = F.when(F.col("tokens") > 0, F.pow(F.col("tokens") / F.lit(total), F.lit(exponent)) / F.lit(z)).otherwise(0.0)
    weighted = sizes.withColumn("weight", F.round(weight, 12))
    epochs = F.coalesce(F.try_divide(F.col("weight") * F.lit(float(spent)), F.col("tokens")), F.lit(0.0))
    # A share of an epoch that is only a rounding error is none.
    return Mixture(exponent, staged(weighted.withColumn("epochs", F.round(epochs, 9))))


def schedule(docs: DataFrame, text: str = "text", source: str = "source", doc_id: str = "doc_id", seed: int = 3, **target) -> DataFrame:
    """How often each document is read and when: `_id`, `_copy`, `source`, `n_tokens`, `weight`, `epochs`, `copies`, `position`.

    In the epoch that breaks off, documents are read while the tokens before them, in the order of the permutation, are within the
    budget. `position` (0 to 1) is where the document stands first if the sources are read alongside; see read_order. Documents
    without words belong to their source and cost nothing; a source without any words is left out (`copies` 0). A null source is one of its
    own; rows that repeat are scheduled alike. `target` is that of mixture.
    """
    weights = mixture(docs, text, source, **target).sources
    rows = docs.select(
        known(doc_id).alias("_id"), F.xxhash64(text).alias("_copy"), F.col(source).alias("source"),
        F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("bigint").alias("n_tokens"),
    )
    placed = rows.join(weights, rows["source"].eqNullSafe(weights["source"])).drop(weights["source"])
    whole = F.floor("epochs").cast("bigint")
    blocks = F.ceil(F.col("docs") / F.lit(BLOCK_DOCS))
    key = [F.col("_id"), F.col("_copy")]
    placed = staged(
        placed.withColumns({
            "block": F.pmod(F.xxhash64(*key, F.lit(seed)), blocks),
            "whole": whole,
            "rest": (F.col("epochs") - whole) * F.col("tokens"),
        })
    )
    # The permutation of blocks: their tokens before each, from one row for a block.
    before = Window.partitionBy("source").orderBy(F.xxhash64(F.lit(seed), F.col("whole"), F.col("block")), "block")
    earlier = before.rowsBetween(Window.unboundedPreceding, -1)
    sums = placed.groupBy("source", "block", "whole", "rest").agg(F.sum("n_tokens").alias("block_tokens"))
    sums = staged(sums.withColumn("before", F.coalesce(F.sum("block_tokens").over(earlier), F.lit(0))).withColumnsRenamed({"source": "s", "block": "b"}).drop("whole", "rest"))
    joined = placed.join(sums, placed["source"].eqNullSafe(sums["s"]) & (placed["block"] == sums["b"])).drop("s", "b")
    # Within a block documents follow each other by hash; a block is small, so this runs over a bounded group.
    inner = Window.partitionBy("source", "block").orderBy(F.xxhash64(F.lit(seed), F.col("whole"), *key), *key).rowsBetween(Window.unboundedPreceding, -1)
    at = joined.withColumn("place", F.col("before") + F.coalesce(F.sum("n_tokens").over(inner), F.lit(0)))
    copies = F.when(F.col("weight") > 0, F.col("whole") + F.when(F.col("place") < F.col("rest"), 1).otherwise(0)).otherwise(0)
    position = F.when(F.col("weight") > 0, F.col("place") / F.col("tokens") / F.col("epochs"))
    return at.select("_id", "_copy", "source", "n_tokens", "weight", "epochs", copies.cast("bigint").alias("copies"), position.alias("position"))


def read_order(copies: Column, position: Column, epochs: Column) -> Column:
    """Places of all copies of a document: an epoch apart, so every stretch of the order has the mixture's weights."""
    return F.transform(F.sequence(F.lit(0).cast("bigint"), copies - 1), lambda k: position + k / epochs)


def mix(docs: DataFrame, text: str = "text", source: str = "source", doc_id: str = "doc_id", **target) -> DataFrame:
    """The rows of `docs`, each as often as it is read, with all their columns. See schedule."""
    plan = schedule(docs, text, source, doc_id, **target).groupBy("_id", "_copy").agg(F.max("copies").alias("copies"))
    rows, _, _ = numbered(docs, text, doc_id)
    read = rows.join(plan.where("copies > 0"), ["_id", "_copy"])
    return named(read.withColumn("time", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies")))), docs)


def mixing_report(docs: DataFrame, **target) -> DataFrame:
    """A row for each document and epoch it is read in, and where in the order."""
    plan = schedule(docs, **target).where("copies > 0")
    read = plan.select("*", F.posexplode(read_order(F.col("copies"), F.col("position"), F.col("epochs"))).alias("epoch", "place"))
    return read.select(restored("_id").alias("doc_id"), "source", "n_tokens", "weight", F.col("epoch").cast("bigint").alias("epoch"), "place")
