"""Mixing sources to target weights by temperature, realised as budgeted block permutations.

A source's weight is its share of tokens to the power of an exponent between 0 (all alike) and 1
(as they are), normalised. The exponent is found by bisection so that the weights have a target
entropy, or so that no source is repeated more often than a limit. Each source then gets its weight's
part of the token budget: as many whole passes over its documents as fit, each in an order of its
own, and the beginning of one more. All sources' streams are cut into the same number of blocks,
so that every block holds the target mixture, and blocks are shuffled inside.

Only DataFrame operations are used. Running sums go over about sqrt(n) slices of a source's n
documents, then inside each slice, so that a source with most documents needs no single task.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from nodeledger.llm.store import cut

#: Tokens in a block, and exponents tried per pass of the bisection.
BLOCK_TOKENS, TRIED = 65_536, 15
_SEED = 20240229


def word_count(text):
    """Words of a text: runs of bytes other than space and 0x09 to 0x0D."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^ \t-\r]+")).cast("long")


def _exponent(shares: DataFrame, reached) -> float:
    """The smallest exponent in [0, 1] at which ``reached`` (growing with the exponent) holds, else 1.

    ``reached(a)`` is an aggregate over ``shares(p)``. Each pass tries several points of the
    interval in one aggregation, so nothing per source comes to the driver.
    """
    low, high = 0.0, 1.0
    first = shares.agg(reached(0.0).alias("ok")).first()
    if first["ok"]:
        return 0.0
    while high - low > 1e-12:
        points = [low + (high - low) * (k + 1) / (TRIED + 1) for k in range(TRIED)]
        row = shares.agg(*(reached(a).alias(f"at{k}") for k, a in enumerate(points))).first()
        good = [a for k, a in enumerate(points) if row[f"at{k}"]]
        bad = [a for k, a in enumerate(points) if not row[f"at{k}"]]
        low, high = max([low, *(a for a in bad if not good or a < min(good))]), min([high, *good])
    return high


def temperature(shares: DataFrame, entropy: float | None = None, repeats: float | None = None) -> float:
    """The exponent for ``shares(p)``: entropy at most the target, or repetition at most the limit.

    Repetition is that of the smallest source when the largest one is passed over once.
    """
    p = F.col("p")
    if repeats is not None:
        spread = F.max(p) / F.min(p)
        return _exponent(shares, lambda a: F.coalesce(F.pow(spread, F.lit(1 - a)) <= repeats, F.lit(True)))
    z = lambda a: F.sum(F.pow(p, F.lit(a)))
    h = lambda a: F.log(z(a)) - a * F.sum(F.pow(p, F.lit(a)) * F.log(p)) / z(a)
    return _exponent(shares, lambda a: F.coalesce(h(a) <= entropy, F.lit(True)))


def mixture(docs: DataFrame, entropy: float | None = None, repeats: float | None = 2.0, budget: int | None = None, carry: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, source, n_tokens, epoch, block, place): one row per copy of a document in the mixture.

    ``docs(doc_id, text, source)``; tokens are words. Give either a target ``entropy`` of the
    weights in nats or a limit ``repeats``. Without ``budget`` it is the smallest one for which
    every document comes up at least once. Copies are in order by (block, place).

    Null and empty texts have no tokens and are placed where their turn comes. A missing source is
    a source of its own. A source without tokens has no weight and is passed over once. Repeated
    rows are documents of their own. An empty table gives an empty mixture. Of the other columns
    those in ``carry`` go along, the rest isn't read.
    """
    source = F.coalesce(F.col("source").cast("string"), F.lit("\0missing"))
    sized = cut(docs.select(F.col("doc_id").cast("long").alias("doc_id"), source.alias("source"), word_count(F.col("text").cast("string")).alias("n_tokens"), *carry))
    sources = cut(sized.groupBy("source").agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("documents")))
    total = sources.agg(F.sum("tokens")).first()[0] or 0
    shares = sources.where("tokens > 0").select((F.col("tokens") / F.lit(float(max(total, 1)))).alias("p"))
    a = temperature(shares, entropy, None if entropy is not None else repeats)
    z = shares.agg(F.sum(F.pow("p", F.lit(a)))).first()[0] or 1.0
    weight = F.when(F.col("tokens") > 0, F.pow(F.col("tokens") / F.lit(float(max(total, 1))), F.lit(a)) / F.lit(z))
    weighted = sources.withColumn("weight", weight)
    if budget is None:
        budget = weighted.agg(F.max(F.col("tokens") / F.col("weight"))).first()[0] or 0.0
    # a rounding error must not cost the largest source its last document
    share = F.col("weight") * F.lit(float(budget)) * (1 + 1e-9)
    plan = weighted.withColumn("share", share).withColumn("passes", F.coalesce(F.ceil(F.col("share") / F.col("tokens") - 1e-6), F.lit(1)))
    plan = plan.withColumn("slices", F.ceil(F.sqrt("documents")))

    # every pass of a source has its own order: a hash of seed, pass and document
    copies = sized.join(plan.select("source", "tokens", "share", "passes", "slices"), "source")
    copies = copies.withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.col("passes") - 1)))
    turn = F.xxhash64(F.lit(_SEED), "epoch", "doc_id")
    copies = copies.withColumn("turn", turn).withColumn("slice", F.floor((F.shiftright("turn", 11) / F.lit(float(2**53)) + 0.5) * F.col("slices")))
    copies = cut(copies.select("doc_id", "source", "n_tokens", "tokens", "share", "epoch", "turn", "slice", *carry))
    sums = copies.groupBy("source", "epoch", "slice").agg(F.sum("n_tokens").alias("in_slice"))
    earlier = Window.partitionBy("source", "epoch").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("source", "epoch", "slice", F.coalesce(F.sum("in_slice").over(earlier), F.lit(0)).alias("ahead"))
    inside = Window.partitionBy("source", "epoch", "slice").orderBy("turn", "doc_id", "n_tokens").rowsBetween(Window.unboundedPreceding, -1)
    placed = copies.withColumn("before", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
    placed = placed.join(sums, ["source", "epoch", "slice"])
    at = F.col("epoch") * F.col("tokens") + F.col("ahead") + F.col("before")
    blocks = max(1, math.ceil(float(budget) / BLOCK_TOKENS))
    taken = placed.withColumn("at", at).where("share is null or at < share or (epoch = 0 and share >= tokens)")
    block = F.least(F.floor(F.coalesce(F.col("at") / F.col("share"), F.lit(0.0)) * blocks), F.lit(blocks - 1))
    # documents without a weight are spread over the blocks
    spread = F.pmod(F.col("turn"), F.lit(blocks))
    taken = taken.withColumn("block", F.when(F.col("share").isNull(), spread).otherwise(block).cast("long"))
    shuffled = Window.partitionBy("block").orderBy(F.xxhash64(F.lit(_SEED + 1), "block", "epoch", "doc_id"), "doc_id", "epoch", "source", "n_tokens")
    named = F.when(F.col("source") != "\0missing", F.col("source")).alias("source")
    return taken.select("doc_id", named, "n_tokens", F.col("epoch").cast("int").alias("epoch"), "block", (F.row_number().over(shuffled) - 1).cast("long").alias("place"), *carry)


def mixed_documents(docs: DataFrame, repeats: float = 2.0) -> DataFrame:
    """The documents of the mixture in its order, one row per copy, with the columns of ``docs``."""
    kept = docs.columns
    key = [F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63))).alias("_id"), F.xxhash64(*kept).alias("_key")]
    keyed = docs.select("*", *key)
    order = mixture(keyed, repeats=repeats, carry=("_id", "_key")).select("_id", "_key", "block", "place")
    # equal rows have as many copies in the order, which take one of them
    joined = keyed.dropDuplicates(["_id", "_key"]).join(order, ["_id", "_key"])
    return joined.repartitionByRange("block", "place").sortWithinPartitions("block", "place").select(*kept)
