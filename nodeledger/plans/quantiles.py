"""Exact quantiles of very large groups.

The built-in ``percentile`` keeps all distinct values of a group in one task. Here equal values
are counted first, the counts are added up per value bucket to find which buckets hold the wanted
ranks, and only inside those buckets are values ranked. Every ranking window is one narrow bucket
of one group, so a group may hold any share of the data.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# At most about a million buckets per group for all doubles that occur as times or sizes; a bucket
# is 0.004 % of its values wide, which whole seconds or nodes below 16,384 do not share.
BUCKETS_PER_DOUBLING = 16_384
# The least of them for counts that are dealt to tasks by bucket; otherwise as many as there are tasks.
FEWEST_PER_DOUBLING = 32


def value_bucket(value: Column, per_doubling: int = BUCKETS_PER_DOUBLING) -> Column:
    """A bucket number that never decreases with the value, see :data:`BUCKETS_PER_DOUBLING`.

    It is declared not null so that joining on it adds no null filter below the shuffle of the
    counts, which is then shared by all steps.
    """
    size = F.floor(F.log2(F.abs(value) + 1) * per_doubling)
    return F.coalesce(F.when(value < 0, -size - 1).otherwise(size), F.lit(0).cast("bigint"))


def _holds_a_rank(last: Column, before: Column, size: Column, probabilities: dict[str, float]) -> Column:
    """Whether one of the two ranks next to a quantile is among ``size`` values after ``before`` others."""
    wanted = F.lit(False)
    for p in probabilities.values():
        for rank in (F.floor(last * F.lit(p)), F.ceil(last * F.lit(p))):
            wanted = wanted | ((rank >= before) & (rank < before + size))
    return wanted


def _interpolated(candidates: DataFrame, keys: Sequence[str], value: str, n: str, probabilities: dict[str, float], *more: str) -> DataFrame:
    """Quantiles per key from the counts of the buckets that hold their ranks, and the first of ``more``.

    Each row knows its ``_bucket``, how many values come ``_before`` that, and the ``_last`` rank of its key.
    """
    inside = Window.partitionBy(*keys, "_bucket").orderBy(value)
    inside = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = candidates.withColumn("_end", F.col("_before") + F.sum(n).over(inside))
    begin, end = F.col("_end") - F.col(n), F.col("_end")
    position = {q: F.col("_last") * F.lit(p) for q, p in probabilities.items()}

    def at(rank: Column) -> Column:
        return F.max(F.when((rank >= begin) & (rank < end), F.col(value)))

    found = ranked.groupBy(*keys).agg(
        F.max("_last").alias("_last"),
        *[F.first(c).alias(c) for c in more],
        *[at(F.floor(position[q])).alias(f"_lo_{q}") for q in probabilities],
        *[at(F.ceil(position[q])).alias(f"_hi_{q}") for q in probabilities],
    )
    return found.select(
        *keys,
        *more,
        *[
            (
                F.col(f"_lo_{q}")
                + (F.col(f"_hi_{q}") - F.col(f"_lo_{q}")) * (position[q] - F.floor(position[q]))
            ).alias(q)
            for q in probabilities
        ],
    )


def exact_quantiles(
    counts: DataFrame,
    keys: Sequence[str],
    value: str,
    n: str,
    probabilities: dict[str, float],
) -> DataFrame:
    """Linearly interpolated quantiles per key, one column per entry of ``probabilities``.

    ``counts`` has one row per (``keys``, ``value``) with its number of occurrences ``n``; keys and
    values are not null.
    """
    keys = list(keys)
    bucketed = counts.withColumn("_bucket", value_bucket(F.col(value)))
    per_bucket = bucketed.groupBy(*keys, "_bucket").agg(F.sum(n).alias("_size"))
    upto = Window.partitionBy(*keys).orderBy("_bucket")
    placed = per_bucket.withColumn("_before", F.sum("_size").over(upto) - F.col("_size"))
    placed = placed.withColumn("_last", F.sum("_size").over(Window.partitionBy(*keys)) - 1)
    wanted = _holds_a_rank(F.col("_last"), F.col("_before"), F.col("_size"), probabilities)
    candidates = placed.filter(wanted).select(*keys, "_bucket", "_before", "_last")
    return _interpolated(bucketed.join(candidates, [*keys, "_bucket"]), keys, value, n, probabilities)


_MOMENTS = ("_size", "_mean", "_squares", "_min", "_max")


def _merged(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Size, mean, squares about the mean and extremes per key from those of its parts.

    Distances are taken from the mean of the key, so that squares of large values are never
    subtracted from each other; what rounding has left in that mean is made good after that.
    """
    size, within = F.col("_size"), Window.partitionBy(*keys)
    near = F.sum(size * F.col("_mean")).over(within) / F.sum(size).over(within)
    away = F.col("_mean") - F.col("_near")
    sums = parts.withColumn("_near", near).groupBy(*keys).agg(
        F.sum(size).alias("_size"),
        F.first("_near").alias("_near"),
        F.sum(size * away).alias("_first"),
        F.sum(F.col("_squares") + size * away * away).alias("_second"),
        F.min("_min").alias("_min"),
        F.max("_max").alias("_max"),
    )
    off = F.col("_first") / size
    squares = F.greatest(F.col("_second") - F.col("_first") * off, F.lit(0.0))
    merged = sums.withColumns({"_mean": F.col("_near") + off, "_squares": squares})
    return merged.select(*keys, *_MOMENTS)


def described(
    counts: DataFrame,
    keys: Sequence[str],
    value: str,
    n: str,
    probabilities: dict[str, float],
    spread: Callable[[DataFrame], DataFrame] | None = None,
    dealt: Sequence[str] = (),
) -> DataFrame:
    """``n_values``, ``mean``, ``std`` (of a sample), ``min``, ``max`` and quantiles per key.

    All from the counts of values that the quantiles need. Each bucket has its own centred moments,
    and buckets are merged about the mean of the group: squares of large values are never subtracted
    from each other.

    ``spread`` copies counts to ``keys``, inside the tasks to which counts are dealt by bucket and the
    columns ``dealt``, the keys they have before; a value may then have several counts in a group.
    Counts are shuffled once. Their tasks first sum them up by bucket, and only these sums are copied
    and shuffled by ``keys``. The buckets that hold a rank go back to the tasks that have the counts,
    with the statistics of their group, so that counts outside of them are neither copied nor moved.
    There are only as many buckets as deal a group to all tasks, since a bucket of each group is a row.
    """
    keys, dealt = list(keys), list(dealt or keys)
    # a named number of partitions: the planner knows only the size before copying
    parts = int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    per_doubling = min(max(parts, FEWEST_PER_DOUBLING), BUCKETS_PER_DOUBLING)
    cells = [*[c for c in counts.columns if c not in (value, n)], "_bucket"]
    bucketed = counts.withColumn("_bucket", value_bucket(F.col(value), per_doubling)).repartition(parts, *dealt, "_bucket")
    copied = spread or (lambda rows: rows)

    single = (F.col(n), F.col(value), F.lit(0.0), F.col(value), F.col(value))
    per_bucket = _merged(bucketed.select(*cells, *[c.alias(m) for c, m in zip(single, _MOMENTS)]), cells)
    if spread:
        per_bucket = _merged(copied(per_bucket), [*keys, "_bucket"])

    size, group = F.col("_size"), Window.partitionBy(*keys)
    placed = per_bucket.withColumns(
        {
            "_before": F.sum(size).over(group.orderBy("_bucket")) - size,
            "n_values": F.sum(size).over(group),
            "mean": F.sum(size * F.col("_mean")).over(group) / F.sum(size).over(group),
            "min": F.min("_min").over(group),
            "max": F.max("_max").over(group),
        }
    )
    apart = F.col("_mean") - F.col("mean")
    squares = F.sum(F.col("_squares") + size * apart * apart).over(group)
    deviation = F.when(F.col("n_values") > 1, F.sqrt(squares / (F.col("n_values") - 1)))
    placed = placed.withColumn("std", deviation).withColumn("_last", F.col("n_values") - 1)
    statistics = ["n_values", "mean", "std", "min", "max"]

    wanted = placed.filter(_holds_a_rank(F.col("_last"), F.col("_before"), size, probabilities))
    added = [k for k in keys if k not in dealt]
    row = F.struct(*[F.col(k).alias(f"_of_{k}") for k in added], "_before", "_last", *statistics)
    by_bucket = wanted.groupBy(*dealt, "_bucket").agg(F.collect_list(row).alias("_groups"))
    copies = copied(bucketed.join(by_bucket, [*dealt, "_bucket"]))

    def same(group: Column) -> Column:
        found = F.lit(True)
        for k in added:
            found = found & (group[f"_of_{k}"] == F.col(k))
        return found

    groups = F.filter("_groups", same) if added else F.col("_groups")
    candidates = copies.select(*keys, "_bucket", value, n, F.inline(groups))
    return _interpolated(candidates, keys, value, n, probabilities, *statistics)
