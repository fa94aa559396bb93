"""Running totals over a whole time line without sorting it in one task.

``sum() over (order by t)`` moves every row into a single partition. Here the time line is cut
into short buckets, and rows are dealt to tasks by bucket alone, once: totals of buckets, their
copies to slices and the scan inside each bucket follow in the same tasks. Bucket totals are scanned
inside their day, and only the per-day totals are scanned as one sequence. The size of every window
partition is set by the clock (distinct instants in ten minutes, buckets in a day, days in the log),
not by the number of rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from nodeledger.functions.times import time_bucket

BUCKET_SECONDS = 600
BUCKETS_PER_DAY = 86_400 // BUCKET_SECONDS

BUCKET, DAY = "_bucket", "_day"


def dealt_by_time(df: DataFrame, at: str, copied: bool = False) -> DataFrame:
    """``df`` with :data:`BUCKET`, all rows of a bucket in one task.

    Rows that are ``copied`` to slices after this shuffle go to the number of partitions set for
    shuffles, which the planner leaves when it is named: their size says little about a task's memory.
    """
    if BUCKET in df.columns:
        return df
    # Never null, and declared so: otherwise each join adds null filters of its own below the
    # shuffle of ``df``, and the shuffle is repeated instead of reused.
    bucket = F.coalesce(time_bucket(at, BUCKET_SECONDS), F.lit(0).cast("bigint"))
    parts = [int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))] if copied else []
    return df.withColumn(BUCKET, bucket).repartition(*parts, BUCKET)


def _offsets(buckets: DataFrame, totals: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """(keys, BUCKET) with the totals of all earlier buckets and the first instant of the next one."""
    day = F.coalesce(F.floor(F.col(BUCKET) / BUCKETS_PER_DAY), F.lit(0).cast("bigint"))
    # days and the buckets inside them are read from one shuffle, which for that holds the same columns
    in_days = buckets.repartition(*keys, day).withColumn(DAY, day)
    days = in_days.groupBy(*keys, DAY).agg(
        *[F.sum(f"_in_{out}").alias(f"_in_{out}") for out in totals],
        F.min("_first").alias("_first"),
    )
    by_day = Window.partitionBy(*keys).orderBy(DAY)
    day_offsets = days.select(
        *keys,
        DAY,
        *[
            (F.sum(f"_in_{out}").over(by_day) - F.col(f"_in_{out}")).alias(f"_day_{out}")
            for out in totals
        ],
        F.lead("_first").over(by_day).alias("_next_day"),
    )
    by_bucket = Window.partitionBy(*keys, DAY).orderBy(BUCKET)
    return in_days.join(day_offsets, [*keys, DAY]).select(
        *keys,
        BUCKET,
        *[
            (
                F.sum(f"_in_{out}").over(by_bucket) - F.col(f"_in_{out}") + F.col(f"_day_{out}")
            ).alias(f"_before_{out}")
            for out in totals
        ],
        F.coalesce(F.lead("_first").over(by_bucket), F.col("_next_day")).alias("_next_bucket"),
    )


def ordered_scan(
    df: DataFrame,
    at: str,
    totals: dict[str, str],
    keys: Sequence[str] = (),
    following: str | None = None,
    number: str | None = None,
    spread: Callable[[DataFrame], DataFrame] | None = None,
    keep_bucket: bool = False,
) -> DataFrame:
    """Add running totals of numeric columns in the order of ``at``.

    ``totals`` maps each new column to the column it adds up, the current row included. With
    ``following``, a column of that name receives the next value of ``at``, with ``number`` one the
    position of the row, from 1. ``at`` must be unique and not null within ``keys``.

    ``spread`` copies rows to ``keys``, after they are dealt to tasks. Copies that share key and
    instant become one row, in which the columns of ``totals`` are added up and others must be equal.
    ``keep_bucket`` leaves :data:`BUCKET` in the result, whose rows are dealt by it.
    """
    keys = list(keys)
    dealt = dealt_by_time(df, at, copied=spread is not None)
    copied = spread(dealt) if spread else dealt
    counted = F.count_distinct(F.col(at)) if spread else F.count(F.lit(1))
    buckets = copied.groupBy(BUCKET, *keys).agg(
        *[F.coalesce(F.sum(src), F.lit(0)).alias(f"_in_{out}") for out, src in totals.items()],
        *([counted.alias(f"_in_{number}")] if number else []),
        F.min(at).alias("_first"),
    )
    outs = [*totals, *([number] if number else [])]
    offsets = _offsets(buckets, outs, keys)

    # joined on the bucket alone, by which rows are dealt already; a map for each column, so that the
    # planner leaves out those that nobody reads
    added = [*[f"_before_{out}" for out in outs], "_next_bucket"]
    columns = copied.columns
    if keys:
        key = F.col(keys[0]) if len(keys) == 1 else F.struct(*keys)
        known = reduce(and_, [F.col(k).isNotNull() for k in keys])
        maps = [F.map_from_entries(F.collect_list(F.struct(key, F.struct(c)))).alias(c) for c in added]
        joined = dealt.join(offsets.filter(known).groupBy(BUCKET).agg(*maps), BUCKET)
        rows = (spread(joined) if spread else joined).filter(known)
        rows = rows.select(*columns, *[F.try_element_at(c, key)[c].alias(c) for c in added])
    else:
        rows = dealt.join(offsets, BUCKET).select(*columns, *added)

    in_bucket = Window.partitionBy(BUCKET, *keys).orderBy(at)
    running = in_bucket if spread else in_bucket.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    place = (F.dense_rank() if spread else F.row_number()).over(in_bucket)
    found = {out: F.col(f"_before_{out}") + F.coalesce(F.sum(src).over(running), F.lit(0)) for out, src in totals.items()}
    if number:
        found[number] = F.col(f"_before_{number}") + place
    if following or spread:
        found["_next_row"] = F.lead(at).over(in_bucket)
    if spread:
        same = in_bucket.rangeBetween(Window.currentRow, Window.currentRow)
        found |= {f"_net_{src}": F.sum(src).over(same) for src in set(totals.values())}
    scanned = rows.withColumns(found)
    if spread:
        scanned = scanned.filter(F.col("_next_row").isNull() | (F.col("_next_row") > F.col(at)))
        scanned = scanned.withColumns({src: F.col(f"_net_{src}") for src in set(totals.values())})
    if following:
        scanned = scanned.withColumn(following, F.coalesce("_next_row", "_next_bucket"))
    kept = [c for c in columns if c != BUCKET]
    bucket = [BUCKET] if keep_bucket else []
    return scanned.select(*kept, *totals, *([number] if number else []), *([following] if following else []), *bucket)
