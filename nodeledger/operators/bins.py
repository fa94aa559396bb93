"""Job-size and walltime histograms, their two-dimensional grid, and the scatter table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nodeledger.functions.columns import marker_size, ratio
from nodeledger.operators.slices import (
    SLICE,
    fan_out,
    period_keys,
    slice_keys,
    tag_period,
    with_slices,
)
from nodeledger.plans.attach import attach
from nodeledger.plans.dense import densify
from nodeledger.plans.settle import settle
from nodeledger.schema import MIN_SCATTER_WALLTIME
from nodeledger.sources.machine import Bin


def _inside(value: Column, b: Bin) -> Column:
    return (value >= F.lit(b.lo)) & (value <= F.lit(b.hi))


def _disjoint(bins: Sequence[Bin]) -> bool:
    ordered = sorted(bins, key=lambda b: b.lo)
    return all(left.hi < right.lo for left, right in zip(ordered, ordered[1:]))


def assign_bin(df: DataFrame, column: str, bins: Sequence[Bin], out: str) -> DataFrame:
    """Add the index of the bin that holds ``column``, null if there is none.

    Overlapping bins give one row per bin that holds the value.
    """
    value = F.col(column)
    if _disjoint(bins):
        cases = [F.when(_inside(value, b), F.lit(i)) for i, b in enumerate(bins)]
        return df.withColumn(out, F.coalesce(*cases))
    hits = F.array(*[F.when(_inside(value, b), F.lit(i)) for i, b in enumerate(bins)])
    return df.withColumn(out, F.explode_outer(F.array_compact(hits)))


def _pick(values: Sequence, index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), index + 1)


def _axis(size: int) -> Column:
    return F.array(*[F.lit(i) for i in range(size)])


def _counted(df: DataFrame, cells: Sequence[str], keys, slices) -> DataFrame:
    """Jobs per group and cell, sliced after the first aggregation."""
    tagged = tag_period(df, slices)
    counts = tagged.groupBy(*period_keys(slices), *keys, *cells).agg(F.count("*").alias("n_jobs"))
    if not slices:
        return counts
    return fan_out(counts, slices).groupBy(*slice_keys(slices), *keys, *cells).agg(
        F.sum("n_jobs").alias("n_jobs")
    )


def histogram(
    df: DataFrame,
    column: str,
    bins: Sequence[Bin],
    *,
    keys: Sequence[str] = (),
    slices: Sequence[str] | None = None,
) -> DataFrame:
    """Jobs per bin with all empty bins kept; percent and share are of the binned jobs."""
    binned = assign_bin(df, column, bins, "bin_id")
    return _histogram_of(_counted(binned, ["bin_id"], keys, slices), bins, [*slice_keys(slices), *keys])


def _histogram_of(counts: DataFrame, bins: Sequence[Bin], groups: Sequence[str]) -> DataFrame:
    full = densify(counts, groups, "bin_id", "n_jobs", _axis(len(bins)), total="_binned")
    share = ratio(F.col("n_jobs"), F.col("_binned"))
    # Bars are shown in the order of the bins' lower bounds.
    rank = {b: i for i, b in enumerate(sorted(bins, key=lambda b: b.lo))}
    return full.select(
        *groups,
        "bin_id",
        _pick([b.name for b in bins], F.col("bin_id")).alias("bin_name"),
        _pick([b.label for b in bins], F.col("bin_id")).alias("range_label"),
        _pick([rank[b] for b in bins], F.col("bin_id")).alias("bin_order"),
        "n_jobs",
        share.alias("share"),
        (share * 100).alias("percent"),
    )


def job_size_histogram(df: DataFrame, bins: Sequence[Bin], **groups) -> DataFrame:
    return histogram(df, "nodes_used", bins, **groups)


def walltime_histogram(df: DataFrame, bins: Sequence[Bin], **groups) -> DataFrame:
    return histogram(df, "walltime_seconds", bins, **groups)


def size_walltime_grid(
    df: DataFrame,
    size_bins: Sequence[Bin],
    walltime_bins: Sequence[Bin],
    *,
    keys: Sequence[str] = (),
    slices: Sequence[str] | None = None,
) -> DataFrame:
    """Jobs per (size bin, walltime bin) with all empty cells kept."""
    binned = assign_bin(df, "nodes_used", size_bins, "size_bin")
    binned = assign_bin(binned, "walltime_seconds", walltime_bins, "walltime_bin")
    counts = _counted(binned.withColumn("_cell", _cell(walltime_bins)), ["_cell"], keys, slices)
    return _grid_of(counts, size_bins, walltime_bins, [*slice_keys(slices), *keys])


def _cell(walltime_bins: Sequence[Bin]) -> Column:
    return F.col("size_bin") * len(walltime_bins) + F.col("walltime_bin")


def _grid_of(counts: DataFrame, size_bins: Sequence[Bin], walltime_bins: Sequence[Bin], groups: Sequence[str]) -> DataFrame:
    width = len(walltime_bins)
    full = densify(counts, groups, "_cell", "n_jobs", _axis(len(size_bins) * width))
    placed = full.select(
        *groups,
        F.floor(F.col("_cell") / width).cast("int").alias("size_bin"),
        (F.col("_cell") % width).alias("walltime_bin"),
        "n_jobs",
    )
    return placed.select(
        *groups,
        "size_bin",
        "walltime_bin",
        _pick([b.label for b in size_bins], F.col("size_bin")).alias("size_label"),
        _pick([b.label for b in walltime_bins], F.col("walltime_bin")).alias("walltime_label"),
        "n_jobs",
    )


def size_walltime_matrix(
    grid: DataFrame, walltime_bins: Sequence[Bin], *, groups: Sequence[str] = ()
) -> DataFrame:
    """The grid as a heat map: a row per size bin, a column per walltime bin, zero as null.

    ``max_cell`` repeats the largest cell of the map; a map without any job is left out.
    """
    filled = F.nullif(F.col("n_jobs"), F.lit(0)).cast("double")
    columns = [
        F.max(F.when(F.col("walltime_bin") == i, filled)).alias(b.duration_label)
        for i, b in enumerate(walltime_bins)
    ]
    rows = grid.groupBy(*groups, "size_bin", "size_label").agg(*columns)
    largest = grid.groupBy(*groups).agg(F.max("n_jobs").alias("max_cell"))
    return attach(rows, largest, groups).filter(F.col("max_cell") > 0)


def _held_by(column: str, bins: Sequence[Bin]) -> Column:
    """The indexes of all bins that hold a value."""
    return F.array_compact(F.array(*[F.when(_inside(F.col(column), b), F.lit(i)) for i, b in enumerate(bins)]))


def job_counts(
    df: DataFrame,
    size_bins: Sequence[Bin],
    walltime_bins: Sequence[Bin],
    *,
    keys: Sequence[str] = (),
    slices: Sequence[str] | None = None,
) -> dict[str, DataFrame]:
    """The two histograms and the grid together, from one pass over the jobs.

    Jobs are counted by the bins that hold their size and those that hold their walltime. These few
    counts are written once, and each table adds them up.
    """
    groups = [*slice_keys(slices), *keys]
    cells = {"_sizes": _held_by("nodes_used", size_bins), "_times": _held_by("walltime_seconds", walltime_bins)}
    joint = settle(_counted(df.withColumns(cells), list(cells), keys, slices))

    def along(*axes: str) -> DataFrame:
        spread = joint
        for held, out in (("_sizes", "size_bin"), ("_times", "walltime_bin")):
            if out in axes:
                spread = spread.withColumn(out, F.explode_outer(held))
        return spread

    def added(rows: DataFrame, cell: Column, name: str) -> DataFrame:
        return rows.groupBy(*groups, cell.alias(name)).agg(F.sum("n_jobs").alias("n_jobs"))

    sizes, times = added(along("size_bin"), F.col("size_bin"), "bin_id"), added(along("walltime_bin"), F.col("walltime_bin"), "bin_id")
    both = added(along("size_bin", "walltime_bin"), _cell(walltime_bins), "_cell")
    return {
        "job_size": _histogram_of(sizes, size_bins, groups),
        "walltime": _histogram_of(times, walltime_bins, groups),
        "size_walltime": _grid_of(both, size_bins, walltime_bins, groups),
    }


def scatter_points(
    df: DataFrame,
    capacity: int,
    *,
    keys: Sequence[str] = (),
    slices: Sequence[str] | None = None,
) -> DataFrame:
    """Jobs of at least 100 s walltime over queue time, with their marker size.

    A yearly or monthly slice shows the jobs that were both queued and started in it.
    """
    kept = with_slices(df.filter(F.col("walltime_seconds") >= MIN_SCATTER_WALLTIME), slices)
    if slices:
        queued = F.col("queued_timestamp").cast("string")
        kept = kept.filter((F.col(SLICE) == "all") | F.startswith(queued, F.col(SLICE)))
    return kept.select(
        *slice_keys(slices),
        *keys,
        "queued_timestamp",
        "walltime_seconds",
        "nodes_used",
        marker_size(F.col("nodes_used"), capacity).alias("marker_size"),
    )


def scatter_bounds(df: DataFrame, *, slices: Sequence[str] | None = None) -> DataFrame:
    """Axis limits of :func:`scatter_points`: 1.1 times the longest walltime of all jobs, first and last point shown.

    One pass: both are aggregated by start and queue month, from which slices follow.
    """
    groups = slice_keys(slices)
    shown = F.col("walltime_seconds") >= MIN_SCATTER_WALLTIME
    queued = F.col("queued_timestamp")
    tags = {"_queued": F.substring(queued.cast("string"), 1, 7)} if slices else {}
    by_month = tag_period(df.withColumns(tags) if tags else df, slices).groupBy(*period_keys(slices), *tags).agg(
        F.max("walltime_seconds").alias("_longest"),
        F.count_if(shown).alias("_shown"),
        F.min(F.when(shown, queued)).alias("_first"),
        F.max(F.when(shown, queued)).alias("_last"),
    )
    sliced = fan_out(by_month, slices)
    inside = (F.col(SLICE) == "all") | F.startswith(F.col("_queued"), F.col(SLICE)) if slices else F.lit(True)
    found = sliced.groupBy(*groups).agg(
        F.min(F.when(inside, F.col("_first"))).alias("first_queued"),
        F.max(F.when(inside, F.col("_last"))).alias("last_queued"),
        F.sum(F.when(inside, F.col("_shown"))).alias("_points"),
        (F.max("_longest") * 1.1).alias("walltime_top"),
    )
    if slices:  # a slice without a point has no chart
        found = found.filter(F.col("_points") > 0)
    return found.select(*groups, "first_queued", "last_queued", "walltime_top")
