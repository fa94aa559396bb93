"""Locally weighted regression (LOWESS) of the utilization grid.

The nearest neighbours of a grid point are a fixed stretch of the grid, so the grid is cut into
chunks at least one stretch long and each chunk is fitted with a copy of its two neighbours. The
tricube weight is a polynomial of the distance on either side of a point, so the sums of a fit follow
from running sums of powers and cost the same for any number of neighbours. The robust passes need the median residual of the whole series; the series is settled between passes
so that a pass reads the previous one and does not repeat it.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import comb

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nodeledger.plans.attach import attach
from nodeledger.plans.quantiles import exact_quantiles
from nodeledger.plans.settle import settle
from nodeledger.schema import TREND_FRACTION, TREND_ROBUST_PASSES

MIN_CHUNK = 512
MIN_NEIGHBOURS = 3
FEW_NEIGHBOURS = 64


# (1 - u**3)**3 by powers of u
_TRICUBE = ((0, 1.0), (3, -3.0), (6, 3.0), (9, -1.0))
_DEGREE = 11


def _line_at_zero(weight, weight_d, weight_dd, value, value_d, own):
    """Value at offset 0 of the weighted line, from its five sums; ``own`` if nothing has weight."""
    with np.errstate(divide="ignore", invalid="ignore"):
        centre = weight_d / weight
        level = value / weight
        spread = np.maximum(weight_dd / weight - centre**2, 1e-12)
        fitted = level - centre * (value_d / weight - centre * level) / spread
    return np.where(weight > 0, fitted, own)


def _side_sums(moments: np.ndarray, first: np.ndarray, last: np.ndarray, shift: np.ndarray, shrink: np.ndarray, side: int, p: int) -> np.ndarray:
    """For each point, the sum over one side of its neighbours of tricube weight, value and distance**p.

    ``moments[q]`` are running sums of value * z**q for positions z around the stretch's centre,
    ``shift`` is a point's own z, ``shrink`` its reach in units of z.
    """
    between = [m[last] - m[first] for m in moments]
    total = np.zeros(len(first))
    for power, coefficient in _TRICUBE:
        q = power + p
        about = np.zeros(len(first))
        for s in range(q + 1):  # (z - shift)**q
            about += comb(q, s) * between[s] * (-shift) ** (q - s)
        # distances are negative on the left, their sizes are not
        total += coefficient * side**power * about / shrink**power
    return total


def _by_moments(r, v, left, points, k, half):
    """The five sums of each fit from running sums of powers, in a time that doesn't grow with ``k``."""
    centre = (points[0] + points[-1]) / 2
    z = (np.arange(len(r)) - centre) / half
    powers = np.cumprod(np.vstack([np.ones_like(z), np.tile(z, (_DEGREE, 1))]), axis=0)
    reach = np.maximum(points - left, left + k - 1 - points)
    shift, shrink = (points - centre) / half, reach / half

    def sums(value, degree):
        running = np.hstack([np.zeros((_DEGREE + 1, 1)), np.cumsum(powers * value, axis=1)])
        for p in range(degree + 1):
            before = _side_sums(running, left, points, shift, shrink, -1, p)
            yield (before + _side_sums(running, points, left + k, shift, shrink, 1, p)) * float(half) ** p

    return [*sums(r, 2), *sums(r * v, 1)]


def _one_by_one(r, v, left, points, k):
    """The same sums, neighbour by neighbour."""
    reach = np.maximum(points - left, left + k - 1 - points)
    sums = np.zeros((5, len(points)))
    for j in range(k):
        at = left + j
        d = (at - points).astype(float)
        w = np.clip(1 - (np.abs(d) / reach) ** 3, 0, None) ** 3 * r[at]
        sums += [w, w * d, w * d * d, w * v[at], w * v[at] * d]
    return list(sums)


def fit_stretch(y, robust, begin, end, offset, n, k) -> np.ndarray:
    """Fit positions ``begin`` to ``end`` of a series of ``n`` points with ``k`` neighbours each.

    ``y`` and ``robust`` start at position ``offset`` and cover all neighbours needed. Running sums are
    centred anew for every eighth of a neighbourhood, which keeps the powers of distances small.
    Where nearly all weight lies on one neighbour, rounding would decide; these points, and all of
    a series with few neighbours, are summed neighbour by neighbour.
    """
    half = k // 2
    fitted = np.empty(end - begin)
    step = max(64, half // 4)
    for low in range(begin, end, step):
        points = np.arange(low, min(low + step, end))
        left = np.minimum(np.maximum(points - half, 0), n - k)
        base = int(left[0])
        here = slice(base - offset, int(left[-1]) + k - offset)
        r, v = robust[here], y[here]
        left, points = left - base, points - base
        if k < FEW_NEIGHBOURS:
            five = _one_by_one(r, v, left, points, k)
        else:
            five = _by_moments(r, v, left, points, k, half)
            with np.errstate(divide="ignore", invalid="ignore"):
                spread = five[2] / five[0] - (five[1] / five[0]) ** 2
            sure = (five[0] > 1e-6) & (spread > 1e-6 * half**2)
            if not sure.all():
                again = np.flatnonzero(~sure)
                for total, part in zip(five, _one_by_one(r, v, left[again], points[again], k)):
                    total[again] = part
        fitted[low - begin : low - begin + len(points)] = _line_at_zero(*five, v[points])
    return fitted


def _fit_chunk(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("x", ignore_index=True)
    own = rows.index[rows["_home"] == rows["_chunk"]]
    if len(own) == 0:
        return rows.assign(fitted=0.0).iloc[:0]
    n, k, offset = (int(rows[c].iloc[0]) for c in ("n", "k", "x"))
    begin, end = int(rows["x"].iloc[own[0]]), int(rows["x"].iloc[own[-1]]) + 1
    fitted = fit_stretch(rows["y"].to_numpy(), rows["robust"].to_numpy(), begin, end, offset, n, k)
    return rows.iloc[own].assign(fitted=fitted)


def _fit(series: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One regression pass over all chunks."""
    size = F.greatest(F.col("k"), F.lit(MIN_CHUNK))
    home = F.floor(F.col("x") / size)
    copies = series.withColumn("_home", home).withColumn(
        "_chunk", F.explode(F.array(F.col("_home") - 1, F.col("_home"), F.col("_home") + 1))
    )
    copies = copies.filter((F.col("_chunk") >= 0) & (F.col("_chunk") * size < F.col("n")))
    fields = [f"{f.name} {f.dataType.simpleString()}" for f in copies.schema.fields]
    fitted = copies.groupBy(*keys, "_chunk").applyInPandas(
        _fit_chunk, ", ".join([*fields, "fitted double"])
    )
    return fitted.select(*series.columns, "fitted")


def _reweigh(fitted: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Bisquare weights from the residuals, scaled by six times their median."""
    residual = fitted.withColumn("_residual", F.abs(F.col("y") - F.col("fitted")))
    counts = residual.groupBy(*keys, "_residual").agg(F.count("*").alias("_n"))
    median = exact_quantiles(counts, keys, "_residual", "_n", {"_median": 0.5})
    scaled = F.when(F.col("_median") == 0, (F.col("_residual") > 0).cast("double")).otherwise(
        F.col("_residual") / (F.col("_median") * 6)
    )
    capped = F.least(scaled, F.lit(1.0))
    weighed = attach(residual, median, keys).withColumn("robust", F.pow(1 - capped * capped, F.lit(2.0)))
    return weighed.drop("_residual", "_median", "fitted")


def utilization_trend(
    grid: DataFrame,
    *,
    keys: Sequence[str] = (),
    fraction: float = TREND_FRACTION,
    robust_passes: int = TREND_ROBUST_PASSES,
) -> DataFrame:
    """Trend of ``utilization_percent`` over the position in the grid.

    ``fraction`` of the points are the neighbours of each. A series too short to have three
    neighbours gets a null trend.
    """
    extent = grid.groupBy(*keys).agg(
        F.min("grid_index").alias("_origin"), F.count("*").alias("n")
    ).withColumn("k", F.floor(F.col("n") * fraction + 1e-10))
    placed = attach(grid, extent, keys).select(
        *keys,
        "grid_time",
        (F.col("grid_index") - F.col("_origin")).alias("x"),
        F.col("utilization_percent").alias("y"),
        "n",
        "k",
        F.lit(1.0).alias("robust"),
    )
    placed = settle(placed)
    short = placed.filter(F.col("k") < MIN_NEIGHBOURS).withColumn("fitted", F.lit(None).cast("double"))
    series = placed.filter(F.col("k") >= MIN_NEIGHBOURS)
    fitted = _fit(series, keys)
    for _ in range(robust_passes):
        fitted = _fit(_reweigh(settle(fitted), keys), keys)
    return fitted.unionByName(short).select(
        *keys,
        "grid_time",
        F.col("y").alias("utilization_percent"),
        F.col("fitted").alias("trend_percent"),
    )
