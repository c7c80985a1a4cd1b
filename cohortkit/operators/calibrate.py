"""Score calibration: isotonic regression over tie-pooled scores and
a linear adjustment with non-negative coefficients, both fitted from Spark
aggregates."""

from __future__ import annotations

import itertools

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from . import isotonic as ISO


def rounded(x, approximation: int):
    """x rounded to 10^-k, half to even; k < 0 leaves x unchanged."""
    c = F.col(x) if isinstance(x, str) else x
    if approximation is None or approximation < 0:
        return c.cast("double")
    f = float(10 ** min(approximation, 10))
    return F.rint(c.cast("double") * f) / f


def tie_pool(df: DataFrame, x: str, y: str, approximation: int = -1) -> DataFrame:
    """(x, y, n): mean label per distinct (rounded) score."""
    return (df.groupBy(rounded(x, approximation).alias("x"))
              .agg(F.avg(F.col(y).cast("double")).alias("y"), F.count(F.lit(1)).alias("n")))


class Isotonic:
    """Increasing isotonic calibration: scores rounded to ``approximation``
    decimals, labels averaged per distinct score, pool-adjacent-violators over
    the pooled points by score ranges (see ``isotonic``), predictions clipped to
    [y_min, y_max]; inputs outside the fitted range take the end values, inputs
    in between are linearly interpolated.

    ``tie_weight='count'`` weighs each pooled point by its row count (the
    least-squares fit of all rows); ``'one'`` gives every distinct score
    weight 1, as a fit on the pooled means alone does. ``accumulate`` takes one
    batch after another and ``finish`` fits what has come so far, the same as a
    fit of all batches at once."""

    def __init__(self, y_min: float | None = 0.0, y_max: float | None = 1.0,
                 increasing: bool = True, approximation: int = -1, tie_weight: str = "count"):
        self.y_min, self.y_max = y_min, y_max
        self.increasing = increasing
        self.approximation = approximation
        self.tie_weight = tie_weight
        self.state: DataFrame | None = None
        self.blocks: DataFrame | None = None
        self._knots: tuple[list[float], list[float]] | None = None

    def fit(self, df: DataFrame, x: str = "score", y: str = "target") -> "Isotonic":
        self.state = cut_lineage(ISO.pooled_state(df, rounded(x, self.approximation), y))
        return self.finish()

    def accumulate(self, df: DataFrame, x: str = "score", y: str = "target") -> "Isotonic":
        new = ISO.pooled_state(df, rounded(x, self.approximation), y)
        self.state = cut_lineage(new) if self.state is None else ISO.merged_state(self.state, new)
        return self

    def finish(self) -> "Isotonic":
        w = F.col("n").cast("double") if self.tie_weight == "count" else F.lit(1.0)
        points = self.state.select("x", (F.col("s") / F.col("n")).alias("y"), w.alias("w"))
        self.blocks = cut_lineage(ISO.fit_blocks(points, self.increasing))
        self._knots = None
        return self

    def knots(self) -> DataFrame:
        """Fitted (boundary, prediction) pairs as a DataFrame, not clipped."""
        return ISO.knots_of(self.blocks)

    def curve(self) -> tuple[list[float], list[float]]:
        """Knots as lists, clipped; their number is bounded (``MAX_KNOTS``)."""
        if self._knots is None:
            self._knots = ISO.collected(self.knots())
        b, p = self._knots
        lo, hi = (float("-inf") if self.y_min is None else self.y_min), (float("inf") if self.y_max is None else self.y_max)
        return b, [min(max(v, lo), hi) for v in p]

    def stage(self, x: str = "score", out: str = "calibrated") -> ISO.IsotonicCalibrator:
        """The fit as a pipeline stage."""
        b, p = self.curve()
        return ISO.IsotonicCalibrator(inputCol=x, outputCol=out, boundaries=b, predictions=p)

    def transform(self, df: DataFrame, x: str = "score", out: str = "calibrated") -> DataFrame:
        return df.withColumn(out, ISO.interpolated(x, *self.curve()))


def moments(df: DataFrame, xcols: list[str], y: str) -> DataFrame:
    """One row of first and second moments for least squares with intercept."""
    cols = ["_one"] + list(xcols)
    d = df.select(F.lit(1.0).alias("_one"), *[F.col(c).cast("double").alias(c) for c in xcols],
                  F.col(y).cast("double").alias("_y"))
    aggs = []
    for i, a in enumerate(cols):
        for b in cols[i:]:
            aggs.append(F.sum(F.col(a) * F.col(b)).alias(f"xx__{a}__{b}"))
        aggs.append(F.sum(F.col(a) * F.col("_y")).alias(f"xy__{a}"))
    aggs.append(F.sum(F.col("_y") * F.col("_y")).alias("yy"))
    return d.agg(*aggs)


def nonneg_least_squares(df: DataFrame, xcols: list[str], y: str) -> tuple[float, list[float]]:
    """Least squares ``y ~ b0 + sum b_i x_i`` with b_i >= 0 (intercept free).
    Spark computes the (d+1)^2 moments; the driver solves the small problem
    exactly by trying every active set (d is the handful of adjustment
    inputs) and keeping the best feasible one."""
    row = moments(df, xcols, y).first().asDict()
    cols = ["_one"] + list(xcols)
    k = len(cols)
    A = np.zeros((k, k))
    bvec = np.zeros(k)
    for i, a in enumerate(cols):
        for j in range(i, k):
            v = row[f"xx__{a}__{cols[j]}"] or 0.0
            A[i, j] = A[j, i] = v
        bvec[i] = row[f"xy__{a}"] or 0.0
    yy = row["yy"] or 0.0
    best = (np.inf, 0.0, [0.0] * len(xcols))
    for r in range(len(xcols) + 1):
        for subset in itertools.combinations(range(1, k), r):
            idx = [0, *subset]
            sol, *_ = np.linalg.lstsq(A[np.ix_(idx, idx)], bvec[idx], rcond=None)
            if any(s < -1e-12 for s in sol[1:]):
                continue
            beta = np.zeros(k)
            beta[idx] = sol
            sse = yy - 2 * beta @ bvec + beta @ A @ beta
            if sse < best[0] - 1e-12:
                best = (sse, float(beta[0]), [float(max(v, 0.0)) for v in beta[1:]])
    return best[1], best[2]


def linear_adjust(df: DataFrame, intercept: float, coefs: list[float], xcols: list[str],
                  out: str = "adjusted") -> DataFrame:
    e = F.lit(float(intercept))
    for c, b in zip(xcols, coefs):
        e = e + F.lit(float(b)) * F.col(c).cast("double")
    return df.withColumn(out, e)
