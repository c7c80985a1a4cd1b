"""Isotonic regression over score ranges. Scores are pooled per distinct value,
cut into ranges, and each range is fitted by its own task (pool adjacent
violators) into blocks of rising means. Neighbouring ranges are then fitted
together, two at a time, over their blocks alone: the fit of two fits is the fit
of their points, so the last round holds the fit of all rows. No points reach
the driver, and after the first round tasks hold blocks, not points.

The fitted curve is a pair of knots a block. It becomes a column expression (a
binary search in a constant array, linear between knots), so that applying it
runs no Python; ``IsotonicCalibrator`` holds it as a pipeline stage that can be
saved and loaded with the model whose scores it calibrates."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage

POINTS_PER_TASK = 200_000
MAX_KNOTS = 20_000
_BLOCK = "range long, x0 double, x1 double, total double, weight double"


def _pool(rows: pa.Table | pa.RecordBatch, stack: list) -> None:
    """Adds blocks, by rising x, to a stack whose means rise."""
    for x0, x1, total, weight in zip(*(rows.column(c).to_pylist() for c in ("x0", "x1", "total", "weight"))):
        while stack and stack[-1][2] * weight >= total * stack[-1][3]:
            low = stack.pop()
            x0, total, weight = low[0], total + low[2], weight + low[3]
        stack.append([x0, x1, total, weight])


def _rows(number: int, stack: list) -> dict:
    cols = list(zip(*stack)) or [(), (), (), ()]
    return {"range": pa.array([number] * len(stack), pa.int64())} | {
        n: pa.array(c, pa.float64()) for n, c in zip(("x0", "x1", "total", "weight"), cols)}


def fit_blocks(points: DataFrame, increasing: bool = True, per_task: int = POINTS_PER_TASK) -> DataFrame:
    """Blocks (x0, x1, value, weight) of the least-squares monotone fit of ``points``
    (x distinct, y, w > 0), by rising x."""
    sign = 1.0 if increasing else -1.0
    p = points.select(F.col("x").alias("x0"), F.col("x").alias("x1"), (F.col("y") * F.col("w") * sign).alias("total"), F.col("w").alias("weight"))
    ranges = max(1, -(-p.count() // per_task))

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stack, number = [], 0
        for b in batches:
            if b.num_rows:
                number = b.column(4)[0].as_py()
                _pool(b, stack)
        if stack:
            yield pa.RecordBatch.from_pydict(_rows(number, stack))

    dealt = p.repartitionByRange(ranges, "x0").sortWithinPartitions("x0").withColumn("range", F.spark_partition_id())
    blocks = dealt.mapInArrow(first, _BLOCK)

    def merged(key, t):
        stack: list = []
        _pool(t.sort_by("x0"), stack)
        return pa.table(_rows(key[0].as_py(), stack))

    while ranges > 1:
        ranges = -(-ranges // 2)
        blocks = blocks.withColumn("range", F.floor(F.col("range") / 2)).groupBy("range").applyInArrow(merged, _BLOCK)
    return blocks.select("x0", "x1", (F.col("total") / F.col("weight") * sign).alias("value"), "weight")


def knots_of(blocks: DataFrame) -> DataFrame:
    """(boundary, prediction): the ends of each block, once where they are one point."""
    ends = F.when(F.col("x0") == F.col("x1"), F.array("x0")).otherwise(F.array("x0", "x1"))
    return blocks.select(F.explode(ends).alias("boundary"), F.col("value").alias("prediction"))


def collected(knots: DataFrame, limit: int = MAX_KNOTS) -> tuple[list[float], list[float]]:
    """Knots as lists, at most ``limit``: a pooled grid of k decimals has at most
    10^k + 1 scores between 0 and 1, and the fit far fewer blocks."""
    rows = knots.orderBy("boundary").limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"the fit has more than {limit} knots; pool the scores to fewer decimals")
    return [r.boundary for r in rows], [r.prediction for r in rows]


def interpolated(x, boundaries: list[float], predictions: list[float],
                 y_min: float | None = None, y_max: float | None = None) -> Column:
    """The fitted curve at ``x``: end values outside the knots, linear in between,
    clipped. NULL and NaN give NULL."""
    if not boundaries:
        raise ValueError("not fitted: no knots")
    if y_min is not None:
        predictions = [max(p, y_min) for p in predictions]
    if y_max is not None:
        predictions = [min(p, y_max) for p in predictions]
    n = len(boundaries)
    b, p = (F.from_json(F.lit(json.dumps(v)), "array<double>") for v in (boundaries, predictions))
    c = (F.col(x) if isinstance(x, str) else x).cast("double")
    steps = [1 << k for k in reversed(range(n.bit_length()))]

    def at(v: Column) -> Column:
        last = F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), lambda i, s: F.when(
            (i + s < n) & (F.get(b, i + s) <= v), i + s).otherwise(i))

        def between(i: Column) -> Column:
            lo, hi = F.get(b, i), F.get(b, i + 1)
            return F.get(p, i) + F.coalesce((F.get(p, i + 1) - F.get(p, i)) * F.try_divide(v - lo, hi - lo), F.lit(0.0))

        return F.get(F.transform(F.array(last), between), F.lit(0))

    clipped = F.greatest(F.least(c, F.lit(boundaries[-1])), F.lit(boundaries[0]))
    inside = F.get(F.transform(F.array(clipped), at), F.lit(0))
    return F.when(c.isNotNull() & ~F.isnan(c), inside)


class IsotonicCalibrator(Transformer, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """A fitted calibration as a pipeline stage: adds ``outputCol``, the curve at
    ``inputCol`` (of a vector column its last element, a probability of class 1)."""

    boundaries = Param(Params._dummy(), "boundaries", "scores of the knots, rising", TypeConverters.toListFloat)
    predictions = Param(Params._dummy(), "predictions", "values of the knots", TypeConverters.toListFloat)

    @keyword_only
    def __init__(self, *, inputCol: str = "score", outputCol: str = "calibrated", boundaries: list | None = None, predictions: list | None = None):
        super().__init__()
        self._setDefault(inputCol="score", outputCol="calibrated")
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, df: DataFrame) -> DataFrame:
        from pyspark.ml.functions import vector_to_array
        x = F.col(self.getInputCol())
        if df.schema[self.getInputCol()].dataType.typeName() == "vectorudt":
            x = F.element_at(vector_to_array(x), -1)
        return df.withColumn(self.getOutputCol(), interpolated(x, self.getOrDefault(self.boundaries), self.getOrDefault(self.predictions)))


def pooled_state(df: DataFrame, x: Column, y: str) -> DataFrame:
    """(x, s, n): label sum and row count of each distinct score. Rows without a
    score or label, or with NaN, take no part."""
    rows = df.select(x.alias("x"), F.col(y).cast("double").alias("y"))
    rows = rows.where(F.col("x").isNotNull() & ~F.isnan("x") & F.col("y").isNotNull() & ~F.isnan("y"))
    return rows.groupBy("x").agg(F.sum("y").alias("s"), F.count("*").alias("n"))


def merged_state(a: DataFrame, b: DataFrame) -> DataFrame:
    """The state of two batches; written, since batches follow each other."""
    return cut_lineage(a.unionByName(b).groupBy("x").agg(F.sum("s").alias("s"), F.sum("n").alias("n")))
