"""Ranking helpers that avoid single-partition windows over input-sized data.

* ``keep_first``: one row per key by a total order, as an aggregate of
  ``min(struct(order..., payload))`` -> partial aggregation before the shuffle,
  so a hot key (a third of all rows) is collapsed map-side to one row per task.
  Struct buffers make it a sort aggregate on both sides.
* ``percent_rank_by_histogram``: global ``percent_rank`` over a count column via
  the histogram of distinct values (bounded by sqrt(2 * rows)).
* ``descending_cumsum``: prefix sums in descending score order via quantile
  buckets: per-bucket totals (n_buckets rows, broadcast) + windows inside each
  bucket.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geo import half_up_round


def keep_first(df: DataFrame, keys: list[str], order: list[Column], nulls_first: bool = False) -> DataFrame:
    """Keep one row per ``keys``: the smallest by ``order`` (ascending; negate a
    numeric column for descending), NULL order keys last as in warehouse SQL or,
    with ``nulls_first``, first as in data-frame sorts. Remaining ties are broken
    by the other columns in their column order, so the result is deterministic."""
    others = [c for c in df.columns if c not in keys]
    placed = [x for e in order for x in (e.isNotNull() if nulls_first else e.isNull(), e)]
    probe = F.struct(*[e.alias(f"_o{i}") for i, e in enumerate(placed)],
                     F.struct(*[F.col(c) for c in others]).alias("_p"))
    return (df.groupBy(*keys).agg(F.min(probe).alias("_m"))
              .select(*keys, *[F.col(f"_m._p.{c}").alias(c) for c in others]))


def percent_rank_by_histogram(df: DataFrame, value_col: str, out_col: str = "quantile",
                              digits: int | None = 2, by: list[str] | None = None) -> DataFrame:
    """Adds ``percent_rank() over (order by value_col)`` (optionally rounded):
    (#rows with a strictly smaller value) / (#rows - 1), 0 for a single row.

    Only the histogram (one row per distinct value) is ranked, so no task ever
    holds the whole input; the histogram joins back on the value."""
    by = list(by or [])
    hist = df.groupBy(*by, value_col).agg(F.count(F.lit(1)).alias("_n"))
    w_before = (Window.partitionBy(*by).orderBy(value_col)
                .rowsBetween(Window.unboundedPreceding, -1))
    w_all = Window.partitionBy(*by)
    hist = hist.select(
        *by, value_col,
        F.coalesce(F.sum("_n").over(w_before), F.lit(0)).alias("_below"),
        F.sum("_n").over(w_all).alias("_total"))
    pr = F.when(F.col("_total") > 1,
                F.col("_below") / (F.col("_total") - 1)).otherwise(F.lit(0.0))
    if digits is not None:
        pr = half_up_round(pr, digits)
    return df.join(hist.select(*by, value_col, pr.alias(out_col)), [*by, value_col])


def descending_cumsum(df: DataFrame, score_col: str, value_cols: list[str],
                      n_buckets: int = 64, rel_error: float = 1e-3,
                      prefix: str = "cum_") -> DataFrame:
    """For every row, the sum of ``value_cols`` over all rows with a score
    greater than or equal to the row's score (``cum_<c>``) and the grand total
    (``total_<c>``). Scores must be unique per row (aggregate ties first).

    Rows are cut into ~``n_buckets`` score ranges by approximate quantiles
    (so buckets hold similar row counts), per-bucket totals are suffix-summed
    over the small bucket table, and each bucket adds its running sum."""
    probs = [i / n_buckets for i in range(1, n_buckets)]
    qs = df.approxQuantile(score_col, probs, rel_error) if n_buckets > 1 else []
    splits = [float("-inf")] + sorted(set(q for q in qs if q is not None)) + [float("inf")]
    b = (Bucketizer(splits=splits, inputCol=score_col, outputCol="_bucket")
         .setHandleInvalid("keep").transform(df))
    tot = b.groupBy("_bucket").agg(*[F.sum(c).alias(f"_t_{c}") for c in value_cols])
    w_above = Window.orderBy(F.col("_bucket").desc()).rowsBetween(Window.unboundedPreceding, -1)
    w_all = Window.partitionBy()
    offsets = tot.select("_bucket", *[F.coalesce(F.sum(f"_t_{c}").over(w_above), F.lit(0))
                                      .alias(f"_off_{c}") for c in value_cols],
                         *[F.sum(f"_t_{c}").over(w_all).alias(f"total_{c}") for c in value_cols])
    w_in = (Window.partitionBy("_bucket").orderBy(F.col(score_col).desc())
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    # offsets has one row per bucket: its size is bounded by n_buckets
    out = b.join(F.broadcast(offsets), "_bucket")
    for c in value_cols:
        out = out.withColumn(prefix + c, F.col(f"_off_{c}") + F.sum(c).over(w_in))
    return out.drop("_bucket", *[f"_off_{c}" for c in value_cols])
