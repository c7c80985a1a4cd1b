"""Counts as of many valid dates without copying rows to dates.

A row of day d belongs to the windows of the valid dates d+1 .. d+n+1: a span.
Rows become spans, spans are reduced (distinct items, sums), and only the reduced
counts are laid out over the dates, as running sums of what starts and ends."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .bookings import _dates

FROM, TO = "_from", "_to"


def spanned(df: DataFrame, day_col, dates, horizon: int) -> DataFrame:
    """Rows inside any date's window, with the span of dates (``_from``, ``_to``, both
    inclusive, clipped to the dates) whose windows hold them. The literal range
    on the day column prunes partitions."""
    ds = _dates(dates)
    lo, hi = ds[0], ds[-1]
    day = F.col(day_col) if isinstance(day_col, str) else day_col
    df = df.filter(day.between(F.lit(lo - _dt.timedelta(days=horizon + 1)), F.lit(hi - _dt.timedelta(days=1))))
    if len(ds) == 1:
        return df.withColumn(FROM, F.lit(lo)).withColumn(TO, F.lit(hi))
    return (df.withColumn(FROM, F.greatest(F.date_add(day, 1), F.lit(lo)))
              .withColumn(TO, F.least(F.date_add(day, horizon + 1), F.lit(hi))))


def distinct_spans(df: DataFrame, keys: list[str], item: str, dates) -> DataFrame:
    """(keys, _from, _to): disjoint spans of dates on which each distinct item of a key
    is in the window. Of an item only its distinct spans are held, one a day at most."""
    if len(_dates(dates)) == 1:
        return df.groupBy(*keys, item).agg(F.first(FROM).alias(FROM), F.first(TO).alias(TO)).select(*keys, FROM, TO)
    held = df.groupBy(*keys, item).agg(F.array_sort(F.collect_set(F.struct(FROM, TO))).alias("_s"))
    s = F.col("_s")

    def rest(span: Column, i: Column) -> Column:
        """What a span adds behind the one before: starts and ends rise together."""
        before = F.get(s, i - 1)
        return F.struct(F.greatest(span[FROM], F.coalesce(F.date_add(before[TO], 1), span[FROM])).alias(FROM), span[TO].alias(TO))

    # one day's span is nearly always the only one
    spans = F.when(F.size(s) == 1, s).otherwise(F.transform(s, rest))
    out = held.select(*keys, F.explode(spans).alias("_x")).select(*keys, f"_x.{FROM}", f"_x.{TO}")
    return out.filter(F.col(FROM) <= F.col(TO))


def by_date(spans: DataFrame, keys: list[str], dates, weight: Column | None = None, out: str = "n") -> DataFrame:
    """(valid_date, keys, out): the weights (1 each) of the spans that hold each date,
    summed; dates on which the sum is not positive are left out. Starts and ends
    are summed per key and date first, and only their running sums meet the dates."""
    ds = _dates(dates)
    w = F.lit(1).cast("long") if weight is None else weight.cast("long")
    if len(ds) == 1:
        total = spans.groupBy(*keys).agg(F.sum(w).alias(out)).filter(F.col(out) > 0)
        return total.select(F.lit(ds[0]).alias("valid_date"), *keys, out)
    edge = F.explode(F.array(F.struct(F.col(FROM).alias("d"), w.alias("v")), F.struct(F.date_add(TO, 1).alias("d"), (-w).alias("v")))).alias("_e")
    edges = spans.select(*keys, edge).groupBy(*keys, F.col("_e.d").alias("_d")).agg(F.sum("_e.v").alias("_v"))
    order = Window.partitionBy(*keys).orderBy("_d")
    run = edges.select(*keys, "_d", F.sum("_v").over(order.rowsBetween(Window.unboundedPreceding, 0)).alias(out),
                       F.coalesce(F.date_sub(F.lead("_d").over(order), 1), F.lit(ds[-1])).alias("_last"))
    run = run.filter((F.col(out) > 0) & (F.col("_d") <= F.lit(ds[-1])))
    laid = run.select(F.explode(F.sequence("_d", F.least("_last", F.lit(ds[-1])))).alias("valid_date"), *keys, out)
    return laid if len(ds) == (ds[-1] - ds[0]).days + 1 else laid.filter(F.col("valid_date").isin(*ds))


def first_spans(df: DataFrame, keys: list[str], order: list[str], payload: list[str], dates) -> DataFrame:
    """(keys, payload, _from, _to): for each key and date the row that comes first by
    ``order`` (then by payload) among those whose span holds the date. Repeated
    rows of a span are reduced before a key's spans, one a day at most, meet."""
    first = F.min(F.struct(*[F.col(c).isNull().alias(f"_n{i}") if j == 0 else F.col(c).alias(f"_o{i}") for i, c in enumerate(order) for j in (0, 1)],
                           F.struct(*payload).alias("_p"))).alias("_m")
    per_day = df.groupBy(*keys, FROM, TO).agg(first)
    if len(_dates(dates)) == 1:
        return per_day.select(*keys, *[F.col(f"_m._p.{c}").alias(c) for c in payload], FROM, TO)
    held = per_day.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("_m", FROM, TO))).alias("_s"))
    s = F.col("_s")
    days = F.sequence(F.array_min(F.transform(s, lambda x: x[FROM])), F.array_max(F.transform(s, lambda x: x[TO])))

    def chosen(d: Column) -> Column:
        x = F.get(F.filter(s, lambda x: (x[FROM] <= d) & (x[TO] >= d)), F.lit(0))
        return F.when(x.isNotNull(), F.struct(x["_m"]["_p"].alias("_p"), d.alias(FROM), d.alias(TO)))

    one = F.transform(s, lambda x: F.struct(x["_m"]["_p"].alias("_p"), x[FROM].alias(FROM), x[TO].alias(TO)))
    many = F.filter(F.transform(days, chosen), lambda x: x.isNotNull())
    return (held.select(*keys, F.explode(F.when(F.size(s) == 1, one).otherwise(many)).alias("_x"))
                .select(*keys, *[F.col(f"_x._p.{c}").alias(c) for c in payload], f"_x.{FROM}", f"_x.{TO}"))
