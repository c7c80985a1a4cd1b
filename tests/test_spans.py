"""Spans of valid dates against rows copied to every date."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortkit.operators import spans as SP
from cohortkit.operators.bookings import fan_out
from cohortkit.operators.windows import keep_first

D0 = dt.date(2024, 1, 1)
DATES = {"one": [D0 + dt.timedelta(days=40)], "run": [D0 + dt.timedelta(days=30 + k) for k in range(12)],
         "gaps": [D0 + dt.timedelta(days=k) for k in (20, 21, 27, 44, 60)]}


def rows(spark, n=500, seed=2):
    rng = np.random.default_rng(seed)
    out = [(D0 + dt.timedelta(days=int(rng.integers(0, 60))), int(rng.integers(0, 12)), int(rng.integers(0, 40)), int(rng.integers(0, 9)), f"p{rng.integers(0, 3)}") for _ in range(n)]
    out += [out[0]] * 200 + [(D0 + dt.timedelta(days=35), 3, None, 1, None)]  # a row that repeats; no item
    return spark.createDataFrame(out, "day date, c int, item int, t int, place string")


@pytest.mark.parametrize("dates", DATES)
@pytest.mark.parametrize("horizon", [0, 7, 59])
def test_equal_to_copies(spark, dates, horizon):
    ds, df = DATES[dates], rows(spark)
    copied = fan_out(df, "day", ds, horizon)
    s = SP.spanned(df, "day", ds, horizon)
    assert s.where("_from > _to").count() == 0

    def same(a, b, cols):
        return sorted(map(tuple, a.select(*cols).collect()), key=str) == sorted(map(tuple, b.select(*cols).collect()), key=str)

    n = copied.groupBy("valid_date", "c").agg(F.sum("t").cast("long").alias("n")).where("n > 0")
    assert same(SP.by_date(s, ["c"], ds, F.col("t")), n, ["valid_date", "c", "n"])
    d = copied.where("item is not null").groupBy("valid_date", "c").agg(F.countDistinct("item").alias("n"))
    got = SP.by_date(SP.distinct_spans(s.where("item is not null"), ["c"], "item", ds), ["c"], ds)
    assert same(got, d, ["valid_date", "c", "n"])
    first = keep_first(copied.select("valid_date", "c", "item", "t", "place"), ["valid_date", "c", "item"], [F.col("t")])
    f = SP.first_spans(s, ["c", "item"], ["t"], ["t", "place"], ds)
    laid = f.withColumn("valid_date", F.explode(F.array(*[F.lit(x) for x in ds]))).where("valid_date between _from and _to")
    assert same(laid, first, ["valid_date", "c", "item", "t", "place"])


def test_no_rows(spark):
    ds, df = DATES["run"], rows(spark).limit(0)
    s = SP.spanned(df, "day", ds, 5)
    assert SP.by_date(SP.distinct_spans(s, ["c"], "item", ds), ["c"], ds).count() == 0
    assert SP.first_spans(s, ["c"], ["t"], ["place"], ds).count() == 0


def test_counts_are_reduced_before_they_meet_the_dates(spark):
    ds = DATES["run"]
    s = SP.spanned(rows(spark), "day", ds, 7)
    plan = SP.by_date(SP.distinct_spans(s, ["c"], "item", ds), ["c"], ds)._jdf.queryExecution().optimizedPlan().toString()
    lines = plan.splitlines()
    laid = next(k for k, x in enumerate(lines) if "Generate explode(sequence" in x)
    below = [k for k, x in enumerate(lines) if "Aggregate" in x]
    assert below and min(below) > laid and not [x for x in lines[laid + 1:] if "explode(sequence" in x]
    assert len(below) == 2  # distinct items, then starts and ends


def test_features_plan_shuffles_little(spark):
    """The written intermediate tables keep the final plan small."""
    from cohortkit.operators.features import ride_features
    from cohortkit.plans.registry import FIX_CFG, SAVED_MIN_YEAR
    from cohortkit.sources.fixtures import Tables

    from .conftest import SF0001
    df = ride_features(Tables(spark, SF0001), DATES_2001, FIX_CFG, SAVED_MIN_YEAR)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan ExistingRDD") >= 3
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan and "Python" not in plan


DATES_2001 = [dt.date(2001, 7, 30), dt.date(2001, 7, 31), dt.date(2001, 8, 1)]
