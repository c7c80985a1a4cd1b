"""The training path: weights, categorical inputs, split by days, early stopping."""

import datetime as dt

import numpy as np
from pyspark.sql import functions as F

from cohortkit.operators import model as MD


def rows(spark, n=600, days=12, seed=1):
    rng = np.random.default_rng(seed)
    out = []
    for k in range(n):
        home, weekend = int(rng.random() < 0.4), int(rng.random() < 0.3)
        q = float(rng.random())
        rh = int(rng.random() < 0.15 + 0.6 * (home != weekend) + 0.1 * q)
        out.append((dt.date(2024, 1, 1 + k % days), f"s{k}", k % 50, rh, int(rng.random() < 0.7), int(rng.random() < 0.5), q, home, weekend, 0.5, "x"))
    return spark.createDataFrame(out, "valid_date date, sessionuuid string, customer_id long, rh int, is_trip_ended int, is_freq int, "
                                      "quantile double, is_home int, is_weekend int, norm_hour double, service string")


def test_only_training_rows_weigh_less(spark):
    d = MD.add_training_weight(MD.time_split(rows(spark), 6, 3)).collect()
    for r in d:
        rule = 1.0 if r.rh == 0 else 0.5 if r.is_trip_ended == 0 else 0.75 if r.is_freq == 0 else 1.0
        assert r.sample_weight == (rule if r.split == "train" else 1.0)
    seen = {(r.split, r.sample_weight) for r in d}
    assert {("train", 0.5), ("train", 0.75), ("train", 1.0), ("val", 1.0), ("test", 1.0)} == seen


def test_categories_are_split_by_sets(spark):
    d = MD.with_categories(MD.add_target(rows(spark)).withColumn("town", F.element_at(F.array(*[F.lit(x) for x in "abcdef"]), (F.col("customer_id") % 6 + 1).cast("int"))), ["is_home", "is_weekend"])
    d = d.withColumn("town", F.when(F.col("customer_id") == 3, None).otherwise(F.col("town")))
    d = MD.with_categories(d, ["town"]).withColumn("target", F.when(F.col("town").isin("b", "e"), 1).otherwise(F.col("target")))
    cats = ["is_home", "is_weekend", "town"]
    model = MD.gbt_pipeline(["quantile"], max_iter=8, max_depth=3, weight=None, categorical=cats).fit(d)
    text = model.stages[-1].toDebugString
    assert "feature 3 in {" in text and "feature 1 <=" not in text and "feature 3 <=" not in text and "feature 0 <=" in text
    other = d.limit(5).withColumn("town", F.lit("unseen"))
    scored = MD.score(model, other)
    assert scored.where("score between 0 and 1").count() == 5 and not [c for c in scored.columns if c.startswith("_")]


def test_the_whole_path(spark):
    model, d = MD.train_propensity(rows(spark), 6, 3, max_iter=30, max_depth=3)
    assert {r.split: r["count"] for r in d.groupBy("split").count().collect()} == {"train": 300, "val": 150, "test": 150}
    assert dict(d.dtypes)["is_home"] == "string" and "valid_date" in d.columns
    used = model.stages[1].getInputCols()
    assert used == ["quantile", "norm_hour", "_index_is_home", "_index_is_weekend"]
    s = MD.score(model, d).where("split = 'test'").collect()
    pos, neg = ([r.calibrated for r in s if r.target == t] for t in (1, 0))
    assert np.mean(pos) > np.mean(neg) + 0.15  # home differs from weekend: no single input shows it
    assert model.stages[2].getNumTrees < 30  # stopped early on the validation days
    alone, _ = MD.train_propensity(rows(spark), 12, 0, max_iter=2, max_depth=2)  # no validation days
    assert alone.stages[2].getNumTrees == 2
