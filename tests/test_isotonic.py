"""Isotonic fit by ranges, calibrated pipeline models, decision table, attribution."""

import itertools
import math
import re
import uuid

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from cohortkit.operators import calibrate as CB
from cohortkit.operators import isotonic as ISO
from cohortkit.operators import model as MD
from cohortkit.operators import shapley as SH
from cohortkit.session import checkpoint_dir


def min_max(x, y, w):
    """Value of each point: max over starts of min over ends of the mean."""
    order = np.argsort(x)
    x, y, w = x[order], y[order], w[order]
    n = len(x)
    mean = np.full((n, n), np.inf)
    for a in range(n):
        mean[a, a:] = np.cumsum(y[a:] * w[a:]) / np.cumsum(w[a:])
    lowest = np.minimum.accumulate(mean[:, ::-1], axis=1)[:, ::-1]
    return x, np.array([lowest[:i + 1, i].max() for i in range(n)])


def frame(spark, x, y, w):
    return spark.createDataFrame([(float(a), float(b), float(c)) for a, b, c in zip(x, y, w)], "x double, y double, w double")


@pytest.mark.parametrize("seed,n,per_task", [(1, 300, 7), (2, 150, 1), (3, 40, 1000), (4, 1, 5), (5, 257, 32)])
def test_blocks_equal_the_min_max_formula(spark, seed, n, per_task):
    rng = np.random.default_rng(seed)
    x = rng.permutation(n) / 7.0
    y = np.round(x / n * 4 + rng.normal(size=n), 1)
    w = rng.integers(1, 9, n).astype(float)
    blocks = sorted(tuple(r) for r in ISO.fit_blocks(frame(spark, x, y, w).repartition(3), per_task=per_task).collect())
    xs, want = min_max(x, y, w)
    got = np.empty(n)
    for x0, x1, v, _ in blocks:
        got[(xs >= x0) & (xs <= x1)] = v
    assert np.allclose(got, want, atol=1e-12)
    assert sum(b[3] for b in blocks) == w.sum()
    values = [b[2] for b in blocks]
    assert values == sorted(set(values))  # blocks are as few as can be
    down = ISO.fit_blocks(frame(spark, x, -y, w), increasing=False, per_task=per_task)
    assert np.allclose(sorted(-r.value for r in down.collect()), values)


def test_extremes(spark):
    assert ISO.fit_blocks(frame(spark, [], [], [])).count() == 0
    falling = ISO.fit_blocks(frame(spark, range(50), range(50, 0, -1), [1] * 50), per_task=4).collect()
    assert [tuple(r) for r in falling] == [(0.0, 49.0, 25.5, 50.0)]
    rising = ISO.fit_blocks(frame(spark, range(50), range(50), [1] * 50), per_task=4)
    assert rising.count() == 50 and ISO.knots_of(rising).count() == 50
    with pytest.raises(ValueError, match="more than 10 knots"):
        ISO.collected(ISO.knots_of(rising), 10)
    with pytest.raises(ValueError, match="not fitted"):
        CB.Isotonic().fit(spark.createDataFrame([], "score double, target int")).transform(spark.range(1).select(F.lit(0.5).alias("score")))


def test_batches_equal_one_fit_and_bad_rows_take_no_part(spark):
    rng = np.random.default_rng(6)
    s = rng.random(900).round(2)
    rows = [(float(a), int(rng.random() < a)) for a in s] + [(None, 1), (float("nan"), 1), (0.5, None)]
    df = spark.createDataFrame(rows, "score double, target int")
    whole = CB.Isotonic(approximation=2).fit(df)
    parts = CB.Isotonic(approximation=2)
    for k in range(0, len(rows), 250):
        parts.accumulate(spark.createDataFrame(rows[k:k + 250], "score double, target int"))
    assert np.allclose(parts.finish().curve(), whole.curve())
    xs, want = min_max(*(np.array([getattr(r, c) for r in whole.state.select("x", (F.col("s") / F.col("n")).alias("y"), "n").collect()], float) for c in ("x", "y", "n")))
    at = spark.createDataFrame([(float(v),) for v in xs], "score double")
    assert np.allclose([r.c for r in whole.transform(at, "score", "c").orderBy("score").collect()], want)
    ones = CB.Isotonic(approximation=2, tie_weight="one").fit(df)
    assert ones.blocks.agg(F.sum("weight")).first()[0] == len(xs)


@pytest.mark.parametrize("n", [1, 2, 3, 64, 65, 1000])
def test_curve_equals_linear_interpolation(spark, n):
    rng = np.random.default_rng(n)
    b = np.unique(rng.random(n).round(6))
    p = np.sort(rng.random(len(b)) * 1.4 - 0.2)
    x = np.r_[rng.random(200) * 1.2 - 0.1, b]
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    out = df.select("x", ISO.interpolated("x", b.tolist(), p.tolist(), 0.0, 1.0).alias("y"))
    got = {r.x: r.y for r in out.collect()}
    assert np.allclose([got[v] for v in x], np.interp(x, b, p.clip(0, 1)))
    odd = spark.createDataFrame([(None,), (float("nan"),)], "x double")
    assert [r[0] for r in odd.select(ISO.interpolated("x", b.tolist(), p.tolist())).collect()] == [None, None]
    assert "Python" not in out._jdf.queryExecution().executedPlan().toString()


def test_score_and_calibration_are_one_saved_model(spark):
    rng = np.random.default_rng(3)
    rows = [(float(a), float(b), int(rng.random() < 1 / (1 + math.exp(-3 * a * b)))) for a, b in rng.normal(size=(600, 2))]
    df = spark.createDataFrame(rows, "a double, b double, target int")
    model = MD.gbt_pipeline(["a", "b"], max_iter=5, max_depth=3, weight=None).fit(df)
    both = MD.calibrated(model, df, approximation=3)
    path = f"{checkpoint_dir(spark).rstrip('/')}/model-{uuid.uuid4().hex}"
    both.write().save(path)
    a = MD.score(both, df).orderBy("a").collect()
    b = MD.score(PipelineModel.load(path), df).orderBy("a").collect()
    assert a == b and {"score", "calibrated"} <= set(a[0].asDict())
    by = sorted((r.score, r.calibrated) for r in a)
    assert [c for _, c in by] == sorted(c for _, c in by)
    assert abs(sum(r.calibrated for r in a) - sum(r.target for r in a)) < 3  # calibrated in the large


def test_thresholds_and_decisions(spark):
    rng = np.random.default_rng(8)
    rows = [(k, float(np.round(rng.random(), 2)), float(np.round(rng.random() * 3 - 1, 3)), int(rng.random() < 0.6)) for k in range(400)]
    df = spark.createDataFrame(rows, "id long, s double, t double, y int")

    def brute(col):
        best = None
        for t in sorted({r[col] for r in rows}):
            hit = [r[3] for r in rows if r[col] >= t]
            if sum(hit) / len(hit) >= 0.65:
                best = max(best or 0, sum(hit))
        return None if best is None else min(t for t in {r[col] for r in rows} if sum(r[3] for r in rows if r[col] >= t) == best)

    got = {r.variant: (r.threshold, r.recall) for r in MD.score_thresholds(df, ["s", "t"], "y", 0.65).collect()}
    assert {c: v[0] for c, v in got.items()} == {c: brute(k) for c, k in (("s", 1), ("t", 2)) if brute(k) is not None}
    out = MD.decision_table(df.withColumn("none", F.lit(0.0)), {"s": "ds", "t": "dt", "none": "dn"}, "y", 0.99).collect()
    found = {r.variant: r.threshold for r in MD.score_thresholds(df, ["s", "t"], "y", 0.99).collect()}
    assert all(r.dn is None for r in out)
    for c, d in (("s", "ds"), ("t", "dt")):
        assert all(r[d] == (None if c not in found else int(r[c] > found[c])) for r in out)


# --- attribution --------------------------------------------------------------------

def test_all_coalitions_give_the_exact_values(spark):
    rng = np.random.default_rng(2)
    names = list("abcd")
    x = rng.normal(size=(12, 4))
    df = spark.createDataFrame([(k, *map(float, r)) for k, r in enumerate(x)], "id long, a double, b double, c double, d double")
    f = lambda v: v[..., 0] * v[..., 1] - 2 * v[..., 2] + np.sin(v[..., 3]) * v[..., 0]
    score = lambda t: t.withColumn("score", F.col("a") * F.col("b") - 2 * F.col("c") + F.sin("d") * F.col("a"))
    back = df.where("id < 5")
    got = {(r.id, r.input): r for r in SH.shapley_values(df, ["id"], names, back, score).collect()}
    base = f(x[:5]).mean()
    for k in range(12):
        v = {s: f(np.where(np.isin(range(4), s), x[k], x[:5])).mean() for n in range(5) for s in itertools.combinations(range(4), n)}
        for i, name in enumerate(names):
            want = sum(math.factorial(len(s)) * math.factorial(3 - len(s)) / 24 * (v[tuple(sorted((*s, i)))] - v[s])
                       for n in range(4) for s in itertools.combinations([j for j in range(4) if j != i], n))
            assert got[k, name].attribution == pytest.approx(want, abs=1e-9)
            assert got[k, name].value == x[k, i] and got[k, name].base == pytest.approx(base)
        assert sum(got[k, n].attribution for n in names) == pytest.approx(f(x[k]) - base, abs=1e-9)


def test_drawn_coalitions_add_up_and_find_a_linear_model(spark):
    rng = np.random.default_rng(4)
    names = [f"x{i}" for i in range(14)]
    beta = rng.normal(size=14)
    df = spark.createDataFrame([(k, *map(float, r)) for k, r in enumerate(rng.normal(size=(20, 14)))], ["id", *names])
    score = lambda t: t.withColumn("score", sum(float(b) * F.col(n) for b, n in zip(beta, names)))
    back = df.limit(3)
    means = back.agg(*[F.avg(n) for n in names]).first()
    runs = [{(r.id, r.input): r.attribution for r in SH.shapley_values(df, ["id"], names, back, score, samples=60, seed=7).collect()} for _ in range(2)]
    assert runs[0] == pytest.approx(runs[1], abs=1e-12)
    for r in df.collect():
        for i, n in enumerate(names):
            assert runs[0][r.id, n] == pytest.approx(beta[i] * (r[n] - means[i]), abs=1e-6)


def test_trained_model_and_bounds(spark):
    rng = np.random.default_rng(5)
    rows = [(k, float(a), float(b), int(a + b > 0)) for k, (a, b) in enumerate(rng.normal(size=(200, 2)))]
    df = spark.createDataFrame(rows, "id long, a double, b double, target int")
    model = MD.gbt_pipeline(["a", "b"], max_iter=3, max_depth=2, weight=None).fit(df)
    out = SH.shapley_values(df.where("id < 30"), ["id"], ["a", "b"], df.limit(10), lambda t: MD.score(model, t))
    sums = out.groupBy("id").agg(F.sum("attribution").alias("s"), F.first("base").alias("b"), F.first("score").alias("f")).collect()
    assert len(sums) == 30 and all(abs(r.s - (r.f - r.b)) < 1e-6 for r in sums)
    with pytest.raises(ValueError, match="background"):
        SH.shapley_values(df, ["id"], ["a", "b"], df, lambda t: MD.score(model, t))
    one = SH.shapley_values(df, ["id"], ["a"], df.limit(2), lambda t: t.withColumn("score", F.col("a") * 2))
    assert one.where("abs(attribution - (score - base)) > 1e-9").count() == 0
    members, weights = SH.coalitions(5, 100)
    assert len(members) == 30 and members.sum() == 75
    few, w = SH.coalitions(12, 60, 1)
    assert len(few) <= 62 and (few.sum(1) % 12 != 0).all() and len({tuple(m) for m in few}) == len(few)


def test_shapley_shuffles_a_record_a_row(spark):
    """Coalitions meet in one group of their row, so none of them is a group to shuffle;
    a null score takes no part in its coalition's mean, and repeated rows are one."""
    df = spark.createDataFrame([(1, 1.0, 2.0), (1, 1.0, 2.0), (2, 3.0, 5.0), (3, -1.0, None)], "id long, a double, b double")
    back = spark.createDataFrame([(0.0, 1.0), (1.0, 3.0), (9.0, 0.0)], "a double, b double")
    out = SH.shapley_values(df, ["id"], ["a", "b"], back, lambda t: t.withColumn("score", F.when(F.col("a") < 9, F.col("a") + 2 * F.col("b"))))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(") == 1 and not re.search(r"hashpartitioning\([^)]*_c#", plan)
    got = {(r.id, r.input): r.attribution for r in out.collect()}
    assert out.count() == 6
    # base 4.5 = the mean over the two background rows that have a score; the one with a = 9
    # scores wherever the row gives a
    assert got[1, "a"] == pytest.approx(0.5 * (1 + 8 / 3 - 4.5) + 0.5 * (5 - 4.5))
    assert got[1, "b"] == pytest.approx(0.5 * (4.5 - 4.5) + 0.5 * (5 - (1 + 8 / 3)))
