"""Hand-made fixtures for the quirks of the semantics register and
brute-force checks of the distributed operators."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortkit.config import EngineConfig
from cohortkit.functions.geo import great_circle_km, half_up_round, location_key
from cohortkit.functions.profiles import l2_normalize_map, smooth_hours
from cohortkit.functions.timefeat import iso_weekday, local_time, weekend_flag
from cohortkit.operators import calibrate as CB
from cohortkit.operators import dataset as DS
from cohortkit.operators import evaluate as EV
from cohortkit.operators import model as MD
from cohortkit.operators import sessions as SS
from cohortkit.operators.bookings import fan_out
from cohortkit.operators.windows import keep_first, percent_rank_by_histogram

CFG = EngineConfig()


def test_half_up_round(spark):
    r = spark.createDataFrame([(0.285,), (0.795,), (0.125,), (1.0,)], "x double").select(
        half_up_round("x", 2).alias("r")).collect()
    assert [x.r for x in r] == [0.28, 0.8, 0.13, 1.0]


def test_location_key(spark):
    r = spark.createDataFrame([(25.0299999, 55.1)], "a double, b double").select(
        location_key("a", "b").alias("k")).first().k
    assert r == "25.030|55.100"


def test_great_circle(spark):
    d = spark.createDataFrame([(25.2048, 55.2708, 24.4539, 54.3773)], "a double, b double, c double, d double")
    v = d.select(great_circle_km("a", "b", "c", "d").alias("km")).first().km
    assert abs(v - 122.8896) < 1e-3


def test_iso_weekday_and_local_time(spark):
    df = spark.createDataFrame([("2024-01-01 22:30:00", "UAE"), ("2024-01-07 12:00:00", "Jordan"),
                                ("2024-01-07 12:00:00", "Egypt")], "ts string, c string")
    df = df.withColumn("ts", F.to_timestamp("ts"))
    out = df.select(iso_weekday("ts").alias("dow"),
                    local_time("ts", "c", {"UAE": "Asia/Dubai", "Jordan": "Asia/Amman"}).alias("lt")).collect()
    assert [o.dow for o in out] == [1, 7, 7]
    assert str(out[0].lt) == "2024-01-02 02:30:00"        # Dubai is UTC+4: next day
    assert out[2].lt is None                                 # unknown country


def test_weekend_flag(spark):
    rows = [(d, c) for d in range(1, 8) for c in ("United Arab Emirates", "Jordan", "Other")]
    df = spark.createDataFrame(rows, "d int, c string")
    got = {(r.d, r.c): r.w for r in df.select("d", "c", weekend_flag("d", "c", CFG.weekend_by_country).alias("w")).collect()}
    assert [d for d in range(1, 8) if got[(d, "Jordan")]] == [5, 7]
    assert [d for d in range(1, 8) if got[(d, "United Arab Emirates")]] == [6, 7]
    assert [d for d in range(1, 8) if got[(d, "Other")]] == [6, 7]


def test_smoothing_and_norm(spark):
    df = spark.createDataFrame([({0: 2, 23: 1, 5: 4},), ({},)], "m map<int,bigint>")
    out = df.select(smooth_hours("m").alias("s"), l2_normalize_map("m").alias("n")).collect()
    s = out[0].s
    assert len(s) == 24 and sum(s.values()) == 3 * 7
    assert s[0] == 3 and s[23] == 3 and s[1] == 2 and s[22] == 1
    assert abs(sum(v * v for v in out[0].n.values()) - 1.0) < 1e-12
    assert out[1].n == {}


def test_keep_first_deterministic_and_hot_key(spark):
    rows = [("hot", i % 7, i) for i in range(3000)] + [("cold", 5, 1), ("cold", 5, 0)]
    df = spark.createDataFrame(rows, "k string, o int, p int")
    out = {r.k: (r.o, r.p) for r in keep_first(df, ["k"], [F.col("o")]).collect()}
    assert out == {"hot": (0, 0), "cold": (5, 0)}


def test_percent_rank_matches_window(spark):
    rnd = random.Random(7)
    rows = [(i, rnd.randint(1, 12)) for i in range(400)]
    df = spark.createDataFrame(rows, "c int, n int")
    got = {r.c: r.quantile for r in percent_rank_by_histogram(df, "n", digits=None).collect()}
    ns = sorted(n for _, n in rows)
    for c, n in rows:
        below = sum(1 for x in ns if x < n)
        assert abs(got[c] - below / (len(ns) - 1)) < 1e-12
    one = spark.createDataFrame([(1, 3)], "c int, n int")
    assert percent_rank_by_histogram(one, "n").first().quantile == 0.0


def test_fan_out_window(spark):
    import datetime as dt
    days = [dt.date(2001, 7, 1) + dt.timedelta(days=i) for i in range(40)]
    df = spark.createDataFrame([(d,) for d in days], "day date")
    dates = [dt.date(2001, 7, 20) + dt.timedelta(days=i) for i in range(5)]
    got = sorted((r.day, r.valid_date) for r in fan_out(df, "day", dates, 3).collect())
    want = sorted((d, v) for d in days for v in dates
                  if v - dt.timedelta(days=4) <= d <= v - dt.timedelta(days=1))
    assert got == want


def _sess(spark, rows):
    cols = ("valid_date string, ts bigint, sessionuuid string, customer_id int, booking_id bigint, "
            "service_area_id string, country_name string, latitude double, longitude double, "
            "dropoff_lat double, dropoff_long double, is_trip_ended int")
    return spark.createDataFrame(rows, cols)


def test_conflict_resolution(spark):
    D = "2001-08-01"
    base = (None, "UAE", 25.0, 55.0, 25.1, 55.1)
    rows = [
        (D, 10, "s1", 1, 100, *base, 1),   # positive
        (D, 5, "s1", 1, 101, *base, 0),    # negative in a session with a positive: dropped
        (D, 7, "s1", 1, 0, *base, 0),      # unbooked in a booked session: dropped
        (D, 3, "s2", 2, 102, *base, 0),    # negative alone: kept
        (D, 4, "s3", 3, 103, *base, 1),    # two bookings in one session: both kept
        (D, 6, "s3", 3, 104, *base, 1),
        (D, 9, "s4", 4, 0, *base, 0),      # unbooked: earliest kept
        (D, 8, "s4", 4, 0, *base, 0),
        (D, 1, None, 5, 0, *base, 0),      # null session: dropped
        (D, 2, "s5", 6, 105, *base, 1),    # same booking twice (two platforms): ended first, then earliest
        (D, 1, "s6", 6, 105, *base, 0),
    ]
    out = SS.clean_sessions(_sess(spark, rows)).collect()
    got = sorted((r.sessionuuid, r.booking_id, r.ts) for r in out)
    assert got == [("s1", 100, 10), ("s2", 102, 3), ("s3", 103, 4), ("s3", 104, 6),
                   ("s4", 0, 8), ("s5", 105, 2)]


def test_saved_place_flags(spark):
    cfg = EngineConfig()
    pt = (25.0, 55.0)
    near, far = {"lat": 25.0005, "long": 55.0}, {"lat": 26.0, "long": 55.0}
    rows = [(1, None), (2, {"home": near}), (3, {"work": near}), (4, {"home": far, "work": near})]
    df = spark.createDataFrame([(i, *pt, m) for i, m in rows],
                               "id int, latitude double, longitude double, "
                               "home_work_coords map<string,struct<lat:double,long:double>>")
    got = {r.id: (r.is_home, r.is_work, r.has_saved) for r in DS.saved_place_flags(df, cfg).collect()}
    assert got == {1: (0, 0, 0), 2: (1, 0, 1), 3: (0, 1, 1), 4: (0, 0, 1)}


def test_location_features_top2_and_radius(spark):
    m = {"25.000|55.000": 5, "25.010|55.000": 9}
    df = spark.createDataFrame([(25.0, 55.0, 0.0, 55.0, m), (25.0, 55.0, 25.0101, 55.0, {"25.000|55.000": 3})],
                               "latitude double, longitude double, dropoff_lat double, dropoff_long double, "
                               "locations map<string,bigint>")
    r = DS.location_features(df, CFG).collect()
    assert r[0].min_dist_to_known_loc == 0.0
    assert abs(r[0].norm_trips_curr_location - 5 / math.sqrt(25 + 81)) < 1e-12
    assert r[0].is_freq == 0                       # zero drop-off coordinate
    assert r[0].dist_to_most_freq > 1.0 and r[0].dist_to_second_freq == 0.0
    assert r[1].dist_to_second_freq is None        # only one place
    assert r[1].is_freq == 0


def _brute_pr(scores, labels):
    out = {}
    P = sum(labels)
    for t in sorted(set(scores)):
        tp = sum(1 for s, y in zip(scores, labels) if s >= t and y == 1)
        fp = sum(1 for s, y in zip(scores, labels) if s >= t and y != 1)
        out[t] = (tp / (tp + fp) if tp + fp else 0.0, tp / P)
    return out


def test_pr_curve_roc_and_threshold(spark):
    rnd = random.Random(3)
    scores = [round(rnd.random(), 2) for _ in range(600)]
    labels = [int(rnd.random() < s) for s in scores]
    df = spark.createDataFrame(list(zip(scores, labels)), "score double, target int")
    pr = {r.threshold: (r.precision, r.recall) for r in EV.pr_curve(df, n_buckets=8).collect()}
    brute = _brute_pr(scores, labels)
    assert pr.keys() == brute.keys()
    for t in brute:
        assert abs(pr[t][0] - brute[t][0]) < 1e-12 and abs(pr[t][1] - brute[t][1]) < 1e-12
    # optimal threshold: max recall with precision >= 0.7, lowest threshold at that recall
    ok = [r for t, (p, r) in brute.items() if p >= 0.7]
    best = max(ok)
    want = min(t for t, (p, r) in brute.items() if r == best)
    got = EV.optimal_threshold(EV.pr_curve(df, n_buckets=8), 0.7).first()
    assert got.threshold == want and got.recall == best
    # ROC AUC = P(score_pos > score_neg) + 0.5 P(tie)
    pos = [s for s, y in zip(scores, labels) if y == 1]
    neg = [s for s, y in zip(scores, labels) if y == 0]
    auc = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    assert abs(EV.roc_auc(df, n_buckets=8).first().roc_auc - auc) < 1e-12


def test_threshold_sweep_bruteforce(spark):
    rnd = random.Random(5)
    rows = [(rnd.random(), int(rnd.random() < 0.4), int(rnd.random() < 0.5)) for _ in range(500)]
    df = spark.createDataFrame(rows, "score double, rh int, is_freq int")
    got = {r.threshold: r for r in EV.threshold_sweep(df).collect()}
    n_rh = sum(r[1] for r in rows)
    for t in EV.DEFAULT_THRESHOLDS:
        s = [r for r in rows if r[0] > t]
        assert abs(got[t].sa_coverage - len(s) / len(rows)) < 1e-12
        assert abs(got[t].rh_coverage - sum(r[1] for r in s) / n_rh) < 1e-12
        assert abs(got[t].relevance_freq_only - sum(r[2] for r in s) / len(s)) < 1e-12


def test_ece_edges(spark):
    M = 4
    scores = [0.0, 0.25, 0.5, 0.75, 1.0, 0.3, 0.9]
    labels = [0, 1, 1, 0, 1, 0, 1]
    df = spark.createDataFrame(list(zip(scores, labels)), "score double, target int")
    bounds = np.linspace(0, 1, M + 1)
    conf, lab = np.array(scores), np.array(labels)
    acc = (conf > 0.5).astype(float) == lab
    want = 0.0
    for lo, hi in zip(bounds[:-1], bounds[1:]):
        inb = (conf > lo) & (conf <= hi)
        if inb.mean() > 0:
            want += abs(conf[inb].mean() - acc[inb].mean()) * inb.mean()
    got = EV.expected_calibration_error(df, M).first().ece
    assert abs(got - want) < 1e-12


def test_isotonic_tie_weights(spark):
    df = spark.createDataFrame([(0.1, 0), (0.1, 1), (0.3, 0), (0.5, 1)], "score double, target int")
    t = spark.createDataFrame([(0.1,), (0.3,), (0.5,), (0.0,), (0.9,), (0.2,)], "score double")
    cnt = CB.Isotonic(approximation=7, tie_weight="count").fit(df)
    one = CB.Isotonic(approximation=7, tie_weight="one").fit(df)
    a = [r.calibrated for r in cnt.transform(t).collect()]
    b = [r.calibrated for r in one.transform(t).collect()]
    assert np.allclose(a, [1 / 3, 1 / 3, 1, 1 / 3, 1, 1 / 3])
    assert np.allclose(b, [0.25, 0.25, 1, 0.25, 1, 0.25])
    single = CB.Isotonic().fit(spark.createDataFrame([(0.4, 1), (0.4, 0)], "score double, target int"))
    assert [r.calibrated for r in single.transform(t).collect()] == [0.5] * 6


def test_nonneg_least_squares(spark):
    rnd = np.random.default_rng(0)
    x1, x2 = rnd.random(300), (rnd.random(300) > 0.5).astype(float)
    y = 0.2 + 0.6 * x1 - 0.3 * x2 + rnd.normal(0, 0.01, 300)
    df = spark.createDataFrame([(float(a), float(b), float(c)) for a, b, c in zip(x1, x2, y)],
                               "x1 double, x2 double, y double")
    b0, (b1, b2) = CB.nonneg_least_squares(df, ["x1", "x2"], "y")
    assert b2 == 0.0 and b1 > 0
    X = np.column_stack([np.ones(300), x1])
    ref = np.linalg.lstsq(X, y, rcond=None)[0]
    assert abs(b0 - ref[0]) < 1e-8 and abs(b1 - ref[1]) < 1e-8


def test_stratified_sample_exact(spark):
    rows = [(f"k{i}", 0 if i % 10 else 1) for i in range(5000)]
    df = spark.createDataFrame(rows, "key string, s int")
    out = MD.stratified_sample(df, 0.07, "s", "key", n_buckets=64)
    counts = {r.s: r["count"] for r in out.groupBy("s").count().collect()}
    assert counts == {0: math.ceil(0.07 * 4500), 1: math.ceil(0.07 * 500)}
    assert out.select("key").distinct().count() == out.count()


def test_sample_weights(spark):
    df = spark.createDataFrame([(1, 0, 0), (1, 1, 0), (1, 1, 1), (0, 0, 0)], "rh int, is_trip_ended int, is_freq int")
    w = [r.sample_weight for r in MD.add_sample_weight(df).collect()]
    assert w == [0.5, 0.75, 1.0, 1.0]


def test_plans_have_no_python_or_cartesian(spark):
    from cohortkit.plans.registry import REGISTRY
    from .conftest import SF0001
    for name in ("features_ride", "sessions_batch", "location_features", "pr_curve"):
        plan = REGISTRY[name].spark(spark, SF0001)._jdf.queryExecution().executedPlan().toString()
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan, name
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name


# --- null order keys, transaction sources, scans --------------------------------

def test_keep_first_places_null_order_keys(spark):
    df = spark.createDataFrame([(1, None, "a"), (1, 5, "b"), (2, None, "c"), (3, 7, "d"), (3, 6, "e")], "k int, o int, p string")
    got = lambda **kw: {r.k: r.p for r in keep_first(df, ["k"], [F.col("o")], **kw).collect()}
    assert got() == {1: "b", 2: "c", 3: "e"}
    assert got(nulls_first=True) == {1: "a", 2: "c", 3: "e"}
    assert {r.k: r.p for r in keep_first(df, ["k"], [-F.col("o")]).collect()} == {1: "b", 2: "c", 3: "d"}


def test_transaction_sources_are_whole():
    from cohortkit.operators.transactions import FOOD_BRANCHES, RIDE_BRANCHES
    from cohortkit.plans.sqlfrag import EXPECTED_SOURCES
    assert len(RIDE_BRANCHES) == 10 == len(EXPECTED_SOURCES) + 1
    assert len(FOOD_BRANCHES) == 11 and {b.name for b in FOOD_BRANCHES} - {b.name for b in RIDE_BRANCHES} == {"food"}


def test_filters_and_columns_reach_the_scan(spark):
    from cohortkit.plans.registry import REGISTRY
    from .conftest import SF0001
    df = REGISTRY["scan_trips_window"].spark(spark, SF0001)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "FileScan parquet" in plan and "ExistingRDD" not in plan
    scans = [x for x in plan.split("FileScan parquet")[1:]]
    assert any("o_orderdate" in x and "o_totalprice" not in x.split("ReadSchema")[1].split("\n")[0] for x in scans)
    assert any("PushedFilters: [" in x and "PushedFilters: []" not in x for x in scans)
