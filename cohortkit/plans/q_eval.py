"""Queries of the evaluation / calibration / model stage, over the scored
fixture view (orders with a pseudo-random score and label)."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from ..operators import calibrate as CB
from ..operators import evaluate as EV
from ..operators import isotonic as ISO
from ..operators import model as MD
from ..operators import shapley as SH
from ..sources.fixtures import Tables
from .q_dataset import TRAINING_VIEWS, training_body, training_rows_q
from .q_sessions import BATCH
from .registry import oracle, register

THRESHOLD = 0.5
TARGET_PRECISION = 0.6
ECE_BINS = 500
VIF_COLS = ("l_quantity", "l_discount", "l_tax", "price_1e4")
_SC = ("scored",)

_COUNTS = """
sc AS (SELECT score, CAST(sum(CASE WHEN target = 1 THEN 1 ELSE 0 END) AS BIGINT) AS pos,
              CAST(sum(CASE WHEN target <> 1 THEN 1 ELSE 0 END) AS BIGINT) AS neg
       FROM scored GROUP BY score),
cu AS (SELECT score, pos, neg, sum(pos) OVER (ORDER BY score DESC) AS tp,
              sum(neg) OVER (ORDER BY score DESC) AS fp, sum(pos) OVER () AS p_all FROM sc),
pr AS (SELECT score AS threshold, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp,
              CASE WHEN tp + fp > 0 THEN CAST(tp AS DOUBLE) / (tp + fp) ELSE 0.0 END AS precision,
              CASE WHEN p_all > 0 THEN CAST(tp AS DOUBLE) / p_all ELSE 1.0 END AS recall FROM cu)"""


def _scored(spark, sf):
    return Tables(spark, sf)["scored"]


@register("threshold_sweep", oracle(_SC, """
t AS (SELECT unnest([0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS threshold),
tot AS (SELECT count(*) AS n, sum(CASE WHEN rh = 1 THEN 1 ELSE 0 END) AS n_rh,
               sum(CASE WHEN rh = 1 AND is_freq = 1 THEN 1 ELSE 0 END) AS n_rel FROM scored),
per AS (SELECT t.threshold, count(s.score) AS sessions,
               sum(CASE WHEN s.rh = 1 THEN 1 ELSE 0 END) AS rh_sessions,
               sum(CASE WHEN s.is_freq = 1 THEN 1 ELSE 0 END) AS relevant_sessions
        FROM t LEFT JOIN scored s ON s.score > t.threshold GROUP BY t.threshold)
SELECT CAST(per.threshold AS DOUBLE) AS threshold,
       CAST(sessions AS DOUBLE) / n AS sa_coverage,
       CAST(rh_sessions AS DOUBLE) / n_rh AS rh_coverage,
       CAST(rh_sessions AS DOUBLE) / sessions AS relevance_rh_total,
       CAST(relevant_sessions AS DOUBLE) / sessions AS relevance_freq_only,
       CAST(relevant_sessions AS DOUBLE) / n_rel AS pct_freq_detected
FROM per, tot"""))
def threshold_sweep_q(spark, sf):
    return EV.threshold_sweep(_scored(spark, sf))


@register("pr_curve", oracle(_SC, _COUNTS + """
SELECT threshold, tp, fp, precision, recall FROM pr"""))
def pr_curve_q(spark, sf):
    return EV.pr_curve(_scored(spark, sf))


@register("optimal_threshold", oracle(_SC, _COUNTS + f""",
best AS (SELECT max(recall) AS r FROM pr WHERE precision >= {TARGET_PRECISION})
SELECT min(threshold) AS threshold, max(recall) AS recall FROM pr, best WHERE pr.recall = best.r"""))
def optimal_threshold_q(spark, sf):
    return EV.optimal_threshold(EV.pr_curve(_scored(spark, sf)), TARGET_PRECISION)


@register("roc_auc", oracle(_SC, _COUNTS + """
SELECT sum(neg * ((tp - pos) + pos / 2.0)) / (sum(pos) * CAST(sum(neg) AS DOUBLE)) AS roc_auc
FROM cu"""))
def roc_auc_q(spark, sf):
    return EV.roc_auc(_scored(spark, sf))


@register("roc_curve", oracle(_SC, """
c AS (SELECT score, sum(target) AS pos, count(*) - sum(target) AS neg FROM scored GROUP BY score),
n AS (SELECT CAST(sum(pos) AS DOUBLE) AS pos, CAST(sum(neg) AS DOUBLE) AS neg FROM c)
SELECT c.score AS threshold, (SELECT sum(x.neg) FROM c x WHERE x.score >= c.score) / n.neg AS fpr,
       (SELECT sum(x.pos) FROM c x WHERE x.score >= c.score) / n.pos AS tpr
FROM c, n"""))
def roc_curve_q(spark, sf):
    return EV.roc_curve(_scored(spark, sf))


@register("log_loss", oracle(_SC, f"""
SELECT avg(-(target * ln(p) + (1 - target) * ln(1 - p))) AS log_loss
FROM (SELECT CAST(target AS DOUBLE) AS target,
             least(greatest(score, {EV.EPS!r}), {1 - EV.EPS!r}) AS p FROM scored) x"""))
def log_loss_q(spark, sf):
    return EV.log_loss(_scored(spark, sf))


@register("confusion_matrix", oracle(_SC, f"""
SELECT CAST(target AS INTEGER) AS actual, CAST(score > {THRESHOLD} AS INTEGER) AS predicted,
       count(*) AS n FROM scored GROUP BY ALL"""))
def confusion_matrix_q(spark, sf):
    return EV.confusion_matrix(_scored(spark, sf), THRESHOLD)


@register("classification_report", oracle(_SC, f"""
c AS (SELECT CAST(sum(CASE WHEN target = 0 AND score <= {THRESHOLD} THEN 1 ELSE 0 END) AS DOUBLE) c00,
             CAST(sum(CASE WHEN target = 0 AND score > {THRESHOLD} THEN 1 ELSE 0 END) AS DOUBLE) c01,
             CAST(sum(CASE WHEN target = 1 AND score <= {THRESHOLD} THEN 1 ELSE 0 END) AS DOUBLE) c10,
             CAST(sum(CASE WHEN target = 1 AND score > {THRESHOLD} THEN 1 ELSE 0 END) AS DOUBLE) c11
      FROM scored),
m AS (SELECT *, coalesce(c00 / nullif(c00 + c10, 0), 0) AS p0, coalesce(c00 / nullif(c00 + c01, 0), 0) AS r0,
             coalesce(c11 / nullif(c11 + c01, 0), 0) AS p1, coalesce(c11 / nullif(c11 + c10, 0), 0) AS r1,
             c00 + c01 AS s0, c10 + c11 AS s1 FROM c),
f AS (SELECT *, coalesce(2 * p0 * r0 / nullif(p0 + r0, 0), 0) AS f0,
             coalesce(2 * p1 * r1 / nullif(p1 + r1, 0), 0) AS f1,
             coalesce((c00 + c11) / nullif(s0 + s1, 0), 0) AS acc FROM m)
SELECT '0' AS label, p0 AS precision, r0 AS recall, f0 AS f1, s0 AS support FROM f
UNION ALL SELECT '1', p1, r1, f1, s1 FROM f
UNION ALL SELECT 'accuracy', acc, acc, acc, s0 + s1 FROM f
UNION ALL SELECT 'macro avg', (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, s0 + s1 FROM f
UNION ALL SELECT 'weighted avg', (p0 * s0 + p1 * s1) / (s0 + s1), (r0 * s0 + r1 * s1) / (s0 + s1),
                 (f0 * s0 + f1 * s1) / (s0 + s1), s0 + s1 FROM f"""))
def classification_report_q(spark, sf):
    return EV.classification_report(_scored(spark, sf), THRESHOLD)


_EDGES = ", ".join(repr(float(e)) for e in np.linspace(0, 1, 6)[1:-1])


@register("calibration_curve", oracle(_SC, f"""
SELECT CAST(({" + ".join(f"CASE WHEN {e} < score THEN 1 ELSE 0 END" for e in _EDGES.split(", "))}) AS INTEGER) AS bin,
       avg(CAST(target AS DOUBLE)) AS prob_true, avg(score) AS prob_pred, count(*) AS n
FROM scored GROUP BY 1"""))
def calibration_curve_q(spark, sf):
    return EV.calibration_curve(_scored(spark, sf), 5)


@register("ece", oracle(_SC, f"""
b AS (SELECT i AS bin, (i - 1) * (CAST(1 AS DOUBLE) / {ECE_BINS}) AS lo,
             CASE WHEN i = {ECE_BINS} THEN CAST(1 AS DOUBLE) ELSE i * (CAST(1 AS DOUBLE) / {ECE_BINS}) END AS hi
      FROM range(1, {ECE_BINS + 1}) r(i)),
pb AS (SELECT b.bin, count(*) AS n, avg(s.score) AS conf,
              avg(CASE WHEN CAST(s.score > 0.5 AS INTEGER) = s.target THEN 1.0 ELSE 0.0 END) AS acc
       FROM scored s JOIN b ON s.score > b.lo AND s.score <= b.hi GROUP BY b.bin)
SELECT (SELECT sum(abs(conf - acc) * n) FROM pb) / (SELECT count(*) FROM scored) AS ece"""))
def ece_q(spark, sf):
    return EV.expected_calibration_error(_scored(spark, sf), ECE_BINS)


def _num(spark, sf):
    li = Tables(spark, sf)["lineitem"]
    return li.select("l_quantity", "l_discount", "l_tax",
                     (F.col("l_extendedprice") / 10000.0).alias("price_1e4"))


_GRAM_SQL = " UNION ALL ".join(
    f"SELECT {i} AS i, {j} AS j, sum(CAST({a} AS DOUBLE) * {b}) AS g FROM num"
    for i, a in enumerate(VIF_COLS) for j, b in enumerate(VIF_COLS))


@register("vif_gram", oracle((), f"""
num AS (SELECT l_quantity, l_discount, l_tax, l_extendedprice / 10000.0 AS price_1e4 FROM lineitem)
{_GRAM_SQL}"""))
def vif_gram_q(spark, sf):
    return EV.gram_matrix(_num(spark, sf), list(VIF_COLS))


@register("vif", None)
def vif_q(spark, sf):
    return EV.variance_inflation(_num(spark, sf), list(VIF_COLS))


# --- calibration ----------------------------------------------------------------

@register("isotonic_tie_pool", oracle(_SC, """
SELECT round_even(score * 10000000.0, 0) / 10000000.0 AS x, avg(CAST(target AS DOUBLE)) AS y,
       count(*) AS n FROM scored GROUP BY 1"""))
def isotonic_tie_pool_q(spark, sf):
    return CB.tie_pool(_scored(spark, sf), "score", "target", 7)


def _iso(spark, sf):
    s = MD.time_split(_scored(spark, sf), 1500, 300)
    train = s.filter(F.col("split") == "train")
    return s, CB.Isotonic(0.0, 1.0, True, approximation=7).fit(train, "score", "target")


@register("isotonic_fit", None)
def isotonic_fit_q(spark, sf):
    """Fitted knots (boundary, prediction) of the calibration on train scores."""
    return _iso(spark, sf)[1].knots()


@register("isotonic_apply", None)
def isotonic_apply_q(spark, sf):
    s, iso = _iso(spark, sf)
    test = s.filter(F.col("split") == "test")
    return iso.transform(test, "score", "calibrated").select("sessionuuid", "score", "calibrated")


@register("linear_moments", oracle(_SC, """
SELECT count(*) AS n, sum(score) AS s_score, sum(is_evening) AS s_evening, sum(target) AS s_y,
       sum(score * score) AS s_score2, sum(score * is_evening) AS s_score_evening,
       sum(is_evening * is_evening) AS s_evening2, sum(score * target) AS s_score_y,
       sum(is_evening * target) AS s_evening_y
FROM (SELECT score, CAST(CAST(hour(ts) > 16 AS INTEGER) AS DOUBLE) AS is_evening,
             CAST(target AS DOUBLE) AS target FROM scored WHERE is_work = 1) x"""))
def linear_moments_q(spark, sf):
    w = _scored(spark, sf).filter(F.col("is_work") == 1).select(
        "score", (F.hour("ts") > 16).cast("int").cast("double").alias("is_evening"),
        F.col("target").cast("double").alias("target"))
    return w.agg(F.count(F.lit(1)).alias("n"), F.sum("score").alias("s_score"),
                 F.sum("is_evening").alias("s_evening"), F.sum("target").alias("s_y"),
                 F.sum(F.col("score") * F.col("score")).alias("s_score2"),
                 F.sum(F.col("score") * F.col("is_evening")).alias("s_score_evening"),
                 F.sum(F.col("is_evening") * F.col("is_evening")).alias("s_evening2"),
                 F.sum(F.col("score") * F.col("target")).alias("s_score_y"),
                 F.sum(F.col("is_evening") * F.col("target")).alias("s_evening_y"))


@register("nonneg_linear_adjust", None)
def nonneg_linear_adjust_q(spark, sf):
    """Non-negative linear adjustment on (score, is_evening) of work-place
    sessions, then isotonic calibration of the adjusted score."""
    s, iso = _iso(spark, sf)
    w = s.filter(F.col("is_work") == 1).withColumn("is_evening", (F.hour("ts") > 16).cast("int"))
    b0, b = CB.nonneg_least_squares(w.filter(F.col("split") == "train"),
                                    ["score", "is_evening"], "target")
    adj = CB.linear_adjust(w.filter(F.col("split") == "test"), b0, b, ["score", "is_evening"])
    return iso.transform(adj, "adjusted", "calibrated").select("sessionuuid", "adjusted", "calibrated")


# --- targets, weights, splits, samples -----------------------------------------

@register("targets", oracle(_SC, """
SELECT sessionuuid, CAST(coalesce(is_freq, 0) + rh AS INTEGER) AS multiclass,
       CAST(rh AS INTEGER) AS rh_vs_rest, CAST(is_freq AS INTEGER) AS pattern_vs_rest
FROM scored"""))
def targets_q(spark, sf):
    s = _scored(spark, sf).drop("target")
    return (MD.add_target(s, "multiclass").withColumnRenamed("target", "multiclass")
            .transform(lambda d: MD.add_target(d, "rh_vs_rest").withColumnRenamed("target", "rh_vs_rest"))
            .transform(lambda d: MD.add_target(d, "pattern_vs_rest")
                       .withColumnRenamed("target", "pattern_vs_rest"))
            .select("sessionuuid", "multiclass", "rh_vs_rest", "pattern_vs_rest"))


@register("sample_weights", oracle(_SC, """
SELECT sessionuuid, CASE WHEN rh = 1 AND is_trip_ended = 0 THEN 0.5
                         WHEN rh = 1 AND is_freq = 0 THEN 0.75 ELSE 1.0 END AS sample_weight
FROM scored"""))
def sample_weights_q(spark, sf):
    return MD.add_sample_weight(_scored(spark, sf)).select("sessionuuid", "sample_weight")


@register("time_split", oracle(_SC, """
d AS (SELECT valid_date, row_number() OVER (ORDER BY valid_date) AS i
      FROM (SELECT DISTINCT valid_date FROM scored) x)
SELECT s.sessionuuid, CASE WHEN d.i <= 60 THEN 'train' WHEN d.i <= 75 THEN 'val' ELSE 'test' END AS split
FROM scored s JOIN d ON s.valid_date = d.valid_date"""))
def time_split_q(spark, sf):
    return MD.time_split(_scored(spark, sf), 60, 15).select("sessionuuid", "split")


@register("target_counts", oracle(_SC, """
SELECT target, count(*) AS n FROM scored GROUP BY target"""))
def target_counts_q(spark, sf):
    return _scored(spark, sf).groupBy("target").agg(F.count(F.lit(1)).alias("n"))


@register("decisions", oracle(_SC, """
SELECT sessionuuid, score, CAST(score > 0.5 AS INTEGER) AS decision_base,
       CAST(score > 0.7 AS INTEGER) AS decision_strict FROM scored"""))
def decisions_q(spark, sf):
    d = MD.decisions(_scored(spark, sf), {"decision_base": 0.5, "decision_strict": 0.7})
    return d.select("sessionuuid", "score", "decision_base", "decision_strict")


@register("hard_negatives", oracle(_SC, """
SELECT sessionuuid, customer_id, score FROM scored WHERE score > 0.98 AND target = 0"""))
def hard_negatives_q(spark, sf):
    s = _scored(spark, sf)
    return (s.filter((F.col("score") > 0.98) & (F.col("target") == 0))
             .orderBy("customer_id").select("sessionuuid", "customer_id", "score"))


@register("evening_subset", oracle(_SC, """
SELECT sessionuuid, CAST(hour(ts) > 16 AS INTEGER) AS is_evening FROM scored WHERE is_work = 1"""))
def evening_subset_q(spark, sf):
    s = _scored(spark, sf).filter(F.col("is_work") == 1)
    return s.select("sessionuuid", (F.hour("ts") > 16).cast("int").alias("is_evening"))


@register("exact_sample", None)
def exact_sample_q(spark, sf):
    return MD.exact_sample(_scored(spark, sf), 2000, "sessionuuid").select("sessionuuid", "score")


@register("stratified_sample", None)
def stratified_sample_q(spark, sf):
    return MD.stratified_sample(_scored(spark, sf), 0.1, "target", "sessionuuid").select(
        "sessionuuid", "target")


# --- boosted trees -----------------------------------------------------------------

def _gbt_data(spark, sf):
    """Order-level rows: price, priority and calendar inputs; label = whether
    the pseudo-random score exceeds the label draw (the scored view's target)."""
    T = Tables(spark, sf)
    o = T["orders"].select("o_orderkey", "o_totalprice", "o_orderpriority", "o_orderdate")
    s = T["scored"].select(F.substring("sessionuuid", 2, 19).cast("long").alias("o_orderkey"),
                           "score", "target", "rh", "is_freq", "is_trip_ended", "valid_date")
    d = o.join(s, "o_orderkey")
    d = d.select("o_orderkey", "valid_date", "target", "rh", "is_freq", "is_trip_ended",
                 (F.col("o_totalprice") / 1e5).alias("price"),
                 F.substring("o_orderpriority", 1, 1).cast("int").alias("priority"),
                 F.dayofweek("o_orderdate").alias("dow"), "score")
    d = MD.add_sample_weight(d)
    d = MD.time_split(d, 1500, 300)
    return d, ["price", "priority", "dow", "score"]


@register("gbt_train_score", None)
def gbt_train_score_q(spark, sf):
    d, feats = _gbt_data(spark, sf)
    d = d.withColumn("is_val", F.col("split") == "val")
    model = MD.gbt_pipeline(feats, max_iter=20, max_depth=5, validation_col="is_val").fit(
        d.filter(F.col("split") != "test"))
    return MD.score(model, d.filter(F.col("split") == "test")).select("o_orderkey", "target", "score")


@register("feature_importance", None)
def feature_importance_q(spark, sf):
    d, feats = _gbt_data(spark, sf)
    model = MD.gbt_pipeline(feats, max_iter=20, max_depth=5).fit(d.filter(F.col("split") == "train"))
    return MD.feature_importance(model, feats)


@register("model_roundtrip", None)
def model_roundtrip_q(spark, sf):
    """Boosted trees and their calibration as one pipeline model, saved to
    the shared checkpoint folder, loaded back and applied to the test split."""
    import uuid
    from pyspark.ml import PipelineModel
    from ..session import checkpoint_dir
    d, feats = _gbt_data(spark, sf)
    train = d.filter(F.col("split") == "train")
    path = f"{checkpoint_dir(spark).rstrip('/')}/models-{uuid.uuid4().hex}"
    model = MD.calibrated(MD.gbt_pipeline(feats, max_iter=10, max_depth=4).fit(train), train, approximation=4)
    model.write().overwrite().save(path)
    scored = MD.score(PipelineModel.load(path), d.filter(F.col("split") == "test"), "model_score")
    return scored.select("o_orderkey", "model_score", "calibrated")


# --- calibration by ranges, decision table --------------------------------------------

_ISO_DIGITS = 2

# isotonic value of each pooled score: the largest, over starts at or before it, of the
# smallest mean, over ends at or after it
_ISO_SQL = f"""
ip AS (SELECT round_even(score * {10 ** _ISO_DIGITS}.0, 0) / {10 ** _ISO_DIGITS}.0 AS x, CAST(sum(target) AS DOUBLE) AS s, count(*) AS n
       FROM scored GROUP BY 1),
ic AS (SELECT x, row_number() OVER w AS i, sum(s) OVER w AS cs, sum(n) OVER w AS cn, s, n FROM ip WINDOW w AS (ORDER BY x)),
im AS (SELECT a.i AS a, b.i AS b, (b.cs - a.cs + a.s) / (b.cn - a.cn + a.n) AS m FROM ic a JOIN ic b ON a.i <= b.i),
il AS (SELECT a, b, min(m) OVER (PARTITION BY a ORDER BY b ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS m FROM im),
iso AS (SELECT ic.i, ic.x, max(il.m) AS v FROM ic JOIN il ON il.a <= ic.i AND il.b = ic.i GROUP BY ALL)"""


def _iso_grid(spark, sf):
    s = _scored(spark, sf)
    return s, CB.Isotonic(0.0, 1.0, True, approximation=_ISO_DIGITS).fit(s, "score", "target")


@register("isotonic_by_ranges", oracle(_SC, _ISO_SQL + """
SELECT x, v AS value FROM iso"""))
def isotonic_by_ranges_q(spark, sf):
    """The fit of tie-pooled scores, in batches and small ranges, at each pooled score."""
    s = _scored(spark, sf)
    iso = CB.Isotonic(0.0, 1.0, True, approximation=_ISO_DIGITS)
    for k in range(3):
        iso.accumulate(s.where(F.pmod(F.xxhash64("sessionuuid"), F.lit(3)) == k))
    points = iso.state.select("x", (F.col("s") / F.col("n")).alias("y"), F.col("n").cast("double").alias("w"))
    iso.blocks = ISO.fit_blocks(points, per_task=9)
    return iso.transform(iso.state.select("x"), "x", "value")


_VARIANTS = {"score": "decision", "calibrated": "calibrated_decision", "second": "second_decision", "second_calibrated": "second_calibrated_decision"}


def _second_sql() -> str:
    return "(CAST((CAST(substr(sessionuuid, 2) AS BIGINT) * 31) % 101 AS DOUBLE) / 101 + 3 * score) / 4"


def _curve_sql(score: str) -> str:
    """The fitted curve at a score: linear between the pooled scores around it."""
    return (f"(SELECT CASE WHEN hi.x IS NULL OR lo.x IS NULL OR hi.x = lo.x THEN coalesce(lo.v, hi.v) "
            f"ELSE lo.v + (hi.v - lo.v) * ({score} - lo.x) / (hi.x - lo.x) END FROM "
            f"(SELECT max(x) AS x, max_by(v, x) AS v FROM iso WHERE x <= {score}) lo, (SELECT min(x) AS x, min_by(v, x) AS v FROM iso WHERE x > {score}) hi)")


@register("decision_table", oracle(_SC, _ISO_SQL + f""",
grid AS (SELECT s.sessionuuid, s.target, s.score, {_second_sql()} AS second FROM scored s),
val AS (SELECT *, {_curve_sql('p.y')} AS v FROM (SELECT DISTINCT y FROM (SELECT score AS y FROM grid UNION ALL SELECT second FROM grid) q) p),
dt AS (SELECT g.*, a.v AS calibrated, b.v AS second_calibrated FROM grid g JOIN val a ON a.y = g.score JOIN val b ON b.y = g.second),
lf AS (""" + " UNION ALL ".join(f"SELECT '{v}' AS variant, {v} AS y, target FROM dt" for v in _VARIANTS) + f"""),
lc AS (SELECT variant, y, sum(target) AS pos, count(*) AS n FROM lf GROUP BY ALL),
lr AS (SELECT variant, y, sum(pos) OVER w AS tp, sum(n) OVER w AS k, sum(pos) OVER (PARTITION BY variant) AS p
       FROM lc WINDOW w AS (PARTITION BY variant ORDER BY y DESC)),
lb AS (SELECT variant, max(tp) AS tp FROM lr WHERE tp / CAST(k AS DOUBLE) >= {TARGET_PRECISION} GROUP BY variant),
th AS (SELECT variant, min(y) AS t FROM lr JOIN lb USING (variant, tp) GROUP BY variant)
SELECT sessionuuid, target, score, round(calibrated, 9) AS calibrated, second, round(second_calibrated, 9) AS second_calibrated,
""" + ", ".join(f"CAST({v} > (SELECT t FROM th WHERE variant = '{v}') AS INTEGER) AS {d}" for v, d in _VARIANTS.items()) + """ FROM dt"""))
def decision_table_q(spark, sf):
    """Raw and calibrated scores of two models, each with the decision at its own
    threshold for the wanted precision."""
    s, iso = _iso_grid(spark, sf)
    second = (((F.substring("sessionuuid", 2, 19).cast("long") * 31) % 101).cast("double") / 101 + 3 * F.col("score")) / 4
    rows = iso.transform(s.select("sessionuuid", "target", "score", second.alias("second")), "score", "calibrated")
    rows = iso.transform(rows, "second", "second_calibrated")
    out = MD.decision_table(rows, _VARIANTS, "target", TARGET_PRECISION)
    return out.withColumns({c: F.round(c, 9) for c in ("calibrated", "second_calibrated")})


# --- attribution ----------------------------------------------------------------------

_INPUTS = ("price", "priority", "evening", "load")


def _black_box(df):
    """A score with interactions, standing for any model that adds a column."""
    z = (F.col("price") * F.col("priority") - 2 * F.col("evening") * F.col("load") + F.col("load") * F.col("load") * F.col("price")) / 4
    return df.withColumn("score", 1 / (1 + F.exp(-z)))


_BOX = "1 / (1 + exp(-(({p}) * ({q}) - 2 * ({e}) * ({l}) + ({l}) * ({l}) * ({p})) / 4))"
_ATTR_ROWS = """SELECT o_orderkey AS id, o_totalprice / 1e5 AS price, CAST(left(o_orderpriority, 1) AS DOUBLE) AS priority,
  CAST(CAST(o_orderkey % 24 > 16 AS INTEGER) AS DOUBLE) AS evening, CAST(o_custkey % 7 AS DOUBLE) / 7 AS load FROM orders"""
_PICK = {"p": "price", "q": "priority", "e": "evening", "l": "load"}
_MIXED = _BOX.format(**{k: f"CASE WHEN (c.m >> {i}) & 1 = 1 THEN r.{v} ELSE b.{v} END" for i, (k, v) in enumerate(_PICK.items())})


@register("shapley_attribution", oracle((), f"""
ar AS ({_ATTR_ROWS}),
bg AS (SELECT * FROM ar WHERE id IN (SELECT id FROM ar ORDER BY id LIMIT 10)),
c AS (SELECT m, CAST(bit_count(m) AS INTEGER) AS k FROM range(16) t(m)),
v AS (SELECT r.id, c.m, c.k, avg({_MIXED}) AS v FROM ar r CROSS JOIN c CROSS JOIN bg b GROUP BY ALL),
f AS (SELECT i, name FROM (VALUES (0, 'price'), (1, 'priority'), (2, 'evening'), (3, 'load')) t(i, name)),
w AS (SELECT k, w FROM (VALUES (0, 0.25), (1, 1 / 12.0), (2, 1 / 12.0), (3, 0.25)) t(k, w))
SELECT a.id, f.name AS input, round(sum(w.w * (b.v - a.v)), 9) + 0.0 AS attribution
FROM v a JOIN w ON w.k = a.k JOIN f ON (a.m >> f.i) & 1 = 0 JOIN v b ON b.id = a.id AND b.m = a.m + (1 << f.i) GROUP BY a.id, f.name"""))
def shapley_attribution_q(spark, sf):
    """Attribution of a black-box score, all coalitions of four inputs."""
    o = Tables(spark, sf)["orders"]
    rows = o.select(F.col("o_orderkey").alias("id"), (F.col("o_totalprice") / 1e5).alias("price"),
                    F.substring("o_orderpriority", 1, 1).cast("double").alias("priority"),
                    (F.col("o_orderkey") % 24 > 16).cast("int").cast("double").alias("evening"), ((F.col("o_custkey") % 7).cast("double") / 7).alias("load"))
    found = SH.shapley_values(rows, ["id"], list(_INPUTS), rows.orderBy("id").limit(10), _black_box, samples=100)
    return found.select("id", "input", (F.round("attribution", 9) + 0.0).alias("attribution"))


# --- training path -------------------------------------------------------------------

_TRAIN_DAYS, _VAL_DAYS = 20, 4


@register("propensity_training", oracle(TRAINING_VIEWS, training_body(BATCH) + f""",
days AS (SELECT valid_date, row_number() OVER (ORDER BY valid_date) AS i FROM (SELECT DISTINCT valid_date FROM trained)),
sp AS (SELECT t.*, CASE WHEN i <= {_TRAIN_DAYS} THEN 'train' WHEN i <= {_TRAIN_DAYS + _VAL_DAYS} THEN 'val' ELSE 'test' END AS split
       FROM trained t JOIN days USING (valid_date))
SELECT split, count(*) AS n_rows, count(*) AS n_scored, count(*) AS n_calibrated, CAST(sum(rh) AS BIGINT) AS positives,
  sum(CASE WHEN split <> 'train' OR rh = 0 THEN 1.0 WHEN is_trip_ended = 0 THEN 0.5 WHEN is_freq = 0 THEN 0.75 ELSE 1.0 END) AS weight
FROM sp GROUP BY split"""))
def propensity_training_q(spark, sf):
    """Trained on the training table's rows and all of them scored."""
    model, rows = MD.train_propensity(training_rows_q(spark, sf), _TRAIN_DAYS, _VAL_DAYS)
    s = MD.score(model, rows)
    valid = lambda c: F.count(F.when(F.col(c).between(0, 1), 1))
    return s.groupBy("split").agg(F.count("*").alias("n_rows"), valid("score").alias("n_scored"), valid("calibrated").alias("n_calibrated"),
                                  F.sum("target").cast("long").alias("positives"), F.sum("sample_weight").alias("weight"))
