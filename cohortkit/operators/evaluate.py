"""Score evaluation as distributed aggregations: threshold sweep, PR / ROC
curves, optimal threshold, log loss, confusion matrix, classification
report, calibration curve, expected calibration error, VIF Gram matrix.

Curves need cumulative counts in score order; they are computed over the
distinct scores with ``descending_cumsum`` (quantile buckets), never with a
single-partition window over the rows."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .windows import descending_cumsum

EPS = float(np.finfo(np.float64).eps)
DEFAULT_THRESHOLDS = (0.4, 0.5, 0.6, 0.7, 0.8, 0.9)


def threshold_sweep(scored: DataFrame, thresholds=DEFAULT_THRESHOLDS, score="score",
                    rh="rh", is_freq="is_freq") -> DataFrame:
    """Per threshold t: share of sessions / booked sessions with score > t and
    the relevance ratios. One scan with conditional counts per threshold (the
    threshold list is a small parameter), no join."""
    aggs = [F.count(F.lit(1)).alias("n"),
            F.sum((F.col(rh) == 1).cast("long")).alias("n_rh"),
            F.sum(((F.col(rh) == 1) & (F.col(is_freq) == 1)).cast("long")).alias("n_rel")]
    for i, t in enumerate(thresholds):
        hit = F.col(score) > F.lit(float(t))
        aggs += [F.sum(hit.cast("long")).alias(f"s{i}"),
                 F.sum((hit & (F.col(rh) == 1)).cast("long")).alias(f"r{i}"),
                 F.sum((hit & (F.col(is_freq) == 1)).cast("long")).alias(f"f{i}")]
    one = scored.agg(*aggs)
    rows = F.explode(F.array(*[
        F.struct(F.lit(float(t)).alias("threshold"), F.col(f"s{i}").alias("sessions"),
                 F.col(f"r{i}").alias("rh_sessions"), F.col(f"f{i}").alias("relevant_sessions"))
        for i, t in enumerate(thresholds)])).alias("r")
    x = one.select("n", "n_rh", "n_rel", rows).select("n", "n_rh", "n_rel", "r.*")
    div = lambda a, b: F.try_divide(F.col(a).cast("double"), F.col(b).cast("double"))
    return x.select("threshold",
                    div("sessions", "n").alias("sa_coverage"),
                    div("rh_sessions", "n_rh").alias("rh_coverage"),
                    div("rh_sessions", "sessions").alias("relevance_rh_total"),
                    div("relevant_sessions", "sessions").alias("relevance_freq_only"),
                    div("relevant_sessions", "n_rel").alias("pct_freq_detected"))


def score_counts(scored: DataFrame, score="score", label="target") -> DataFrame:
    """(score, pos, neg): positives and negatives per distinct score."""
    return scored.groupBy(F.col(score).alias("score")).agg(
        F.sum((F.col(label) == 1).cast("long")).alias("pos"),
        F.sum((F.col(label) != 1).cast("long")).alias("neg"))


def pr_curve(scored: DataFrame, score="score", label="target", n_buckets: int = 64) -> DataFrame:
    """Precision-recall curve over all distinct scores (threshold = score,
    decision ``score >= threshold``): tp, fp, precision, recall."""
    c = descending_cumsum(score_counts(scored, score, label), "score", ["pos", "neg"], n_buckets)
    c = c.withColumn("_P", F.col("total_pos"))
    tp, fp = F.col("cum_pos"), F.col("cum_neg")
    prec = F.when(tp + fp > 0, tp / (tp + fp)).otherwise(F.lit(0.0))
    rec = F.when(F.col("_P") > 0, tp / F.col("_P")).otherwise(F.lit(1.0))
    return c.select(F.col("score").alias("threshold"), tp.alias("tp"), fp.alias("fp"),
                    prec.alias("precision"), rec.alias("recall"))


def optimal_threshold(pr: DataFrame, target_precision: float = 0.9) -> DataFrame:
    """(threshold, recall): the largest recall reached with precision >= target,
    reported at the LOWEST threshold having that recall (so the precision there
    may be below target). NULLs when no real threshold reaches the target."""
    # one pass: by recall, its lowest threshold and whether it ever has the precision;
    # recall is constant over a contiguous threshold range
    by_recall = pr.groupBy("recall").agg(F.min("threshold").alias("threshold"), F.max("precision").alias("p"))
    top = F.max(F.when(F.col("p") >= target_precision, F.struct("recall", "threshold")))
    return by_recall.agg(top.alias("t")).select(
        F.col("t.threshold").cast("double").alias("threshold"), F.col("t.recall").cast("double").alias("recall"))


def roc_curve(scored: DataFrame, score="score", label="target", n_buckets: int = 64) -> DataFrame:
    """ROC curve over all distinct scores (decision ``score >= threshold``): threshold, fpr, tpr."""
    c = descending_cumsum(score_counts(scored, score, label), "score", ["pos", "neg"], n_buckets)
    rate = lambda x, n: F.when(F.col(n) > 0, F.col(x) / F.col(n)).otherwise(F.lit(0.0))
    return c.select(F.col("score").alias("threshold"), rate("cum_neg", "total_neg").alias("fpr"),
                    rate("cum_pos", "total_pos").alias("tpr"))


def roc_auc(scored: DataFrame, score="score", label="target", n_buckets: int = 64) -> DataFrame:
    """Area under the ROC curve with tied scores as trapezoids:
    sum over score groups of neg * (positives strictly above + pos / 2) / (P * N)."""
    c = descending_cumsum(score_counts(scored, score, label), "score", ["pos"], n_buckets)
    part = F.col("neg").cast("double") * ((F.col("cum_pos") - F.col("pos")) + F.col("pos") / 2.0)
    return c.agg((F.sum(part) / (F.sum("pos").cast("double") * F.sum("neg").cast("double")))
                 .alias("roc_auc"))


def log_loss(scored: DataFrame, score="score", label="target", eps: float = EPS) -> DataFrame:
    p = F.least(F.greatest(F.col(score).cast("double"), F.lit(eps)), F.lit(1 - eps))
    y = F.col(label).cast("double")
    return scored.agg(F.avg(-(y * F.log(p) + (1 - y) * F.log(1 - p))).alias("log_loss"))


def confusion_matrix(scored: DataFrame, threshold: float, score="score", label="target") -> DataFrame:
    return (scored.groupBy(F.col(label).cast("int").alias("actual"),
                           (F.col(score) > threshold).cast("int").alias("predicted"))
                  .agg(F.count(F.lit(1)).alias("n")))


def classification_report(scored: DataFrame, threshold: float, score="score",
                          label="target") -> DataFrame:
    """Per-class precision / recall / F1 / support, macro and weighted
    averages and accuracy (zero division -> 0), from one aggregation."""
    y, p = F.col(label).cast("int"), (F.col(score) > threshold).cast("int")
    one = scored.agg(*[F.sum(((y == a) & (p == b)).cast("long")).alias(f"c{a}{b}")
                       for a in (0, 1) for b in (0, 1)])
    d = lambda a, b: F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))  # noqa
    c00, c01, c10, c11 = (F.col(n) for n in ("c00", "c01", "c10", "c11"))
    p0, r0, s0 = d(c00, c00 + c10), d(c00, c00 + c01), c00 + c01
    p1, r1, s1 = d(c11, c11 + c01), d(c11, c11 + c10), c10 + c11
    f0, f1 = d(2 * p0 * r0, p0 + r0), d(2 * p1 * r1, p1 + r1)
    n = (s0 + s1).cast("double")
    acc = d(c00 + c11, s0 + s1)

    def row(name, pr, rc, f, sup):
        return F.struct(F.lit(name).alias("label"), pr.alias("precision"), rc.alias("recall"),
                        f.alias("f1"), sup.cast("double").alias("support"))
    rows = F.array(row("0", p0, r0, f0, s0), row("1", p1, r1, f1, s1),
                   row("accuracy", acc, acc, acc, s0 + s1),
                   row("macro avg", (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, s0 + s1),
                   row("weighted avg", (p0 * s0 + p1 * s1) / n, (r0 * s0 + r1 * s1) / n,
                       (f0 * s0 + f1 * s1) / n, s0 + s1))
    return one.select(F.explode(rows).alias("r")).select("r.*")


def calibration_curve(scored: DataFrame, n_bins: int = 5, score="score", label="target") -> DataFrame:
    """Uniform bins; a score equal to an inner edge falls in the lower bin.
    (bin, prob_true, prob_pred, n) for non-empty bins."""
    edges = [float(e) for e in np.linspace(0.0, 1.0, n_bins + 1)[1:-1]]
    b = F.size(F.filter(F.array(*[F.lit(e) for e in edges]), lambda e: e < F.col(score)))
    return (scored.groupBy(b.alias("bin"))
                  .agg(F.avg(F.col(label).cast("double")).alias("prob_true"),
                       F.avg(F.col(score).cast("double")).alias("prob_pred"),
                       F.count(F.lit(1)).alias("n")))


def ece_bins(scored: DataFrame, m: int = 500, score="score", label="target") -> DataFrame:
    """Bin index per row for M uniform bins, open left / closed right, with the
    edges of ``linspace(0, 1, M+1)`` (i * (1/M), last edge exactly 1). A score
    of 0 (or outside (0, 1]) gets no bin."""
    step = 1.0 / m
    s = F.col(score).cast("double")
    lo = lambda b: (b - 1).cast("double") * F.lit(step)
    hi = lambda b: F.when(b == m, F.lit(1.0)).otherwise(b.cast("double") * F.lit(step))  # noqa
    b0 = F.least(F.greatest(F.ceil(s * m), F.lit(0)), F.lit(m)).cast("int")
    b1 = (F.when((b0 >= 1) & (s <= lo(b0)), b0 - 1)
           .when((b0 < m) & (s > hi(b0)), b0 + 1).otherwise(b0))
    ok = (b1 >= 1) & (s > lo(b1)) & (s <= hi(b1))
    return scored.withColumn("_bin", F.when(ok, b1))


def expected_calibration_error(scored: DataFrame, m: int = 500, score="score",
                               label="target") -> DataFrame:
    """Sum over bins of |mean score - accuracy| * (bin rows / all rows), where
    accuracy is ``(score > 0.5) == label``."""
    b = ece_bins(scored, m, score, label)
    correct = ((F.col(score) > 0.5).cast("int") == F.col(label).cast("int")).cast("double")
    per_bin = (b.groupBy("_bin").agg(F.count(F.lit(1)).alias("n"),
                                     F.avg(F.col(score).cast("double")).alias("conf"),
                                     F.avg(correct).alias("acc")))
    total = F.sum("n")
    contrib = F.sum(F.when(F.col("_bin").isNotNull(), F.abs(F.col("conf") - F.col("acc")) * F.col("n")))
    return per_bin.agg((contrib / total).alias("ece"))


def gram_matrix(df: DataFrame, cols: list[str]) -> DataFrame:
    """(i, j, g) with g = sum(x_i * x_j): one aggregation of d*d sums."""
    sums = [F.sum(F.col(a).cast("double") * F.col(b).cast("double")).alias(f"g_{i}_{j}")
            for i, a in enumerate(cols) for j, b in enumerate(cols)]
    one = df.agg(*sums)
    cells = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), F.col(f"g_{i}_{j}").alias("g"))
                      for i in range(len(cols)) for j in range(len(cols))])
    return one.select(F.explode(cells).alias("c")).select("c.*")


def variance_inflation(df: DataFrame, cols: list[str]) -> DataFrame:
    """VIF of each column regressed on the others without an intercept:
    VIF_i = G_ii * (G^-1)_ii. Spark computes the d x d Gram matrix; only that
    small matrix reaches the driver."""
    g = gram_matrix(df, cols).collect()
    d = len(cols)
    G = np.zeros((d, d))
    for r in g:
        G[r["i"], r["j"]] = r["g"]
    inv = np.linalg.pinv(G)
    vif = [float(G[i, i] * inv[i, i]) for i in range(d)]
    spark = df.sparkSession
    return spark.createDataFrame([(c, v) for c, v in zip(cols, vif)], "feature string, vif double")
