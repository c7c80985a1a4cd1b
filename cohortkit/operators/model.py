"""Targets, sample weights, time split, decisions, samples and the boosted-
tree classifier pipeline (MLlib)."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

# training-table columns that are not model inputs
NON_FEATURES = ("valid_date", "ts", "sessionuuid", "customer_id", "booking_id", "is_trip_ended",
                "rh", "is_freq", "service", "is_work", "has_saved", "weekday",
                "norm_hour_denoised", "target", "sample_weight", "split", "latitude", "longitude")


def add_target(df: DataFrame, kind: str = "rh_vs_rest") -> DataFrame:
    """multiclass: is_freq (NULL -> 0) + rh; rh_vs_rest: rh; pattern_vs_rest: is_freq."""
    if kind == "multiclass":
        t = F.coalesce(F.col("is_freq"), F.lit(0)) + F.col("rh")
    elif kind == "rh_vs_rest":
        t = F.col("rh")
    elif kind == "pattern_vs_rest":
        t = F.col("is_freq")
    else:
        raise ValueError(kind)
    return df.withColumn("target", t.cast("int"))


def add_sample_weight(df: DataFrame) -> DataFrame:
    """1.0; 0.75 for booked sessions outside frequent places; 0.5 for booked
    sessions whose trip did not end (the later rule wins)."""
    rh = F.col("rh") == 1
    w = (F.when(rh & (F.col("is_trip_ended") == 0), F.lit(0.5))
          .when(rh & (F.col("is_freq") == 0), F.lit(0.75))
          .otherwise(F.lit(1.0)))
    return df.withColumn("sample_weight", w)


def add_training_weight(df: DataFrame, split: str = "split") -> DataFrame:
    """The sample weights of training rows; validation and test rows weigh 1.0."""
    ruled = add_sample_weight(df)
    return ruled.withColumn("sample_weight", F.when(F.col(split) == "train", F.col("sample_weight")).otherwise(F.lit(1.0)))


def with_categories(df: DataFrame, cols) -> DataFrame:
    """Categorical inputs as text; NULL becomes a category of its own."""
    return df.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols})


def time_split(df: DataFrame, n_train: int = 60, n_val: int = 15, date_col: str = "valid_date") -> DataFrame:
    """train / val / test by the ordinal of the distinct dates. Only the
    distinct dates are ranked (one row per day), then broadcast back."""
    days = df.select(date_col).distinct()
    ranked = days.select(date_col, F.row_number().over(Window.orderBy(date_col)).alias("_i"))
    split = (F.when(F.col("_i") <= n_train, "train")
              .when(F.col("_i") <= n_train + n_val, "val").otherwise("test"))
    # one row per distinct day: bounded by the number of days
    return df.join(F.broadcast(ranked.select(date_col, split.alias("split"))), date_col)


def decisions(df: DataFrame, thresholds: dict[str, float], score: str = "score") -> DataFrame:
    """Decision column per named threshold: score > t -> 1."""
    for name, t in thresholds.items():
        df = df.withColumn(name, (F.col(score) > F.lit(float(t))).cast("int"))
    return df


def score_thresholds(df: DataFrame, scores: list[str], label: str, target_precision: float) -> DataFrame:
    """(variant, threshold, recall) of each score column, all in one pass: the lowest
    threshold of the highest recall at ``target_precision``. Rows are counted per
    distinct score; running counts go by slices of the score, so no task ranks a
    whole variant."""
    long = df.select(F.col(label).cast("long").alias("_y"), F.explode(F.array(*[
        F.struct(F.lit(c).alias("variant"), F.col(c).cast("double").alias("threshold")) for c in scores])).alias("_s"))
    c = long.groupBy("_s.variant", "_s.threshold").agg(F.sum("_y").alias("_pos"), F.count("*").alias("_n"))
    c = c.withColumn("_slice", F.floor(F.col("threshold") * 4096))
    per = c.groupBy("variant", "_slice").agg(F.sum("_pos").alias("_p"), F.sum("_n").alias("_c"))
    above = Window.partitionBy("variant").orderBy(F.desc("_slice")).rowsBetween(Window.unboundedPreceding, -1)
    per = per.select("variant", "_slice", F.coalesce(F.sum("_p").over(above), F.lit(0)).alias("_tp"), F.coalesce(F.sum("_c").over(above), F.lit(0)).alias("_k"),
                     F.sum("_p").over(Window.partitionBy("variant")).alias("_all"))
    inside = Window.partitionBy("variant", "_slice").orderBy(F.desc("threshold")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    r = c.join(per, ["variant", "_slice"]).select("variant", "threshold", (F.col("_tp") + F.sum("_pos").over(inside)).alias("tp"),
                                                  (F.col("_k") + F.sum("_n").over(inside)).alias("k"), "_all")
    # of the rows that are precise enough the most true positives, then the lowest score with as many
    most = r.groupBy("variant", "tp").agg(F.min("threshold").alias("t"), F.max((F.col("tp") / F.col("k") >= target_precision).cast("int")).alias("ok"), F.max("_all").alias("_all"))
    best = most.where("ok = 1").groupBy("variant").agg(F.max(F.struct("tp", "t", "_all")).alias("b"))
    return best.select("variant", F.col("b.t").alias("threshold"), F.when(F.col("b._all") > 0, F.col("b.tp") / F.col("b._all")).otherwise(1.0).alias("recall"))


def decision_table(df: DataFrame, variants: dict[str, str], label: str, target_precision: float) -> DataFrame:
    """``df`` with a decision column for each score column of ``variants`` (score ->
    decision): 1 above the score's own threshold for the wanted precision, NULL
    where no threshold reaches it."""
    found = {r.variant: r.threshold for r in score_thresholds(df, list(variants), label, target_precision).collect()}
    for score_col, out in variants.items():
        t = found.get(score_col)
        df = df.withColumn(out, F.lit(None).cast("int") if t is None else (F.col(score_col) > F.lit(t)).cast("int"))
    return df


def exact_sample(df: DataFrame, n: int, key: str, seed: int = 42) -> DataFrame:
    """Exactly n rows chosen by a seeded hash of ``key`` (top-n by hash:
    per-partition top-n, then one small merge)."""
    return df.orderBy(F.xxhash64(F.col(key), F.lit(seed)), F.col(key)).limit(n)


def stratified_sample(df: DataFrame, frac: float, stratum: str, key: str, seed: int = 42,
                      n_buckets: int | None = None) -> DataFrame:
    """Exactly ceil(frac * n_s) rows of every stratum s, the ones with the
    smallest seeded hash. Two passes keep every task small even when one
    stratum holds most rows: a (stratum, hash bucket) histogram locates the
    cut bucket per stratum, and only rows of that bucket are ranked. Without
    ``n_buckets`` there is one for about 1,000 rows, 4,096 at least."""
    if n_buckets is None:
        n_buckets = max(4096, df.count() // 1000)
    h = F.xxhash64(F.col(key), F.lit(seed))
    span = 2.0 ** 64 / n_buckets
    b = F.floor((h.cast("double") + F.lit(2.0 ** 63)) / F.lit(span)).cast("int")
    x = df.withColumn("_h", h).withColumn("_b", F.least(b, F.lit(n_buckets - 1)))
    hist = x.groupBy(stratum, "_b").agg(F.count(F.lit(1)).alias("_c"))
    w = Window.partitionBy(stratum).orderBy("_b")
    hist = hist.select(stratum, "_b", "_c",
                       F.coalesce(F.sum("_c").over(w.rowsBetween(Window.unboundedPreceding, -1)),
                                  F.lit(0)).alias("_before"),
                       F.sum("_c").over(Window.partitionBy(stratum)).alias("_n"))
    hist = hist.withColumn("_k", F.ceil(F.col("_n") * F.lit(frac)))
    cut = hist.filter((F.col("_before") < F.col("_k")) & (F.col("_before") + F.col("_c") >= F.col("_k")))
    cut = cut.select(stratum, F.col("_b").alias("_cb"), (F.col("_k") - F.col("_before")).alias("_r"))
    j = x.join(cut, stratum)      # one row per stratum; broadcast by Spark if small
    below = j.filter(F.col("_b") < F.col("_cb"))
    edge = j.filter(F.col("_b") == F.col("_cb"))
    edge = edge.withColumn("_rn", F.row_number().over(
        Window.partitionBy(stratum, "_b").orderBy("_h", key))).filter(F.col("_rn") <= F.col("_r"))
    cols = df.columns
    return below.select(*cols).unionByName(edge.select(*cols))


def feature_columns(df: DataFrame, exclude=NON_FEATURES) -> list[str]:
    """Numeric model inputs of a training table."""
    return [c for c, t in df.dtypes if c not in exclude and t in ("int", "bigint", "double", "float")]


CATEGORICAL = ("is_home", "is_weekend")


def gbt_pipeline(features: list[str], max_iter: int = 300, max_depth: int = 5, seed: int = 42,
                 label: str = "target", weight: str | None = "sample_weight",
                 validation_col: str | None = None, categorical: tuple | list = ()) -> Pipeline:
    """VectorAssembler + GBTClassifier (row subsampling 0.9, sample weights,
    optional validation-indicator early stopping). ``categorical`` text columns are
    indexed; the index's column metadata marks them as nominal, so that trees
    split them by sets of categories. Categories unseen in training are one more."""
    gbt = GBTClassifier(labelCol=label, featuresCol="_features", maxIter=max_iter,
                        maxDepth=max_depth, subsamplingRate=0.9, seed=seed)
    if weight:
        gbt = gbt.setWeightCol(weight)
    if validation_col:
        gbt = gbt.setValidationIndicatorCol(validation_col)
    indexed = [f"_index_{c}" for c in categorical]
    index = [StringIndexer(inputCols=list(categorical), outputCols=indexed, handleInvalid="keep",
                           stringOrderType="alphabetAsc")] if categorical else []
    return Pipeline(stages=[*index, VectorAssembler(inputCols=[*features, *indexed], outputCol="_features",
                                                    handleInvalid="keep"), gbt])


def train_propensity(rows: DataFrame, n_train: int = 60, n_val: int = 15, target: str = "rh_vs_rest",
                     max_iter: int = 200, max_depth: int = 6, approximation: int = 4) -> tuple[PipelineModel, DataFrame]:
    """The training path over a training table: target, split by days, weights of
    training rows, categorical inputs, boosted trees that stop early on the
    validation days, and the calibration of their training scores in the same
    model. Returns (model, all rows with target, split and weight)."""
    d = add_training_weight(time_split(add_target(rows, target), n_train, n_val))
    d = cut_lineage(with_categories(d, CATEGORICAL).withColumn("_is_val", F.col("split") == "val"))
    inputs = [c for c in feature_columns(d) if c not in CATEGORICAL]
    used = d.where("split <> 'test'")
    has_val = bool(used.where("_is_val").take(1))
    trees = gbt_pipeline(inputs, max_iter, max_depth, categorical=CATEGORICAL, validation_col="_is_val" if has_val else None).fit(used)
    return calibrated(trees, d.where("split = 'train'"), approximation=approximation), d.drop("_is_val")


def calibrated(model: PipelineModel, df: DataFrame, label: str = "target", approximation: int = 4,
               out: str = "calibrated") -> PipelineModel:
    """``model`` with an isotonic stage behind it, fitted on its scores of ``df``:
    one object that scores, calibrates, and is saved and loaded as a whole."""
    from .calibrate import Isotonic
    iso = Isotonic(0.0, 1.0, True, approximation).fit(score(model, df, "_raw"), "_raw", label)
    return PipelineModel([*model.stages, iso.stage("probability", out)])


def score(model: PipelineModel, df: DataFrame, out: str = "score") -> DataFrame:
    """Probability of class 1 as a plain double column."""
    res = model.transform(df)
    return (res.withColumn(out, vector_to_array("probability")[1])
               .drop("_features", "rawPrediction", "probability", "prediction",
                     *[c for c in res.columns if c.startswith("_index_")]))


def feature_importance(model: PipelineModel, features: list[str]) -> DataFrame:
    imp = model.stages[-1].featureImportances.toArray().tolist()
    spark = SparkSession.builder.getOrCreate()
    return spark.createDataFrame(list(zip(features, imp)), "feature string, importance double")
