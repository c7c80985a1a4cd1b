"""Sinks and partitioned reads of the daily tables (sessions, features,
training rows): one dataset partitioned by ``valid_date`` instead of one file
per day and kind."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def write_daily(df: DataFrame, path: str, partition_col: str = "valid_date") -> None:
    """Idempotent daily sink: dynamic partition overwrite, so re-running a
    day replaces exactly that day's partition. Rows are rebalanced by the
    partition column: tasks write few files, and a large day is split."""
    (df.hint("rebalance", F.col(partition_col))
       .write.mode("overwrite")
       .option("partitionOverwriteMode", "dynamic")
       .partitionBy(partition_col)
       .parquet(path))


def read_daily(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("basePath", path).parquet(path)


def partition_days(df: DataFrame, partition_col: str = "valid_date") -> DataFrame:
    return df.select(F.col(partition_col).cast("string").alias(partition_col)).distinct()


def paired_partitions_check(a: DataFrame, b: DataFrame, partition_col: str = "valid_date") -> DataFrame:
    """Days present in only one of two daily datasets (both directions):
    (valid_date, side). Empty when the pairs match, which is what the
    per-file count and name assertions of a day-by-day reader check."""
    da, db = partition_days(a, partition_col), partition_days(b, partition_col)
    only_a = da.join(db, partition_col, "left_anti").withColumn("side", F.lit("left_only"))
    only_b = db.join(da, partition_col, "left_anti").withColumn("side", F.lit("right_only"))
    return only_a.unionByName(only_b)


def partition_slice(df: DataFrame, min_index: int | None, max_index: int | None,
                    partition_col: str = "valid_date") -> DataFrame:
    """Rows of the days with ordinal in [min_index, max_index) of the sorted
    distinct days (Python slice semantics, negative indices allowed). Only
    the distinct days are ranked; the day list joins back (one row per day)."""
    days = partition_days(df, partition_col)
    n = F.count(F.lit(1)).over(Window.partitionBy())
    ranked = days.select(partition_col,
                         (F.row_number().over(Window.orderBy(partition_col)) - 1).alias("_i"),
                         n.alias("_n"))

    def norm(ix, default):
        if ix is None:
            return F.lit(default) if isinstance(default, int) else default
        return F.lit(ix) if ix >= 0 else F.greatest(F.col("_n") + F.lit(ix), F.lit(0))

    lo = norm(min_index, 0)
    hi = norm(max_index, F.col("_n"))
    keep = (ranked.filter((F.col("_i") >= lo) & (F.col("_i") < hi))
                  .select(F.col(partition_col).alias("_day")))
    return df.join(F.broadcast(keep), F.col(partition_col).cast("string") == F.col("_day"),
                   "left_semi")
