"""Multi-day point-in-time batch helpers (date spine, window fan-out)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def date_spine_from(df: DataFrame, ts_col: str, n_days: int) -> DataFrame:
    """The last ``n_days`` calendar days ending at the latest date of
    ``ts_col`` (one row per valid_date): a one-row aggregate exploded."""
    last = df.agg(F.max(F.to_date(ts_col)).alias("_last"))
    return last.select(F.explode(F.sequence(F.date_sub("_last", n_days - 1), F.col("_last")))
                       .alias("valid_date"))


def date_spine(spark, end_date: str, n_days: int) -> DataFrame:
    """``n_days`` valid dates ending at ``end_date``."""
    return spark.range(1).select(
        F.explode(F.sequence(F.date_sub(F.lit(end_date).cast("date"), n_days - 1),
                             F.lit(end_date).cast("date"))).alias("valid_date"))
