"""The training table: versions of a flat table, partitioned by valid_date, each
with its schema and row count written beside it after the data. A reader sees
finished versions only and checks the schema it finds against the one written."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

VERSIONS = "_versions"
_LOG = "version long, schema string, n_rows long, partition string"


class SchemaMismatch(ValueError):
    """The data of a version does not have the schema it was written with."""


def _log(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.schema(_LOG).parquet(f"{path.rstrip('/')}/{VERSIONS}")
    except Exception as e:  # no version is finished yet
        if "PATH_NOT_FOUND" in str(e):
            return None
        raise


def versions(spark: SparkSession, path: str) -> list[int]:
    log = _log(spark, path)
    return [] if log is None else sorted(r.version for r in log.select("version").distinct().collect())


def write_training(df: DataFrame, path: str, partition: str = "valid_date") -> int:
    """Writes ``df`` as a new version and returns its number. The version counts
    once its log row is written, which happens last: a lost driver leaves no
    half-written version that a reader could see, and the next write takes the
    same number again."""
    spark, base = df.sparkSession, path.rstrip("/")
    if partition not in df.columns:
        raise ValueError(f"no column {partition}")
    done = versions(spark, base)
    number = (done[-1] if done else 0) + 1
    target = f"{base}/v={number:06d}"
    df.hint("rebalance", F.col(partition)).write.mode("overwrite").option(
        "partitionOverwriteMode", "static").partitionBy(partition).parquet(target)
    rows = spark.read.schema(df.schema).parquet(target).count()
    spark.createDataFrame([(number, df.schema.json(), rows, partition)], _LOG).coalesce(1).write.mode("append").parquet(f"{base}/{VERSIONS}")
    return number


def _differences(found: T.StructType, wanted: T.StructType, partition: str) -> list[str]:
    """Columns that are missing, added or of another type. The partition column's
    type is not stored with the files."""
    a, b = ({f.name: f.dataType.simpleString() for f in s if f.name != partition} for s in (found, wanted))
    return [f"{n}: {a.get(n, 'missing')} instead of {b.get(n, 'none')}" for n in sorted(a.keys() | b.keys()) if a.get(n) != b.get(n)]


def read_training(spark: SparkSession, path: str, version: int | None = None,
                  columns: list[str] | None = None, expect: T.StructType | None = None) -> DataFrame:
    """A version (the latest finished one unless given), columns in the order they
    were written. ``expect``: a schema that the caller relies on."""
    base = path.rstrip("/")
    log = _log(spark, base)
    rows = [] if log is None else log.where(F.lit(version is None) | (F.col("version") == F.lit(version or 0))).orderBy(F.desc("version")).limit(1).collect()
    if not rows:
        raise ValueError(f"no finished version {'' if version is None else version} in {base}")
    wanted = T.StructType.fromJson(json.loads(rows[0].schema))
    target = f"{base}/v={rows[0].version:06d}"
    if rows[0].n_rows:
        bad = _differences(spark.read.parquet(target).schema, wanted, rows[0].partition)
        if bad:
            raise SchemaMismatch(f"{target}: {'; '.join(bad)}")
        df = spark.read.schema(wanted).parquet(target).select(*wanted.fieldNames())
    else:
        df = spark.createDataFrame([], wanted)
    if expect is not None:
        bad = _differences(df.schema, expect, "")
        if bad:
            raise SchemaMismatch(f"{target}: {'; '.join(bad)}")
    return df.select(*columns) if columns else df
