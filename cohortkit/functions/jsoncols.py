"""JSON columns: map-valued profiles as JSON text at the sinks, and JSON text
back into maps or flat columns, with Spark's own JSON functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAX_KEYS = 1000


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def map_to_json(m) -> Column:
    """JSON object of a map, keys in the map's own key order (numbers by value,
    text by code point), so equal maps give equal texts. NULL stays NULL; NULL
    values stay as null."""
    c = _c(m)
    ordered = F.map_from_entries(F.array_sort(F.map_entries(c)))
    return F.to_json(ordered, {"ignoreNullFields": "false"})


def json_to_map(c, value: str = "double", key: str = "string") -> Column:
    """Map of a JSON object. Text that is no JSON object gives NULL; JSON keys are
    text, ``key`` casts them."""
    parsed = F.from_json(_c(c), T.MapType(T.StringType(), T._parse_datatype_string(value)))
    return parsed if key == "string" else F.transform_keys(parsed, lambda k, v: k.cast(key))


def json_keys(df: DataFrame, col: str, limit: int = MAX_KEYS) -> list[str]:
    """All keys that occur in any row's JSON object, numbers by value before text by
    code point. Only the distinct keys reach the driver, and at most ``limit``:
    an object with keys of unbounded variety is a map, not a set of columns."""
    k = F.col("_k")
    keys = df.select(F.explode(F.json_object_keys(F.col(col))).alias("_k")).distinct()
    rows = keys.orderBy(k.try_cast("double").asc_nulls_last(), k).limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"{col} has more than {limit} keys; read it with json_to_map")
    return [r["_k"] for r in rows]


def json_struct_type(keys: list[str], value: str = "double") -> T.StructType:
    return T.StructType([T.StructField(k, T._parse_datatype_string(value)) for k in keys])


def parse_json_struct(df: DataFrame, col: str, value: str = "double", keys: list[str] | None = None,
                      out: str | None = None) -> DataFrame:
    """``col`` parsed into a struct with one field for each key of any row (inferred
    over all rows unless given); a key that a row lacks is NULL."""
    keys = json_keys(df, col) if keys is None else keys
    return df.withColumn(out or col, F.from_json(F.col(col), json_struct_type(keys, value)))


def unnest_json(df: DataFrame, col: str, prefix: str = "", value: str = "double",
                keys: list[str] | None = None) -> DataFrame:
    """``col`` replaced by a column ``<prefix><key>`` for each key."""
    keys = json_keys(df, col) if keys is None else keys
    new = [f"{prefix}{k}" for k in keys]
    taken = [c for c in new if c in df.columns and c != col]
    if taken:
        raise ValueError(f"columns exist already: {taken}")
    parsed = F.from_json(F.col(col), json_struct_type(keys, value))
    return (df.withColumn("__parsed", parsed)
              .select(*[F.col(f"`{c}`") for c in df.columns if c != col],
                      *[F.col("__parsed").getField(k).alias(n) for k, n in zip(keys, new)]))


def row_to_json(cols: dict[str, str | Column]) -> Column:
    """JSON object of a row of columns, in the given order; NULL columns as null."""
    return F.to_json(F.struct(*[_c(c).alias(k) for k, c in cols.items()]), {"ignoreNullFields": "false"})
