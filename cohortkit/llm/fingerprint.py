"""Operator 5: document fingerprints as threshold-scaled sketches.

A text's words (A-Z lower-cased) form shingles of five words - a shorter text
is one shingle - and the sketch keeps every shingle hash below a fixed
fraction of the hash range. Unlike sketches of fixed size it grows with the
text, so the sketches of a short and a very long text still share the hashes
of what they have in common, and the union of two sketches is the sketch of
both texts. A text with fewer than ``LEAST`` such hashes keeps its ``LEAST``
smallest instead (a higher threshold of its own); two sketches are compared
below the lower of their thresholds. The likeness is the containment of the
smaller sketch in the other, 0 to 1; two sketches without any hash are alike.

Only DataFrame functions are used. Words are hashed once and shingles are
hashes of five word hashes; the next document is found by a window inside
ranges of doc_id whose first rows are also sent to the range before.

Defined results: a null or empty text, or one without words, has an empty
sketch (alike: 1.0 only with another empty sketch, else 0.0); rows with equal
doc_id follow in order of their texts, a null doc_id comes first; a table of
one row is its own next document; other columns are ignored; an empty table
gives an empty table.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import ascii_lower, let

SHINGLE = 5
#: One hash in so many is kept.
SCALE = 16
LEAST = 32
TOP = (1 << 63) - 1
THRESHOLD = -(1 << 63) + (1 << 64) // SCALE
#: Rows of a doc_id range, and ranges at most.
RANGE_ROWS, RANGES = 4000, 8192


def shingle_hashes(text: Column) -> Column:
    """Hash of each shingle, in the text's order."""
    ws = F.filter(F.split(ascii_lower(F.coalesce(text, F.lit(""))), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    return F.transform(ws, lambda w: F.xxhash64(w))


def _shingles(hashes: Column) -> Column:
    n = F.size(hashes)
    five = F.transform(F.sequence(F.lit(1), n - (SHINGLE - 1)), lambda i: F.xxhash64(
        *[F.get(hashes, i + (k - 1)) for k in range(SHINGLE)]))
    few = F.when(n > 0, F.array(F.xxhash64(F.array_join(hashes.cast("array<string>"), " ")))).otherwise(F.array().cast("array<bigint>"))
    return F.when(n >= SHINGLE, five).otherwise(few)


def sketch(df: DataFrame, text: str, out: str) -> DataFrame:
    """``df`` with ``out``: the sorted hashes the text keeps (array<bigint>)."""
    df = df.withColumn("__h", shingle_hashes(F.col(text)))
    df = df.withColumn("__s", _shingles(F.col("__h")))
    df = df.withColumn("__low", F.array_distinct(F.filter("__s", lambda h: h < F.lit(THRESHOLD))))
    rest = F.slice(F.array_sort(F.array_distinct("__s")), 1, LEAST)
    kept = F.when(F.size("__low") >= LEAST, F.array_sort("__low")).otherwise(rest)
    return df.withColumn(out, kept).drop("__h", "__s", "__low")


def merge(a: Column, b: Column) -> Column:
    """Sketch of two texts' joint shingles."""
    both = F.array_sort(F.array_union(a, b))
    low = F.filter(both, lambda h: h < F.lit(THRESHOLD))
    return F.when(F.size(low) >= LEAST, low).otherwise(F.slice(both, 1, LEAST))


def reach(a: Column) -> Column:
    """Hashes up to here are all in the sketch."""
    low = F.size(F.filter(a, lambda h: h < F.lit(THRESHOLD)))
    return F.when(F.size(a) < LEAST, F.lit(TOP)).when(low >= LEAST, F.lit(THRESHOLD - 1)).otherwise(F.array_max(a))


def likeness(a: Column, b: Column) -> Column:
    """Containment of the smaller sketch in the other below their common threshold."""
    def below(upto):
        return F.struct(F.filter(a, lambda h: h <= upto).alias("x"), F.filter(b, lambda h: h <= upto).alias("y"))

    def share(v):
        least = F.least(F.size(v["x"]), F.size(v["y"]))
        return F.when(least == 0, 0.0).otherwise(F.size(F.array_intersect(v["x"], v["y"])) / F.greatest(least, F.lit(1)))

    both = (F.size(a) == 0) & (F.size(b) == 0)
    return F.when(both, 1.0).otherwise(let(let(F.least(reach(a), reach(b)), below), share)).cast("double")


def fingerprint(a: Column) -> Column:
    """The sketch as text: 16 hexadecimal digits for each hash."""
    return F.array_join(F.transform(a, lambda h: F.lpad(F.hex(h), 16, "0")), "")


def with_next(df: DataFrame, key: str, order: list[str], columns: list[str]) -> DataFrame:
    """``df`` with next_<c> of the following row by ``key`` (a long; ties by
    ``order``); the first row follows the last. Rows meet inside ranges of the
    key; a range's first rows are sent once more, to the end of the range
    before, so that no range needs another."""
    lo = -(1 << 63)
    k = F.coalesce(F.col(key), F.lit(lo))
    n = df.count()
    if not n:
        return df.select("*", *[F.lit(None).cast(df.schema[c].dataType).alias(f"next_{c}") for c in columns])
    ranges = max(1, min(RANGES, math.ceil(n / RANGE_ROWS)))
    at = [i / ranges for i in range(1, ranges)]
    got = df.agg(F.min(k).alias("first"), *([F.percentile_approx(k, at, 100_000).alias("cuts")] if at else [])).first()
    heads = sorted({got["first"], *(got["cuts"] if at else [])})
    steps, size = [], 1
    while size < len(heads):
        size *= 2
    padded = heads + [TOP] * (size - len(heads))
    step = size
    while step > 1:
        step //= 2
        steps.append(step)
    cuts = F.array(*[F.lit(h) for h in padded])
    place = F.aggregate(F.array(*[F.lit(s) for s in steps]) if steps else F.array().cast("array<int>"), F.lit(0),
                        lambda i, s: F.when((i + s < len(heads)) & (F.get(cuts, i + s) <= F.col("__k")), i + s).otherwise(i))
    rows = df.withColumn("__k", k).withColumn("__range", place)
    before = (F.col("__range") + F.lit(len(heads) - 1)) % len(heads)
    head = F.get(cuts, F.col("__range")) == F.col("__k")
    own = F.struct(F.col("__range").alias("r"), F.lit(0).alias("extra"))
    rows = rows.withColumn("__at", F.explode(F.when(head, F.array(
        own, F.struct(before.alias("r"), F.lit(1).alias("extra")))).otherwise(F.array(own))))
    w = Window.partitionBy("__at.r").orderBy("__at.extra", "__k", *order)
    rows = rows.select("*", *[F.lead(c).over(w).alias(f"next_{c}") for c in columns])
    return rows.where("__at.extra = 0").drop("__k", "__range", "__at")


def edited(text: Column, follow: Column) -> Column:
    """The last half of the text replaced by the start of the following one."""
    half = F.floor(F.char_length(text) / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.char_length(text) - half), F.substring(follow, F.lit(1), half))


def fingerprints(docs: DataFrame) -> DataFrame:
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = with_next(sketch(rows, "text", "sketch"), "doc_id", ["text"], ["text", "sketch"])
    rows = rows.withColumn("edited", edited(F.col("text"), F.col("next_text")))
    return sketch(rows, "edited", "edited_sketch")


def op5(docs: DataFrame) -> DataFrame:
    return fingerprints(docs).select(
        "doc_id", F.char_length("text").cast("long").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        fingerprint(F.col("sketch")).alias("fingerprint"), fingerprint(F.col("edited_sketch")).alias("edited_fingerprint"),
        likeness(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        likeness(F.col("sketch"), F.col("next_sketch")).alias("near_next"))
