"""Predicate builders shared by the scans (plain Column expressions, so
Catalyst can push the simple ones into the parquet scan)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def like_any(col, patterns) -> Column:
    """lower(col) contains any pattern (SQL ``LIKE '%p%'`` OR-chain).
    NULL input gives NULL, so ``~like_any`` drops NULL names as SQL does."""
    low = F.lower(_c(col))
    return reduce(lambda a, b: a | b, [low.contains(p) for p in patterns])


def strip_suffixes(col, suffixes) -> Column:
    """Delete each suffix string in order (two-argument SQL replace)."""
    out = _c(col)
    for s in suffixes:
        out = F.replace(out, F.lit(s))
    return out


def in_bbox(lat, lon, country, bounds_by_country: dict) -> Column:
    """Inclusive per-country bounding box; rows of other countries are False."""
    terms = []
    for name, ((la0, la1), (lo0, lo1)) in bounds_by_country.items():
        terms.append((_c(country) == name) & _c(lat).between(la0, la1)
                     & _c(lon).between(lo0, lo1))
    return reduce(lambda a, b: a | b, terms)


def valid_service_area(col, ids) -> Column:
    """Service-area id (string or number) is in the valid list."""
    return _c(col).cast("string").try_cast("double").try_cast("long").isin(*ids)


def null_or_less(col, bound) -> Column:
    return _c(col).isNull() | (_c(col) < bound)


def nonzero_coords(*cols) -> Column:
    return reduce(lambda a, b: a & b, [(_c(c) != 0) & _c(c).isNotNull() for c in cols])
