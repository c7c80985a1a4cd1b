"""Map-valued profile expressions (weekday / hour histograms, location maps),
evaluated with higher-order functions inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def map_sum_squares(m) -> Column:
    return F.aggregate(F.map_values(_c(m)), F.lit(0.0),
                       lambda acc, v: acc + v.cast("double") * v.cast("double"))


def l2_normalize_map(m) -> Column:
    """Divide every value by the L2 norm of the map's values. An all-zero or
    empty map yields zeros (not NaN)."""
    def divided(norm: Column) -> Column:
        return F.transform_values(
            _c(m), lambda k, v: F.coalesce(F.try_divide(v.cast("double"), norm), F.lit(0.0)))

    # the norm as a lambda's variable: evaluated once a map, not once an entry
    return F.get(F.transform(F.array(F.sqrt(map_sum_squares(m))), divided), F.lit(0))


def smooth_hours(m) -> Column:
    """Circular 3-hour smoothing of an hour histogram: value(h) = n(h-1) + n(h)
    + n(h+1) over the 24 hours (missing hours count 0). Returns map<int,long>
    with all 24 keys."""
    mm = _c(m)

    def n(h):
        return F.coalesce(F.element_at(mm, h), F.lit(0).cast("long"))

    hours = F.sequence(F.lit(0), F.lit(23))
    return F.map_from_arrays(
        hours,
        F.transform(hours, lambda h: n(h) + n((h + 1) % 24) + n((h + 23) % 24)))


def lookup(m, key) -> Column:
    """m[key] as double, 0.0 when the key is absent or the map is NULL."""
    return F.coalesce(F.element_at(_c(m), _c(key)).cast("double"), F.lit(0.0))


def canon_map(m, value_fmt: str | None = None) -> Column:
    """Canonical text of a map for comparisons: entries sorted by key,
    'k=v' joined by ';'. ``value_fmt`` is a format_string pattern for values."""
    def fmt(e):
        v = e["value"]
        v = F.format_string(value_fmt, v) if value_fmt else v.cast("string")
        return F.concat(e["key"].cast("string"), F.lit("="), v)
    return F.array_join(F.transform(F.array_sort(F.map_entries(_c(m))), fmt), ";")
