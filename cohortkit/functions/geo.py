"""Geographic column expressions (all JVM-side, codegen-friendly)."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import EARTH_RADIUS_KM


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def great_circle_km(lat1, lon1, lat2, lon2, radius_km: float = EARTH_RADIUS_KM) -> Column:
    """Great-circle distance on a sphere, atan2 (Vincenty special case) form,
    which is stable for both tiny and antipodal separations."""
    p1, p2 = F.radians(_c(lat1)), F.radians(_c(lat2))
    dl = F.radians(_c(lon2)) - F.radians(_c(lon1))
    s1, c1, s2, c2 = F.sin(p1), F.cos(p1), F.sin(p2), F.cos(p2)
    cdl, sdl = F.cos(dl), F.sin(dl)
    y = F.sqrt(F.pow(c2 * sdl, 2) + F.pow(c1 * s2 - s1 * c2 * cdl, 2))
    x = s1 * s2 + c1 * c2 * cdl
    return F.lit(radius_km) * F.atan2(y, x)


def great_circle_sql(lat1: str, lon1: str, lat2: str, lon2: str,
                     radius_km: float = EARTH_RADIUS_KM) -> str:
    """Same formula as SQL text (used by oracle queries)."""
    p1, p2 = f"radians({lat1})", f"radians({lat2})"
    dl = f"(radians({lon2}) - radians({lon1}))"
    y = (f"sqrt(pow(cos({p2}) * sin({dl}), 2) + "
         f"pow(cos({p1}) * sin({p2}) - sin({p1}) * cos({p2}) * cos({dl}), 2))")
    x = f"(sin({p1}) * sin({p2}) + cos({p1}) * cos({p2}) * cos({dl}))"
    return f"({radius_km} * atan2({y}, {x}))"


def location_key(lat, lon) -> Column:
    """'lat|long' key of a ~110 m grid cell: each coordinate rounded to three
    decimals (half up) and printed with exactly three decimals."""
    return F.format_string("%.3f|%.3f", half_up_round(_c(lat), 3), half_up_round(_c(lon), 3))


def key_lat(key) -> Column:
    return F.split(_c(key), r"\|").getItem(0).cast("double")


def key_lon(key) -> Column:
    return F.split(_c(key), r"\|").getItem(1).cast("double")


def within(lat1, lon1, lat2, lon2, km: float) -> Column:
    return great_circle_km(lat1, lon1, lat2, lon2) <= F.lit(km)




def half_up_round(x, digits: int) -> Column:
    """round(x, d) as floor(x * 10^d + 0.5) / 10^d: the warehouse SQL rounding
    of doubles (multiply first), which differs from Spark's decimal-string
    rounding on values such as 0.285."""
    f = float(10 ** digits)
    return F.floor(_c(x) * F.lit(f) + F.lit(0.5)) / F.lit(f)


def half_up_round_sql(x: str, digits: int) -> str:
    f = float(10 ** digits)
    return f"(floor(({x}) * {f} + 0.5) / {f})"
