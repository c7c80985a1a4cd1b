"""Time column expressions: zones, ISO weekday, minutes, cyclical encoding."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def local_time(ts_utc, country, tz_by_country: dict) -> Column:
    """UTC instant -> wall clock of the country's zone (timestamp_ntz);
    NULL for countries without a configured zone."""
    ts = _c(ts_utc).cast("timestamp")
    out = None
    for country_name, tz in tz_by_country.items():
        conv = F.from_utc_timestamp(ts, tz).cast("timestamp_ntz")
        out = (F.when(_c(country) == country_name, conv) if out is None
               else out.when(_c(country) == country_name, conv))
    return out if out is not None else F.lit(None).cast("timestamp_ntz")


def epoch_to_local(epoch_seconds, country, tz_by_country: dict) -> Column:
    return local_time(F.timestamp_seconds(_c(epoch_seconds)), country, tz_by_country)


def iso_weekday(ts) -> Column:
    """ISO day of week, 1 = Monday ... 7 = Sunday (Spark's dayofweek is 1 = Sunday)."""
    return ((F.dayofweek(_c(ts)) + 5) % 7 + 1).cast("int")


def minutes_of_day(ts) -> Column:
    return (F.hour(_c(ts)) * 60 + F.minute(_c(ts))).cast("int")


def cyclical(x, max_val: float) -> tuple[Column, Column]:
    """(sin, cos) of 2*pi*x/max_val."""
    ang = F.lit(2 * math.pi) * _c(x) / F.lit(float(max_val))
    return F.sin(ang), F.cos(ang)


def weekend_flag(weekday, country, weekend_by_country: dict, default=(6, 7)) -> Column:
    """1 when the ISO weekday is a weekend day in the row's country."""
    out = None
    for country_name, days in weekend_by_country.items():
        hit = _c(weekday).isin(*days).cast("int")
        out = (F.when(_c(country) == country_name, hit) if out is None
               else out.when(_c(country) == country_name, hit))
    dflt = _c(weekday).isin(*default).cast("int")
    return dflt if out is None else out.otherwise(dflt)
