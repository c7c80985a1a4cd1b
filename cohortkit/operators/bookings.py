"""Booking scans: history-window / single-day predicates, status filters,
booking dedup and the activity cohort (percent rank of trip counts)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import EngineConfig
from ..functions.predicates import like_any, nonzero_coords
from ..functions.timefeat import local_time
from .windows import keep_first, percent_rank_by_histogram


def as_date(d) -> _dt.date:
    return d if isinstance(d, _dt.date) else _dt.date.fromisoformat(str(d))


def window_bounds(date, horizon: int) -> tuple[_dt.date, _dt.date]:
    """History window of a valid date D: D-(n+1) .. D-1, both inclusive."""
    d = as_date(date)
    return d - _dt.timedelta(days=horizon + 1), d - _dt.timedelta(days=1)


def in_window(day_col: str, date, horizon: int):
    lo, hi = window_bounds(date, horizon)
    # literal bounds -> partition pruning / parquet min-max pushdown
    return F.col(day_col).between(F.lit(lo), F.lit(hi))


def ride_filters(cfg: EngineConfig, ended: bool | None = True, intercity_later: bool = True,
                 dropoff_nonzero: bool = True):
    """The booking predicates shared by every ride scan."""
    p = (F.col("customer_id").isNotNull()
         & F.col("booking_country").isin(*cfg.booking_countries)
         & ~like_any("cct_name", cfg.excluded_patterns)
         & nonzero_coords("pickup_lat", "pickup_long")
         & F.col("booking_platform").isin(*cfg.platforms)
         & F.col("business_type").isin(*cfg.business_types))
    if ended:
        p = p & F.col("is_trip_ended")
    if intercity_later:
        p = p & ~F.col("is_intercity") & ~F.col("is_later")
    if dropoff_nonzero:
        p = p & nonzero_coords("dropoff_lat", "dropoff_long")
    if cfg.excluded_customers:
        p = p & ~F.col("customer_id").isin(*cfg.excluded_customers)
    return p


def _dates(dates) -> list[_dt.date]:
    if isinstance(dates, (str, _dt.date)):
        dates = [dates]
    return sorted({as_date(d) for d in dates})


def fan_out(df: DataFrame, day_col, dates, horizon: int) -> DataFrame:
    """Point-in-time range join without a nested loop: every row is copied to
    each requested valid date D whose history window [D-(n+1), D-1] contains
    its day (column ``valid_date``). The generated sequence is clipped to the
    requested span, so the fan-out is at most min(#dates, n+1); rows outside
    every window are pruned by a literal range predicate first."""
    ds = _dates(dates)
    lo, hi = ds[0], ds[-1]
    day = F.col(day_col) if isinstance(day_col, str) else day_col
    b = df.filter(day.between(F.lit(lo - _dt.timedelta(days=horizon + 1)),
                              F.lit(hi - _dt.timedelta(days=1))))
    if len(ds) == 1:
        return b.withColumn("valid_date", F.lit(lo))
    first = F.greatest(F.date_add(day, 1), F.lit(lo))
    last = F.least(F.date_add(day, horizon + 1), F.lit(hi))
    out = b.withColumn("valid_date", F.explode(F.sequence(first, last)))
    if len(ds) != (hi - lo).days + 1:        # non-contiguous spine
        out = out.filter(F.col("valid_date").isin(*ds))
    return out


def scan_history(trips: DataFrame, dates, cfg: EngineConfig) -> DataFrame:
    """Ended ride bookings of the history window of every valid date
    (not deduped), with ``valid_date``."""
    return fan_out(trips.filter(ride_filters(cfg)), "day", dates, cfg.history_horizon)


def scan_day(trips: DataFrame, date, cfg: EngineConfig) -> DataFrame:
    """Bookings made on ``date`` (any end status), used to label sessions."""
    return trips.filter((F.col("day") == F.lit(as_date(date)))
                        & (F.col("booking_id") != 0)
                        & ride_filters(cfg, ended=False, dropoff_nonzero=False))


def dedup_bookings(df: DataFrame, ts_col: str = "booking_creation_date",
                   keys=("valid_date", "customer_id", "booking_id")) -> DataFrame:
    """Earliest row per (valid date, customer, booking) - window dependent, so
    applied after the fan-out."""
    return keep_first(df, list(keys), [F.col(ts_col)])


def ride_base_bookings(trips: DataFrame, dates, cfg: EngineConfig) -> DataFrame:
    """Deduped history bookings of every valid date with the local booking
    time ``ts``."""
    cols = ["booking_id", "customer_id", "booking_creation_date", "booking_country",
            "pickup_lat", "pickup_long", "dropoff_lat", "dropoff_long", "day"]
    base = dedup_bookings(scan_history(trips.select(*cols, "cct_name", "is_trip_ended",
                                                    "is_intercity", "is_later",
                                                    "booking_platform", "business_type"),
                                       dates, cfg).select("valid_date", *cols[:-1]))
    return base.select(
        "valid_date", "booking_id", "customer_id",
        local_time("booking_creation_date", "booking_country", cfg.tz_by_booking_country)
        .alias("ts"),
        "pickup_lat", "pickup_long", "dropoff_lat", "dropoff_long")


def trips_per_customer(bookings: DataFrame, distinct: bool = True,
                       out_col: str = "num_trips") -> DataFrame:
    agg = F.countDistinct("booking_id") if distinct else F.count("booking_id")
    return bookings.groupBy("valid_date", "customer_id").agg(agg.alias(out_col))


def customer_quantiles(bookings: DataFrame, distinct: bool = False,
                       out_col: str = "num_trips") -> DataFrame:
    """(valid_date, customer_id, num_trips, quantile) with quantile =
    round(percent_rank, 2) over all customers of the date's window."""
    return percent_rank_by_histogram(trips_per_customer(bookings, distinct, out_col),
                                     out_col, "quantile", 2, by=["valid_date"])


def active_cohort(trips: DataFrame, dates, cfg: EngineConfig) -> DataFrame:
    """(valid_date, customer_id) whose rounded trip-count percent rank is >=
    the percentile (distinct bookings over the history window, no dedup)."""
    q = customer_quantiles(scan_history(trips, dates, cfg)
                           .select("valid_date", "customer_id", "booking_id"), distinct=True)
    return q.filter(F.col("quantile") >= cfg.percentile).select("valid_date", "customer_id")
