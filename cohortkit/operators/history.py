"""Booking histories as spans: which bookings count for which valid dates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import EngineConfig
from ..functions.timefeat import local_time
from .bookings import ride_filters
from .spans import FROM, TO, by_date, distinct_spans, first_spans, spanned
from .windows import percent_rank_by_histogram

_PLACES = ["pickup_lat", "pickup_long", "dropoff_lat", "dropoff_long"]


def ride_booking_spans(trips: DataFrame, dates, cfg: EngineConfig) -> DataFrame:
    """Ended ride bookings of the dates' windows, one row a (customer, booking) and span:
    the earliest row that the span's windows hold, with the local booking time
    ``ts`` and its places."""
    t = spanned(trips.filter(ride_filters(cfg)), "day", dates, cfg.history_horizon)
    b = first_spans(t, ["customer_id", "booking_id"], ["booking_creation_date"], ["booking_creation_date", "booking_country", *_PLACES], dates)
    return b.select("customer_id", "booking_id",
                    local_time("booking_creation_date", "booking_country", cfg.tz_by_booking_country).alias("ts"), *_PLACES, FROM, TO)


def quantiles(counts: DataFrame, value: str) -> DataFrame:
    """``counts`` with the rounded percent rank of ``value`` within each valid date."""
    return percent_rank_by_histogram(counts, value, "quantile", 2, by=["valid_date"])


def active_by_distinct_trips(trips: DataFrame, dates, cfg: EngineConfig) -> DataFrame:
    """(valid_date, customer_id, num_trips, quantile) by distinct ended bookings."""
    t = spanned(trips.filter(ride_filters(cfg)), "day", dates, cfg.history_horizon).select("customer_id", "booking_id", FROM, TO)
    return quantiles(by_date(distinct_spans(t, ["customer_id"], "booking_id", dates), ["customer_id"], dates, out="num_trips"), "num_trips")
