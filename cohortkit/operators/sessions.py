"""Labelled app sessions per valid date: active-cohort semi join, first event
per booking / per session, match to the day's bookings, conflict resolution,
and cross-day de-duplication.

Everything is keyed by ``valid_date`` so one job serves any number of days
(the original extracts one day per query); a single day is a one-date spine.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import EngineConfig
from ..functions.predicates import strip_suffixes
from ..session import cut_lineage
from .bookings import _dates, fan_out, ride_filters
from .history import active_by_distinct_trips
from .windows import keep_first, percent_rank_by_histogram

SESSION_COLS = ("valid_date", "ts", "sessionuuid", "customer_id", "booking_id", "service_area_id",
                "country_name", "latitude", "longitude", "dropoff_lat", "dropoff_long",
                "is_trip_ended")


def history_fanout(bookings: DataFrame, dates, horizon: int, day_col: str = "day") -> DataFrame:
    """See bookings.fan_out (copy rows to every valid date whose window holds them)."""
    return fan_out(bookings, day_col, dates, horizon)


def active_cohort_batch(trips: DataFrame, dates, cfg: EngineConfig) -> DataFrame:
    """(valid_date, customer_id) of the active cohort of every date."""
    q = active_by_distinct_trips(trips, dates, cfg)
    return q.filter(F.col("quantile") >= cfg.percentile).select("valid_date", "customer_id")


def percent_rank_by_date(counts: DataFrame, value_col: str) -> DataFrame:
    """Rounded percent rank of ``value_col`` within each valid_date."""
    return percent_rank_by_histogram(counts, value_col, "quantile", 2, by=["valid_date"])


def _event_base(ev: DataFrame, dates, cfg: EngineConfig, cohort: DataFrame) -> DataFrame:
    ds = _dates(dates)
    e = ev.filter(F.col("date").isin(*ds)
                  & F.col("country_name").isin(*cfg.event_countries)
                  & F.col("platform").isin("android", "ios")
                  & F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
    e = e.withColumnRenamed("date", "valid_date")
    c = cohort.select("valid_date", F.col("customer_id").cast("string").alias("userid"))
    return e.join(c, ["valid_date", "userid"], "left_semi")


def _event_cols(e: DataFrame, booking_id) -> DataFrame:
    return e.select(
        "valid_date", "platform", "timestamp",
        F.floor(F.col("timestamp") / 1000).cast("long").alias("ts"),
        "sessionuuid", F.col("userid").cast("int").alias("customer_id"),
        booking_id.alias("booking_id"), "service_area_id", "country_name",
        F.round(F.col("latitude").cast("decimal(38,5)"), 5).cast("double").alias("latitude"),
        F.round(F.col("longitude").cast("decimal(38,5)"), 5).cast("double").alias("longitude"))


def booked_events(booking_events: DataFrame, dates, cfg: EngineConfig,
                  cohort: DataFrame) -> DataFrame:
    """First event per (platform, booking) of cohort members (per platform, so
    a booking seen on both platforms gives two rows until cleaned)."""
    e = _event_base(booking_events, dates, cfg, cohort)
    e = e.filter(F.col("booking_id").isNotNull() & (F.col("booking_id") != ""))
    bid = F.col("booking_id").cast("decimal(38,1)").cast("long")
    e = _event_cols(e, bid)
    first = keep_first(e, ["valid_date", "platform", "booking_id"],
                       [F.col("timestamp"), F.col("sessionuuid")])
    return first.drop("platform", "timestamp")


def unbooked_events(app_events: DataFrame, dates, cfg: EngineConfig,
                    cohort: DataFrame) -> DataFrame:
    """First service-tile style event per (platform, session) of cohort members."""
    e = _event_base(app_events, dates, cfg, cohort)
    e = e.filter(F.col("eventname").isin(*cfg.event_names)
                 & strip_suffixes("contentid", ("_rebranded", "_rebrand")).isin(*cfg.services))
    e = _event_cols(e, F.lit(0).cast("long"))
    first = keep_first(e, ["valid_date", "platform", "sessionuuid"], [F.col("timestamp")])
    return first.drop("platform", "timestamp")


def day_bookings(trips: DataFrame, dates, cfg: EngineConfig) -> DataFrame:
    """Bookings made on each valid date (one row per booking id)."""
    ds = _dates(dates)
    b = trips.filter(F.col("day").isin(*ds) & (F.col("booking_id") != 0)
                     & ride_filters(cfg, ended=False, dropoff_nonzero=False))
    b = b.select(F.col("day").alias("valid_date"), "booking_id", "is_trip_ended",
                 "dropoff_lat", "dropoff_long")
    # the source may repeat a booking; keep one row so the match cannot fan out
    return keep_first(b, ["valid_date", "booking_id"], [-F.col("is_trip_ended").cast("int")])


def match_sessions(candidates: DataFrame, bookings: DataFrame) -> DataFrame:
    """Left join candidates to the day's bookings: unmatched booking ids become
    0 (unbooked), missing end status becomes 0."""
    b = bookings.withColumn("_in", F.lit(1))
    j = candidates.join(b, ["valid_date", "booking_id"], "left")
    return j.select(
        F.col("valid_date").cast("string").alias("valid_date"), "ts", "sessionuuid", "customer_id",
        F.when(F.col("_in") == 1, F.col("booking_id")).otherwise(F.lit(0).cast("long"))
        .alias("booking_id"),
        "service_area_id", "country_name", "latitude", "longitude", "dropoff_lat", "dropoff_long",
        F.coalesce(F.col("is_trip_ended").cast("int"), F.lit(0)).alias("is_trip_ended"))


def raw_sessions(T, dates, cfg: EngineConfig) -> DataFrame:
    """Uncleaned session rows of the given valid dates (schema S1)."""
    cohort = active_cohort_batch(T["trips"], dates, cfg)
    cand = booked_events(T["booking_events"], dates, cfg, cohort).unionByName(
        unbooked_events(T["superapp_events"], dates, cfg, cohort))
    return match_sessions(cand, day_bookings(T["trips"], dates, cfg))


def clean_sessions(s: DataFrame) -> DataFrame:
    """Per-day conflict resolution:
    * booked rows: drop negatives whose session has a positive, then one row
      per booking (ended first, then earliest);
    * unbooked rows: drop sessions that have a booked row, then one row per
      (customer, session), earliest first."""
    s = s.filter(F.col("sessionuuid").isNotNull())
    booked = s.filter(F.col("booking_id") != 0)
    pos_sessions = (booked.filter(F.col("is_trip_ended") == 1)
                    .select("valid_date", "sessionuuid").distinct())
    neg = (booked.filter(F.col("is_trip_ended") == 0)
           .join(pos_sessions, ["valid_date", "sessionuuid"], "left_anti"))
    booked = booked.filter(F.col("is_trip_ended") == 1).unionByName(neg)
    booked = keep_first(booked, ["valid_date", "booking_id"],
                        [-F.col("is_trip_ended"), F.col("ts"), F.col("sessionuuid")], nulls_first=True)
    unbooked = (s.filter(F.col("booking_id") == 0)
                .join(booked.select("valid_date", "sessionuuid").distinct(),
                      ["valid_date", "sessionuuid"], "left_anti"))
    unbooked = keep_first(unbooked, ["valid_date", "customer_id", "sessionuuid"], [F.col("ts")], nulls_first=True)
    return booked.unionByName(unbooked).select(*SESSION_COLS)


def sessions(T, dates, cfg: EngineConfig, materialize: bool = True) -> DataFrame:
    """Cleaned sessions of the given dates. The raw session rows (at most one
    per app session and platform) are written to the shared checkpoint folder
    first: conflict resolution reads them four times, and the written table
    cuts the lineage back to the event scans (also for executor loss)."""
    raw = raw_sessions(T, dates, cfg)
    if materialize:
        raw = cut_lineage(raw)
    return clean_sessions(raw)


def dedup_across_days(frame: DataFrame) -> DataFrame:
    """One row per session over all days: booked rows win over unbooked ones,
    booked by (ended desc, ts), unbooked by ts. One aggregate, so that the rows
    are computed once. Without a session id, booked and unbooked rows do not meet."""
    booked = F.col("booking_id") != 0
    alone = F.col("sessionuuid").isNull() & ~booked
    first = keep_first(frame.filter(F.col("booking_id").isNotNull()).withColumn("_alone", alone), ["sessionuuid", "_alone"],
                       [(~booked).cast("int"), F.when(booked, -F.col("is_trip_ended")), F.col("ts"), F.col("valid_date"),
                        F.when(booked, F.col("booking_id"))], nulls_first=True)
    return first.select("sessionuuid", *[c for c in frame.columns if c != "sessionuuid"])
