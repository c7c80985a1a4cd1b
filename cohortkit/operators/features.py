"""Point-in-time customer feature rows (ride and food programs) for one valid
date: frequent places, weekday / hour profiles, transaction counts, saved
places, activity quantile. All joins are on customer_id, so every side is
hash-partitioned once on the same key and the join chain reuses it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import EngineConfig
from ..functions.geo import location_key
from ..functions.predicates import nonzero_coords
from ..functions.timefeat import iso_weekday, local_time
from ..session import cut_lineage
from .bookings import _dates, fan_out
from .history import quantiles as history_quantiles
from .history import ride_booking_spans
from .spans import FROM, TO, by_date, first_spans, spanned
from .transactions import FOOD_BRANCHES, RIDE_BRANCHES, txn_features
from .windows import keep_first


def keyed_bookings(base: DataFrame, quantiles: DataFrame, percentile: float,
                   with_pickup: bool = True) -> DataFrame:
    """Bookings of active customers with 'lat|long' keys of their places."""
    active = quantiles.filter(F.col("quantile") >= percentile).select("valid_date", "customer_id")
    cols = [F.col("valid_date"), F.col("booking_id"), F.col("customer_id"), F.col("ts"),
            location_key("dropoff_lat", "dropoff_long").alias("dropoff")]
    if with_pickup:
        cols.append(location_key("pickup_lat", "pickup_long").alias("pickup"))
    return base.join(active, ["valid_date", "customer_id"], "inner").select(*cols)


def frequent_locations(bookings: DataFrame, min_bookings: int,
                       with_pickup: bool = True) -> DataFrame:
    """(customer_id, location, num_bookings) for places (pickup or drop-off)
    used by at least ``min_bookings`` distinct bookings. One scan: each
    booking emits its places through ``explode`` instead of a UNION ALL."""
    places = (F.array("pickup", "dropoff") if with_pickup else F.array("dropoff"))
    return (bookings.select("valid_date", "customer_id", "booking_id",
                            F.explode(places).alias("location"))
                    .groupBy("valid_date", "customer_id", "location")
                    .agg(F.countDistinct("booking_id").alias("num_bookings"))
                    .filter(F.col("num_bookings") >= min_bookings))


def location_map(freq: DataFrame, min_locations: int) -> DataFrame:
    """(customer_id, locations map<string,long>, n_locations) for customers with
    at least ``min_locations`` frequent places (HAVING on count, not on the
    size of the collected list)."""
    return (freq.groupBy("valid_date", "customer_id")
                .agg(F.map_from_entries(F.collect_list(F.struct("location", "num_bookings")))
                     .alias("locations"),
                     F.count(F.lit(1)).alias("n_locations"))
                .filter(F.col("n_locations") >= min_locations))


def frequent_dropoff_history(bookings: DataFrame, freq: DataFrame, locmap: DataFrame) -> DataFrame:
    """Bookings whose drop-off is one of the customer's frequent places
    (customer kept by the location-count rule): an equi semi join on
    (customer, place) instead of an array-contains test."""
    kept = freq.join(locmap.select("valid_date", "customer_id"), ["valid_date", "customer_id"],
                     "left_semi")
    return bookings.join(kept.select("valid_date", "customer_id", F.col("location").alias("dropoff")),
                         ["valid_date", "customer_id", "dropoff"], "left_semi")


def _profile(hist: DataFrame, key: F.Column, out_col: str) -> DataFrame:
    per_key = (hist.groupBy("valid_date", "customer_id", key.alias("k"))
                   .agg(F.countDistinct("booking_id").alias("n")))
    return per_key.groupBy("valid_date", "customer_id").agg(
        F.map_from_entries(F.collect_list(F.struct("k", "n"))).alias(out_col))


def week_profile(hist: DataFrame, out_col: str = "week_stats") -> DataFrame:
    """ISO weekday (1 = Monday) -> distinct bookings (<= 7 entries)."""
    return _profile(hist, iso_weekday("ts"), out_col)


def hour_profile(hist: DataFrame, out_col: str = "hour_stats") -> DataFrame:
    """Local hour -> distinct bookings (<= 24 entries)."""
    return _profile(hist, F.hour("ts"), out_col)


def saved_places(T, dates, cfg: EngineConfig, customers: DataFrame,
                 min_year: int = 2019) -> DataFrame:
    """(valid_date, customer_id, home_work_coords map<string, struct<lat,long>>):
    latest saved home / work place per customer strictly before each valid
    date. Of the places that count from the same date on only the latest is
    kept, and only those meet the dates of their own customer."""
    ds = _dates(dates)
    # customers first, then any bookmark before the date: no lower bound
    usl = (T["bookmarks"].filter(F.col("country_id").isin(1, 19))
           .join(customers.select(F.col("customer_id").alias("user_id")).distinct(), "user_id", "left_semi")
           .filter(F.col("last_updated") < F.lit(ds[-1]))
           .select(F.col("user_id").alias("customer_id"), "provider_id", F.date_add(F.to_date("last_updated"), 1).alias("_saved")))
    name = F.lower("search_display_name")
    sli = (T["location_master"]
           .filter((F.col("year") > min_year) & F.col("date").isNotNull()
                   & (F.col("date") < F.lit(ds[-1]))
                   & F.col("country_id").isin(1, 19)
                   & (name.startswith("home") | name.startswith("work")))
           .select("provider_reference_id", "date", "last_updated", "latitude", "longitude",
                   F.when(name.startswith("home"), "home").when(name.startswith("work"), "work")
                   .alias("location_type")))
    j = (usl.join(sli, usl.provider_id == sli.provider_reference_id, "inner")
            .filter(F.col("location_type").isNotNull())
            .select("customer_id", "location_type", "last_updated",
                    "provider_reference_id",
                    F.struct(F.col("latitude").alias("lat"), F.col("longitude").alias("long"))
                    .alias("coords"),
                    F.greatest("_saved", F.date_add("date", 1), F.lit(ds[0])).alias(FROM)))
    order = [-F.unix_micros(F.col("last_updated").cast("timestamp")), -F.col("provider_reference_id")]
    from_date = keep_first(j, ["customer_id", "location_type", FROM], order)
    dated = customers.select("valid_date", "customer_id").join(from_date, "customer_id").filter(F.col("valid_date") >= F.col(FROM)).drop(FROM)
    latest = keep_first(dated, ["valid_date", "customer_id", "location_type"], order)
    return latest.groupBy("valid_date", "customer_id").agg(
        F.map_from_entries(F.collect_list(F.struct("location_type", "coords")))
        .alias("home_work_coords"))


def active_bookings(spans: DataFrame, quantiles: DataFrame, percentile: float) -> DataFrame:
    """Booking spans of customers that are active at any of the dates, with the keys of
    their places; written, since places and profiles both read them."""
    ever = quantiles.filter(F.col("quantile") >= percentile).select("customer_id").distinct()
    cols = [location_key("dropoff_lat", "dropoff_long").alias("dropoff")]
    if "pickup_lat" in spans.columns:
        cols.append(location_key("pickup_lat", "pickup_long").alias("pickup"))
    return cut_lineage(spans.join(ever, "customer_id", "left_semi").select("customer_id", "ts", *cols, FROM, TO))


def frequent_places(bookings: DataFrame, quantiles: DataFrame, dates, percentile: float, min_bookings: int, min_places: int) -> DataFrame:
    """(valid_date, customer_id, locations): places with at least ``min_bookings`` bookings
    in the date's window, of customers active at the date that have at least
    ``min_places`` of them. Bookings are summed per place before they meet dates."""
    places = F.array_distinct(F.array("pickup", "dropoff")) if "pickup" in bookings.columns else F.array("dropoff")
    spans = bookings.select("customer_id", F.explode(places).alias("location"), FROM, TO)
    n = by_date(spans, ["customer_id", "location"], dates, out="num_bookings").filter(F.col("num_bookings") >= min_bookings)
    active = quantiles.filter(F.col("quantile") >= percentile).select("valid_date", "customer_id")
    return location_map(n.join(active, ["valid_date", "customer_id"], "left_semi"), min_places).drop("n_locations")


def profiles(bookings: DataFrame, places: DataFrame, only_frequent: bool) -> DataFrame:
    """``places`` with week_stats and hour_stats (bookings per ISO weekday and local hour),
    both from one aggregate. ``only_frequent``: only bookings whose drop-off is one
    of the date's frequent places count."""
    grain = ["customer_id", "dropoff", FROM, TO, "_week", "_hour"] if only_frequent else ["customer_id", FROM, TO, "_week", "_hour"]
    few = bookings.withColumn("_week", iso_weekday("ts")).withColumn("_hour", F.hour("ts")).groupBy(*grain).agg(F.count("*").alias("_n"))
    j = places.join(few, "customer_id").filter(F.col("valid_date").between(F.col(FROM), F.col(TO)))
    if only_frequent:
        j = j.filter(F.map_contains_key("locations", F.col("dropoff")))
    count = lambda c, k: F.sum(F.when(F.col(c) == k, F.col("_n")))
    sums = [count("_week", k).alias(f"_w{k}") for k in range(1, 8)] + [count("_hour", k).alias(f"_h{k}") for k in range(24)]
    per = j.groupBy("valid_date", "customer_id").agg(*sums)
    as_map = lambda p, ks: F.map_filter(F.map_from_arrays(F.array(*[F.lit(k) for k in ks]), F.array(*[F.col(f"{p}{k}") for k in ks])), lambda k, v: v.isNotNull())
    return per.select("valid_date", "customer_id", as_map("_w", range(1, 8)).alias("week_stats"), as_map("_h", range(24)).alias("hour_stats"))


def ride_features(T, date, cfg: EngineConfig, saved_min_year: int = 2019) -> DataFrame:
    """Feature row per active ride customer of each date (schema S2, maps kept
    as MapType)."""
    base = cut_lineage(ride_booking_spans(T["trips"], date, cfg))
    quant = history_quantiles(by_date(base, ["customer_id"], date, out="num_trips"), "num_trips")
    quant = cut_lineage(quant)
    bookings = active_bookings(base, quant, cfg.percentile)
    locmap = cut_lineage(frequent_places(bookings, quant, date, cfg.percentile, cfg.min_bookings_per_location, cfg.min_locations_ride))
    both = profiles(bookings, locmap, only_frequent=True)
    trx = txn_features(T, date, cfg, RIDE_BRANCHES, {"base_bookings": base, "customers": locmap.select("valid_date", "customer_id")})
    saved = saved_places(T, date, cfg, locmap.select("valid_date", "customer_id"), saved_min_year)
    k = ["valid_date", "customer_id"]
    out = locmap.join(both, k).join(trx, k, "left").join(quant, k, "left").join(saved, k, "left")
    return out.select(F.col("valid_date").cast("string").alias("valid_date"),
                      F.lit("rh").alias("service"),
                      "customer_id", "num_trips", "quantile", "trx_amt", "week_stats",
                      "hour_stats", "locations", "home_work_coords")


def food_base_orders(T, date, cfg: EngineConfig) -> DataFrame:
    """Delivered food orders of the window, earliest row per (customer, order),
    with local time."""
    o = T["mkt_orders"].filter(
        (F.col("order_status") == "delivered") & (F.col("order_type") == "food")
        & F.col("country").isin(*cfg.event_countries)
        & nonzero_coords("drop_off_latitude", "drop_off_longitude")
        & F.col("order_id").isNotNull())
    o = fan_out(o, "day", date, cfg.history_horizon)
    o = o.select("valid_date", F.col("order_id").alias("booking_id"), "customer_id",
                 "booking_creation_timestamp", "country",
                 F.col("drop_off_latitude").alias("dropoff_lat"),
                 F.col("drop_off_longitude").alias("dropoff_long"))
    o = keep_first(o, ["valid_date", "customer_id", "booking_id"],
                   [F.col("booking_creation_timestamp")])
    o = o.select("valid_date", "booking_id", "customer_id",
                 local_time("booking_creation_timestamp", "country", cfg.tz_by_country).alias("ts"),
                 "dropoff_lat", "dropoff_long")
    return o.filter(F.col("ts").isNotNull())


def food_order_spans(T, date, cfg: EngineConfig) -> DataFrame:
    """Delivered food orders of the dates' windows as spans, earliest row first, with
    local time; orders of other countries than the known ones go."""
    o = T["mkt_orders"].filter(
        (F.col("order_status") == "delivered") & (F.col("order_type") == "food")
        & F.col("country").isin(*cfg.event_countries)
        & nonzero_coords("drop_off_latitude", "drop_off_longitude")
        & F.col("order_id").isNotNull())
    o = spanned(o, "day", date, cfg.history_horizon).withColumnsRenamed(
        {"order_id": "_order", "drop_off_latitude": "dropoff_lat", "drop_off_longitude": "dropoff_long"})
    o = first_spans(o, ["customer_id", "_order"], ["booking_creation_timestamp"], ["booking_creation_timestamp", "country", "dropoff_lat", "dropoff_long"], date)
    o = o.select("customer_id", F.col("_order").alias("booking_id"),
                 local_time("booking_creation_timestamp", "country", cfg.tz_by_country).alias("ts"), "dropoff_lat", "dropoff_long", FROM, TO)
    return o.filter(F.col("ts").isNotNull())


def food_features(T, date, cfg: EngineConfig) -> DataFrame:
    """Feature row per active food customer (schema S3): drop-off places only,
    at least one frequent place, profiles over all the customer's orders."""
    base = cut_lineage(food_order_spans(T, date, cfg))
    quant = cut_lineage(history_quantiles(by_date(base, ["customer_id"], date, out="num_orders"), "num_orders"))
    bookings = active_bookings(base, quant, cfg.percentile)
    locmap = cut_lineage(frequent_places(bookings, quant, date, cfg.percentile, cfg.min_bookings_per_location, cfg.min_locations_food))
    k = ["valid_date", "customer_id"]
    both = profiles(bookings, locmap, only_frequent=False)
    trx = txn_features(T, date, cfg, FOOD_BRANCHES, {"customers": locmap.select(*k), "food_base": base})
    out = locmap.join(both, k, "left").join(trx, k, "left").join(quant, k, "left")
    return out.select(F.col("valid_date").cast("string").alias("valid_date"), "customer_id",
                      "num_orders",
                      "quantile", "trx_amt", "week_stats", "hour_stats", "locations")
