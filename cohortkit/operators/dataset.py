"""Training rows: sessions joined point-in-time with the customer features of
the same valid date, plus local-time, profile, place and saved-place
features. Every feature is a native column expression (higher-order
functions over the per-customer maps); no Python runs per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import EngineConfig
from ..functions.geo import great_circle_km, key_lat, key_lon
from ..functions.predicates import in_bbox, valid_service_area
from ..functions.profiles import l2_normalize_map, lookup, smooth_hours
from ..functions.timefeat import cyclical, epoch_to_local, iso_weekday, minutes_of_day, weekend_flag
from .sessions import dedup_across_days


def prepare_features(features: DataFrame) -> DataFrame:
    """Adds the smoothed hour histogram and L2-normalised profile maps."""
    return (features
            .withColumn("hour_denoised_stats", smooth_hours("hour_stats"))
            .withColumn("norm_week", l2_normalize_map("week_stats"))
            .withColumn("norm_hour", l2_normalize_map("hour_stats"))
            .withColumn("norm_hour_denoised", l2_normalize_map("hour_denoised_stats")))


def time_features(df: DataFrame, cfg: EngineConfig, ts_col: str = "ts") -> DataFrame:
    """Epoch seconds -> country wall clock (rows of other countries dropped),
    hour, ISO weekday, cyclical minutes of day and weekend flag."""
    local = epoch_to_local(ts_col, "country_name", cfg.tz_by_country)
    out = df.withColumn(ts_col, local).filter(F.col(ts_col).isNotNull())
    s, c = cyclical(minutes_of_day(ts_col), 24 * 60)
    return (out.withColumn("hour", F.hour(ts_col))
               .withColumn("weekday", iso_weekday(ts_col))
               .withColumn("minutes_sin", s).withColumn("minutes_cos", c)
               .withColumn("is_weekend", weekend_flag("weekday", "country_name",
                                                      cfg.weekend_by_country)))


def _entries(m) -> Column:
    return F.map_entries(F.col(m) if isinstance(m, str) else m)


def location_features(df: DataFrame, cfg: EngineConfig, lat="latitude", lon="longitude",
                      dlat="dropoff_lat", dlon="dropoff_long", locations="locations") -> DataFrame:
    """Distances from the session point to the customer's frequent places:
    nearest distance and its L2-normalised trip weight (0 beyond the radius),
    drop-off at a frequent place, distances to the two most used places
    (NULL when there is only one)."""
    thr = cfg.d_threshold_km
    norm = F.sqrt(F.aggregate(F.map_values(locations), F.lit(0.0),
                              lambda acc, v: acc + v.cast("double") * v.cast("double")))
    near = F.array_min(F.transform(_entries(locations), lambda e: F.struct(
        great_circle_km(lat, lon, key_lat(e["key"]), key_lon(e["key"])).alias("d"),
        e["key"].alias("k"), e["value"].alias("v"))))
    dmin = near["d"]
    weight = F.when(dmin <= thr, near["v"].cast("double") / norm).otherwise(F.lit(0.0))
    drop_zero = (F.col(dlat) == 0) | (F.col(dlon) == 0)
    drop_near = F.exists(F.map_keys(locations), lambda k: great_circle_km(
        dlat, dlon, key_lat(k), key_lon(k)) <= thr)
    is_freq = F.when(drop_zero, F.lit(0)).otherwise(drop_near.cast("int"))
    # most used places: count desc, key asc
    ranked = F.array_sort(F.transform(_entries(locations),
                                      lambda e: F.struct((-e["value"]).alias("nv"), e["key"].alias("k"))))

    def dist_to(i):
        k = F.element_at(ranked, i)["k"]
        return F.when(F.size(ranked) >= i, great_circle_km(lat, lon, key_lat(k), key_lon(k)))

    return (df.withColumn("min_dist_to_known_loc", dmin)
              .withColumn("norm_trips_curr_location", weight)
              .withColumn("is_freq", is_freq)
              .withColumn("dist_to_most_freq", dist_to(1))
              .withColumn("dist_to_second_freq", dist_to(2)))


def saved_place_flags(df: DataFrame, cfg: EngineConfig, lat="latitude", lon="longitude",
                      coords="home_work_coords") -> DataFrame:
    """is_home / is_work / has_saved within the radius. A missing place counts
    as coordinate 0 (absent); with the default rule the work place is only
    tested when no home place is saved."""
    thr = cfg.d_threshold_km
    m = F.col(coords)
    h_lat = F.coalesce(F.element_at(m, F.lit("home"))["lat"], F.lit(0.0))
    h_lon = F.coalesce(F.element_at(m, F.lit("home"))["long"], F.lit(0.0))
    w_lat = F.coalesce(F.element_at(m, F.lit("work"))["lat"], F.lit(0.0))
    w_lon = F.coalesce(F.element_at(m, F.lit("work"))["long"], F.lit(0.0))
    has_home, has_work = h_lat != 0.0, w_lat != 0.0
    near_home = (great_circle_km(h_lat, h_lon, lat, lon) <= thr).cast("int")
    near_work = (great_circle_km(w_lat, w_lon, lat, lon) <= thr).cast("int")
    if cfg.work_requires_no_home:
        is_home = F.when(has_home, near_home).otherwise(F.lit(0))
        is_work = F.when(~has_home & has_work, near_work).otherwise(F.lit(0))
    else:
        is_home = F.when(has_home, near_home).otherwise(F.lit(0))
        is_work = F.when(has_work, near_work).otherwise(F.lit(0))
    has_saved = (has_home | has_work).cast("int")
    return (df.withColumn("is_home", F.coalesce(is_home, F.lit(0)))
              .withColumn("is_work", F.coalesce(is_work, F.lit(0)))
              .withColumn("has_saved", F.coalesce(has_saved, F.lit(0))))


TRAINING_COLS = (
    "valid_date", "ts", "sessionuuid", "customer_id", "booking_id", "is_trip_ended", "service",
    "quantile", "weekday", "minutes_sin", "minutes_cos", "is_weekend", "rh", "norm_week",
    "norm_hour", "norm_hour_denoised", "latitude", "longitude", "min_dist_to_known_loc",
    "norm_trips_curr_location", "is_freq", "dist_to_most_freq", "dist_to_second_freq",
    "is_home", "is_work", "has_saved", "rh_frac")


def training_rows(sessions: DataFrame, features: DataFrame, cfg: EngineConfig) -> DataFrame:
    """Flat training table (schema S4) over all valid dates."""
    # profiles are prepared for the rows that have sessions only
    j = prepare_features(sessions.join(features, ["valid_date", "customer_id"], "inner"))
    j = j.drop("week_stats", "hour_stats", "hour_denoised_stats")
    j = time_features(j, cfg)
    j = (j.withColumn("rh", (F.col("booking_id") != 0).cast("int"))
          .withColumn("norm_week", lookup("norm_week", "weekday"))
          .withColumn("norm_hour", lookup("norm_hour", "hour"))
          .withColumn("norm_hour_denoised", lookup("norm_hour_denoised", "hour"))
          .withColumn("dropoff_lat", F.coalesce(F.col("dropoff_lat"), F.lit(0.0)).cast("double"))
          .withColumn("dropoff_long", F.coalesce(F.col("dropoff_long"), F.lit(0.0)).cast("double"))
          .withColumn("latitude", F.col("latitude").cast("double"))
          .withColumn("longitude", F.col("longitude").cast("double")))
    j = location_features(j, cfg)
    j = saved_place_flags(j, cfg)
    j = j.withColumn("rh_frac", F.try_divide(F.col("num_trips").cast("double"),
                                             F.col("trx_amt").cast("double")))
    j = j.filter(F.col("min_dist_to_known_loc") <= cfg.max_known_location_km)
    keep = [c for c in TRAINING_COLS] + ["country_name", "service_area_id"]
    j = dedup_across_days(j.select(*keep))
    j = j.filter(valid_service_area("service_area_id", cfg.valid_service_area_ids)
                 & in_bbox("latitude", "longitude", "country_name", cfg.bounds_by_country))
    return j.select(*TRAINING_COLS)
