"""Queries of the dataset-build stage (time, profile, place and saved-place
features, filters, training rows)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..config import BOUNDS_BY_COUNTRY, EARTH_RADIUS_KM
from ..functions.geo import great_circle_km, great_circle_sql
from ..functions.predicates import in_bbox, valid_service_area
from ..functions.profiles import canon_map, l2_normalize_map, smooth_hours
from ..operators import dataset as DS
from ..operators import features as FT
from ..operators import sessions as SS
from ..sources.fixtures import Tables
from . import sqlfrag as S
from .q_features import _RIDE, RIDE_FEATURE_VIEWS, _ride_parts, ride_features_body
from .q_sessions import _VIEWS as _SESSION_VIEWS
from .q_sessions import BATCH, _session_ctes
from .registry import FEATURE_DATE, FIX_CFG, SAVED_MIN_YEAR, oracle, register

D, C = FEATURE_DATE, FIX_CFG


def gc(a, b, c, d) -> str:
    return great_circle_sql(a, b, c, d)


@register("great_circle_km", oracle(("trips",), f"""
SELECT booking_id, {gc('pickup_lat', 'pickup_long', 'dropoff_lat', 'dropoff_long')} AS dist_km
FROM trips WHERE dropoff_lat <> 0 AND dropoff_long <> 0"""))
def great_circle_km_q(spark, sf):
    t = Tables(spark, sf)["trips"].filter((F.col("dropoff_lat") != 0) & (F.col("dropoff_long") != 0))
    return t.select("booking_id", great_circle_km("pickup_lat", "pickup_long", "dropoff_lat",
                                                  "dropoff_long").alias("dist_km"))


def _local_sql(ts: str) -> str:
    whens = " ".join(f"WHEN '{c}' THEN to_timestamp({ts}) AT TIME ZONE '{tz}'"
                     for c, tz in C.tz_by_country.items())
    return f"CASE country_name {whens} END"


def _weekend_sql(dow: str) -> str:
    whens = " ".join(f"WHEN '{c}' THEN CAST({dow} IN {S.lst(days)} AS INTEGER)"
                     for c, days in C.weekend_by_country.items())
    return f"CASE country_name {whens} ELSE CAST({dow} IN (6, 7) AS INTEGER) END"


@register("time_parts", oracle(("trips", "booking_events"), f"""
lt AS (SELECT sessionuuid, country_name, {_local_sql('"timestamp" // 1000')} AS ts
       FROM booking_events),
tp AS (SELECT sessionuuid, country_name, ts, hour(ts) AS hour, isodow(ts) AS weekday,
              hour(ts) * 60 + minute(ts) AS minutes FROM lt WHERE ts IS NOT NULL)
SELECT sessionuuid, ts, hour, weekday, sin(2 * pi() * minutes / 1440.0) AS minutes_sin,
       cos(2 * pi() * minutes / 1440.0) AS minutes_cos, {_weekend_sql('weekday')} AS is_weekend
FROM tp"""))
def time_parts_q(spark, sf):
    e = Tables(spark, sf)["booking_events"].select(
        "sessionuuid", "country_name", F.floor(F.col("timestamp") / 1000).cast("long").alias("ts"))
    t = DS.time_features(e, C)
    return t.select("sessionuuid", "ts", "hour", "weekday", "minutes_sin", "minutes_cos",
                    "is_weekend")


@register("hour_smoothing", oracle(("trips",), _RIDE + "," + """
hn AS (SELECT customer_id, hour(ts) AS h, count(DISTINCT booking_id) AS n FROM hist
       GROUP BY customer_id, hour(ts)),
cust AS (SELECT DISTINCT customer_id FROM hn),
grid AS (SELECT c.customer_id, g.h FROM cust c, range(0, 24) g(h)),
sm AS (SELECT g.customer_id, g.h,
              COALESCE(a.n, 0) + COALESCE(b.n, 0) + COALESCE(c.n, 0) AS s
       FROM grid g
       LEFT JOIN hn a ON a.customer_id = g.customer_id AND a.h = g.h
       LEFT JOIN hn b ON b.customer_id = g.customer_id AND b.h = (g.h + 1) % 24
       LEFT JOIN hn c ON c.customer_id = g.customer_id AND c.h = (g.h + 23) % 24)
SELECT customer_id, string_agg(CAST(h AS VARCHAR) || '=' || CAST(s AS VARCHAR), ';' ORDER BY h)
       AS hour_denoised_stats
FROM sm GROUP BY customer_id"""))
def hour_smoothing_q(spark, sf):
    T, base, quant, bk, freq, locmap = _ride_parts(spark, sf)
    h = FT.hour_profile(FT.frequent_dropoff_history(bk, freq, locmap))
    return h.select("customer_id", canon_map(smooth_hours("hour_stats")).alias("hour_denoised_stats"))


@register("l2_norm_profile", oracle(("trips",), _RIDE + "," + """
wn AS (SELECT customer_id, isodow(ts) AS k, count(DISTINCT booking_id) AS n FROM hist
       GROUP BY customer_id, isodow(ts)),
wz AS (SELECT customer_id, k, n / sqrt(sum(n * n) OVER (PARTITION BY customer_id)) AS v FROM wn)
SELECT customer_id, string_agg(CAST(k AS VARCHAR) || '=' || printf('%.6f', v), ';' ORDER BY k)
       AS norm_week
FROM wz GROUP BY customer_id"""))
def l2_norm_profile_q(spark, sf):
    T, base, quant, bk, freq, locmap = _ride_parts(spark, sf)
    w = FT.week_profile(FT.frequent_dropoff_history(bk, freq, locmap))
    return w.select("customer_id", canon_map(l2_normalize_map("week_stats"), "%.6f").alias("norm_week"))


# pseudo-sessions: every distinct ride of a customer that has frequent places,
# standing at its pickup point, with its drop-off
_PTS = """
pts AS (SELECT DISTINCT t.booking_id, t.customer_id, t.pickup_lat AS latitude, t.pickup_long AS longitude,
               COALESCE(t.dropoff_lat, 0) AS dropoff_lat, COALESCE(t.dropoff_long, 0) AS dropoff_long
        FROM trips t WHERE t.customer_id IN (SELECT customer_id FROM locs))"""


def _pts(spark, sf):
    T, base, quant, bk, freq, locmap = _ride_parts(spark, sf)
    pts = (T["trips"].select("booking_id", "customer_id", F.col("pickup_lat").alias("latitude"),
                             F.col("pickup_long").alias("longitude"),
                             F.coalesce("dropoff_lat", F.lit(0.0)).alias("dropoff_lat"),
                             F.coalesce("dropoff_long", F.lit(0.0)).alias("dropoff_long"))
           .distinct())
    return T, pts, locmap


@register("location_features", oracle(("trips",), _RIDE + "," + _PTS + f""",
lf AS (SELECT f.customer_id, f.location,
              CAST(split_part(f.location, '|', 1) AS DOUBLE) AS klat,
              CAST(split_part(f.location, '|', 2) AS DOUBLE) AS klon,
              f.num_bookings / sqrt(sum(f.num_bookings * f.num_bookings)
                                    OVER (PARTITION BY f.customer_id)) AS w,
              row_number() OVER (PARTITION BY f.customer_id
                                 ORDER BY f.num_bookings DESC, f.location) AS rk
       FROM freq f WHERE f.customer_id IN (SELECT customer_id FROM locs)),
pd AS (SELECT p.*, lf.location, lf.w, lf.rk,
              {gc('p.latitude', 'p.longitude', 'lf.klat', 'lf.klon')} AS dist,
              {gc('p.dropoff_lat', 'p.dropoff_long', 'lf.klat', 'lf.klon')} AS ddist
       FROM pts p JOIN lf ON p.customer_id = lf.customer_id),
nn AS (SELECT * FROM (SELECT booking_id, dist, w, row_number() OVER (PARTITION BY booking_id
                                                 ORDER BY dist, location) AS rn FROM pd) x
       WHERE rn = 1),
ag AS (SELECT booking_id, min(dropoff_lat) AS dlat, min(dropoff_long) AS dlon, min(ddist) AS dmin,
              max(CASE WHEN rk = 1 THEN dist END) AS d1, max(CASE WHEN rk = 2 THEN dist END) AS d2
       FROM pd GROUP BY booking_id)
SELECT ag.booking_id, nn.dist AS min_dist_to_known_loc,
       CASE WHEN nn.dist <= {C.d_threshold_km} THEN nn.w ELSE 0.0 END AS norm_trips_curr_location,
       CASE WHEN ag.dlat = 0 OR ag.dlon = 0 THEN 0
            ELSE CAST(ag.dmin <= {C.d_threshold_km} AS INTEGER) END AS is_freq,
       ag.d1 AS dist_to_most_freq, ag.d2 AS dist_to_second_freq
FROM ag JOIN nn ON ag.booking_id = nn.booking_id"""))
def location_features_q(spark, sf):
    T, pts, locmap = _pts(spark, sf)
    j = pts.join(locmap.select("customer_id", "locations"), "customer_id")
    out = DS.location_features(j, C)
    return out.select("booking_id", "min_dist_to_known_loc", "norm_trips_curr_location", "is_freq",
                      "dist_to_most_freq", "dist_to_second_freq")


@register("saved_place_flags", oracle(("trips", "bookmarks", "location_master"), _RIDE + ","
                                      + S.saved_cte(D, "SELECT customer_id FROM locs", SAVED_MIN_YEAR)
                                      + "," + _PTS + f""",
sv AS (SELECT customer_id,
              COALESCE(max(CASE WHEN location_type = 'home' THEN latitude END), 0) AS hlat,
              COALESCE(max(CASE WHEN location_type = 'home' THEN longitude END), 0) AS hlon,
              COALESCE(max(CASE WHEN location_type = 'work' THEN latitude END), 0) AS wlat,
              COALESCE(max(CASE WHEN location_type = 'work' THEN longitude END), 0) AS wlon
       FROM saved_rows GROUP BY customer_id),
pj AS (SELECT p.booking_id, p.latitude, p.longitude, COALESCE(sv.hlat, 0) AS hlat,
              COALESCE(sv.hlon, 0) AS hlon, COALESCE(sv.wlat, 0) AS wlat, COALESCE(sv.wlon, 0) AS wlon
       FROM pts p LEFT JOIN sv ON p.customer_id = sv.customer_id)
SELECT booking_id,
       CASE WHEN hlat <> 0 THEN CAST({gc('hlat', 'hlon', 'latitude', 'longitude')} <= {C.d_threshold_km}
                                      AS INTEGER) ELSE 0 END AS is_home,
       CASE WHEN hlat = 0 AND wlat <> 0
            THEN CAST({gc('wlat', 'wlon', 'latitude', 'longitude')} <= {C.d_threshold_km} AS INTEGER)
            ELSE 0 END AS is_work,
       CASE WHEN hlat <> 0 OR wlat <> 0 THEN 1 ELSE 0 END AS has_saved
FROM pj"""))
def saved_place_flags_q(spark, sf):
    T, pts, locmap = _pts(spark, sf)
    saved = FT.saved_places(T, D, C, locmap.select("valid_date", "customer_id"), SAVED_MIN_YEAR)
    j = (pts.join(locmap.select("customer_id"), "customer_id", "left_semi")
            .join(saved.drop("valid_date"), "customer_id", "left"))
    return DS.saved_place_flags(j, C).select("booking_id", "is_home", "is_work", "has_saved")


def _bbox_sql() -> str:
    parts = [f"(country_name = '{c}' AND latitude BETWEEN {la0} AND {la1} "
             f"AND longitude BETWEEN {lo0} AND {lo1})"
             for c, ((la0, la1), (lo0, lo1)) in BOUNDS_BY_COUNTRY.items()]
    return "(" + " OR ".join(parts) + ")"


@register("bbox_filter", oracle(("superapp_events",), f"""
SELECT country_name, count(*) AS n_events,
       CAST(sum(CASE WHEN {_bbox_sql()} THEN 1 ELSE 0 END) AS BIGINT) AS n_inside
FROM superapp_events GROUP BY country_name"""))
def bbox_filter_q(spark, sf):
    e = Tables(spark, sf)["superapp_events"]
    inside = F.coalesce(in_bbox("latitude", "longitude", "country_name", C.bounds_by_country),
                        F.lit(False))
    return e.groupBy("country_name").agg(F.count(F.lit(1)).alias("n_events"),
                                         F.sum(inside.cast("long")).alias("n_inside"))


@register("service_area_filter", oracle(("superapp_events",), f"""
SELECT service_area_id, count(*) AS n_events,
       TRY_CAST(TRY_CAST(service_area_id AS DOUBLE) AS BIGINT) IN {S.lst(C.valid_service_area_ids)}
           AS valid
FROM superapp_events GROUP BY service_area_id"""))
def service_area_filter_q(spark, sf):
    e = Tables(spark, sf)["superapp_events"]
    return (e.groupBy("service_area_id")
             .agg(F.count(F.lit(1)).alias("n_events"))
             .withColumn("valid", valid_service_area("service_area_id", C.valid_service_area_ids)))


@register("rh_frac", oracle(("trips",) + S.TXN_VIEWS,
                            S.ride_base_ctes(C, D) + "," + S.txn_cte(
                                C, D, "SELECT customer_id AS userid, CAST(booking_id AS VARCHAR) AS "
                                      "transaction_id, 'ride_hailing' AS service FROM base") + """
SELECT q.customer_id, CAST(q.num_trips AS DOUBLE) / t.trx_amt AS rh_frac
FROM quant q LEFT JOIN trx t ON q.customer_id = t.customer_id"""))
def rh_frac_q(spark, sf):
    from ..operators import bookings as B
    from ..operators import transactions as TX
    T = Tables(spark, sf)
    base = B.ride_base_bookings(T["trips"], D, C)
    q = B.customer_quantiles(base, distinct=False)
    t = TX.txn_features(T, D, C, TX.RIDE_BRANCHES, {"base_bookings": base})
    j = q.join(t, ["valid_date", "customer_id"], "left")
    return j.select("customer_id", F.try_divide(F.col("num_trips").cast("double"),
                                                F.col("trx_amt").cast("double")).alias("rh_frac"))


def _map_sql(col: str) -> str:
    """Entries of a canonical map text 'k=v;...'."""
    return (f"list_transform(string_split({col}, ';'), lambda e: struct_pack(k := split_part(e, '=', 1), "
            f"v := CAST(split_part(e, '=', 2) AS DOUBLE)))")


def _value(entries: str, key: str) -> str:
    return f"coalesce(list_sum(list_transform(list_filter({entries}, lambda e: e.k = CAST({key} AS VARCHAR)), lambda e: e.v)), 0)"


def _norm(entries: str) -> str:
    return f"sqrt(list_sum(list_transform({entries}, lambda e: e.v * e.v)))"


def _km(lat: str, lon: str) -> str:
    """Distance of the session point to a place, by the chord of its unit vectors."""
    a, b, c, d = (f"radians({x})" for x in ("j.latitude", "j.longitude", lat, lon))
    chord = (f"power(cos({a}) * cos({b}) - cos({c}) * cos({d}), 2) + power(cos({a}) * sin({b}) - cos({c}) * sin({d}), 2) "
             f"+ power(sin({a}) - sin({c}), 2)")
    return f"2 * {EARTH_RADIUS_KM} * asin(sqrt({chord}) / 2)"


def _saved_sql(place: str, i: int) -> str:
    """Coordinate of a saved place from 'home=lat,long;work=lat,long', 0 where none is saved."""
    return (f"coalesce(CAST(split_part(split_part(list_filter(string_split(coalesce(j.home_work_coords, ''), ';'), "
            f"lambda e: starts_with(e, '{place}='))[1], '=', 2), ',', {i}) AS DOUBLE), 0)")


def training_body(dates) -> str:
    """CTEs up to ``trained``, the training rows of the dates: feature rows of each
    date on its own, joined with the cleaned sessions."""
    feats = " UNION ALL ".join(f"SELECT * FROM (WITH {ride_features_body(d.isoformat()).strip()}) f{i}" for i, d in enumerate(dates))
    hours = f"list_transform(range(24), lambda h: {_value('hm', 'h')} + {_value('hm', '(h + 1) % 24')} + {_value('hm', '(h + 23) % 24')})"
    near = f"CAST({_km('{0}', '{1}')} <= {C.d_threshold_km} AS INTEGER)"
    home, work = ([_saved_sql(p, i) for i in (1, 2)] for p in ("home", "work"))
    return _session_ctes(dates) + f""",
feats AS ({feats}),
fm AS (SELECT *, {_map_sql('week_stats')} AS wm, {_map_sql('hour_stats')} AS hm, {_map_sql('locations')} AS lm FROM feats),
j0 AS (SELECT c.* EXCLUDE (ts), {_local_sql('c.ts')} AS ts, f.* EXCLUDE (valid_date, customer_id, week_stats, hour_stats, locations),
              {hours} AS smooth, row_number() OVER () AS rid
       FROM clean c JOIN fm f ON f.valid_date = c.valid_date AND f.customer_id = c.customer_id),
j AS (SELECT *, hour(ts) AS hour, isodow(ts) AS weekday, hour(ts) * 60 + minute(ts) AS minutes FROM j0 WHERE ts IS NOT NULL),
places AS (SELECT j.rid, e.k, e.v, {_km("CAST(split_part(e.k, '|', 1) AS DOUBLE)", "CAST(split_part(e.k, '|', 2) AS DOUBLE)")} AS km,
                  {_km("CAST(split_part(e.k, '|', 1) AS DOUBLE)", "CAST(split_part(e.k, '|', 2) AS DOUBLE)").replace('j.latitude', 'j.dropoff_lat').replace('j.longitude', 'j.dropoff_long')} AS drop_km,
                  row_number() OVER (PARTITION BY j.rid ORDER BY e.v DESC, e.k) AS rk
           FROM j, unnest(j.lm) AS u(e)),
pl AS (SELECT rid, min(km) AS min_km, first(v ORDER BY km, k) AS near_v, min(drop_km) AS drop_km,
              max(CASE WHEN rk = 1 THEN km END) AS km1, max(CASE WHEN rk = 2 THEN km END) AS km2 FROM places GROUP BY rid),
flat AS (SELECT j.valid_date, j.ts, j.sessionuuid, j.customer_id, j.booking_id, j.is_trip_ended, j.service, j.quantile, j.weekday,
    sin(2 * pi() * j.minutes / 1440.0) AS minutes_sin, cos(2 * pi() * j.minutes / 1440.0) AS minutes_cos, {_weekend_sql('j.weekday')} AS is_weekend,
    CAST(j.booking_id <> 0 AS INTEGER) AS rh, {_value('j.wm', 'j.weekday')} / {_norm('j.wm')} AS norm_week, {_value('j.hm', 'j.hour')} / {_norm('j.hm')} AS norm_hour,
    j.smooth[j.hour + 1] / sqrt(list_sum(list_transform(j.smooth, lambda x: x * x))) AS norm_hour_denoised, j.latitude, j.longitude,
    pl.min_km AS min_dist_to_known_loc, CASE WHEN pl.min_km <= {C.d_threshold_km} THEN pl.near_v / {_norm('j.lm')} ELSE 0.0 END AS norm_trips_curr_location,
    CASE WHEN coalesce(j.dropoff_lat, 0) = 0 OR coalesce(j.dropoff_long, 0) = 0 THEN 0 ELSE CAST(pl.drop_km <= {C.d_threshold_km} AS INTEGER) END AS is_freq,
    pl.km1 AS dist_to_most_freq, pl.km2 AS dist_to_second_freq,
    CASE WHEN {home[0]} <> 0 THEN {near.format(*home)} ELSE 0 END AS is_home,
    CASE WHEN {home[0]} = 0 AND {work[0]} <> 0 THEN {near.format(*work)} ELSE 0 END AS is_work,
    CAST({home[0]} <> 0 OR {work[0]} <> 0 AS INTEGER) AS has_saved, CAST(j.num_trips AS DOUBLE) / nullif(j.trx_amt, 0) AS rh_frac,
    j.country_name, j.service_area_id
  FROM j JOIN pl USING (rid) WHERE pl.min_km <= {C.max_known_location_km}),
fb AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY sessionuuid ORDER BY is_trip_ended DESC, ts, valid_date, booking_id) AS rn
       FROM flat WHERE booking_id <> 0) WHERE rn = 1),
fu AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY sessionuuid ORDER BY ts, valid_date) AS rn
       FROM flat WHERE booking_id = 0 AND sessionuuid NOT IN (SELECT sessionuuid FROM fb)) WHERE rn = 1),
trained AS (SELECT * EXCLUDE (country_name, service_area_id) FROM (FROM fb UNION ALL FROM fu) u
  WHERE TRY_CAST(TRY_CAST(service_area_id AS DOUBLE) AS BIGINT) IN {S.lst(C.valid_service_area_ids)} AND {_bbox_sql()})"""


TRAINING_VIEWS = tuple(dict.fromkeys(_SESSION_VIEWS + RIDE_FEATURE_VIEWS))


@register("training_rows", oracle(TRAINING_VIEWS, training_body(BATCH) + """
SELECT * FROM trained"""))
def training_rows_q(spark, sf):
    """Flat training table over the 30-day batch."""
    T = Tables(spark, sf)
    sess = SS.sessions(T, BATCH, C)
    feats = FT.ride_features(T, BATCH, C, SAVED_MIN_YEAR)
    return DS.training_rows(sess, feats, C)
