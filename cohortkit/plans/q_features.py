"""Queries of the feature-extraction stage (scans, cohort, places, profiles,
transactions, saved places, feature assembly)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.geo import location_key
from ..functions.predicates import like_any
from ..functions.profiles import canon_map
from ..operators import bookings as B
from ..operators import features as FT
from ..operators import transactions as TX
from ..sources.fixtures import Tables
from . import sqlfrag as S
from .registry import FEATURE_DATE, FIX_CFG, SAVED_MIN_YEAR, oracle, register, saved_canon

D, C = FEATURE_DATE, FIX_CFG
_TXN_VIEWS = ("trips",) + S.TXN_VIEWS


# --- scans and predicates ---------------------------------------------------

@register("scan_trips_window", oracle(("trips",), f"""
SELECT booking_id, customer_id, CAST(day AS VARCHAR) AS day, booking_creation_date FROM trips
WHERE {S.window('day', D, C.history_horizon)} AND {S.ride_filter(C)}"""))
def scan_trips_window(spark, sf):
    return (B.scan_history(Tables(spark, sf)["trips"], D, C)
            .select("booking_id", "customer_id", F.col("day").cast("string").alias("day"),
                    "booking_creation_date"))


@register("like_any_exclusion", oracle(("trips",), f"""
SELECT cct_name, count(*) AS n_rows, {S.like_any('cct_name', C.excluded_patterns)} AS excluded
FROM trips GROUP BY cct_name"""))
def like_any_exclusion(spark, sf):
    t = Tables(spark, sf)["trips"]
    return t.groupBy("cct_name").agg(F.count(F.lit(1)).alias("n_rows"),
                                     like_any("cct_name", C.excluded_patterns).alias("excluded"))


@register("date_spine", oracle((), """
SELECT CAST(CAST(d AS DATE) AS VARCHAR) AS valid_date
FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS last_day FROM orders
      ORDER BY last_day DESC LIMIT 1) m,
     generate_series(m.last_day - INTERVAL 29 DAY, CAST(m.last_day AS TIMESTAMP), INTERVAL 1 DAY) g(d)"""))
def date_spine_q(spark, sf):
    from ..operators.batch import date_spine_from
    return (date_spine_from(Tables(spark, sf)["orders"], "o_orderdate", 30)
            .select(F.col("valid_date").cast("string").alias("valid_date")))


# --- cohort -----------------------------------------------------------------

@register("trips_per_customer", oracle(("trips",), f"""
SELECT customer_id, count(DISTINCT booking_id) AS num_trips FROM trips
WHERE {S.window('day', D, C.history_horizon)} AND {S.ride_filter(C)} GROUP BY customer_id"""))
def trips_per_customer(spark, sf):
    return (B.trips_per_customer(B.scan_history(Tables(spark, sf)["trips"], D, C), True)
            .select("customer_id", "num_trips"))


@register("active_cohort", oracle(("trips",), f"""
c AS (SELECT customer_id, count(DISTINCT booking_id) AS num_trips FROM trips
      WHERE {S.window('day', D, C.history_horizon)} AND {S.ride_filter(C)} GROUP BY customer_id),
q AS (SELECT customer_id, num_trips,
             {S.round2('percent_rank() OVER (ORDER BY num_trips)')} AS quantile FROM c)
SELECT customer_id, num_trips, quantile FROM q"""))
def active_cohort_q(spark, sf):
    t = B.scan_history(Tables(spark, sf)["trips"], D, C).select("valid_date", "customer_id",
                                                                "booking_id")
    return B.customer_quantiles(t, distinct=True).select("customer_id", "num_trips", "quantile")


@register("booking_dedup", oracle(("trips",), S.ride_base_ctes(C, D) + """
SELECT booking_id, customer_id, ts FROM base"""))
def booking_dedup(spark, sf):
    return B.ride_base_bookings(Tables(spark, sf)["trips"], D, C).select("booking_id", "customer_id", "ts")


@register("local_time_bookings", oracle(("trips",), f"""
SELECT booking_id, booking_country,
       {S.local_ts('booking_creation_date', 'booking_country', C.tz_by_booking_country)} AS ts
FROM trips"""))
def local_time_bookings(spark, sf):
    from ..functions.timefeat import local_time
    t = Tables(spark, sf)["trips"]
    return t.select("booking_id", "booking_country",
                    local_time("booking_creation_date", "booking_country",
                               C.tz_by_booking_country).alias("ts"))


# --- places and profiles ----------------------------------------------------

@register("location_key", oracle(("trips",), f"""
SELECT booking_id, {S.loc_key('pickup_lat', 'pickup_long')} AS pickup,
       {S.loc_key('dropoff_lat', 'dropoff_long')} AS dropoff FROM trips"""))
def location_key_q(spark, sf):
    t = Tables(spark, sf)["trips"]
    return t.select("booking_id", location_key("pickup_lat", "pickup_long").alias("pickup"),
                    location_key("dropoff_lat", "dropoff_long").alias("dropoff"))


def _ride_parts(spark, sf):
    T = Tables(spark, sf)
    base = B.ride_base_bookings(T["trips"], D, C)
    quant = B.customer_quantiles(base, distinct=False)
    bk = FT.keyed_bookings(base, quant, C.percentile, True)
    freq = FT.frequent_locations(bk, C.min_bookings_per_location, True)
    locmap = FT.location_map(freq, C.min_locations_ride)
    return T, base, quant, bk, freq, locmap


_RIDE = S.ride_base_ctes(C, D) + "," + S.ride_location_ctes(C)


@register("frequent_locations", oracle(("trips",), _RIDE + """
SELECT customer_id, location, num_bookings FROM freq"""))
def frequent_locations_q(spark, sf):
    return _ride_parts(spark, sf)[4].select("customer_id", "location", "num_bookings")


@register("frequent_location_map", oracle(("trips",), _RIDE + """
SELECT customer_id, locations, n_locations FROM locs"""))
def frequent_location_map_q(spark, sf):
    lm = _ride_parts(spark, sf)[5]
    return lm.select("customer_id", canon_map("locations").alias("locations"), "n_locations")


@register("frequent_dropoff_history", oracle(("trips",), _RIDE + """
SELECT booking_id, customer_id, dropoff FROM hist"""))
def frequent_dropoff_history_q(spark, sf):
    T, base, quant, bk, freq, locmap = _ride_parts(spark, sf)
    return FT.frequent_dropoff_history(bk, freq, locmap).select("booking_id", "customer_id", "dropoff")


@register("week_profile", oracle(("trips",), _RIDE + "," + S.profile_cte("week", "hist", "isodow(ts)", "week_stats") + """
SELECT customer_id, week_stats FROM week"""))
def week_profile_q(spark, sf):
    T, base, quant, bk, freq, locmap = _ride_parts(spark, sf)
    w = FT.week_profile(FT.frequent_dropoff_history(bk, freq, locmap))
    return w.select("customer_id", canon_map("week_stats").alias("week_stats"))


@register("hour_profile", oracle(("trips",), _RIDE + "," + S.profile_cte("hr", "hist", "hour(ts)", "hour_stats") + """
SELECT customer_id, hour_stats FROM hr"""))
def hour_profile_q(spark, sf):
    T, base, quant, bk, freq, locmap = _ride_parts(spark, sf)
    h = FT.hour_profile(FT.frequent_dropoff_history(bk, freq, locmap))
    return h.select("customer_id", canon_map("hour_stats").alias("hour_stats"))


@register("hour_unpivot", oracle(("trips",), _RIDE + """
SELECT customer_id, hour(ts) AS hour, count(DISTINCT booking_id) AS num_trips
FROM hist GROUP BY customer_id, hour(ts)"""))
def hour_unpivot_q(spark, sf):
    """Long form of the hour histogram (map exploded back to rows)."""
    T, base, quant, bk, freq, locmap = _ride_parts(spark, sf)
    h = FT.hour_profile(FT.frequent_dropoff_history(bk, freq, locmap))
    return h.select("customer_id", F.explode("hour_stats").alias("hour", "num_trips"))


# --- transactions -----------------------------------------------------------

_RIDES_TXN = ("SELECT customer_id AS userid, CAST(booking_id AS VARCHAR) AS transaction_id, "
              "'ride_hailing' AS service FROM base")
_TXN = S.ride_base_ctes(C, D) + "," + S.txn_cte(C, D, _RIDES_TXN)


@register("txn_union", oracle(_TXN_VIEWS, _TXN + """
SELECT service, count(*) AS n_rows, count(DISTINCT userid) AS n_users,
       count(DISTINCT transaction_id) AS n_txn FROM txn GROUP BY service"""))
def txn_union_q(spark, sf):
    t = TX.transactions(Tables(spark, sf), D, C)
    return t.groupBy("service").agg(F.count(F.lit(1)).alias("n_rows"),
                                    F.countDistinct("userid").alias("n_users"),
                                    F.countDistinct("transaction_id").alias("n_txn"))


@register("txn_by_service", oracle(_TXN_VIEWS, _TXN + """
SELECT userid, service, trx_amt FROM txn_service"""))
def txn_by_service_q(spark, sf):
    return (TX.txn_by_service(TX.transactions(Tables(spark, sf), D, C))
            .select("userid", "service", "trx_amt"))


@register("txn_preaggregated_branch", oracle(_TXN_VIEWS, _TXN + """
SELECT userid, service, trx_amt FROM bike"""))
def txn_preaggregated_branch_q(spark, sf):
    return TX.bike_branch(Tables(spark, sf), D, C).select("userid", "service", "trx_amt")


@register("txn_features", oracle(_TXN_VIEWS, _TXN + """
SELECT customer_id, trx_amt FROM trx"""))
def txn_features_q(spark, sf):
    return TX.txn_features(Tables(spark, sf), D, C).select("customer_id", "trx_amt")


@register("null_or_less", oracle(("p2p", "pilot_users"), f"""
SELECT p.sender_id AS userid, p.transaction_id FROM p2p p
LEFT JOIN pilot_users pu ON pu.user_id = p.sender_id
WHERE {S.window('p.day', D, C.history_horizon)}
  AND (pu.cash_out_invite_id IS NULL OR pu.cash_out_invite_id < 1)
  AND p.transaction_status_id = 1 AND p.country IN {S.lst(C.event_countries)}"""))
def null_or_less_q(spark, sf):
    return TX._p2p(Tables(spark, sf), D, C, {}).select("userid", "transaction_id")


@register("partner_id_join", oracle(("partner_txn", "partner_map"), f"""
SELECT CAST(pm.sub AS BIGINT) AS userid, a.appointment_ref_code AS transaction_id
FROM partner_txn a JOIN partner_map pm ON pm.identifier = a.partner_customer_id
WHERE {S.window('CAST(a.booking_creation_date AS DATE)', D, C.history_horizon)}
  AND lower(a.order_status) = 'order completed'"""))
def partner_id_join_q(spark, sf):
    return TX._laundry(Tables(spark, sf), D, C, {}).select("userid", "transaction_id")


@register("service_case_map", oracle(("mkt_orders",), """
SELECT merchant_name, order_type,
       CASE WHEN lower(merchant_name) LIKE '%quik%' THEN 'quik'
            WHEN lower(order_type) IN ('box', 'anything') THEN 'delivery'
            ELSE order_type END AS service,
       count(*) AS n_rows
FROM mkt_orders GROUP BY ALL"""))
def service_case_map_q(spark, sf):
    o = Tables(spark, sf)["mkt_orders"]
    return (o.groupBy("merchant_name", "order_type", TX.order_service().alias("service"))
             .agg(F.count(F.lit(1)).alias("n_rows")))


# --- saved places and assembly ---------------------------------------------

@register("saved_places_latest", oracle(("trips", "bookmarks", "location_master"), _RIDE + ","
                                        + S.saved_cte(D, "SELECT customer_id FROM locs", SAVED_MIN_YEAR)
                                        + """
SELECT customer_id, home_work_coords FROM saved"""))
def saved_places_latest_q(spark, sf):
    T, base, quant, bk, freq, locmap = _ride_parts(spark, sf)
    s = FT.saved_places(T, D, C, locmap.select("valid_date", "customer_id"), SAVED_MIN_YEAR)
    return s.select("customer_id", saved_canon().alias("home_work_coords"))


def ride_features_body(date: str) -> str:
    """CTEs and SELECT of the ride feature rows of one date (maps as canonical text)."""
    return (
        S.ride_base_ctes(C, date) + "," + S.ride_location_ctes(C) + ","
        + S.profile_cte("week", "hist", "isodow(ts)", "week_stats") + ","
        + S.profile_cte("hr", "hist", "hour(ts)", "hour_stats") + ","
        + S.txn_cte(C, date, _RIDES_TXN) + ","
        + S.saved_cte(date, "SELECT customer_id FROM locs", SAVED_MIN_YEAR) + f"""
SELECT '{date}' AS valid_date, 'rh' AS service, l.customer_id, q.num_trips, q.quantile,
       t.trx_amt, w.week_stats, h.hour_stats, l.locations, s.home_work_coords
FROM locs l
LEFT JOIN week w ON l.customer_id = w.customer_id
LEFT JOIN hr h ON l.customer_id = h.customer_id
LEFT JOIN trx t ON l.customer_id = t.customer_id
LEFT JOIN quant q ON l.customer_id = q.customer_id
LEFT JOIN saved s ON l.customer_id = s.customer_id
WHERE w.week_stats IS NOT NULL AND h.hour_stats IS NOT NULL""")


RIDE_FEATURE_VIEWS = _TXN_VIEWS + ("bookmarks", "location_master")
_FEATURES_RIDE_SQL = oracle(RIDE_FEATURE_VIEWS, ride_features_body(D))


def render_ride_features(df):
    return df.select("valid_date", "service", "customer_id", "num_trips", "quantile", "trx_amt",
                     canon_map("week_stats").alias("week_stats"),
                     canon_map("hour_stats").alias("hour_stats"),
                     canon_map("locations").alias("locations"),
                     saved_canon().alias("home_work_coords"))


@register("features_ride", _FEATURES_RIDE_SQL)
def features_ride_q(spark, sf):
    return render_ride_features(FT.ride_features(Tables(spark, sf), D, C, SAVED_MIN_YEAR))


def _food_base(date: str) -> str:
    return f"""
fo0 AS (SELECT * FROM mkt_orders
        WHERE {S.window('day', date, C.history_horizon)} AND order_status = 'delivered'
          AND order_type = 'food' AND country IN {S.lst(C.event_countries)}
          AND drop_off_latitude <> 0 AND drop_off_longitude <> 0 AND order_id IS NOT NULL),
fbase AS (SELECT order_id AS booking_id, customer_id,
                 {S.local_ts('booking_creation_timestamp', 'country', C.tz_by_country)} AS ts,
                 drop_off_latitude AS dropoff_lat, drop_off_longitude AS dropoff_long
          FROM (SELECT *, row_number() OVER (PARTITION BY customer_id, order_id
                                             ORDER BY booking_creation_timestamp) AS rn FROM fo0) x
          WHERE rn = 1),
fcnt AS (SELECT customer_id, count(booking_id) AS num_orders FROM fbase GROUP BY customer_id),
fquant AS (SELECT customer_id, num_orders,
                  {S.round2('percent_rank() OVER (ORDER BY num_orders)')} AS quantile FROM fcnt),
fbk AS (SELECT b.booking_id, b.customer_id, b.ts,
               {S.loc_key('b.dropoff_lat', 'b.dropoff_long')} AS dropoff
        FROM fbase b JOIN fquant q ON b.customer_id = q.customer_id WHERE q.quantile >= {C.percentile}),
ffreq AS (SELECT customer_id, dropoff AS location, count(DISTINCT booking_id) AS num_bookings
          FROM fbk GROUP BY customer_id, dropoff
          HAVING count(DISTINCT booking_id) >= {C.min_bookings_per_location}),
flocs AS (SELECT customer_id,
                 string_agg(location || '=' || CAST(num_bookings AS VARCHAR), ';' ORDER BY location)
                     AS locations
          FROM ffreq GROUP BY customer_id HAVING count(*) >= {C.min_locations_food}),
fhist AS (SELECT * FROM fbk WHERE customer_id IN (SELECT customer_id FROM flocs))"""


def _food_rides(date: str) -> str:
    return f"""SELECT DISTINCT customer_id AS userid, CAST(booking_id AS VARCHAR) AS transaction_id,
         'ride_hailing' AS service
  FROM trips WHERE customer_id IN (SELECT customer_id FROM flocs)
    AND {S.window('day', date, C.history_horizon)}
    AND service_area_id IN {S.lst(C.food_service_area_ids)}
    AND {S.ride_filter(C, ended=True, intercity_later=False)}"""


def food_features_body(date: str) -> str:
    """CTEs and SELECT of the food feature rows of one date (maps as canonical text)."""
    return (
        _food_base(date) + ","
        + S.profile_cte("fweek", "fhist", "isodow(ts)", "week_stats") + ","
        + S.profile_cte("fhour", "fhist", "hour(ts)", "hour_stats") + ","
        + S.txn_cte(C, date, _food_rides(date), food=True) + f"""
SELECT '{date}' AS valid_date, l.customer_id, q.num_orders, q.quantile, t.trx_amt,
       w.week_stats, h.hour_stats, l.locations
FROM flocs l
LEFT JOIN fweek w ON l.customer_id = w.customer_id
LEFT JOIN fhour h ON l.customer_id = h.customer_id
LEFT JOIN trx t ON l.customer_id = t.customer_id
LEFT JOIN fquant q ON l.customer_id = q.customer_id""")


@register("features_food", oracle(_TXN_VIEWS, food_features_body(D)))
def features_food_q(spark, sf):
    f = FT.food_features(Tables(spark, sf), D, C)
    return f.select("valid_date", "customer_id", "num_orders", "quantile", "trx_amt",
                    canon_map("week_stats").alias("week_stats"),
                    canon_map("hour_stats").alias("hour_stats"),
                    canon_map("locations").alias("locations"))


@register("txn_union_food", oracle(_TXN_VIEWS, _food_base(D) + "," + S.txn_cte(C, D, _food_rides(D), food=True) + """
SELECT service, count(*) AS n_rows, count(DISTINCT userid) AS n_users,
       count(DISTINCT transaction_id) AS n_txn FROM txn GROUP BY service"""))
def txn_union_food_q(spark, sf):
    T = Tables(spark, sf)
    base = FT.food_base_orders(T, D, C)
    quant = B.customer_quantiles(base, distinct=False, out_col="num_orders")
    bookings = FT.keyed_bookings(base, quant, C.percentile, with_pickup=False)
    freq = FT.frequent_locations(bookings, C.min_bookings_per_location, with_pickup=False)
    customers = FT.location_map(freq, C.min_locations_food).select("valid_date", "customer_id")
    t = TX.transactions(T, D, C, TX.FOOD_BRANCHES, {"customers": customers, "food_base": base})
    return t.groupBy("service").agg(F.count(F.lit(1)).alias("n_rows"),
                                    F.countDistinct("userid").alias("n_users"),
                                    F.countDistinct("transaction_id").alias("n_txn"))
