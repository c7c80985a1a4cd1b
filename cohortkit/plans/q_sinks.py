"""Queries of sinks and jobs: JSON columns, quoted names, the training table and
the extraction job. What is written goes to the shared checkpoint folder."""

from __future__ import annotations

import datetime as _dt
import uuid

from pyspark.sql import functions as F

from ..functions import jsoncols as JC
from ..functions.profiles import canon_map, smooth_hours
from ..operators import extract as X
from ..operators import features as FT
from ..session import checkpoint_dir
from ..sources import names as NM
from ..sources import training as TR
from ..sources.fixtures import Tables
from . import sqlfrag as S
from .q_features import (_RIDE, _TXN_VIEWS, RIDE_FEATURE_VIEWS, _ride_parts, food_features_body, ride_features_body)
from .q_sessions import _VIEWS, _session_ctes
from .registry import FEATURE_DATE, FIX_CFG, SAVED_MIN_YEAR, oracle, register, saved_canon

D, C = FEATURE_DATE, FIX_CFG


def scratch(spark, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _profiles(spark, sf):
    _, _, _, bk, freq, locmap = _ride_parts(spark, sf)
    hist = FT.frequent_dropoff_history(bk, freq, locmap)
    return FT.week_profile(hist), FT.hour_profile(hist), locmap


def _json_cte(name: str, key: str, order: str = "k") -> str:
    return f"""
{name} AS (SELECT customer_id, '{{' || string_agg('"' || CAST(k AS VARCHAR) || '":' || CAST(n AS VARCHAR), ',' ORDER BY {order}) || '}}' AS text
  FROM (SELECT customer_id, {key} AS k, count(DISTINCT booking_id) AS n FROM hist GROUP BY ALL) GROUP BY customer_id)"""


@register("json_map_render", oracle(("trips",), _RIDE + "," + _json_cte("w", "isodow(ts)") + "," + _json_cte("h", "hour(ts)") + """,
l AS (SELECT customer_id, '{' || string_agg('"' || location || '":' || CAST(num_bookings AS VARCHAR), ',' ORDER BY location) || '}' AS text
  FROM freq GROUP BY customer_id)
SELECT locs.customer_id, w.text AS week_stats, h.text AS hour_stats, l.text AS locations
FROM locs JOIN w USING (customer_id) JOIN h USING (customer_id) JOIN l USING (customer_id)"""))
def json_map_render_q(spark, sf):
    """The maps of the feature rows as JSON text, keys in a stable order."""
    week, hour, locmap = _profiles(spark, sf)
    j = locmap.join(week, ["valid_date", "customer_id"]).join(hour, ["valid_date", "customer_id"])
    return j.select("customer_id", *[JC.map_to_json(c).alias(c) for c in ("week_stats", "hour_stats", "locations")])


@register("json_map_parse", oracle(("trips",), _RIDE + """,
n AS (SELECT customer_id, hour(ts) AS k, count(DISTINCT booking_id) AS n FROM hist GROUP BY ALL),
keys AS (SELECT DISTINCT k FROM n)
SELECT c.customer_id, 'hour_' || CAST(keys.k AS VARCHAR) AS name, CAST(n.n AS DOUBLE) AS value
FROM (SELECT DISTINCT customer_id FROM n) c CROSS JOIN keys LEFT JOIN n ON n.customer_id = c.customer_id AND n.k = keys.k"""))
def json_map_parse_q(spark, sf):
    """JSON text to one column a key that occurs anywhere, and back to rows."""
    _, hour, _ = _profiles(spark, sf)
    text = hour.select("customer_id", JC.map_to_json("hour_stats").alias("hour_stats"))
    flat = JC.unnest_json(text, "hour_stats", "hour_")
    names = [c for c in flat.columns if c != "customer_id"]
    return flat.unpivot(["customer_id"], names, "name", "value")


@register("hours_json", oracle(("trips",), _RIDE + """,
n AS (SELECT customer_id, hour(ts) AS h, count(DISTINCT booking_id) AS n FROM hist GROUP BY ALL),
g AS (SELECT c.customer_id, r.h, sum(n.n) AS s FROM (SELECT DISTINCT customer_id FROM n) c CROSS JOIN range(24) r(h)
      LEFT JOIN n ON n.customer_id = c.customer_id AND n.h IN (r.h, (r.h + 1) % 24, (r.h + 23) % 24) GROUP BY ALL)
SELECT customer_id, '{' || string_agg('"' || CAST(h AS VARCHAR) || '":' || CAST(coalesce(s, 0) AS VARCHAR), ',' ORDER BY h) || '}' AS hours
FROM g GROUP BY customer_id"""))
def hours_json_q(spark, sf):
    """The smoothed hours of a row as one JSON object, hours in order."""
    _, hour, _ = _profiles(spark, sf)
    smooth = hour.select("customer_id", smooth_hours("hour_stats").alias("m"))
    return smooth.select("customer_id", JC.row_to_json({str(h): F.element_at("m", F.lit(h)) for h in range(24)}).alias("hours"))


@register("quoted_columns", oracle(("partner_txn", "partner_map"), """
SELECT CAST(m.sub AS BIGINT) AS userid, t.order_status, count(*) AS n_rows
FROM partner_txn t JOIN partner_map m ON m.identifier = t.partner_customer_id GROUP BY ALL"""))
def quoted_columns_q(spark, sf):
    """A source whose names hold spaces, dots and quotes."""
    t = Tables(spark, sf)
    path = scratch(spark, "quoted")
    odd = {"partner_customer_id": "Partner Customer ID", "order_status": "Order.Status", "appointment_ref_code": "Ref `Code` (new)",
           "booking_creation_date": "booking creation.date"}
    t["partner_txn"].select(*[F.col(c).alias(n) for c, n in odd.items()]).write.parquet(path)
    rows = NM.select_mapped(spark.read.parquet(path), {"Partner Customer ID": "identifier", "Order.Status": "order_status"})
    j = rows.join(t["partner_map"], "identifier")
    return j.groupBy(F.col("sub").cast("long").alias("userid"), "order_status").agg(F.count("*").alias("n_rows"))


@register("training_sink_roundtrip", oracle(("scored",), """
SELECT sessionuuid, CAST(valid_date AS VARCHAR) AS valid_date, score, target, is_freq FROM scored WHERE rh = 1"""))
def training_sink_roundtrip_q(spark, sf):
    """Two versions of a training table; the latest is read, its schema checked.
    The test rows spread over years, so a year is a partition here."""
    rows = Tables(spark, sf)["scored"].select("sessionuuid", "valid_date", "score", "target", "is_freq", "rh", F.year("valid_date").alias("year"))
    path = scratch(spark, "training")
    TR.write_training(rows.where("rh = 0"), path, "year")
    TR.write_training(rows.where("rh = 1").drop("rh"), path, "year")
    back = TR.read_training(spark, path, expect=rows.drop("rh").schema)
    return back.withColumn("valid_date", F.col("valid_date").cast("string")).drop("year")


@register("features_sink_roundtrip", oracle(RIDE_FEATURE_VIEWS, ride_features_body(D)))
def features_sink_roundtrip_q(spark, sf):
    """Feature rows with JSON maps through the daily sink and back."""
    job = X.ExtractionJob(D, 1, scratch(spark, "features"), history_horizon=C.history_horizon, percentile=C.percentile,
                          include_sessions=False, saved_min_year=SAVED_MIN_YEAR)
    X.extract(Tables(spark, sf), job, C)
    rows = X.extracted(spark, job, "features")
    return rows.select("valid_date", "service", "customer_id", "num_trips", "quantile", "trx_amt",
                       *[canon_map(c).alias(c) for c in ("week_stats", "hour_stats", "locations")], saved_canon().alias("home_work_coords"))


_DAYS = [_dt.date.fromisoformat(D) - _dt.timedelta(days=k) for k in (1, 0)]


def _nested(body: str) -> str:
    return f"(WITH {body.strip()})"


@register("extract_job", oracle(tuple(dict.fromkeys(_VIEWS + RIDE_FEATURE_VIEWS + _TXN_VIEWS)), _session_ctes(_DAYS) + ",\n" + f"""
ride AS ({" UNION ALL ".join(f"SELECT * FROM {_nested(ride_features_body(d.isoformat()))} r{i}" for i, d in enumerate(_DAYS))}),
eats AS (SELECT * FROM {_nested(food_features_body(D))} f)
SELECT 'ride' AS service, 'features' AS kind, valid_date, customer_id, num_trips AS n, trx_amt, week_stats AS detail FROM ride
UNION ALL SELECT 'food', 'features', valid_date, customer_id, num_orders, trx_amt, week_stats FROM eats
UNION ALL SELECT 'ride', 'sessions', valid_date, customer_id, count(*), CAST(NULL AS BIGINT), max(sessionuuid) FROM clean GROUP BY valid_date, customer_id"""))
def extract_job_q(spark, sf):
    """Both services through the extraction job; the ride job is run for a
    first day, and then for two, of which it extracts the second alone."""
    T = Tables(spark, sf)
    common = {"path": scratch(spark, "extract"), "history_horizon": C.history_horizon, "percentile": C.percentile, "saved_min_year": SAVED_MIN_YEAR}
    first = X.ExtractionJob(_DAYS[0], 1, **common)
    ride = X.ExtractionJob(_DAYS[1], 2, **common)
    food = X.ExtractionJob(_DAYS[1], 1, service="food", include_sessions=False, **common)
    X.extract(T, first, C)
    if X.extract(T, ride, C) != [("features", _DAYS[1]), ("sessions", _DAYS[1])]:
        raise AssertionError("a finished day was extracted again")
    X.extract(T, food, C)

    def rows(job, kind, n, trx, detail):
        return X.extracted(spark, job, kind).select(
            F.lit(job.service).alias("service"), F.lit(kind).alias("kind"), "valid_date", F.col("customer_id").cast("long").alias("customer_id"),
            n.alias("n"), trx.alias("trx_amt"), detail.alias("detail"))

    s = X.extracted(spark, ride, "sessions").groupBy("valid_date", "customer_id").agg(F.count("*").alias("n"), F.max("sessionuuid").alias("detail"))
    return (rows(ride, "features", F.col("num_trips"), F.col("trx_amt"), canon_map("week_stats"))
            .unionByName(rows(food, "features", F.col("num_orders"), F.col("trx_amt"), canon_map("week_stats")))
            .unionByName(s.select(F.lit("ride").alias("service"), F.lit("sessions").alias("kind"), "valid_date",
                                  F.col("customer_id").cast("long").alias("customer_id"), "n", F.lit(None).cast("long").alias("trx_amt"), "detail")))
