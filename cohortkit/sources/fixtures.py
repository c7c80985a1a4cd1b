"""Adapter views that map the driver's TPC-H-like tables onto the logical
inputs of the pipeline (bookings, app events, payments, saved places, ...).

Each view is ONE SQL text with ``{table}`` placeholders, run by Spark (tables
passed as DataFrames to ``spark.sql``) and by the DuckDB oracle (placeholders
replaced by view names, text used as a CTE). Both engines therefore see the
same inputs; only a few dialect slots differ (``_DIALECT``).

All derived values use integer arithmetic and correctly rounded division so
the two engines produce bit-identical doubles.
"""

from __future__ import annotations


from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
               "lineitem", "events")

# days subtracted from event timestamps so the 30 event days (2024-01-01..30)
# line up with the last 30 booking days (2001-07-03..2001-08-01)
EVENT_SHIFT_DAYS = 8217

_DIALECT = {
    "spark": {"epoch_ms": "unix_millis(CAST({x} AS TIMESTAMP))",
              "repeat": "explode(CASE WHEN {x} THEN array(0, {n}) ELSE array(0) END)"},
    "duckdb": {"epoch_ms": "(epoch_us({x}) // 1000)",
               "repeat": "unnest(CASE WHEN {x} THEN [0, {n}] ELSE [0] END)"},
}

# Country of a customer / user id: 0 -> UAE, 1 -> Jordan, 2 -> outside.
_BOOKING_COUNTRY = "CASE {k} % 3 WHEN 0 THEN 'UAE' WHEN 1 THEN 'Jordan' ELSE 'Egypt' END"
_EVENT_COUNTRY = ("CASE {k} % 3 WHEN 0 THEN 'United Arab Emirates' WHEN 1 THEN 'Jordan' "
                  "ELSE 'Egypt' END")
# base coordinates in 1/10000 degree
_LAT0 = "CASE {k} % 3 WHEN 1 THEN 319500 WHEN 2 THEN 300500 ELSE 250000 END"
_LON0 = "CASE {k} % 3 WHEN 1 THEN 359100 WHEN 2 THEN 312300 ELSE 550000 END"
_SERVICE_AREA = ("CASE {k} % 10 WHEN 0 THEN 1 WHEN 1 THEN 21 WHEN 2 THEN 64 WHEN 3 THEN 68 "
                 "WHEN 4 THEN 111 WHEN 5 THEN 87 WHEN 6 THEN 49 WHEN 7 THEN 47 WHEN 8 THEN 5 "
                 "ELSE 9 END")


def _f(t: str, **kw) -> str:
    return t.format(**kw)


VIEWS: dict[str, tuple[tuple[str, ...], str]] = {}

# ride bookings: one row per order, plus a late duplicate row for 1 in 23
_trips_base = """
SELECT o.o_orderkey + 1 AS booking_id,
       o.o_custkey AS customer_id,
       o.o_orderdate + INTERVAL 1 MINUTE * ((o.o_orderkey * 37) % 1440) AS booking_creation_date,
       CAST(o.o_orderdate AS DATE) AS day,
       {country} AS booking_country,
       CASE o.o_orderkey % 8 WHEN 0 THEN 'Go' WHEN 1 THEN 'Go+' WHEN 2 THEN 'Business'
            WHEN 3 THEN 'Food Courier' WHEN 4 THEN 'Comfort' WHEN 5 THEN 'Quik Box'
            WHEN 6 THEN 'Hala Taxi' ELSE 'Max 4hrs' END AS cct_name,
       o.o_orderstatus <> 'P' AS is_trip_ended,
       (o.o_orderkey % 17 = 0) AS is_intercity,
       (o.o_orderkey % 11 = 0) AS is_later,
       CAST({lat0} + 100 * (o.o_orderkey % 4) AS DOUBLE) / 10000 AS pickup_lat,
       CAST({lon0} + 100 * (o.o_orderkey % 4) AS DOUBLE) / 10000 AS pickup_long,
       CASE WHEN o.o_orderkey % 13 = 0 THEN CAST(0 AS DOUBLE)
            ELSE CAST({lat0} + 100 * (CAST(floor(o.o_orderkey / 4) AS BIGINT) % 3) AS DOUBLE) / 10000
       END AS dropoff_lat,
       CASE WHEN o.o_orderkey % 13 = 0 THEN CAST(0 AS DOUBLE)
            ELSE CAST({lon0} + 100 * (CAST(floor(o.o_orderkey / 4) AS BIGINT) % 3) AS DOUBLE) / 10000
       END AS dropoff_long,
       CASE o.o_orderkey % 5 WHEN 4 THEN 'WEB' WHEN 2 THEN 'ICMA' WHEN 3 THEN 'ICMA' ELSE 'ACMA' END
           AS booking_platform,
       CASE WHEN o.o_orderkey % 29 = 0 THEN 'B2B' WHEN o.o_orderkey % 3 = 0 THEN 'jv'
            ELSE 'Ride Hailing' END AS business_type,
       {area} AS service_area_id
FROM {{orders}} o JOIN {{customer}} c ON o.o_custkey = c.c_custkey
""".format(country=_f(_BOOKING_COUNTRY, k="c.c_nationkey"), lat0=_f(_LAT0, k="c.c_nationkey"),
           lon0=_f(_LON0, k="c.c_nationkey"), area=_f(_SERVICE_AREA, k="o.o_orderkey"))

VIEWS["trips"] = (("orders", "customer"), f"""
SELECT booking_id, customer_id, booking_creation_date + INTERVAL 1 MINUTE * late AS booking_creation_date, day,
       booking_country, cct_name, is_trip_ended, is_intercity, is_later, pickup_lat, pickup_long, dropoff_lat,
       dropoff_long, booking_platform, business_type, service_area_id
FROM (SELECT b.*, {{rows_of_trip}} AS late FROM ({_trips_base}) b) d
""")

_COUNTRY_NAME = ("CASE t.booking_country WHEN 'UAE' THEN 'United Arab Emirates' "
                 "ELSE t.booking_country END")

# booking events of the two app platforms, derived from bookings; 1 in 9
# bookings is also seen on the other platform one minute later
_be = """
SELECT 'S' || CAST(t.customer_id AS STRING) || '-' || CAST(t.day AS STRING) AS sessionuuid,
       {epoch} AS timestamp,
       CAST(t.customer_id AS STRING) AS userid,
       CASE WHEN t.booking_id % 31 = 0 THEN ''
            WHEN t.booking_id % 2 = 0 THEN CAST(t.booking_id AS STRING) || '.0'
            ELSE CAST(t.booking_id AS STRING) END AS booking_id,
       CAST(CAST(round(t.pickup_lat * 10000) AS BIGINT) + 5 * (t.booking_id % 3) AS DOUBLE) / 10000 AS latitude,
       CAST(CAST(round(t.pickup_long * 10000) AS BIGINT) + 5 * (t.booking_id % 3) AS DOUBLE) / 10000 AS longitude,
       {country} AS country_name,
       CAST(t.service_area_id AS STRING) AS service_area_id,
       CASE WHEN (t.booking_id + {flip}) % 2 = 0 THEN 'android' ELSE 'ios' END AS platform,
       'book_ride' AS eventname,
       'ride_hailing' AS contentid,
       t.day AS date
FROM {{trips}} t
"""
_be_ts = "t.booking_creation_date - INTERVAL 1 MINUTE * (t.booking_id % 7) + INTERVAL 1 MINUTE * t.flip"

VIEWS["booking_events"] = (("trips",), _be.format(country=_COUNTRY_NAME, flip="t.flip", epoch="{epoch_ms0}").replace(
    "FROM {trips} t", "FROM (SELECT r.*, {rows_of_event} AS flip FROM {trips} r) t"))

# super-app events, derived from the event log, shifted onto the booking days
_shift = f"e.ts - INTERVAL {EVENT_SHIFT_DAYS} DAY"
VIEWS["superapp_events"] = (("events",), f"""
SELECT 'S' || CAST(e.user_id AS STRING) || '-' || CAST(CAST({_shift} AS DATE) AS STRING) AS sessionuuid,
       {{epoch_ms_e}} AS timestamp,
       CAST(e.user_id AS STRING) AS userid,
       CASE WHEN e.event_id % 41 = 0 THEN CAST(NULL AS DOUBLE)
            ELSE CAST({_f(_LAT0, k='e.user_id')} + 100 * (e.event_id % 4) + 5 * (e.event_id % 3)
                      + CASE WHEN e.event_id % 37 = 0 THEN 10000 ELSE 0 END AS DOUBLE) / 10000
       END AS latitude,
       CAST({_f(_LON0, k='e.user_id')} + 100 * (e.event_id % 4) + 5 * (e.event_id % 3) AS DOUBLE)
           / 10000 AS longitude,
       {_f(_EVENT_COUNTRY, k='e.user_id')} AS country_name,
       CAST({_f(_SERVICE_AREA, k='e.user_id')} AS STRING) AS service_area_id,
       CASE WHEN e.event_id % 2 = 0 THEN 'android' ELSE 'ios' END AS platform,
       CASE e.event_type WHEN 'click' THEN 'tap_service_tile' WHEN 'view' THEN 'launch_mini_app'
            WHEN 'purchase' THEN 'tap_widget_primary_cta' WHEN 'signup' THEN 'open_super_app'
            ELSE 'tap_hold_banner_card' END AS eventname,
       CASE e.event_id % 7 WHEN 0 THEN 'food' WHEN 1 THEN 'quik' WHEN 2 THEN 'pay_bills'
            WHEN 3 THEN 'bike' WHEN 4 THEN 'ride_hailing' WHEN 5 THEN 'shop' ELSE 'taxi' END
       || CASE e.event_id % 3 WHEN 0 THEN '' WHEN 1 THEN '_rebrand' ELSE '_rebranded' END AS contentid,
       CAST({_shift} AS DATE) AS date
FROM {{events}} e
""")

# marketplace orders: one per line item
VIEWS["mkt_orders"] = (("lineitem", "orders"), """
SELECT l.l_orderkey * 8 + l.l_linenumber AS order_id,
       l.l_orderkey + 1 AS booking_id,
       o.o_custkey AS customer_id,
       CAST(l.l_shipdate AS DATE) AS day,
       l.l_shipdate + INTERVAL 1 MINUTE * ((l.l_orderkey * 13 + l.l_linenumber * 7) % 1440)
           AS booking_creation_timestamp,
       {country} AS country,
       CASE WHEN l.l_linestatus = 'F' AND l.l_linenumber % 4 = 0 THEN 'Delivered'
            WHEN l.l_linestatus = 'F' THEN 'delivered' ELSE 'cancelled' END AS order_status,
       CASE WHEN l.l_partkey % 11 = 0 THEN 'anything' WHEN l.l_returnflag = 'N' THEN 'food'
            WHEN l.l_returnflag = 'A' THEN 'box' ELSE 'shop' END AS order_type,
       CASE WHEN l.l_partkey % 5 = 0 THEN 'Quik Mart'
            ELSE 'Store ' || CAST(l.l_partkey % 7 AS STRING) END AS merchant_name,
       CASE WHEN l.l_suppkey % 19 = 0 THEN CAST(0 AS DOUBLE)
            ELSE CAST({lat0} + 100 * (l.l_partkey % 3) AS DOUBLE) / 10000 END AS drop_off_latitude,
       CASE WHEN l.l_suppkey % 19 = 0 THEN CAST(0 AS DOUBLE)
            ELSE CAST({lon0} + 100 * (l.l_partkey % 3) AS DOUBLE) / 10000 END AS drop_off_longitude
FROM {{lineitem}} l JOIN {{orders}} o ON l.l_orderkey = o.o_orderkey
""".format(country=_f(_EVENT_COUNTRY, k="o.o_custkey"), lat0=_f(_LAT0, k="o.o_custkey"),
           lon0=_f(_LON0, k="o.o_custkey")))

# person-to-person transfers (purchase events)
VIEWS["p2p"] = (("events",), f"""
SELECT e.user_id AS sender_id,
       'T' || CAST(e.event_id AS STRING) AS transaction_id,
       CAST({_shift} AS DATE) AS day,
       CASE WHEN e.event_id % 5 = 0 THEN 2 ELSE 1 END AS transaction_status_id,
       {_f(_EVENT_COUNTRY, k='e.user_id')} AS country
FROM {{events}} e WHERE e.event_type = 'purchase'
""")

# cash-out pilot users (every tenth user; half of them invited)
VIEWS["pilot_users"] = (("customer",), """
SELECT c.c_custkey AS user_id,
       CASE WHEN c.c_custkey % 20 = 0 THEN 1 ELSE 0 END AS cash_out_invite_id
FROM {customer} c WHERE c.c_custkey % 10 = 0
""")

# bill payments (click events)
VIEWS["bills"] = (("events",), f"""
SELECT e.user_id AS customer_id,
       'B' || CAST(e.event_id AS STRING) AS transaction_id,
       CAST({_shift} AS DATE) AS transaction_date,
       CASE WHEN e.event_id % 6 = 0 THEN 0 ELSE 1 END AS successful_transactions
FROM {{events}} e WHERE e.event_type = 'click'
""")

# partner-tenant transactions keyed by the partner's customer identifier
VIEWS["partner_txn"] = (("orders",), """
SELECT 'P' || CAST(o.o_custkey AS STRING) AS partner_customer_id,
       'L' || CAST(o.o_orderkey AS STRING) AS appointment_ref_code,
       o.o_orderdate AS booking_creation_date,
       CASE o.o_orderstatus WHEN 'F' THEN 'Order Completed' ELSE 'open' END AS order_status
FROM {orders} o WHERE o.o_orderpriority = '3-MEDIUM'
""")

# home-services appointments, keyed by the partner's customer identifier
VIEWS["home_services"] = (("orders",), """
SELECT 'P' || CAST(o.o_custkey AS STRING) AS partner_customer_id,
       'H' || CAST(o.o_orderkey AS STRING) AS appointment_ref_code,
       o.o_orderdate AS appointment_create_date,
       CASE o.o_orderkey % 4 WHEN 0 THEN 'Duration: 2h' WHEN 1 THEN 'PCR at home' ELSE 'none' END
           AS appointment_attributes,
       CASE o.o_orderkey % 6 WHEN 0 THEN 'Home Cleaning' WHEN 2 THEN 'Premium Men Salon'
            WHEN 3 THEN 'Women Spa' WHEN 5 THEN 'PCR Test' ELSE 'Gardening' END AS service_type,
       CASE WHEN o.o_orderkey % 10 = 0 THEN 'Nurse Amal' ELSE 'Omar' END AS assigned_professional,
       CASE WHEN o.o_orderstatus = 'P' THEN 'Yes' ELSE 'No' END AS cancellation
FROM {orders} o WHERE o.o_orderpriority = '1-URGENT'
""")

# car rentals by the month and by the day
for _kind, _priority, _off in (("monthly", "2-HIGH", "Cancelled"), ("daily", "5-LOW", "Pending_Payment")):
    VIEWS[f"car_rental_{_kind}"] = (("orders",), f"""
SELECT 'P' || CAST(o.o_custkey AS STRING) AS partner_customer_id, o.o_orderkey AS booking_id,
       CAST(o.o_orderdate AS DATE) AS booked_date,
       CASE WHEN o.o_orderkey % 7 = 0 THEN '{_off}' WHEN o.o_orderkey % 7 = 1 THEN 'pending_approval'
            WHEN o.o_orderkey % 7 = 2 THEN 'failed' ELSE 'Completed' END AS status
FROM {{orders}} o WHERE o.o_orderpriority = '{_priority}'
""")

# tickets and passes
VIEWS["tickets"] = (("orders",), """
SELECT CAST(o.o_custkey AS STRING) AS user_id, 'K' || CAST(o.o_orderkey AS STRING) AS order_ref,
       CAST(o.o_orderdate AS DATE) AS txn_date,
       CASE o.o_orderstatus WHEN 'F' THEN 'Success' ELSE 'failed' END AS order_status
FROM {orders} o WHERE o.o_orderpriority = '4-NOT SPECIFIED'
""")

# partner identifier -> customer id mapping
VIEWS["partner_map"] = (("customer",), """
SELECT 'P' || CAST(c.c_custkey AS STRING) AS identifier, CAST(c.c_custkey AS STRING) AS sub
FROM {customer} c
""")

# remittances (signup and error events); 1 in 17 sender ids is not numeric
VIEWS["remittance"] = (("events",), f"""
SELECT CASE WHEN e.event_id % 17 = 0 THEN 'n/a' ELSE CAST(e.user_id AS STRING) END AS sender_user_id,
       'R' || CAST(e.event_id AS STRING) AS id,
       {_shift} AS created_at,
       CASE WHEN e.event_id % 4 = 0 THEN 'unpaid' ELSE 'PAID' END AS invoice_status,
       CASE e.event_id % 3 WHEN 0 THEN 'Completed' WHEN 1 THEN 'paid' ELSE 'failed' END AS status,
       CASE e.user_id % 3 WHEN 0 THEN 'AE' WHEN 1 THEN 'JO' ELSE 'EG' END AS sender_country
FROM {{events}} e WHERE e.event_type IN ('signup', 'error')
""")

# pre-aggregated daily bike statistics (view events per user and day)
VIEWS["bike_daily"] = (("events",), f"""
SELECT e.user_id AS customer_id, CAST({_shift} AS DATE) AS day,
       CAST(SUM(CASE WHEN e.event_type = 'view' THEN 1 ELSE 0 END) AS BIGINT) AS trip_cnt
FROM {{events}} e GROUP BY e.user_id, CAST({_shift} AS DATE)
""")

# saved-place bookmarks and the location master they point to
VIEWS["bookmarks"] = (("trips",), """
SELECT t.customer_id AS user_id, t.booking_id AS provider_id,
       t.booking_creation_date AS last_updated,
       CASE t.booking_country WHEN 'UAE' THEN 1 WHEN 'Jordan' THEN 19 ELSE 3 END AS country_id
FROM {trips} t WHERE t.booking_id % 7 IN (0, 1, 2)
""")

VIEWS["location_master"] = (("trips",), """
SELECT t.booking_id AS provider_reference_id, t.booking_creation_date AS last_updated,
       t.day AS date, year(t.day) AS year,
       t.dropoff_lat AS latitude, t.dropoff_long AS longitude,
       CASE t.booking_id % 5 WHEN 0 THEN 'Home - Marina' WHEN 1 THEN 'work tower'
            WHEN 2 THEN 'HOME' ELSE 'Gym' END AS search_display_name,
       CASE t.booking_country WHEN 'UAE' THEN 1 WHEN 'Jordan' THEN 19 ELSE 3 END AS country_id
FROM {trips} t
""")

# scored sessions for the evaluation operators: pseudo-random score in [0,1)
# with ties, and a label that agrees with it about two times in three
VIEWS["scored"] = (("orders",), """
SELECT 'S' || CAST(o.o_orderkey AS STRING) AS sessionuuid,
       o.o_custkey AS customer_id,
       CAST(o.o_orderdate AS DATE) AS valid_date,
       o.o_orderdate + INTERVAL 1 MINUTE * ((o.o_orderkey * 37) % 1440) AS ts,
       CAST((o.o_orderkey * 7919) % 10007 AS DOUBLE) / 10007 AS score,
       CASE WHEN CAST((o.o_orderkey * 104729) % 10009 AS DOUBLE) / 10009
                 < CAST((o.o_orderkey * 7919) % 10007 AS DOUBLE) / 10007 THEN 1 ELSE 0 END AS target,
       CASE WHEN CAST((o.o_orderkey * 104729) % 10009 AS DOUBLE) / 10009
                 < CAST((o.o_orderkey * 7919) % 10007 AS DOUBLE) / 10007 THEN 1 ELSE 0 END AS rh,
       CASE WHEN CAST((o.o_orderkey * 104729) % 10009 AS DOUBLE) / 10009
                 < CAST((o.o_orderkey * 7919) % 10007 AS DOUBLE) / 10007
                 AND o.o_orderkey % 3 > 0 THEN 1 ELSE 0 END AS is_freq,
       CASE WHEN o.o_orderstatus = 'P' THEN 0 ELSE 1 END AS is_trip_ended,
       CASE WHEN o.o_orderkey % 4 = 0 THEN 1 ELSE 0 END AS is_work
FROM {orders} o
""")


def _render(name: str, dialect: str) -> str:
    deps, text = VIEWS[name]
    d = _DIALECT[dialect]
    slots = {
        "epoch_ms0": d["epoch_ms"].format(x=_be_ts),
        "rows_of_trip": d["repeat"].format(x="b.booking_id % 23 = 0", n=3),
        "rows_of_event": d["repeat"].format(x="r.booking_id % 9 = 0", n=1),
        "epoch_ms_e": d["epoch_ms"].format(x=_shift),
    }
    for k, v in slots.items():
        text = text.replace("{" + k + "}", v)
    return text


def view_sql(name: str, dialect: str = "duckdb") -> str:
    """SQL text of a fixture view, with table names for the given dialect."""
    deps, _ = VIEWS[name]
    return _render(name, dialect).format(**{t: t for t in deps})


def oracle_with(*names: str) -> str:
    """``WITH`` prefix defining the given fixture views (and their
    dependencies) for DuckDB; append the query body after it."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order or n not in VIEWS:
            return
        for dep in VIEWS[n][0]:
            visit(dep)
        order.append(n)

    for n in names:
        visit(n)
    parts = [f"{n} AS ({view_sql(n, 'duckdb')})" for n in order]
    return "WITH " + ",\n".join(parts) + "\n" if parts else ""


class Tables:
    """Loader for base tables and fixture views of one scale-factor folder.

    Base tables are plain parquet scans and fixture views lazy SQL over them, so
    that filters and column pruning reach the scans of every query.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._cache: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._cache:
            if name in VIEWS:
                deps, _ = VIEWS[name]
                text = _render(name, "spark")
                self._cache[name] = self.spark.sql(text, **{d: self[d] for d in deps})
            else:
                self._cache[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._cache[name]

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self[name]
