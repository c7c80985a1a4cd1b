"""Cross-service transaction counts: a declarative list of source branches,
each mapped to (userid, transaction_id, service), unioned by name, counted
distinct per (user, service) and summed per user, plus the pre-aggregated
bike branch."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from typing import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import DAILY_RENTAL_OFF, MONTHLY_RENTAL_OFF, WELLNESS_PATTERNS, EngineConfig
from ..functions.predicates import null_or_less
from .bookings import fan_out, ride_base_bookings, ride_filters
from .history import ride_booking_spans
from .spans import FROM, TO, by_date, distinct_spans, spanned

TXN_COLS = ("userid", "transaction_id", "service")


@dataclass(frozen=True)
class Branch:
    name: str
    build: Callable  # (tables, date, cfg, ctx) -> DataFrame[TXN_COLS]


def _placed(df: DataFrame, day, date, cfg: EngineConfig, ctx: dict) -> DataFrame:
    """Rows of the history windows: with the span of dates they count for where the
    caller asks for spans, else copied to each valid date."""
    return (spanned if ctx.get("spans") else fan_out)(df, day, date, cfg.history_horizon)


def _of_customers(df: DataFrame, ctx: dict) -> DataFrame:
    """Rows of the customers that have frequent places: at the row's date, or (spans)
    at any date; the feature rows are joined by customer and date later."""
    if ctx.get("spans"):
        return df.join(ctx["customers"].select("customer_id").distinct(), "customer_id", "left_semi")
    return df.join(ctx["customers"], ["valid_date", "customer_id"], "left_semi")


def _out(df: DataFrame, user, txn, service) -> DataFrame:
    when = [c for c in ("valid_date", FROM, TO) if c in df.columns]
    return df.select(*when, user.cast("long").alias("userid"),
                     txn.cast("string").alias("transaction_id"), service.alias("service"))


def order_service(merchant="merchant_name", order_type="order_type"):
    """CASE order type -> service: quick-commerce merchant first, box/anything
    deliveries, otherwise the order type itself."""
    return (F.when(F.lower(F.col(merchant)).contains("quik"), F.lit("quik"))
             .when(F.lower(F.col(order_type)).isin("box", "anything"), F.lit("delivery"))
             .otherwise(F.col(order_type)))


def _rides(T, date, cfg, ctx):
    base = ctx.get("base_bookings")
    if base is None:
        base = ride_base_bookings(T["trips"], date, cfg)
    return _out(base, F.col("customer_id"), F.col("booking_id"), F.lit("ride_hailing"))


def _rides_food(T, date, cfg, ctx):
    """Food program's ride branch: any ended ride in the service-area list of
    customers that have frequent places (no intercity/scheduled exclusion)."""
    t = T["trips"].filter(ride_filters(cfg, ended=True, intercity_later=False)
                          & F.col("service_area_id").isin(*cfg.food_service_area_ids))
    t = _of_customers(_placed(t, "day", date, cfg, ctx), ctx)
    return _out(t, F.col("customer_id"), F.col("booking_id"), F.lit("ride_hailing")).distinct()


def appointment_service(attributes="appointment_attributes", kind="service_type",
                        professional="assigned_professional"):
    """CASE home-services appointment -> service, first rule that holds."""
    has = lambda c, *ps: reduce(lambda x, y: x | y, [F.lower(F.col(c)).like(p) for p in ps])
    return (F.when(has(attributes, "%duration%") | has(kind, "%home cleaning%"), F.lit("justmop"))
             .when(has(attributes, "%pcr%") | has(kind, "%pcr%") | has(professional, "%nurse%"), F.lit("pcr"))
             .when(has(kind, *WELLNESS_PATTERNS), F.lit("wellness"))
             .otherwise(F.lit("na")))


def _food(T, date, cfg, ctx):
    """Food program only: its own base orders."""
    return _out(ctx["food_base"], F.col("customer_id"), F.col("booking_id"), F.lit("food"))


def _orders(T, date, cfg, ctx):
    """Delivered marketplace orders, by their booking id."""
    o = T["mkt_orders"].filter(F.col("country").isin(*cfg.event_countries)
                               & (F.lower("order_status") == "delivered"))
    o = _placed(o, "day", date, cfg, ctx)
    return _out(o, F.col("customer_id"), F.col("booking_id"), order_service())


def _orders_but_food(T, date, cfg, ctx):
    """Food program: orders of its customers, food left to the food branch."""
    o = T["mkt_orders"].filter(F.col("country").isin(*cfg.event_countries)
                               & (F.lower("order_status") == "delivered") & (F.col("order_type") != "food"))
    o = _of_customers(_placed(o, "day", date, cfg, ctx), ctx)
    return _out(o, F.col("customer_id"), F.col("booking_id"), order_service())


def _p2p(T, date, cfg, ctx):
    p = T["p2p"].filter((F.col("transaction_status_id") == 1)
                        & F.col("country").isin(*cfg.event_countries))
    p = _placed(p, "day", date, cfg, ctx)
    pilots = T["pilot_users"].select("user_id", "cash_out_invite_id")
    p = (p.join(pilots, p.sender_id == pilots.user_id, "left")
          .filter(null_or_less("cash_out_invite_id", 1)))
    return _out(p, F.col("sender_id"), F.col("transaction_id"), F.lit("send_money"))


def _bills(T, date, cfg, ctx):
    b = _placed(T["bills"].filter(F.col("successful_transactions") == 1), "transaction_date", date, cfg, ctx)
    return _out(b, F.col("customer_id"), F.col("transaction_id"), F.lit("pay_bills"))


def _tenant(view, day, keep, txn, service):
    """A partner tenant's branch: its customers get their ids from the map."""
    def build(T, date, cfg, ctx):
        a = _placed(T[view].filter(keep()), F.to_date(day), date, cfg, ctx)
        pm = T["partner_map"]
        j = a.join(pm, a.partner_customer_id == pm.identifier, "inner")
        return _out(j, F.col("sub").cast("long"), F.col(txn), service())
    return build


_home_services = _tenant("home_services", "appointment_create_date", lambda: F.lower("cancellation") == "no",
                         "appointment_ref_code", appointment_service)
_car_monthly = _tenant("car_rental_monthly", "booked_date", lambda: ~F.lower("status").isin(*MONTHLY_RENTAL_OFF),
                       "booking_id", lambda: F.lit("swapp_monthlydaily|monthly"))
_car_daily = _tenant("car_rental_daily", "booked_date", lambda: ~F.lower("status").isin(*DAILY_RENTAL_OFF),
                     "booking_id", lambda: F.lit("swapp_monthlydaily|daily"))
_laundry = _tenant("partner_txn", "booking_creation_date", lambda: F.lower("order_status") == "order completed",
                   "appointment_ref_code", lambda: F.lit("laundryshoes"))


def _tickets(T, date, cfg, ctx):
    t = _placed(T["tickets"].filter(F.lower("order_status") == "success"), "txn_date", date, cfg, ctx)
    return _out(t, F.col("user_id").cast("long"), F.col("order_ref"), F.lit("tickets_and_passes"))


def _remittance(T, date, cfg, ctx):
    r = T["remittance"].filter((F.lower("invoice_status") == "paid")
                               & F.lower("status").isin("paid", "completed")
                               & F.col("sender_country").isin("AE", "JO"))
    r = _placed(r, F.to_date("created_at"), date, cfg, ctx)
    return _out(r, F.col("sender_user_id").try_cast("long"), F.col("id"),
                F.lit("send_abroad_remittance"))


_SHARED = (
    Branch("p2p", _p2p),
    Branch("bills", _bills),
    Branch("home_services", _home_services),
    Branch("car_rental_monthly", _car_monthly),
    Branch("car_rental_daily", _car_daily),
    Branch("laundry", _laundry),
    Branch("tickets", _tickets),
    Branch("remittance", _remittance),
)

RIDE_BRANCHES = (Branch("rides", _rides), Branch("orders", _orders)) + _SHARED

FOOD_BRANCHES = (Branch("rides", _rides_food), Branch("food", _food),
                 Branch("orders", _orders_but_food)) + _SHARED


def transactions(T, date, cfg: EngineConfig, branches=RIDE_BRANCHES, ctx=None) -> DataFrame:
    """UNION ALL of all transaction branches."""
    ctx = ctx or {}
    parts = [b.build(T, date, cfg, ctx) for b in branches]
    return reduce(lambda a, b: a.unionByName(b), parts)


def bike_branch(T, date, cfg: EngineConfig) -> DataFrame:
    """Pre-aggregated daily statistics: sum of positive daily trip counts."""
    b = T["bike_daily"].filter((F.col("trip_cnt") > 0) & F.col("customer_id").isNotNull())
    b = fan_out(b, "day", date, cfg.history_horizon)
    return (b.groupBy("valid_date", F.col("customer_id").alias("userid"))
             .agg(F.lit("bike").alias("service"), F.sum("trip_cnt").cast("long").alias("trx_amt")))


def txn_by_service(txn: DataFrame) -> DataFrame:
    return (txn.filter(F.col("userid").isNotNull())
               .groupBy("valid_date", "userid", "service")
               .agg(F.countDistinct("transaction_id").alias("trx_amt")))


def txn_features(T, date, cfg: EngineConfig, branches=RIDE_BRANCHES, ctx=None) -> DataFrame:
    """(valid_date, customer_id, trx_amt): distinct transactions per service summed per
    user. Transactions are reduced to distinct ones before they meet the dates.
    ``ctx['base_bookings']`` and ``ctx['food_base']`` hold spans here; with
    ``ctx['customers']`` only theirs are counted."""
    ctx = {**(ctx or {}), "spans": True}
    base = ctx.get("base_bookings")
    if (base is None or FROM not in base.columns) and any(b.build is _rides for b in branches):
        ctx["base_bookings"] = ride_booking_spans(T["trips"], date, cfg)
    wanted = ctx["customers"].select(F.col("customer_id").cast("long").alias("userid")).distinct() if "customers" in ctx else None

    def of_wanted(df: DataFrame) -> DataFrame:
        return df if wanted is None else df.join(wanted, "userid", "left_semi")

    txn = of_wanted(transactions(T, date, cfg, branches, ctx).filter(F.col("userid").isNotNull()))
    counted = distinct_spans(txn, ["userid", "service"], "transaction_id", date).select("userid", FROM, TO, F.lit(1).cast("long").alias("_w"))
    b = T["bike_daily"].filter((F.col("trip_cnt") > 0) & F.col("customer_id").isNotNull())
    bike = spanned(b, "day", date, cfg.history_horizon).select(F.col("customer_id").cast("long").alias("userid"), FROM, TO, F.col("trip_cnt").cast("long").alias("_w"))
    both = counted.unionByName(of_wanted(bike)).withColumnRenamed("userid", "customer_id")
    return by_date(both, ["customer_id"], date, F.col("_w"), "trx_amt")
