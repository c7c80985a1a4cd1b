"""Steps of the training rows that must not repeat work or meet the dates too early."""

import datetime as dt
import random

from cohortkit.operators import features as FT
from cohortkit.operators import sessions as SS
from cohortkit.operators import transactions as TX
from cohortkit.plans.registry import FIX_CFG as C
from cohortkit.sources.fixtures import Tables

DAYS = [dt.date(2001, 7, 1) + dt.timedelta(days=i) for i in range(6)]


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_sessions_are_kept_by_one_aggregate(spark):
    rnd = random.Random(4)
    rows = [(rnd.choice([None, "a", "b", "c", "d", "e"]), rnd.choice([None, 0, 0, 1, 2]), rnd.choice([0, 1]), rnd.choice([None, 1, 2, 3]),
             rnd.choice(["d1", "d2"]), rnd.randrange(5)) for _ in range(80)]
    out = SS.dedup_across_days(spark.createDataFrame(rows, "sessionuuid string, booking_id long, is_trip_ended int, ts long, valid_date string, x int"))
    assert "Join" not in plan(out)
    low = lambda v: (v is not None, v or 0)  # noqa: E731  nulls come first
    booked = [r for r in rows if r[1]]
    taken = {r[0] for r in booked} - {None}
    unbooked = [r for r in rows if r[1] == 0 and r[0] not in taken]
    want = []
    for part, order in ((booked, lambda r: (-r[2], low(r[3]), r[4], r[1], r[5])), (unbooked, lambda r: (low(r[3]), r[4], -1, r[2], r[5]))):
        best = {}
        for r in part:
            if r[0] not in best or order(r) < order(best[r[0]]):
                best[r[0]] = r
        want += best.values()
    key = lambda r: tuple(map(str, r))
    assert sorted(map(tuple, out.select("sessionuuid", "booking_id", "is_trip_ended", "ts", "valid_date", "x").collect()), key=key) == sorted(want, key=key)


def test_saved_places_are_reduced_before_the_dates(spark):
    rnd = random.Random(7)
    at = lambda: dt.datetime(2001, 6, 28) + dt.timedelta(hours=12 * rnd.randrange(20))
    marks = [(rnd.randrange(6), rnd.randrange(60), rnd.choice([None, at(), at(), at()]), rnd.choice([1, 19, 3])) for _ in range(150)]
    places = [(i % 60, rnd.choice([None, at(), at()]), (d := at().date()), d.year, rnd.random(), rnd.choice([None, 1.0]),
               rnd.choice(["Home x", "WORK", "Gym"]), rnd.choice([1, 19, 3])) for i in range(90)]
    wanted = [(d, c) for d in DAYS for c in range(6) if rnd.random() < 0.8]
    T = {"bookmarks": spark.createDataFrame(marks, "user_id long, provider_id long, last_updated timestamp, country_id int"),
         "location_master": spark.createDataFrame(places, "provider_reference_id long, last_updated timestamp, date date, year int, latitude double, "
                                                          "longitude double, search_display_name string, country_id int")}
    out = FT.saved_places(T, DAYS, C, spark.createDataFrame(wanted, "valid_date date, customer_id long"), 1999)
    keys = [line for line in plan(out).splitlines() if "Aggregate [" in line]
    assert any("location_type#" in k and "_from#" in k and "valid_date#" not in k for k in keys)
    want = {}
    for day, who in wanted:
        best = {}
        for user, provider, saved, country in marks:
            if user != who or country == 3 or saved is None or not saved < dt.datetime.combine(day, dt.time()):
                continue
            for ref, updated, date, _, lat, lon, name, land in places:
                kind = {"h": "home", "w": "work"}.get(name[0].lower())
                if ref == provider and land != 3 and kind and date < day:
                    k = (updated is None, -updated.timestamp() if updated else 0, -ref, updated or 0, lat, lon is not None, lon or 0)
                    if kind not in best or k < best[kind][0]:
                        best[kind] = (k, (lat, lon))
        if best:
            want[day, who] = {kind: c for kind, (_, c) in best.items()}
    got = {(r.valid_date, r.customer_id): {k: (v.lat, v.long) for k, v in r.home_work_coords.items()} for r in out.collect()}
    assert got == want and len(got) > 5


def test_transactions_of_wanted_customers_only(spark):
    T = Tables(spark, "none")
    day = dt.datetime(2001, 6, 20)
    T._cache.update(
        customer=spark.createDataFrame([(k, k % 3) for k in range(1, 9)], "c_custkey long, c_nationkey int"),
        orders=spark.createDataFrame([(k, k % 8 + 1, "F", day, ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"][k % 5]) for k in range(80)],
                                     "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate timestamp, o_orderpriority string"),
        lineitem=spark.createDataFrame([(k, 1, day, "F", "A", k, k) for k in range(80)],
                                       "l_orderkey long, l_linenumber int, l_shipdate timestamp, l_linestatus string, l_returnflag string, l_partkey long, l_suppkey long"),
        events=spark.createDataFrame([(k, k % 8 + 1, dt.datetime(2023, 12, 18), ["purchase", "click", "signup", "view"][k % 4]) for k in range(80)],
                                     "event_id long, user_id long, ts timestamp, event_type string"))
    wanted = spark.createDataFrame([(DAYS[0], 2), (DAYS[1], 2), (DAYS[0], 5)], "valid_date date, customer_id long")
    rows = lambda ctx: {(r.valid_date, r.customer_id): r.trx_amt for r in TX.txn_features(T, DAYS, C, TX.RIDE_BRANCHES, ctx).collect()}
    every, some = rows({}), rows({"customers": wanted})
    assert {c for _, c in some} == {2, 5} < {c for _, c in every}
    assert some == {k: n for k, n in every.items() if k[1] in (2, 5)}
