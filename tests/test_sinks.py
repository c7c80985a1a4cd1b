"""JSON columns, quoted names, the training table and the extraction job."""

import datetime as dt
import json
import uuid

import pytest
from pyspark.sql import functions as F

from cohortkit.functions import jsoncols as JC
from cohortkit.functions.profiles import canon_map
from cohortkit.operators import extract as X
from cohortkit.session import checkpoint_dir
from cohortkit.sources import names as NM
from cohortkit.sources import training as TR
from cohortkit.config import EngineConfig
from cohortkit.sources.fixtures import Tables

from .conftest import SF0001


def scratch(spark):
    return f"{checkpoint_dir(spark).rstrip('/')}/test-{uuid.uuid4().hex}"


# --- JSON columns -----------------------------------------------------------

def test_maps_to_json_and_back(spark):
    rows = [(1, {10: 5, 2: 7}, {"b|1": 1, "a\"2": 2}), (2, {}, {}), (3, None, None), (4, {1: None}, {"é": 3})]
    df = spark.createDataFrame(rows, "id long, hours map<int,long>, places map<string,long>")
    text = df.select("id", JC.map_to_json("hours").alias("hours"), JC.map_to_json("places").alias("places"))
    got = {r.id: (r.hours, r.places) for r in text.collect()}
    assert got[1] == ('{"2":7,"10":5}', '{"a\\"2":2,"b|1":1}')
    assert got[2] == ("{}", "{}") and got[3] == (None, None) and got[4] == ('{"1":null}', '{"é":3}')
    back = text.select("id", JC.json_to_map("hours", "bigint", "int").alias("hours"), JC.json_to_map("places", "bigint").alias("places"))
    assert {r.id: (r.hours, r.places) for r in back.collect()} == {i: (h, p) for i, h, p in rows}


def test_keys_are_inferred_over_all_rows(spark):
    text = [json.dumps({str(k): k * 0.5}) for k in range(12)] + ["{}", None, "no json", '{"x y.z": 2, "3": null}', "[1, 2]"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(text)], "id long, j string").repartition(7)
    assert JC.json_keys(df, "j") == [str(k) for k in range(12)] + ["x y.z"]
    flat = JC.unnest_json(df, "j", "h_")
    assert flat.columns == ["id", *[f"h_{k}" for k in range(12)], "h_x y.z"]
    got = {r.id: r for r in flat.collect()}
    for k in range(12):
        assert got[k][f"h_{k}"] == k * 0.5 and sum(v is not None for v in got[k]) == 2
    assert got[15]["h_x y.z"] == 2 and got[15]["h_3"] is None
    assert all(v is None for i in (12, 13, 14, 16) for v in got[i][1:])
    struct = JC.parse_json_struct(df, "j", out="parsed")
    assert struct.select("parsed.`11`").where("id = 11").first()[0] == 5.5
    with pytest.raises(ValueError, match="more than 5 keys"):
        JC.json_keys(df, "j", 5)
    with pytest.raises(ValueError, match="exist already"):
        JC.unnest_json(df.withColumn("h_3", F.lit(1)), "j", "h_")
    empty = df.limit(0)
    assert JC.json_keys(empty, "j") == [] and JC.unnest_json(empty, "j").columns == ["id"]


def test_rows_to_json_keep_the_given_order(spark):
    df = spark.createDataFrame([(2, None, "é")], "b int, a double, c string")
    assert df.select(JC.row_to_json({"10": "b", "2": "a", "c.d": "c"})).first()[0] == '{"10":2,"2":null,"c.d":"é"}'


# --- names --------------------------------------------------------------------

def test_names_with_spaces_dots_and_quotes(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], ["Order.Status", "a `b` c", "order status", "Ünit (%)"])
    path = scratch(spark)
    df.write.parquet(path)
    back = spark.read.parquet(path)
    got = NM.select_mapped(back, {"Order.Status": "status", "a `b` c": "abc"})
    assert got.columns == ["status", "abc"] and tuple(got.first()) == (1, 2)
    assert "Ünit" not in got._jdf.queryExecution().executedPlan().toString()  # pruned at the scan
    assert NM.plain_names(back).columns == ["order_status", "a_b_c", "order_status_2", "nit"]
    with pytest.raises(ValueError, match="no such"):
        NM.select_mapped(back, {"no such": "x"})


# --- training table ---------------------------------------------------------------

def table(spark, n, extra="x double"):
    rows = [(dt.date(2024, 1, 1 + k % 3), k, k / 2) for k in range(n)]
    return spark.createDataFrame(rows, f"valid_date date, id long, {extra}")


def test_versions_of_the_training_table(spark):
    path = scratch(spark)
    assert TR.versions(spark, path) == []
    with pytest.raises(ValueError, match="no finished version"):
        TR.read_training(spark, path)
    assert TR.write_training(table(spark, 10), path) == 1
    assert TR.write_training(table(spark, 7).withColumn("é f", F.lit("v")), path) == 2
    assert TR.write_training(table(spark, 0), path) == 3
    assert TR.versions(spark, path) == [1, 2, 3]
    assert TR.read_training(spark, path).count() == 0 and TR.read_training(spark, path).columns == ["valid_date", "id", "x"]
    two = TR.read_training(spark, path, 2)
    assert two.columns == ["valid_date", "id", "x", "é f"] and two.count() == 7
    assert sorted(tuple(r) for r in TR.read_training(spark, path, 1).collect()) == sorted(tuple(r) for r in table(spark, 10).collect())
    assert TR.read_training(spark, path, 2, ["id"]).columns == ["id"]
    assert "PartitionFilters: [isnotnull(valid_date" in two.where("valid_date = date'2024-01-02'")._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(ValueError, match="no column"):
        TR.write_training(table(spark, 1).drop("valid_date"), path)


def test_a_schema_that_changed_is_refused(spark):
    path = scratch(spark)
    TR.write_training(table(spark, 5), path)
    with pytest.raises(TR.SchemaMismatch, match="x: double instead of string"):
        TR.read_training(spark, path, expect=table(spark, 0).withColumn("x", F.lit("")).schema)
    spark.createDataFrame([(1, "a")], "id long, x string").write.mode("overwrite").parquet(f"{path}/v=000001/valid_date=2024-01-01")
    spark.createDataFrame([(1, "a")], "id long, x string").write.mode("overwrite").parquet(f"{path}/v=000001/valid_date=2024-01-02")
    spark.createDataFrame([(1, "a")], "id long, x string").write.mode("overwrite").parquet(f"{path}/v=000001/valid_date=2024-01-03")
    with pytest.raises(TR.SchemaMismatch, match="x: string instead of double"):
        TR.read_training(spark, path)


def test_an_unfinished_version_is_not_seen(spark):
    path = scratch(spark)
    TR.write_training(table(spark, 5), path)
    table(spark, 9).write.partitionBy("valid_date").parquet(f"{path}/v=000002")  # no log row
    assert TR.read_training(spark, path).count() == 5
    assert TR.write_training(table(spark, 3), path) == 2 and TR.read_training(spark, path).count() == 3


# --- extraction job -----------------------------------------------------------------

CFG = EngineConfig(history_horizon=2500)
DAY = dt.date(2001, 8, 1)


def job(path, days, **more):
    return X.ExtractionJob(DAY, days, path, history_horizon=2500, saved_min_year=1994, **more)


def test_parameters():
    assert job("p", 3).dates() == [DAY - dt.timedelta(days=k) for k in (2, 1, 0)]
    assert job("p", 1, include_sessions=False).kinds() == ["features"]
    assert X.service() is X.SERVICES["ride"] and X.service("food").features is not X.service().features
    for bad in ({"service": "boats"}, {"percentile": 1.5}, {"days_per_run": 0}):
        with pytest.raises(ValueError):
            job("p", 1, **bad)
    with pytest.raises(ValueError):
        job("p", 0)


@pytest.fixture
def counted(monkeypatch, spark):
    """A service whose extractors report their calls and give small rows."""
    calls = []
    days = {}

    def feats(T, dates, cfg, j):
        calls.append(("features", list(dates), cfg.history_horizon, cfg.percentile))
        rows = [(d.isoformat(), c, {1: c}, {"a|b": 2}) for d in dates for c in range(days.get(d, 2))]
        return spark.createDataFrame(rows, "valid_date string, customer_id long, week_stats map<int,long>, locations map<string,long>")

    def sess(T, dates, cfg, j):
        calls.append(("sessions", list(dates)))
        return spark.createDataFrame([(d.isoformat(), "s") for d in dates if days.get(d, 1)], "valid_date string, sessionuuid string")

    monkeypatch.setitem(X.SERVICES, "small", X.Service(feats, sess))
    return calls, days


def test_a_job_goes_on_where_it_stopped(spark, counted, monkeypatch):
    calls, days = counted
    T, path = Tables(spark, SF0001), scratch(spark)
    j = job(path, 5, service="small", days_per_run=2, percentile=0.5)
    assert X.pending(spark, j, "features") == j.dates()
    real, seen = X._counts, []

    def stopped(*a):
        seen.append(a)
        if len(seen) == 2:
            raise RuntimeError("driver lost")
        return real(*a)

    monkeypatch.setattr(X, "_counts", stopped)
    with pytest.raises(RuntimeError):
        X.extract(T, j, CFG)
    monkeypatch.setattr(X, "_counts", real)
    assert X.pending(spark, j, "features") == j.dates()[2:] and X.pending(spark, j, "sessions") == j.dates()
    assert X.extracted(spark, j, "features").count() == 4  # the days that were written but not closed do not count
    done = X.extract(T, j, CFG)
    assert done == [("features", d) for d in j.dates()[2:]] + [("sessions", d) for d in j.dates()]
    assert [c[1] for c in calls if c[0] == "features"] == [j.dates()[:2], j.dates()[2:4], j.dates()[2:4], j.dates()[4:]]
    assert calls[0][2:] == (2500, 0.5)
    assert X.extract(T, j, CFG) == []
    rows = X.extracted(spark, j, "features").collect()
    assert len(rows) == 10 and all(r.week_stats == {1: r.customer_id} and r.locations == {"a|b": 2} for r in rows)
    raw = spark.read.parquet(j.target("features"))
    assert dict(raw.dtypes)["week_stats"] == "string"
    assert {(r.kind, r.valid_date, r.n_rows) for r in X.manifest(spark, path).collect()} == {
        (k, d.isoformat(), n) for k, n in (("features", 2), ("sessions", 1)) for d in j.dates()}


def test_days_without_rows_and_a_restart(spark, counted):
    calls, days = counted
    T, path = Tables(spark, SF0001), scratch(spark)
    j = job(path, 3, service="small")
    days[j.dates()[0]] = 0
    X.extract(T, j, CFG)
    assert X.pending(spark, j, "sessions") == [] and X.extracted(spark, j, "sessions").count() == 2
    days[j.dates()[1]] = 0  # its former partition stays, its rows do not count
    assert len(X.extract(T, j, CFG, restart=True)) == 6
    assert {r.valid_date for r in X.extracted(spark, j, "features").collect()} == {DAY.isoformat()}


def test_all_days_empty(spark, counted):
    calls, days = counted
    j = job(scratch(spark), 1, service="small")
    days[DAY] = 0
    assert len(X.extract(Tables(spark, SF0001), j, CFG)) == 2 and X.pending(spark, j, "features") == []


def test_rides_and_food_through_the_sink(spark):
    from cohortkit.operators.features import ride_features
    T = Tables(spark, SF0001)
    j = job(scratch(spark), 1, include_sessions=False)
    X.extract(T, j, CFG)
    cols = ["customer_id", "num_trips", canon_map("week_stats"), canon_map("hour_stats"), canon_map("locations")]
    want = sorted(tuple(r) for r in ride_features(T, DAY, CFG, 1994).select(*cols).collect())
    assert sorted(tuple(r) for r in X.extracted(spark, j, "features").select(*cols).collect()) == want and want
