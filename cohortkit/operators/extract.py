"""The extraction job: for each service its feature rows and sessions of the
last days up to a date, written day by day as partitioned datasets. A manifest
row a finished (service, kind, day) lets a stopped job go on where it was."""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import DEFAULT, EngineConfig
from ..functions.jsoncols import json_to_map, map_to_json
from ..sources.io import read_daily, write_daily
from .bookings import as_date
from .features import food_features, ride_features
from .sessions import sessions

# maps of the feature rows that the sinks hold as JSON text: column -> value and key type
JSON_COLUMNS = {"week_stats": ("bigint", "int"), "hour_stats": ("bigint", "int"), "locations": ("bigint", "string"),
                "home_work_coords": ("struct<lat:double,long:double>", "string")}
MANIFEST = "_manifest"
_ENTRY = "service string, kind string, valid_date string, state string, n_rows long, run string, at timestamp"
_RUN = "extract_run"

Extractor = Callable[..., DataFrame]


@dataclass(frozen=True)
class Service:
    """What a service extracts. Both functions take (tables, dates, config)."""

    features: Extractor
    sessions: Extractor


def _ride(T, dates, cfg: EngineConfig, job: ExtractionJob) -> DataFrame:
    return ride_features(T, dates, cfg, job.saved_min_year)


def _food(T, dates, cfg: EngineConfig, job: ExtractionJob) -> DataFrame:
    return food_features(T, dates, cfg)


def _sessions(T, dates, cfg: EngineConfig, job: ExtractionJob) -> DataFrame:
    return sessions(T, dates, cfg)


SERVICES: dict[str, Service] = {"ride": Service(_ride, _sessions), "food": Service(_food, _sessions)}
DEFAULT_SERVICE = "ride"


def service(name: str | None = None) -> Service:
    """A registered service; rides unless named."""
    try:
        return SERVICES[name or DEFAULT_SERVICE]
    except KeyError:
        raise ValueError(f"unknown service {name!r}; known: {sorted(SERVICES)}") from None


@dataclass(frozen=True)
class ExtractionJob:
    """Parameters of one job. ``days_per_run`` days are extracted by one plan and
    count as finished together."""

    up_to_date: str | _dt.date
    days_back: int
    path: str
    service: str = DEFAULT_SERVICE
    history_horizon: int = 60
    percentile: float = 0.8
    include_sessions: bool = True
    include_features: bool = True
    days_per_run: int = 30
    saved_min_year: int = 2019

    def __post_init__(self):
        if self.days_back < 1 or self.days_per_run < 1:
            raise ValueError("days_back and days_per_run must be at least 1")
        if not 0 <= self.percentile <= 1:
            raise ValueError("percentile must be between 0 and 1")
        service(self.service)

    def dates(self) -> list[_dt.date]:
        """The last ``days_back`` days up to and including ``up_to_date``."""
        end = as_date(self.up_to_date)
        return [end - _dt.timedelta(days=k) for k in reversed(range(self.days_back))]

    def kinds(self) -> list[str]:
        return [k for k, on in (("features", self.include_features), ("sessions", self.include_sessions)) if on]

    def target(self, kind: str) -> str:
        return f"{self.path.rstrip('/')}/{self.service}/{kind}"


def _missing(e: Exception) -> bool:
    return any(x in str(e) for x in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"))


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """The latest entry of each (service, kind, valid_date): state 'open' or 'done',
    n_rows, run; empty before the first. One short row a day and run."""
    try:
        rows = spark.read.schema(_ENTRY).parquet(f"{path.rstrip('/')}/{MANIFEST}")
    except Exception as e:
        if not _missing(e):
            raise
        rows = spark.createDataFrame([], _ENTRY)
    key = ["service", "kind", "valid_date"]
    last = rows.groupBy(*key).agg(F.max(F.struct("at", "state", "n_rows", "run")).alias("e"))
    return last.select(*key, "e.state", "e.n_rows", "e.run")


def _done(spark: SparkSession, job: ExtractionJob, kind: str) -> DataFrame:
    return manifest(spark, job.path).where(
        (F.col("service") == job.service) & (F.col("kind") == kind) & (F.col("state") == "done"))


def pending(spark: SparkSession, job: ExtractionJob, kind: str) -> list[_dt.date]:
    finished = {r.valid_date for r in _done(spark, job, kind).select("valid_date").collect()}
    return [d for d in job.dates() if d.isoformat() not in finished]


def _enter(spark: SparkSession, job: ExtractionJob, kind: str, days: list[_dt.date], run: str, counts: dict | None) -> None:
    state = "open" if counts is None else "done"
    rows = [(job.service, kind, d.isoformat(), state, (counts or {}).get(d.isoformat(), 0), run, _dt.datetime.now()) for d in days]
    spark.createDataFrame(rows, _ENTRY).coalesce(1).write.mode("append").parquet(f"{job.path.rstrip('/')}/{MANIFEST}")


def to_sink(features: DataFrame) -> DataFrame:
    """Feature rows with their maps as JSON text."""
    return features.withColumns({c: map_to_json(c) for c in JSON_COLUMNS if c in features.columns})


def from_sink(rows: DataFrame) -> DataFrame:
    """Feature rows as extracted: JSON text back to maps."""
    return rows.withColumns({c: json_to_map(c, *types) for c, types in JSON_COLUMNS.items() if c in rows.columns})


def extract(T, job: ExtractionJob, cfg: EngineConfig = DEFAULT, restart: bool = False) -> list[tuple[str, _dt.date]]:
    """Writes the days that are not done yet and returns the (kind, day) written.
    Their manifest entry is opened first, then they are replaced as whole
    partitions, then the entry is closed: a run that was stopped is repeated for
    its open days. ``restart`` extracts all days anew."""
    spark = T.spark
    cfg = replace(cfg, history_horizon=job.history_horizon, percentile=job.percentile)
    parts, run, written = service(job.service), uuid.uuid4().hex, []
    for kind in job.kinds():
        days = job.dates() if restart else pending(spark, job, kind)
        for at in range(0, len(days), job.days_per_run):
            chunk = days[at:at + job.days_per_run]
            _enter(spark, job, kind, chunk, run, None)
            rows = getattr(parts, kind)(T, chunk, cfg, job)
            rows = to_sink(rows) if kind == "features" else rows
            write_daily(rows.withColumn(_RUN, F.lit(run)), job.target(kind))
            _enter(spark, job, kind, chunk, run, _counts(spark, job, kind, chunk, run))
            written += [(kind, d) for d in chunk]
    return written


def _rows(spark: SparkSession, job: ExtractionJob, kind: str, days: list[_dt.date]) -> DataFrame:
    rows = read_daily(spark, job.target(kind)).where(F.col("valid_date").isin(*days))
    return rows.withColumn("valid_date", F.col("valid_date").cast("string"))


def _counts(spark: SparkSession, job: ExtractionJob, kind: str, days: list[_dt.date], run: str) -> dict[str, int]:
    try:
        rows = _rows(spark, job, kind, days)
    except Exception as e:  # no day has had a row so far
        if not _missing(e):
            raise
        return {}
    return {r.valid_date: r["count"] for r in rows.where(F.col(_RUN) == run).groupBy("valid_date").count().collect()}


def extracted(spark: SparkSession, job: ExtractionJob, kind: str) -> DataFrame:
    """The job's done days of a kind. Of a day only the rows of the run that the
    manifest names count: a day that came out empty the second time is empty,
    though its former partition is still there."""
    runs = _done(spark, job, kind).select("valid_date", F.col("run").alias(_RUN))
    rows = _rows(spark, job, kind, job.dates()).join(F.broadcast(runs), ["valid_date", _RUN], "left_semi").drop(_RUN)
    return from_sink(rows) if kind == "features" else rows
