"""Registered queries: a Spark plan per operator of the survey plus the
equivalent DuckDB SQL over the same base tables (fixture views as CTEs).

Spark results keep MapType internally; the registered query renders maps as
canonical 'k=v;...' text only at the output so both engines can be compared.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import EngineConfig
from ..functions.profiles import canon_map
from ..sources.fixtures import Tables, oracle_with
from . import sqlfrag as S

# Fixture parameters (see FIXTURES.md): the valid date is the last booking
# day, and the history horizon covers all booking days of the test tables.
FEATURE_DATE = "2001-08-01"
FIX_CFG = EngineConfig(history_horizon=2500)
SAVED_MIN_YEAR = 1994


@dataclass
class Query:
    name: str
    spark: Callable[[SparkSession, str], DataFrame]
    sql: str | None


REGISTRY: dict[str, Query] = {}


def register(name: str, sql: str | None):
    def deco(fn):
        REGISTRY[name] = Query(name, fn, sql)
        return fn
    return deco


def oracle(views, body: str) -> str:
    """DuckDB text: fixture views + extra CTEs (``body`` may start with
    'name AS (...), ...' CTE definitions, followed by the final SELECT)."""
    head = oracle_with(*views)
    body = body.strip()
    if body.upper().startswith("SELECT"):
        return head + body
    return (head.rstrip() + ",\n" if head else "WITH ") + body


def saved_canon(col: str = "home_work_coords"):
    return F.array_join(F.transform(
        F.array_sort(F.map_entries(F.col(col))),
        lambda e: F.concat(e["key"], F.lit("="),
                           F.format_string("%.4f,%.4f", e["value"]["lat"], e["value"]["long"]))),
        ";")


# ---------------------------------------------------------------------------
# imports of query modules register their queries
from . import q_features, q_sessions, q_dataset, q_eval, q_sinks  # noqa: E402,F401
