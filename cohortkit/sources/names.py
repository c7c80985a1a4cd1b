"""Sources whose column names hold spaces, dots or quotes: names are mapped where
the source is read, so that no later expression has to quote them."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def quoted(name: str) -> str:
    """A name as one identifier, whatever it holds."""
    return "`" + name.replace("`", "``") + "`"


def column(name: str) -> Column:
    return F.col(quoted(name))


def plain(name: str) -> str:
    """Lower-case letters, digits and single underscores: 'Order.Status (new)' is
    'order_status_new'."""
    return re.sub(r"[^0-9a-z]+", "_", name.lower()).strip("_") or "column"


def select_mapped(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """The columns of ``mapping`` (source name -> name), and no others; a source
    column that is missing is an error that names it."""
    missing = [c for c in mapping if c not in df.columns]
    if missing:
        raise ValueError(f"missing source columns: {missing}")
    return df.select(*[column(c).alias(n) for c, n in mapping.items()])


def plain_names(df: DataFrame) -> DataFrame:
    """All columns under plain names; of names that fall together the later ones
    are numbered."""
    seen: dict[str, int] = {}
    out = []
    for c in df.columns:
        name = plain(c)
        seen[name] = seen.get(name, 0) + 1
        out.append(column(c).alias(name if seen[name] == 1 else f"{name}_{seen[name]}"))
    return df.select(*out)
