"""Operator 3: approximate nearest neighbours by multiprobe p-stable hashing.

Each of ``TABLES`` tables hashes a vector with ``FUNCTIONS`` functions
floor((a.x + b) / w), a normal (2-stable). w is ``WIDTH`` times the root mean
square of the vectors' norms. A query visits its own bucket and perturbed ones:
all offsets of up to ``SHIFT`` steps a function are ordered by the squared
distance of the query's projections to the offset's cell, which orders them by
estimated success, and the first ``PROBES`` of each table are visited. The
visited buckets' rows are the candidates; tables are merged by keeping each
query's nearest found, with exact distances on the original vectors.

Every row is indexed. Equal vectors are one entry of which the ``NEAREST`` + 1
smallest ids stand for all: no more of them can be among a query's nearest. A
bucket meets its queries in blocks of at most ``BLOCK`` rows and ``BLOCK``
queries. Tables of every size are hashed; a query that found fewer than
``NEAREST`` meets all vectors of its length, in the same blocks, so no query
lacks neighbours that exist. Recall against brute force on the test
tables is given in the README.

Defined results: vectors that are null, empty, zero or hold null or non-finite
components take no part; vectors of another length are never neighbours; ties
go to the smaller vec_id; of rows alike in vec_id and vector one counts; a row
is no neighbour of its own vec_id; other columns are ignored; an empty table
gives an empty table.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import join_on, mix64, written

TABLES, FUNCTIONS, WIDTH, SHIFT, PROBES = 6, 6, 1.5, 2, 100
NEAREST = 10
BLOCK = 4096
EVERY = 100


def functions_of(dim: int, table: int, seed: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """Directions (dim x FUNCTIONS) and shifts (in widths) of a table."""
    rng = np.random.default_rng([seed, dim, table])
    return rng.normal(size=(dim, FUNCTIONS)), rng.random(FUNCTIONS)


def _offsets() -> np.ndarray:
    return np.array(list(itertools.product(range(-SHIFT, SHIFT + 1), repeat=FUNCTIONS)), np.int64)


def bucket_key(cells: np.ndarray, dim: int, table: int) -> np.ndarray:
    """64-bit key of each row of cells."""
    h = np.full(cells.shape[:-1], dim * 64 + table + 1, np.uint64)
    for j in range(cells.shape[-1]):
        h = mix64(h * np.uint64(0x9E3779B97F4A7C15) + cells[..., j].astype(np.int64).view(np.uint64))
    return h.view(np.int64)


def vectors(rows: DataFrame) -> DataFrame:
    """The rows that take part: vec_id, embedding as array<double>."""
    e = F.col("embedding").cast("array<double>")
    good = F.forall(e, lambda x: x.isNotNull() & (F.abs(x) < float("inf")) & ~F.isnan(x)) & F.exists(e, lambda x: x != 0)
    return rows.select("vec_id", e.alias("embedding")).where(F.col("vec_id").isNotNull() & good)


def representatives(rows: DataFrame) -> DataFrame:
    """Of equal vectors the rows with the smallest ids."""
    rows = rows.withColumn("embedding", F.transform("embedding", lambda x: x + F.lit(0.0)))  # -0.0 and 0.0 are equal
    w = Window.partitionBy("embedding").orderBy("vec_id")
    return rows.withColumn("__n", F.row_number().over(w)).where(F.col("__n") <= NEAREST + 1).drop("__n")


def _stack(b: pa.RecordBatch, name: str = "embedding") -> list[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, matrix) for each vector length in a batch."""
    col = b.column(b.schema.get_field_index(name))
    sizes, flat = np.diff(col.offsets.to_numpy()), col.flatten().to_numpy()
    starts = np.r_[0, np.cumsum(sizes)[:-1]].astype(np.int64)
    return [(at := np.flatnonzero(sizes == d), flat[starts[at][:, None] + np.arange(d)]) for d in np.unique(sizes)]


def _keyed(rows: DataFrame, width: float, probing: bool) -> DataFrame:
    """(key, id, embedding): a row for each table, or for each probe."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        offsets = _offsets() if probing else None
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                b = whole.slice(at, 256)
                for rows_at, x in _stack(b):
                    ids = b.column(0).to_numpy()[rows_at]
                    for t in range(TABLES):
                        a, shift = functions_of(x.shape[1], t)
                        p = x @ a / width + shift
                        cell = np.floor(p)
                        if not probing:
                            key, n = bucket_key(cell, x.shape[1], t), 1
                        else:
                            key, n = _probes(p - cell, cell.astype(np.int64), offsets, x.shape[1], t)
                        who = np.repeat(np.arange(len(x)), n)
                        flat = x[who].ravel()
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(key.ravel()), pa.array(np.full(len(who), t, np.int32)), pa.array(ids[who]),
                             pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, x.shape[1], dtype=np.int32)), pa.array(flat))],
                            names=["key", "tab", "id", "x"])

    return rows.select("vec_id", "embedding").mapInArrow(run, "key long, tab int, id long, x array<double>")


def _probes(inside: np.ndarray, cell: np.ndarray, offsets: np.ndarray, dim: int, table: int):
    """Keys of the first PROBES buckets of each row, in order of estimated success."""
    cost = np.zeros((len(inside), len(offsets)))
    steps = np.arange(-SHIFT, SHIFT + 1)
    for j in range(FUNCTIONS):
        f = inside[:, j][:, None]
        gap = np.where(steps == 0, 0.0, np.where(steps > 0, steps - f, f - steps - 1)) ** 2
        cost += gap[:, offsets[:, j] + SHIFT]
    n = min(PROBES, len(offsets))
    first = np.argpartition(cost, n - 1, axis=1)[:, :n]
    first = np.take_along_axis(first, np.argsort(np.take_along_axis(cost, first, 1), axis=1, kind="stable"), 1)
    return bucket_key(cell[:, None, :] + offsets[first], dim, table), n


def _scan(index: DataFrame, probes: DataFrame) -> DataFrame:
    """query_id, vec_id, score of the nearest of each visited bucket's block."""
    held = index.groupBy("key").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("parts"))
    asked = probes.groupBy("key").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("turns"))
    sizes = written(held.join(asked, "key"), "lsh-sizes")

    def dealt(df, own, other):
        df = join_on(df, sizes, ["key"]).withColumn(own, F.pmod(F.xxhash64("id"), F.col("parts" if own == "i" else "turns")).cast("int"))
        return df.withColumn(other, F.explode(F.sequence(F.lit(0), F.col("parts" if other == "i" else "turns") - 1))).select("key", "i", "j", "id", "x")

    def nearest(key, rows, queries):
        if not rows.num_rows or not queries.num_rows:
            return pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        x, q = (np.stack(t.column("x").to_numpy(zero_copy_only=False)) for t in (rows, queries))
        ids, who = rows.column("id").to_numpy(), queries.column("id").to_numpy()
        order = np.argsort(ids, kind="stable")
        x, ids = x[order], ids[order]
        out = [[], [], []]
        for at in range(0, len(q), 256):
            y, w = q[at:at + 256], who[at:at + 256]
            d = (y * y).sum(1)[:, None] + (x * x).sum(1) - 2 * y @ x.T
            own = ids == w[:, None]
            d[own] = np.inf
            n = min(NEAREST + 2, len(x))
            top = np.partition(d, n - 1, axis=1)[:, n - 1]
            r, c = np.nonzero((d <= top[:, None] + 1e-9 * (1 + np.abs(top[:, None]))) & ~own)
            exact = np.sqrt(((y[r] - x[c]) ** 2).sum(1))
            by = np.lexsort((ids[c], exact, r))
            r, c, exact = r[by], c[by], exact[by]
            begin = np.searchsorted(r, r)
            keep = np.arange(len(r)) - begin < NEAREST
            for o, v in zip(out, (w[r[keep]], ids[c[keep]], exact[keep])):
                o.append(v)
        a, b, s = (np.concatenate(o) for o in out)
        return pa.table({"query_id": pa.array(a), "vec_id": pa.array(b), "score": pa.array(s)})

    left = dealt(index, "i", "j").groupBy("key", "i", "j")
    right = dealt(probes, "j", "i").groupBy("key", "i", "j")
    return left.cogroup(right).applyInArrow(nearest, "query_id long, vec_id long, score double")


def _best(found: DataFrame) -> DataFrame:
    w = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.distinct().withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= NEAREST)


def search(rows: DataFrame, queries: DataFrame) -> DataFrame:
    """query_id, rank, vec_id, score. Both frames: vec_id, embedding."""
    base = written(representatives(vectors(rows)), "lsh-vectors")
    asked = written(vectors(queries).dropDuplicates(["vec_id", "embedding"]), "lsh-queries")
    square = F.aggregate("embedding", F.lit(0.0), lambda acc, x: acc + x * x)
    width = WIDTH * math.sqrt(base.agg(F.avg(square)).first()[0] or 1.0)
    index = _keyed(base, width, False)
    best = written(_best(_scan(index, _keyed(asked, width, True))), "lsh-found")
    few = asked.join(best.where(F.col("rank") == NEAREST).select(F.col("query_id").alias("vec_id")), "vec_id", "left_anti")
    if few.take(1):  # the length is the key: blocks of its rows meet blocks of its queries
        by_length = [F.size("embedding").cast("long").alias("key"), F.col("vec_id").alias("id"), F.col("embedding").alias("x")]
        more = _scan(base.select(*by_length), written(few.select(*by_length), "lsh-few"))
        best = _best(best.select("query_id", "vec_id", "score").unionByName(more))
    return best.select("query_id", "rank", "vec_id", "score")


def op3(rows: DataFrame) -> DataFrame:
    return search(rows, rows.where(F.col("vec_id") % EVERY == 0))
