import random

import numpy as np
import pytest

from cohortkit.llm import neighbours as nn

SCHEMA = "vec_id long, embedding array<float>, label int, score double, key long"


def brute(rows, queries):
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], dtype=np.float32).astype(float)
    out = {}
    for q in queries:
        d = np.sqrt(((x - x[np.flatnonzero(ids == q)[0]]) ** 2).sum(1))
        order = [j for j in np.lexsort((ids, d)) if ids[j] != q][:10]
        out[q] = [(int(ids[j]), float(d[j])) for j in order]
    return out


def vectors(n, dim=16, seed=1):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, dim))
    x = centres[rng.integers(0, 12, n)] + 0.5 * rng.normal(size=(n, dim))
    x[50:90] = x[50]  # a very common vector
    return [(i, [float(v) for v in np.float32(x[i])]) for i in range(n)]


def test_small_tables_are_exact(spark):
    rows = vectors(260)
    odd = [(1000, None), (1001, [0.0] * 16), (1002, [float("nan")] * 16), (1003, [1.0] + [None] * 15), (1100, []), (1200, [float("inf")] * 16), (None, rows[0][1]), rows[7]]
    df = spark.createDataFrame([(i, v, 1, 0.0, 5) for i, v in rows + odd], SCHEMA)
    got = {}
    for r in nn.op3(df).orderBy("query_id", "rank").collect():
        assert r["rank"] == len(got.setdefault(r.query_id, [])) + 1
        got[r.query_id].append((r.vec_id, r.score))
    want = brute(rows, [0, 100, 200])
    assert set(got) == set(want)
    for q in want:
        assert [i for i, _ in got[q]] == [i for i, _ in want[q]]
        assert [s for _, s in got[q]] == pytest.approx([s for _, s in want[q]], abs=1e-12)
    few = spark.createDataFrame([(i, v, 1, 0.0, 5) for i, v in rows[:4]], SCHEMA)
    assert nn.op3(few).count() == 3
    assert nn.op3(df.limit(0)).count() == 0


def test_recall_and_order_of_a_hashed_table(spark):
    rows = vectors(4000) + [(5000, [900.0] * 16)]  # an outlier finds its ten, too
    df = spark.createDataFrame([(i, v, 1, 0.0, 5) for i, v in rows], SCHEMA)
    got = {}
    for r in nn.op3(df).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    want = brute(rows, [i for i, _ in rows if i % 100 == 0])
    assert set(got) == set(want) and all(len(g) == 10 for g in got.values())
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.9 * 10 * len(want)
    for g in got.values():
        assert g == sorted(g, key=lambda x: (x[1], x[0]))
    assert [i for i, _ in got[5000]] == [i for i, _ in want[5000]]


def test_a_rare_length_in_a_hashed_table(spark):
    rare = [(6000 + i, [float(i + 1)] * 5) for i in range(4)]
    rows = vectors(2600) + [(7000, [900.0] * 16), (7100, [-900.0] * 16)]
    df = spark.createDataFrame([(i, v, 1, 0.0, 5) for i, v in rows + rare + [(8000, [1.0] * 3)]], SCHEMA)
    got = {}
    for r in nn.op3(df).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    assert got[6000] == [6001, 6002, 6003] and 8000 not in got
    want = brute(rows, [7000, 7100])
    assert all(got[q] == [i for i, _ in want[q]] for q in want)
    assert all(len(g) == 10 for q, g in got.items() if q != 6000)
