import math

import numpy as np
import pytest

from cohortkit.llm import hardneg as hn

SCHEMA = "vec_id long, embedding array<float>, label int, rank int, score double, x string"
OUT = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def brute(rows):
    kept = {}
    for i, v, label in rows:
        if i is None or v is None or label is None or any(c is None or not math.isfinite(c) for c in v):
            continue
        q = [math.floor(256 * float(np.float32(c))) for c in v]
        kept[i] = min(kept.get(i, (99, q)), ((label + 1) % 10 if i % 7 == 0 else label, q))
    out = []
    for a, (la, qa) in kept.items():
        if a % 50:
            continue
        s = [(-sum(x * y for x, y in zip(qa, q)), i, label) for i, (label, q) in kept.items() if i != a and len(q) == len(qa)]
        for p, i, _ in sorted(x for x in s if x[2] == la)[:5]:
            fit = sorted((m, j) for m, j, label in s if label != la and 50 * -p <= 100 * -m <= 95 * -p)
            out += [(a, i, k + 1, j, -p, -m) for k, (m, j) in enumerate(fit[:3])]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame([(i, v, label, 3, 0.5, "x") for i, v, label in rows], SCHEMA)


def result(df):
    assert df.columns == OUT
    return sorted(tuple(r) for r in df.collect())


def vectors(n, dim, seed, centres=6, spread=0.15):
    rng = np.random.default_rng(seed)
    c = rng.normal(size=(centres, dim))
    of = rng.integers(0, centres, n)
    x = c[of] + spread * rng.normal(size=(n, dim))
    label = np.where(rng.random(n) < 0.6, of, rng.integers(0, 10, n))
    return [(i, [float(v) for v in np.float32(x[i])], int(label[i])) for i in range(n)]


ODD = [(2000, None, 1), (2050, [float("nan")] * 8, 1), (2100, [1.0] + [None] * 7, 1), (2150, [1.0] * 8, None), (None, [1.0] * 8, 1),
       (2200, [float("inf")] * 8, 2), (2250, [], 1), (2251, [], 1), (2252, [], 2), (2300, [1.0, 2.0], 1), (2301, [1.0, 2.5], 1), (2302, [0.5, 1.0], 4),
       (2350, [0.0] * 8, 3), (2400, [-1.0] * 8, 3), (2450, [1.0] * 3, 2)]


@pytest.mark.parametrize("sample,block,asked", [(4096, 16 << 20, 4096), (300, 2000, 3), (0, 1000, 2)])
def test_equals_brute_force(spark, monkeypatch, sample, block, asked):
    monkeypatch.setattr(hn, "SAMPLE", sample)
    monkeypatch.setattr(hn, "BLOCK", block)
    monkeypatch.setattr(hn, "ASKED", asked)
    rows = vectors(900, 8, 1) + ODD
    rows += [rows[50], (57, rows[3][1], 4), (7, rows[7][1], 9)]  # a repeated row and repeated ids
    rows += [(3000 + k, rows[100][1], k % 4) for k in range(300)]  # a hot vector, with ties
    assert result(hn.op11(frame(spark, rows))) == brute(rows)


def test_few_rows_and_none(spark):
    rows = vectors(52, 4, 3)
    assert result(hn.op11(frame(spark, rows))) == brute(rows)
    assert hn.op11(frame(spark, rows).limit(0)).count() == 0
    assert result(hn.op11(frame(spark, rows[:1]))) == []


def test_ranges_drop_subtrees(spark):
    """In clustered rows most leaves are out of reach, and the tree knows it."""
    rows = vectors(3000, 6, 5, centres=12, spread=0.02)
    index = hn.Index(hn.quantized(frame(spark, rows)))
    tree = index.tree
    assert len(tree.nodes) > 4 and tree.leaves > 20
    held = {}
    for r in index.rows.collect():
        held.setdefault(r.leaf, []).append(r)
    assert sum(map(len, held.values())) == len(rows)
    visits, total = 0, 0
    for r in index.rows.where("vec_id % 100 = 0").collect():
        a = np.array(r.x)
        whole = (a * a).sum() + tree.square
        scores = {leaf: [float(a @ np.array(o.x)) for o in group] for leaf, group in held.items()}
        low, high = 0.5 * (a * a).sum(), 0.9 * (a * a).sum()
        annuli = np.sqrt([[whole - 2 * high, whole - 2 * low]])
        found = set(tree.visited(a, annuli))
        assert {leaf for leaf, s in scores.items() if any(low <= v <= high for v in s)} <= found
        visits, total = visits + len(found), total + len(held)
    assert visits < 0.5 * total
