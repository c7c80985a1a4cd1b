import random
import re

import numpy as np
import pytest

from cohortkit.llm import mixing

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size string, start int"


def rows(n, seed=3):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        s = rnd.choice(["a"] * 8 + ["b", "c", "é", "B", None])
        out.append((i, " ".join(f"w{i}_{j}" for j in range(rnd.choice([1, 5, 60, 700]))), "en", s, 1, "x", 1))
    return out + [(n, None, "en", "a", 1, "x", 1), (n + 1, "", "en", "zz", 1, "x", 1), (n + 2, "one word", None, "tiny", 1, "x", 1)]


def brute_targets(size):
    order = sorted([s for s in size if s is not None], key=lambda s: s.encode()) + ([None] if None in size else [])
    w = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    total, capped = sum(size.values()), {}
    while True:
        open_ = {s for s in size if s not in capped}
        level = (total - sum(capped.values())) / sum(w[s] for s in open_) if open_ else 0
        new = {s: 3.0 * size[s] for s in open_ if level * w[s] > 3 * size[s]}
        if not new:
            return {s: capped.get(s, level * w[s]) for s in size}
        capped |= new


def test_permutation():
    for n in (1, 2, 3, 10, 257, 1000):
        got = mixing.permute(np.arange(n), np.full(n, n), np.full(n, 99, np.uint64))
        assert sorted(got) == list(range(n))
    a = mixing.permute(np.arange(1000), np.full(1000, 1000), np.full(1000, 1, np.uint64))
    assert abs(np.corrcoef(np.arange(1000), a)[0, 1]) < 0.15


@pytest.fixture(scope="module")
def data(spark):
    r = rows(500)
    return r, spark.createDataFrame(r, SCHEMA)


def test_targets_and_taken(spark, data):
    raw, df = data
    out = mixing.op7(df).collect()
    assert len(out) == len(raw)
    text = {r[0]: r[1] for r in raw}
    source = {r[0]: r[3] for r in raw}
    size = {}
    for i, t in text.items():
        size[source[i]] = size.get(source[i], 0) + len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    want, took = brute_targets(size), {s: 0 for s in size}
    for r in out:
        n = len(re.findall(r"[^\x20\x09-\x0D]+", text[r.doc_id] or ""))
        assert r["size"] == n and r.source_size == size[source[r.doc_id]] and 0 <= r.taken <= 3 * n
        assert r.target == pytest.approx(want[source[r.doc_id]])
        took[source[r.doc_id]] += r.taken
    for s in size:
        assert abs(took[s] - want[s]) <= max(0.02 * want[s], 3), (s, took[s], want[s])
    assert sorted(map(tuple, mixing.op7(df.repartition(7)).collect()), key=str) == sorted(map(tuple, out), key=str)


def test_mixture_agrees_with_counts(spark, data):
    raw, df = data
    counts = {r.doc_id: r.taken for r in mixing.op7(df).collect()}
    got = {}
    for r in mixing.mix(df).collect():
        for w in r.words:
            i = int(w[1:].split("_")[0]) if w[0] == "w" and "_" in w else 502
            got[i] = got.get(i, 0) + 1
    assert got == {i: t for i, t in counts.items() if t}


def test_stage_rows_repeats_empty(spark, data):
    raw, df = data
    out = mixing.mixed_documents(df)
    assert out.columns == df.columns and out.count() > 0
    twice = df.where("doc_id < 50").unionByName(df.where("doc_id < 50"))
    assert mixing.op7(twice).count() == 100
    assert mixing.op7(df.limit(0)).count() == 0 and mixing.mixed_documents(df.limit(0)).count() == 0


def test_whole_documents_meet_the_targets(spark):
    rnd = random.Random(4)
    raw = [(i, " ".join(f"w{i}_{j}" for j in range(rnd.choice([40, 700, 2500, 4000]))), "en", "abc"[i % 3], 1, "x", 1) for i in range(150)]
    df = spark.createDataFrame(raw, SCHEMA)
    size = {i: len(t.split()) for i, t, *_ in raw}
    own = {s: sum(size[i] for i, _, _, x, *_ in raw if x == s) for s in "abc"}
    want, got, long = brute_targets(own), dict.fromkeys("abc", 0), dict.fromkeys("abc", 0)
    for r in mixing.mixed_documents(df).collect():
        got[r.source] += size[r.doc_id]
        long[r.source] += size[r.doc_id] > 2048
    for s in "abc":
        assert abs(got[s] - want[s]) <= 4000 + mixing.BLOCK, (s, got[s], want[s])
        n = sum(size[i] > 2048 for i, _, _, x, *_ in raw if x == s)
        assert abs(long[s] - n * want[s] / own[s]) <= 3, (s, long[s], n)
