import hashlib
import random

import pytest
from pyspark.sql import functions as F

from cohortkit.llm import fingerprint as fp

SCHEMA = "doc_id long, text string, next_text string, sketch int, fingerprint int"


def texts():
    rnd = random.Random(2)
    base = [" ".join(rnd.choice("abcdefgh") + str(rnd.randrange(500)) for _ in range(n)) for n in (1200, 700, 3, 1, 60, 5000)]
    return [None, "", "  \t", "Één twee", base[0], base[0], base[0] + " tail", base[5], " ".join(base[5].split()[:700]), *base]


def test_contract_and_likeness(spark):
    rows = [(i * 7, t) for i, t in enumerate(texts())] + [(None, "null id")]
    out = {r.doc_id: r for r in fp.op5(spark.createDataFrame([(i, t, "n", 1, 2) for i, t in rows], SCHEMA)).collect()}
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    assert len(out) == len(rows)
    for (i, t), (_, nxt) in zip(order, order[1:] + order[:1]):
        t, nxt = t or "", nxt or ""
        half = len(t) // 2
        e = t[:len(t) - half] + nxt[:half]
        r = out[i]
        assert r.n_chars == len(t) and r.edited_sha256 == hashlib.sha256(e.encode()).hexdigest()
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        if e == t:
            assert r.fingerprint == r.edited_fingerprint and r.near_edited == 1
        if len(t.split()) > 500 and t != nxt:
            assert 0.3 <= r.near_edited
    by = {t: out[i] for i, t in rows}
    assert out[4 * 7].fingerprint == out[5 * 7].fingerprint and out[4 * 7].near_next == 1
    assert out[5 * 7].near_next > 0.9
    assert out[7 * 7].near_next == 1.0  # a seventh of a long text, contained in it
    assert by[""].fingerprint == ""


def test_containment_estimate(spark):
    rnd = random.Random(4)
    a = [f"w{rnd.randrange(10**6)}" for _ in range(4000)]
    b = a[:2000] + [f"v{rnd.randrange(10**6)}" for _ in range(30_000)]
    df = spark.createDataFrame([(" ".join(a), " ".join(b))], "x string, y string")
    df = fp.sketch(fp.sketch(df, "x", "a"), "y", "b")
    df = fp.sketch(df.withColumn("z", F.concat_ws(" ", "x", "y")), "z", "c")
    r = df.select(fp.likeness(F.col("a"), F.col("b")).alias("l"), fp.merge(F.col("a"), F.col("b")).alias("m"), "c").first()
    assert abs(r.l - 0.5) < 0.1
    assert len(set(r.c) ^ set(r.m)) <= 5  # but for the four shingles across the seam


@pytest.mark.parametrize("n", [1, 2, 50])
def test_next_over_many_ranges(spark, n, monkeypatch):
    monkeypatch.setattr(fp, "RANGE_ROWS", 3)
    rnd = random.Random(n)
    ids = [rnd.randrange(-40, 40) for _ in range(n)]
    rows = [(i, f"t{j:03}") for j, i in enumerate(ids)]
    got = fp.with_next(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", ["text"], ["text"]).collect()
    order = sorted(rows)
    want = [(a, b, d) for (a, b), (_, d) in zip(order, order[1:] + order[:1])]
    assert sorted((r.doc_id, r.text, r.next_text) for r in got) == sorted(want)


def test_empty(spark):
    assert fp.op5(spark.createDataFrame([], SCHEMA)).count() == 0
