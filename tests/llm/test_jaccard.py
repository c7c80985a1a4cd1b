import random

import numpy as np
import pytest

from cohortkit.llm import jaccard

SCHEMA = "doc_id long, text string, node long, n long, component_id int"


def brute_sets(texts):
    out = []
    for t in texts:
        w = (t or "").encode().lower().split()
        out.append({tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set()))
    return out


def brute(rows):
    ss = brute_sets([t for _, t in rows])
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if ss[i] and ss[j] and 100 * len(ss[i] & ss[j]) >= 80 * len(ss[i] | ss[j]):
                up[max(root(i), root(j))] = min(root(i), root(j))
    least = {}
    for i, (d, _) in enumerate(rows):
        least[root(i)] = min(d, least.get(root(i), d))
    return sorted((d, len(ss[i]), least[root(i)]) for i, (d, _) in enumerate(rows))


def corpus(seed, n=40):
    rnd = random.Random(seed)
    word = lambda: rnd.choice("abcdefghijklmnop") + str(rnd.randrange(60))
    passage = [word() for _ in range(14)]
    out = [None, "", " \t\n", "one", "ONE", "two words", "a b c d e", "a b c d e", "A b c\td e"]
    for _ in range(n):
        base = [word() for _ in range(rnd.choice([4, 6, 20, 50, 60, 120, 400, 1500]))]
        if rnd.random() < 0.5:
            base += passage
        for _ in range(rnd.choice([1, 2, 5])):
            c = list(base)
            for _ in range(rnd.randrange(0, 1 + len(c) // 35)):
                c[rnd.randrange(len(c))] = word()
            if rnd.random() < 0.3:
                c += [word() for _ in range(rnd.randrange(1 + len(c) // 5))]
            out.append(" ".join(c))
    rnd.shuffle(out)
    return [(3 * i + 1, t) for i, t in enumerate(out)]


def test_keys_meet_for_every_link():
    rnd = np.random.default_rng(1)
    for n in (1, 2, 3, 4, 5, 9, 40, 47, 48, 49, 61, 75, 76, 77, 121, 122, 500, 3000):
        for _ in range(12):
            u = np.unique(rnd.integers(0, 1 << 63, 2 * n + 8, dtype=np.uint64))
            rnd.shuffle(u)
            a = np.sort(u[:n])
            drop = rnd.integers(0, n // 5 + 1)
            add = rnd.integers(0, max(0, (5 * (n - drop) - 4 * n) // 4) + 1)
            b = np.sort(np.r_[u[drop:n], u[n:n + add]])
            if jaccard.linked(len(np.intersect1d(a, b)), len(a), len(b)):
                spares = {}
                for s in (a, b):
                    if len(s) >= jaccard.SMALL:
                        k = jaccard.band_of(len(s))
                        spares[k] = min(jaccard.spare(s), spares.get(k, 1 << 30))
                assert len(np.intersect1d(jaccard.keys_of(a, spares), jaccard.keys_of(b, spares)))
                weak = dict.fromkeys(spares, 0)
                assert len(np.intersect1d(jaccard.keys_of(a, weak), jaccard.keys_of(b, weak)))


def test_unrelated_sets_share_no_keys():
    """Blocks of few elements are not equal by chance, however many sets there are."""
    rnd = np.random.default_rng(7)
    sets = [np.unique(rnd.integers(0, 1 << 63, 70, dtype=np.uint64)) for _ in range(3000)]
    spares = {0: min(jaccard.spare(s) for s in sets)}
    keys = np.concatenate([jaccard.keys_of(s, spares) for s in sets])
    assert len(keys) > 3000 and len(np.unique(keys)) == len(keys)


def test_sketch_bounds_the_difference():
    rnd = np.random.default_rng(2)
    for n in (60, 300):
        a, b = (np.unique(rnd.integers(0, 400, n, dtype=np.uint64)) for _ in range(2))
        diff = len(np.setxor1d(a, b))
        f, g = jaccard.fold(a), jaccard.fold(b)
        assert np.bitwise_count(f ^ g).sum() <= diff
        assert np.bitwise_count(jaccard.halved(f, 4) ^ jaccard.halved(g, 4)).sum() <= np.bitwise_count(f ^ g).sum()
        (v, c), (w, d) = jaccard.sketch(a, 0), jaccard.sketch(b, 0)
        assert max(np.count_nonzero(v != w), np.abs(c - d).sum()) <= diff


@pytest.mark.parametrize("seed,few", [(1, 8), (2, 2)])
def test_components_equal_brute_force(spark, seed, few):
    rows = corpus(seed)
    df = spark.createDataFrame([(d, t, 1, 2, 3) for d, t in rows], SCHEMA).repartition(5)
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.op8(df, few).collect())
    assert got == brute(rows)
    keep = [r.doc_id for r in jaccard.kept(df).collect()]
    assert sorted(keep) == sorted({c for _, _, c in got})


def test_repeats_nulls_empty(spark):
    rows = [(5, "a b c d e f"), (5, "a b c d e f"), (None, "a b c d e f"), (None, "lonely one"), (2, "A B C D E F")]
    got = [(r.doc_id, r.n_shingles, r.component_id) for r in jaccard.op8(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    assert sorted(got, key=str) == sorted([(5, 2, 2), (5, 2, 2), (None, 2, 2), (2, 2, 2), (None, 1, None)], key=str)
    empty = spark.createDataFrame([], SCHEMA)
    assert jaccard.op8(empty).count() == 0 and jaccard.kept(empty).count() == 0


@pytest.mark.parametrize("part", [1, 3, 6, 100])
def test_a_bucket_that_passes_in_parts_loses_no_member(part):
    """Sizes around the part's, also with few nodes after it, in batches of any size."""
    import pyarrow as pa
    rnd = np.random.default_rng(part)
    sizes = [1, 2, 3, 4, 5, 6, 7, 8, 9, 13, 20, 3, 2, 1, 40]
    key = np.repeat(64 * np.arange(len(sizes)), sizes)
    node = np.concatenate([np.sort(rnd.choice(1000, n, replace=False)) for n in sizes])
    twice = np.sort(np.r_[np.arange(len(key)), rnd.integers(0, len(key), 30)])  # repeated rows
    for step in (1, 2, 5, 1000):
        rows = [pa.RecordBatch.from_arrays([pa.array(key[twice][k:k + step]), pa.array(node[twice][k:k + step])], names=["key", "node"]) for k in range(0, len(twice), step)]
        got = [(k, a, b) for t in jaccard.in_runs(iter(rows), 3, part) for k, a, b in zip(*(c.to_pylist() for c in t.columns))]
        members = sorted((a, b) for k, a, b in got if k == 1)
        assert members == sorted((int(x), int(y)) for x, y in zip(key, node) if sizes[x // 64] > 3)
        pairs = {(a, b) for k, a, b in got if k == 0}
        for g, n in enumerate(sizes):
            own = node[key == 64 * g].tolist()
            want = {(a, b) for a in own for b in own if a < b} if n <= 3 else {(own[0], b) for b in own[1:]}
            assert want <= pairs


def test_large_groups_in_parts_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", 4)
    real = jaccard.candidates
    monkeypatch.setattr(jaccard, "candidates", lambda docs, spares, few: real(docs, spares, few, 5))
    rnd = random.Random(3)
    base = [f"w{k}" for k in range(300)]
    rows = []
    for i in range(60):  # near copies, and texts that share a long passage only
        c = list(base) if i % 2 else base[:90] + [f"u{i}x{k}" for k in range(210)]
        for _ in range(rnd.randrange(4)):
            c[rnd.randrange(len(c))] = f"e{rnd.randrange(10 ** 6)}"
        rows.append((i, " ".join(c)))
    df = spark.createDataFrame([(d, t, 1, 2, 3) for d, t in rows], SCHEMA)
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.op8(df, 2).collect()) == brute(rows)


def near_copies(n, edits, seed=5):
    rnd = random.Random(seed)
    base = [f"w{k}" for k in range(150)]
    rows = []
    for i in range(n):
        c = list(base)
        for k in rnd.sample(range(150), edits[i % len(edits)]):
            c[k] = f"e{i}x{k}"
        rows.append((i, " ".join(c)))
    return rows


def test_open_pairs_of_a_large_bucket_do_not_travel(spark, monkeypatch):
    """Texts whose differences are near the limit leave pairs open with the square of
    their number; a bucket gives a spanning forest of them."""
    monkeypatch.setattr(jaccard, "BLOCK", 16)
    rows = jaccard.members(spark.createDataFrame(near_copies(60, [2]), "doc_id long, text string")).collect()
    nodes = spark.createDataFrame([(r.node, r.n, r.fold) for r in rows], "node long, n long, fold binary")
    folds = [(r.node, np.frombuffer(r.fold, np.uint64)) for r in rows]
    open_ = [(a, b) for k, (a, f) in enumerate(folds) for b, g in folds[:k] if 9 * int(np.bitwise_count(f ^ g).sum()) <= 2 * max(rows[0].n, 1)]
    unresolved = spark.createDataFrame([(1, r.node, r.node) for r in rows], "key long, node long, label long").coalesce(1)
    got = [(r.a, r.b) for r in jaccard._crossing(unresolved, nodes).collect()]
    tasks = spark.sparkContext.defaultParallelism
    assert len(open_) > 300 and set(map(frozenset, got)) <= set(map(frozenset, open_)) and len(got) < min(59 * tasks, 180)
    trees, want = jaccard.Forest(), jaccard.Forest()
    for e in got:
        trees.join(*e)
    for e in open_:
        want.join(*e)
    for a, b in ((a, b) for a, _ in folds for b, _ in folds):
        assert (trees.root(a) == trees.root(b)) == (want.root(a) == want.root(b))


def test_near_copies_at_the_limit_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", 16)
    monkeypatch.setattr(jaccard, "SET_BLOCK", 8)
    monkeypatch.setattr(jaccard, "starred", lambda key: np.zeros(len(key), bool))
    rows = near_copies(70, [1, 2, 2, 3, 4])
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.op8(spark.createDataFrame(rows, "doc_id long, text string"), 2).collect())
    assert got == brute(rows) and 1 < len({c for _, _, c in got}) < 70
