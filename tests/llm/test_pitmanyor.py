import math
import random
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from cohortkit.llm import pitmanyor as py

SCHEMA = "doc_id long, text string, row long, word string, score double"


def corpus(n=300):
    rnd = random.Random(6)
    vowels, others = [w + "a" for w in "bcdfghjkl"], [w + "k" for w in "aeioumnp"]
    rows = []
    for i in range(n):
        w = []
        for _ in range(rnd.choice([0, 1, 8, 60, 200])):
            near = w and w[-1].lower().endswith("a")
            w.append(rnd.choice(others if near else vowels) if rnd.random() < 0.9 else rnd.choice(["Rare%d" % rnd.randrange(400), "x" * 5]))
        rows.append((i, " ".join(w)))
    return rows + [(n, None), (n + 1, ""), (n + 2, "never seen"), (n + 2, "never seen"), (None, "ba ak")]


def token_lists(rows):
    return [(t or "").encode().lower().split() + [b"\n"] for _, t in rows]


@pytest.mark.parametrize("limit", [0, 30, 100_000])
def test_contract(spark, limit):
    rows = corpus()
    out = py.op9(spark.createDataFrame([(d, t, 1, "w", 2.0) for d, t in rows], SCHEMA).repartition(3), limit).collect()
    crc = lambda d: zlib.crc32(("" if d is None else str(d)).encode()) % 10
    toks = token_lists(rows)
    count = Counter(w for (d, _), ws in zip(rows, toks) if crc(d) for w in ws)
    n, v = sum(count.values()), len(count)
    assert len(out) == len(rows)
    want = {}
    for (d, _), ws in zip(rows, toks):
        base = sum(math.log10((count[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws)
        want[d] = (crc(d) == 0, len(ws), sum(count[w] > 0 for w in ws), n, base)
    for r in out:
        h, k, known, total, base = want[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (h, k, known, total)
        assert r.base_score == pytest.approx(base, rel=1e-9) and r.score <= 0
    held = [r for r in out if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held) + 0.1 * sum(r.n_tokens for r in held)


def test_probabilities_add_up(spark):
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id long, text string")
    named = py.frequent(df)
    table = py.counts(df, named)
    chain = py.gibbs(table)
    samples = chain[-py.SAMPLES:]
    model = py.predictive(table, chain).collect()
    word = 257 + int(np.searchsorted(named, py.hash_words([b"ba"]).view(np.int64)[0]))
    back, floor = np.stack([s.back() for s in samples]), [s.floor() for s in samples]
    for ctx in (py.START, word, ord("a"), ord("k")):
        total = sum(dict(zip(r.ctx, r.own)).get(ctx, 0.0) + sum(back[s, ctx] * r.root[s] for s in range(py.SAMPLES)) / py.SAMPLES for r in model)
        unknown = sum(back[s, ctx] * floor[s] for s in range(py.SAMPLES)) / py.SAMPLES
        assert total + unknown == pytest.approx(1.0, abs=1e-9)


def test_seating_follows_the_restaurant():
    rng = np.random.default_rng(1)
    draw = py.keyed(1, 0, np.arange(3000), np.zeros(3000, np.int64))
    for c, a, d in ((5, 0.5, 0.5), (40, 2.0, 0.7), (400, 3.0, 0.3), (3000, 0.05, 0.7)):
        jumps = py.seat(np.full(3000, c), np.full(3000, a), d, draw).mean()
        exact = []
        for _ in range(300):
            t = 1
            for k in range(2, c + 1):
                t += rng.random() * (a + k - 1 - d * t) < a
            exact.append(t)
        assert abs(jumps - np.mean(exact)) < 4 * (np.std(exact) + 0.05) / 300 ** 0.5 + 0.02


def test_tokens_and_contexts():
    named = np.sort(py.hash_words([b"the", py.END]).view(np.int64))
    at = {w: 257 + int(np.searchsorted(named, py.hash_words([w]).view(np.int64)[0])) for w in (b"the", py.END)}
    w, ctx, doc = py.tokens(["The cat", None, "", "a the the"], named)
    assert doc.tolist() == [0, 0, 0, 1, 2, 3, 3, 3, 3]
    assert ctx.tolist() == [py.START, at[b"the"], ord("t"), py.START, py.START, py.START, ord("a"), at[b"the"], at[b"the"]]
    assert w[0] == w[6] == w[7] and w[2] == w[3] == w[8]
    assert py.tokens(["The cat"], named[:0])[1].tolist() == [py.START, ord("e"), ord("t")]
    assert all(len(x) == 0 for x in py.tokens([], named))


def test_partitions_and_samples(spark):
    df = spark.createDataFrame(corpus(), "doc_id long, text string")
    a, b = ({(r.doc_id, r.n_tokens): r.score for r in py.op9(df.repartition(n)).collect()} for n in (1, 7))
    assert a.keys() == b.keys() and all(a[k] == pytest.approx(b[k], rel=1e-9) for k in a)
    chain = py.gibbs(py.counts(df, py.frequent(df)))
    assert len(chain) == 1 + py.BURN + py.SAMPLES
    assert len({c.tables.sum() for c in chain[1:]}) > 1


def test_a_very_long_text_and_few_entries(spark, monkeypatch):
    rnd = random.Random(2)
    long = " ".join(rnd.choice(["ba", "ek", "Cu"]) + str(rnd.randrange(300)) for _ in range(200_000))
    df = spark.createDataFrame(corpus(60) + [(500 + i, long) for i in range(2)], "doc_id long, text string")
    want = {(r.doc_id, r.n_tokens): r.score for r in py.op9(df).collect()}
    monkeypatch.setattr(py, "ENTRIES", 50)
    got = {(r.doc_id, r.n_tokens): r.score for r in py.op9(df).collect()}
    assert got.keys() == want.keys() and (500, 200_001) in got
    assert all(got[k] == pytest.approx(want[k], rel=1e-9) for k in got)


def test_empty_and_untrained(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert py.op9(df).count() == 0
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 10 == 0)
    r = py.op9(spark.createDataFrame([(held, "a b")], "doc_id long, text string")).first()
    assert (r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) == (3, 0, 0, 0.0, 0.0)


def test_words_are_hashed_from_the_column_bytes():
    texts = ["A" * 200 + " b\tC\x0bd\x1ce " + "x" * 65 + " " + "y" * 64, "", None, "  ", "é É z", "abcdefgh abcdefghi"]
    column = pa.array(["left out", *texts]).slice(1)
    lists = token_lists(enumerate(texts))
    w, last, size = py.word_hashes(column)
    flat = [x for ws in lists for x in ws]
    assert size.tolist() == [len(ws) for ws in lists] and last.tolist() == [x[-1] for x in flat]
    assert w.tolist() == py.hash_words(flat).view(np.int64).tolist() and len(set(w.tolist())) == len(set(flat))
    assert [(a, n) for a, n in py.slices(column, 4, 100)] == [(0, 1), (1, 4), (5, 1)]


def test_finder_finds_each_number():
    rng = np.random.default_rng(3)
    for kind, n in ((np.uint64, 0), (np.uint64, 1), (np.uint64, 5000), (np.uint32, 5000)):
        keys = np.unique(rng.integers(0, np.iinfo(kind).max, n, kind, endpoint=True))
        finder = py.Finder(keys)
        place, found = finder.find(keys)
        assert found.all() and place.tolist() == list(range(len(keys)))
        other = np.setdiff1d(np.r_[keys + kind(1), np.array([0, np.iinfo(kind).max], kind)], keys)
        assert not finder.find(other)[1].any()
    key = py.pair(np.repeat(np.arange(300), 3), np.tile(np.array([0, 256, py.CONTEXTS - 1]), 300), np.uint32)
    assert len(np.unique(key)) == 900


def whole_model(rows, seed=5):
    """Scores of each text by the same draws, all pairs in one place."""
    crc = lambda d: zlib.crc32(("" if d is None else str(d)).encode()) % 10
    lists = token_lists(rows)
    ids = {w: int(py.hash_words([w]).view(np.int64)[0]) for ws in lists for w in ws}
    pairs = lambda ws: list(zip([py.END, *ws[:-1]], ws))
    count = Counter(p for (d, _), ws in zip(rows, lists) if crc(d) for p in pairs(ws))
    words = sorted({w for _, w in count})
    at = {w: i for i, w in enumerate(words)}
    key = list(count)
    v, w = (np.array([at[p[i]] for p in key]) for i in (0, 1))
    h, c, size = np.array([ids[x] for x in words]), np.array([count[p] for p in key]), len(words)
    n = np.bincount(w, weights=c)
    own, samples = np.zeros(len(key)), []
    t, root_tables, guests_in_all = np.ones(len(key)), float(size), 0.0
    for sweep in range(py.BURN + py.SAMPLES + 1):
        if sweep:
            p = (guests - py.ROOT_DISCOUNT * r + weight) / (py.ROOT_STRENGTH + guests_in_all)
            t = py.seat(c, (py.STRENGTH + py.DISCOUNT * tables)[v] * p[w], py.DISCOUNT, py.keyed(seed, 2 * sweep, h[w], h[v]))
        weight = (py.ROOT_STRENGTH + py.ROOT_DISCOUNT * root_tables) / (size + 1)
        tables, guests = (np.bincount(x, weights=t, minlength=size) for x in (v, w))
        r = py.seat(guests, np.full(size, weight), py.ROOT_DISCOUNT, py.keyed(seed, 2 * sweep + 1, h, np.full(size, -1)))
        root_tables, guests_in_all = r.sum(), guests.sum()
        weight = (py.ROOT_STRENGTH + py.ROOT_DISCOUNT * root_tables) / (size + 1)
        if sweep > py.BURN:
            own += (c - py.DISCOUNT * t) / py.SAMPLES
            base = py.ROOT_STRENGTH + guests_in_all
            samples.append(((py.STRENGTH + py.DISCOUNT * tables) / (py.STRENGTH + n), (guests - py.ROOT_DISCOUNT * r + weight) / base, weight / base))
    pair_at = {p: i for i, p in enumerate(key)}

    def prob(a, b):
        x = own[pair_at[a, b]] / (py.STRENGTH + n[at[a]]) if (a, b) in pair_at else 0.0
        return x + sum((back[at[a]] if a in at else 1.0) * (root[at[b]] if b in at else floor) for back, root, floor in samples) / py.SAMPLES

    for a in (py.END, words[len(words) // 2], b"never"):
        assert sum(prob(a, b) for b in words) + prob(a, b"unseen") == pytest.approx(1.0, abs=1e-9)
    return [sum(math.log10(prob(a, b)) for a, b in pairs(ws)) for ws in lists]


@pytest.mark.parametrize("limit", [500, None])
def test_every_word_is_a_context(spark, monkeypatch, limit):
    rows = corpus(80)
    chain = ["w%04d" % (i * 7919 % 3000) for i in range(3000)]  # each has its follower, all end in a digit
    rows += [(1000 + i, " ".join(chain[j % 3000] for j in range(50 * i, 50 * i + 70))) for i in range(120)]
    monkeypatch.setattr(py, "NAMED", 2)
    monkeypatch.setattr(py, "ENTRIES", 4000)
    got = {(r.doc_id, r.n_tokens): r for r in py.op9(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), limit).collect()}
    for (d, _), ws, want in zip(rows, token_lists(rows), whole_model(rows)):
        assert got[d, len(ws)].score == pytest.approx(want, rel=1e-9)
    held = [r for r in got.values() if r.held_out and r.doc_id and r.doc_id >= 1000]
    assert sum(r.score for r in held) > sum(r.base_score for r in held) + 1.0 * sum(r.n_tokens for r in held)


def test_packed_lists():
    assert py.unpacked("code", py.packed("code", np.arange(-2, 700), np.array([702]))[0]).tolist() == list(range(-2, 700))
    assert py.unpacked("word", py.packed("word", np.array([3, -(1 << 60)]), np.array([2, 0]))[0]).tolist() == [3, -(1 << 60)]
    assert len(py.unpacked("n", py.packed("n", np.arange(3), np.array([3, 0]))[1])) == 0


def test_few_numbers_are_held_at_once():
    rng = np.random.default_rng(3)
    word = np.unique(rng.integers(-(1 << 62), 1 << 62, 3000))
    x, n = [rng.integers(0, len(word) ** 2, 1 << 20)], 1 << 20
    u, at = np.unique(x[0], return_inverse=True)
    x[0] = x[0].copy()
    tracemalloc.start()
    try:
        key, place = py.distinct(x.pop())
        assert tracemalloc.get_traced_memory()[1] < 26 * n  # besides the given numbers
        assert np.array_equal(key, u) and np.array_equal(place, at)
        tracemalloc.reset_peak()
        held = tracemalloc.get_traced_memory()[0]
        group, before, this, mine = py.grouped(word, key, 40)
        assert tracemalloc.get_traced_memory()[1] - held < 50 * n
        tracemalloc.reset_peak()
        held = tracemalloc.get_traced_memory()[0]
        py.packed("word", key, np.array([len(key) - 5, 0, 5]))
        assert tracemalloc.get_traced_memory()[1] - held < 100_000  # no copy
    finally:
        tracemalloc.stop()
    assert np.array_equal(before * len(word) + this.astype(np.int64), key[mine])
    assert np.array_equal(group, py.pair_group(word[before], word[this], 40))
    assert np.all(np.diff(group.astype(int)) >= 0) and np.array_equal(np.sort(mine), np.arange(len(key)))
    for empty in (py.distinct(np.empty(0, np.int64)), py.grouped(word, key[:0], 40)):
        assert all(len(a) == 0 for a in empty)


def test_texts_are_summed_in_spans():
    size = np.array([3, 1, 9, 2, 2])
    got = list(py.text_spans(size, 4))
    assert got == [(slice(0, 2), slice(0, 4)), (slice(2, 3), slice(4, 13)), (slice(3, 5), slice(13, 17))]
    assert list(py.text_spans(size[:0])) == []


def test_answers_are_read_in_order_of_their_senders():
    one = np.array([2, 1, 0, 1])
    t = py._rows("kind int, frm int, t binary, r binary", 4, kind=np.array([0, 1, 0, 1]), frm=np.array([7, 2, 1, 0]), t=(np.array([5, 6, 8, 9]), one))
    assert py._where(t, "kind", 1).tolist() == [1, 3]
    assert [x.tolist() for x in py._answer(t, ("t", "r"))] == [[9, 8, 5, 6], []]
    assert py._answer(t, ("t",), py._where(t, "kind", 0))[0].tolist() == [5, 6]
