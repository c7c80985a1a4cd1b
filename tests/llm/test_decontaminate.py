import hashlib
import re

import numpy as np
import pytest

from cohortkit.llm import decontaminate as dc

DOCS = "doc_id long, text string, lang string, source string, n_chars long, n_hit long, item_id string"
CLASS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def words(text):
    return CLASS.findall((text or "").translate(LOWER))


def brute(docs, items, window=10):
    wins = {}
    for i, t in items:
        w = words(t)
        k = min(window, len(w))
        for a in range(len(w) - k + 1 if w else 0):
            wins.setdefault(tuple(w[a:a + k]), set()).add("" if i is None else str(i))
    lengths = {len(w) for w in wins}
    out = []
    for i, t in docs:
        w, hit, names = words(t), set(), set()
        for k in lengths:
            for a in range(len(w) - k + 1):
                if tuple(w[a:a + k]) in wins:
                    hit.update(range(a, a + k))
                    names |= wins[tuple(w[a:a + k])]
        out.append((i, len(w), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def rows(spark, docs, items):
    d = spark.createDataFrame([(i, t, "en", "s", 1, 7, "x") for i, t in docs], DOCS)
    return d, spark.createDataFrame([(i, t, "q") for i, t in items], "item_id long, text string, doc_id string")


def fixture(seed=5):
    rng = np.random.default_rng(seed)
    vocab = ["a", "Bb", "cé", "d1", "ee", "ff", "gg", "hh"]
    say = lambda n: " ".join(vocab[k] for k in rng.integers(0, len(vocab), n))
    items = [(k, say(int(rng.integers(1, 40)))) for k in range(30)]
    items += [(3, "other text of a known id"), (None, "Short one"), (50, None), (51, ""), (52, "..."), items[4], (60, items[5][1]), (10, "x y z " * 8)]
    docs = [(k, say(int(rng.integers(0, 60)))) for k in range(80)]
    docs += [(200 + k, say(5) + ", " + items[k][1].upper() + "!\n" + say(5)) for k in range(30)]
    docs += [(300, None), (301, ""), (302, " .-"), (None, "a short ONE indeed"), (None, "a short ONE indeed"), docs[85]]
    docs += [(400 + k, "x y z " * 30) for k in range(20)]  # a hot group that repeats a passage over and over
    docs += [(500, say(30_000) + " short one " + say(30_000)), (501, "word" * 5000 + " short one")]
    return docs, items


def result(df):
    return sorted([tuple(r) for r in df.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated").collect()], key=str)


def test_equals_brute_force(spark):
    docs, items = fixture()
    assert result(dc.op13(*rows(spark, docs, items))) == brute(docs, items)


@pytest.mark.parametrize("name,value", [("SHARD", 300), ("BLOCK", 400), ("PIECE", 7)])
def test_shards_blocks_and_pieces_change_nothing(spark, monkeypatch, name, value):
    monkeypatch.setattr(dc, name, value)
    docs, items = fixture(8)
    docs = [(i, t[:3000] if t and i != 501 else t) for i, t in docs]
    blocks, _ = dc._blocks(rows(spark, docs, items)[1], 10)
    assert name != "BLOCK" or len(blocks) > 3
    # workers are separate processes: the in-process search takes the changed sizes
    held = [dc.Items(*b.value) for b in blocks]
    got, at = [], 0
    for part in dc._shards([t for _, t in docs]):
        shard = dc.Shard(part, max(x.longest for x in held))
        edge, names = np.zeros(len(shard.s) + 1, int), [set() for _ in part]
        for x in held:
            _, _, places, of = shard.search(x)
            for p, w in zip(places, of):
                edge[p:p + x.size[x.window[w]]] = 1
                names[shard.document(p)].update(x.ids[k] for k in x.owners[x.owned[w]:x.owned[w + 1]])
        for b, n, who in zip(shard.begin, shard.sizes, names):
            hit = int(edge[b:b + n].sum())
            got.append((docs[at][0], int(n), hit, len(who), hashlib.sha256(",".join(sorted(who)).encode()).hexdigest(), hit > 0))
            at += 1
    assert sorted(got, key=str) == brute(docs, items)


def test_empty_tables(spark):
    docs, items = fixture()
    d, b = rows(spark, docs, items)
    assert dc.op13(d.limit(0), b).count() == 0
    clean = dc.op13(d, b.limit(0))
    assert clean.where("contaminated or n_hit > 0 or n_items > 0").count() == 0 and clean.count() == len(docs)


def test_removal_keeps_all_columns_and_clean_rows(spark):
    docs, items = fixture()
    d, b = rows(spark, docs, items)
    kept = dc.decontaminated(d, b)
    assert kept.columns == d.columns
    want = sorted([r[0] for r in brute(docs, items) if not r[5]], key=str)
    assert sorted([r.doc_id for r in kept.collect()], key=str) == want


def test_longest_matches_and_their_places(spark):
    docs, items = fixture()
    docs, items = [x for x in docs if x[0] is not None and x[0] < 300], [x for x in items if x[0] is not None and x[0] != 3]
    d, b = rows(spark, docs, items)
    got = {(r.item_id, r.item_word): (r.length, r.doc_id, r.doc_word) for r in dc.matches(d, b, 6).collect()}
    texts, want = {i: words(t) for i, t in docs}, {}
    for i, t in items:
        w = words(t)
        for a in range(len(w)):
            best = 0
            for s in texts.values():
                for p in range(len(s)):
                    k = 0
                    while a + k < len(w) and p + k < len(s) and w[a + k] == s[p + k]:
                        k += 1
                    best = max(best, k)
            if best >= 6:
                want[str(i), a] = max(best, want.get((str(i), a), 0))
    assert {k: v[0] for k, v in got.items()} == want
    for (i, a), (n, doc, p) in got.items():
        assert any(words(t)[a:a + n] == texts[doc][p:p + n] for k, t in items if str(k) == i)


def test_suffix_array_order():
    rng = np.random.default_rng(1)
    for top, depth in ((2, 64), (3, 7), (40, 9), (1 << 40, 5)):
        s = np.r_[rng.integers(1, top + 1, 200), 0, np.ones(40, int), 0, rng.integers(1, top + 1, 200), 0]
        sa = dc.suffix_array(s, depth)
        assert sorted(sa) == [k for k in range(len(s)) if s[k]]
        keys = [tuple(s[p:p + depth]) for p in sa]
        assert keys == sorted(keys)
