import re
import zlib
from collections import Counter

import numpy as np
import pytest

from cohortkit.llm import spelling as sp

DOCS = "doc_id long, text string, lang string, word string, n long, root string"


def count(docs):
    total = Counter()
    for i, t in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{low}".encode())
            if h % 97 == 0:
                low = low[:h % len(low)] + low[h % len(low) + 1:]
            total[low] += 1
    return {w: n for w, n in total.items() if len(w) >= 5 and n >= 3}


def near(words):
    """Near words by what each shares with others when a code point goes."""
    by, out = {}, {w: set() for w in words}
    for w in words:
        for k in range(len(w)):
            cut = w[:k] + w[k + 1:]
            by.setdefault((k, cut), set()).add(w)
            if cut in out:
                out[w].add(cut)
                out[cut].add(w)
    for group in by.values():
        for w in group:
            out[w] |= group - {w}
    return out


def brute(words):
    of, rows, form = near(words), {}, {}
    for w, n in words.items():
        best = min(of[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= 2 * n else None
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        rows[w] = (form[w], root, n, len(of[w]), words[form[w]] if form[w] else None)
    return rows


def result(df):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()}


def crowd(seed, n, letters="abé", longest=11):
    """Words of few letters, so that near ones and common grams abound."""
    rng = np.random.default_rng(seed)
    out = {"".join(rng.choice(list(letters), int(rng.integers(5, longest)))) for _ in range(n)}
    return {w: int(rng.integers(3, 200)) for w in sorted(out)}


@pytest.mark.parametrize("seed,common,hot", [(1, 64, 1024), (2, 3, 8), (3, 1, 2), (4, 20, 40)])
def test_near_words_equal_brute_force(spark, monkeypatch, seed, common, hot):
    monkeypatch.setattr(sp, "COMMON", common)
    monkeypatch.setattr(sp, "HOT", hot)
    words = crowd(seed, 700)
    rng = np.random.default_rng(seed)
    base = "".join(rng.choice(list("abcdefgh"), 120))
    for w in (base, base[:60] + "x" + base[61:], base[:-1], base + "q", "z" + base, base[:70], base[:70] + "aa", base[:46], base[:47], base[:48], base[:49], "aaaaa", "aaaaaa", "aaaaaaaa"):
        words[w] = words.get(w, 7)
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    got = {}
    for r in sp.near_words(df).collect():
        assert r.other not in got.setdefault(r.word, set()), "a pair came twice"
        got[r.word].add(r.other)
        assert r.n == words[r.other]
    assert got == {w: x for w, x in near(words).items() if x}


def fixture():
    words = crowd(9, 250, "abcdeé")
    rng = np.random.default_rng(4)
    names = list(words)
    docs = [(k, " ".join(w.upper() if k % 3 else w for w in rng.choice(names, 60))) for k in range(120)]
    docs += [(500 + k, "chained " * 3 + "chainex " * 6 + "chaixex " * 12 + "chaxxex,chaxxex." * 24) for k in range(2)]
    docs += [(700, None), (701, ""), (None, "nulled nulled nulled ×÷×÷× ×÷×÷× ×÷×÷×"), docs[5], docs[5], (702, "É" * 6 + " éééééé " * 3)]
    return docs + [(900, "lengthy wordings " * 70_000), (901, "y" * 100_000 + " " + "y" * 100_000 + "1" + "y" * 100_000)]


def test_variants_equal_brute_force(spark):
    docs = fixture()
    df = spark.createDataFrame([(i, t, "en", "w", 1, "r") for i, t in docs], DOCS)
    want = brute(count(docs))
    got = result(sp.op12(df))
    assert got == want
    assert got["chained"][:2] == ("chainex", "chaxxex") and want["y" * 100_000][0] is None
    assert sp.op12(df.limit(0)).count() == 0


def test_pieces_of_a_text(monkeypatch):
    text = "One two-three,four " * 40 + "x" * 50
    whole = sp._runs(text)
    monkeypatch.setattr(sp, "PIECE", 7)
    assert sp._runs(text) == whole and whole[b"three"] == 40


def test_dictionary_is_closed_under_prefixes_and_counts_words(spark):
    words = crowd(11, 400)
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    known = sp.dictionary(df, 10)
    assert (known.counts > 10).all() and len(known.keys) > 50
    w = sp.Words(list(words))
    rows, band = sp._bands(w)
    held = Counter()
    for side, d, place in w.starts(rows, band):
        key, size, n = w.grow(rows, band, side, d, place, known)
        for g in range(2, sp.LONGEST + 1):
            k, s, _ = w.grow(rows, band, side, d, place, known, g)
            held.update(k[s == g].tolist())
        assert ((size == sp.longest_gram(band)) | (n < 0) | (place < 0) | (place + size == w.size[rows] + 2)).all()
    assert {k: n for k, n in held.items() if n > 10} == dict(zip(known.keys.tolist(), known.counts.tolist()))
