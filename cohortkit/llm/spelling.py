"""Operator 12: spelling variants by an index of variable-length grams.

Words of ``MIN_LENGTH`` code points and ``MIN_COUNT`` occurrences at least are
compared; two are near if one inserted, deleted or replaced code point parts
them. A pair belongs to the band of its shorter length l, so a word takes part
in the band of its own length and, as a longer partner, in the one below.

Words get a mark before and behind. A gram begins at one of the first or last
places of a word and is known by its side and distance from that end. The gram
dictionary is built level by level: a gram of ``SHORTEST`` characters grows by
one for as long as more than T words of the band hold it there, to half the
band's padded length and ``LONGEST`` at most. What stops a gram's growth lies
within it, so an edit outside a gram leaves the gram and its length as they are.
The dictionary of frequent grams has a proven bound (T grows with the words) and
is broadcast.

Bounds of what an edit can affect: an edit affects a left gram only at its
places, and leaves it where it is if it lies behind; the same holds for a right
gram, seen from the end. So of a left and a right gram of a word that do not
overlap each edit leaves one, with its key, in the other word as well. Of all
such pairs of grams a word merges the two lists that are the shortest by the
dictionary's counts, and skips the others. Every pair of a word and a member of
such a list is verified. A pair that first differs behind the left gram counts in
the left list, any other in the right list.

A list of more than ``HOT`` words is not compared: its words meet in sublists by
what is left of them without one code point, which hold near words only.

Defined results: null texts have no words; a null doc_id counts as empty in the
checksum; repeated rows count each; other columns are ignored; an empty table
gives an empty table. Words hold code points below U+0100 only, by the pattern.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, UPPER, hash_words, mix64, written

MIN_LENGTH, MIN_COUNT, EVERY = 5, 3, 97
SHORTEST, LONGEST, STEPS = 2, 6, 2
COMMON = 64
GRAMS = 400_000
HOT = 1024
WIDE = 48
PAIRS = 1 << 20
PIECE = 1 << 20
RUN, NOT_RUN = re.compile("[A-Za-zÀ-ÿ]+"), re.compile("[^A-Za-zÀ-ÿ]")
LEFT, RIGHT = 0, 1
ROWS = "key long, word string, n long, role int, split int"


def _runs(text: str) -> Counter:
    """Runs of a text, A-Z lower-cased; long texts are taken in pieces."""
    found, at = Counter(), 0
    while at < len(text):
        gap = NOT_RUN.search(text, at + PIECE)
        end = gap.start() if gap else len(text)
        found.update(RUN.findall(text, at, end))
        at = end
    out = Counter()
    for run, n in found.items():
        out[run.encode().lower()] += n
    return out


def vocabulary(docs: DataFrame, least: int = MIN_COUNT, length: int = MIN_LENGTH) -> DataFrame:
    """word, n: the distinct words of at least ``length`` code points and ``least``
    occurrences, some runs with a code point deleted by their checksum."""
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()

        def flush() -> pa.RecordBatch:
            b = pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], names=["word", "n"])
            total.clear()
            return b

        for b in batches:
            for at in range(b.num_rows):
                text, start = b.column(1)[at].as_py(), zlib.crc32(f"{b.column(0)[at].as_py() or ''}:".encode())
                for run, n in _runs(text or "").items():
                    h = zlib.crc32(run, start)
                    word = run.decode()
                    if h % EVERY == 0:
                        k = h % len(word)
                        word = word[:k] + word[k + 1:]
                    if len(word) >= length:
                        total[word] += n
                if len(total) > 300_000:
                    yield flush()
        if total:
            yield flush()

    rows = docs.select(F.col("doc_id").cast("string"), "text").mapInArrow(counted, "word string, n long")
    return rows.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def longest_gram(band: np.ndarray) -> np.ndarray:
    return np.minimum((band + 2) // 2, LONGEST)


class Words:
    """Code points of some words, and the grams of their ends."""

    def __init__(self, words: list[str]):
        self.size = np.array([len(w) for w in words], np.int64)
        self.codes = np.frombuffer("".join(words).encode("latin-1"), np.uint8).astype(np.uint64)
        self.start = np.cumsum(self.size) - self.size

    def code(self, rows: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Code at a place of the padded word: 1 before it, 2 behind it."""
        inner = self.codes[np.clip(self.start[rows] + place - 1, 0, len(self.codes) - 1)]
        return np.where(place == 0, np.uint64(1), np.where(place > self.size[rows], np.uint64(2), inner))

    def starts(self, rows: np.ndarray, band: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
        """(side, distance, first place) of each gram of the ends; -1: not in this word."""
        for p in range(STEPS + 1):
            yield LEFT, p, np.full(len(rows), p, np.int64)
        half = longest_gram(band)
        for d in range(-STEPS, STEPS + 1):
            far = half + d
            place = self.size[rows] + 2 - far
            yield RIGHT, d + STEPS, np.where((far >= SHORTEST) & (place > 0), place, -1)

    def grow(self, rows, band, side, distance, place, known: Dictionary, upto: int = LONGEST):
        """(key, length, words that hold it, or -1 where few do) of the grams that begin
        at ``place``; with ``upto``, what grew to that length and may need a count is
        marked by its length."""
        key = mix64(band.astype(np.uint64) * np.uint64(64) + np.uint64(side * 32 + distance))
        top, size = np.minimum(longest_gram(band), upto), np.zeros(len(rows), np.int64)
        count = np.full(len(rows), -1, np.int64)
        on = np.flatnonzero(place >= 0)
        for g in range(1, upto + 1):
            on = on[(g <= top[on]) & (place[on] + g <= self.size[rows[on]] + 2)]
            key[on] = mix64(key[on] * np.uint64(0x9E3779B97F4A7C15) + self.code(rows[on], place[on] + g - 1))
            size[on] = g
            if g >= SHORTEST:
                count[on] = known.count(key[on])
                on = on[count[on] > 0]
        return key, size, count


class Dictionary:
    """Keys of the frequent grams, with the number of words that hold each."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray):
        order = np.argsort(keys)
        self.keys, self.counts = keys[order], counts[order]

    def count(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.full(len(keys), -1, np.int64)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.counts[at], -1)


def _bands(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Each word in the band of its length, and in the one below as a longer partner."""
    rows = np.arange(len(words.size))
    longer = rows[words.size > MIN_LENGTH]
    return np.r_[rows, longer], np.r_[words.size, words.size[longer] - 1]


def _slices(batches: Iterator[pa.RecordBatch], n: int = 50_000) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for at in range(0, b.num_rows, n):
            yield b.slice(at, n)


def dictionary(words: DataFrame, common: int) -> Dictionary:
    """The grams that more than ``common`` words of a band hold, level by level: a
    level counts only what extends a frequent gram."""
    spark = words.sparkSession
    known = Dictionary(np.empty(0, np.uint64), np.empty(0, np.int64))
    for level in range(SHORTEST, LONGEST + 1):
        shared = spark.sparkContext.broadcast((known.keys, known.counts))

        def counted(batches: Iterator[pa.RecordBatch], level=level, shared=shared) -> Iterator[pa.RecordBatch]:
            known, held = Dictionary(*shared.value), []

            def flush() -> pa.RecordBatch:
                keys = np.concatenate([k for k, _ in held])
                u, of = np.unique(keys, return_inverse=True)
                n = np.bincount(of.ravel(), weights=np.concatenate([c for _, c in held]))
                held[:] = [(u, n)]
                return pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(n.astype(np.int64))], names=["key", "n"])

            for b in _slices(batches):
                w = Words(b.column(0).to_pylist())
                rows, band = _bands(w)
                for side, distance, place in w.starts(rows, band):
                    key, size, _ = w.grow(rows, band, side, distance, place, known, level)
                    key = key[size == level]
                    held.append((key, np.ones(len(key))))
                if sum(len(k) for k, _ in held) > 4_000_000:
                    b = flush()
                    if b.num_rows > 2_000_000:
                        held.clear()
                        yield b
            if held:
                yield flush()

        rows = words.select("word").mapInArrow(counted, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
        got = rows.where(F.col("n") > common).toArrow()
        if not got.num_rows:
            break
        known = Dictionary(np.r_[known.keys, got.column(0).to_numpy().view(np.uint64)], np.r_[known.counts, got.column(1).to_numpy()])
    return known


def _listed(words: DataFrame, known: Dictionary, hot: int) -> DataFrame:
    """The gram lists: key, word, n, role (0 longer partner, 1 member, 2 or 3 a member that
    merges this list as its left or right one), split (code points up to the end of the
    member's left gram: pairs that share as many first ones count in the left list)."""
    shared = words.sparkSession.sparkContext.broadcast((known.keys, known.counts))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Dictionary(*shared.value)
        for b in _slices(batches, 20_000):
            names = b.column(0).to_pylist()
            w = Words(names)
            rows, band = _bands(w)
            own = band == w.size[rows]
            grams = [(side, place, *w.grow(rows, band, side, d, place, known)) for side, d, place in w.starts(rows, band)]
            best = np.full(len(rows), np.iinfo(np.int64).max)
            pick = np.full((2, len(rows)), -1)
            for i, (side, p, _, g, n) in enumerate(grams):
                for j, (other, q, _, h, m) in enumerate(grams):
                    if side == LEFT and other == RIGHT:
                        cost = np.where(n < 0, COMMON, n) + np.where(m < 0, COMMON, m)
                        fit = (q >= 0) & (g >= SHORTEST) & (h >= SHORTEST) & (p + g <= q) & (cost < best)
                        best[fit], pick[0, fit], pick[1, fit] = cost[fit], i, j
            covered = np.zeros(len(rows), np.int64)
            for i, (side, p, _, g, _) in enumerate(grams):
                covered = np.where(pick[0] == i, p + g - 1, covered)  # first code points the left gram takes
            out = [[], [], [], []]
            for i, (side, place, key, size, n) in enumerate(grams):
                there = size >= SHORTEST
                chosen = (pick[side] == i) & own
                role = np.where(chosen, 2 + side, np.where(own, 1, 0))
                large = n > hot
                at = np.flatnonzero(there & ~large)
                for o, v in zip(out, (key[at], rows[at], role[at], covered[at])):
                    o.append(v)
                for k in np.flatnonzero(there & large):
                    sub = _sublists(names[rows[k]], int(key[k]), bool(own[k]))
                    for o, v in zip(out, (sub, *(np.full(len(sub), x[k]) for x in (rows, role, covered)))):
                        o.append(v)
            key, at, role, split = (np.concatenate(o) for o in out)
            yield pa.RecordBatch.from_arrays(
                [pa.array(key.astype(np.uint64).view(np.int64)), b.column(0).take(pa.array(at)), b.column(1).take(pa.array(at)),
                 pa.array(role.astype(np.int32)), pa.array(split.astype(np.int32))], names=["key", "word", "n", "role", "split"])

    return words.select("word", "n").mapInArrow(run, ROWS)


def _sublists(word: str, key: int, own: bool) -> np.ndarray:
    """Keys of a word in place of a long list's: the word without each of its code
    points, by place for words of one length, and as it is where it is the shorter one."""
    cuts = [word[:k] + word[k + 1:] for k in range(len(word))]
    names = [f"{k}/{c}" for k, c in enumerate(cuts)] + [word] if own else sorted(set(cuts))
    return mix64(hash_words([x.encode() for x in names]) ^ np.uint64(key))


def _one_apart(s: str, t: str) -> bool:
    k = next((i for i, (a, b) in enumerate(zip(s, t)) if a != b), min(len(s), len(t)))
    return s != t and s[k + 1:] == t[k + 1:] if len(s) == len(t) else len(t) == len(s) + 1 and s[k:] == t[k + 1:]


def _verified(i: np.ndarray, j: np.ndarray, m: np.ndarray, size: np.ndarray, right: np.ndarray, split: np.ndarray, words: list[str]) -> np.ndarray:
    """Which pairs (a merging word, a member of its list) are near and count in this list."""
    a, b = m[i], m[j]
    differ = a != b
    first = np.argmax(differ, axis=1)
    differ[np.arange(len(i)), first] = False
    same = (size[i] == size[j]) & (i != j) & ~differ.any(axis=1)
    longer = np.flatnonzero(size[j] == size[i] + 1)
    late = (a[longer, :-1] != b[longer, 1:]) & (np.arange(m.shape[1] - 1) >= first[longer][:, None])
    same[longer] = ~late.any(axis=1)
    wide = np.flatnonzero((size[i] >= WIDE) & (size[j] - size[i] <= 1) & (i != j))
    for k in wide:
        s, t = words[i[k]], words[j[k]]
        first[k] = next((x for x, (c, d) in enumerate(zip(s, t)) if c != d), len(s))
        same[k] = _one_apart(s, t)
    return same & ((first < split[i]) == right[i])


def _near(lists: DataFrame) -> DataFrame:
    """word, other, n: near words, both ways."""
    def pairs(t: pa.Table) -> Iterator[pa.RecordBatch]:
        key, role, split, n = (t.column(c).to_numpy() for c in ("key", "role", "split", "n"))
        words = t.column("word").to_pylist()
        size = np.array([len(w) for w in words], np.int64)
        m = np.zeros((len(words), int(min(size.max(), WIDE)) + 2), np.uint8)
        codes = np.frombuffer("".join(w[:WIDE] for w in words).encode("latin-1"), np.uint8)
        kept = np.minimum(size, WIDE)
        m[np.repeat(np.arange(len(words)), kept), np.arange(len(codes)) - np.repeat(np.cumsum(kept) - kept, kept)] = codes
        begin = np.searchsorted(key, key, side="left")
        end = np.searchsorted(key, key, side="right")
        probes = np.flatnonzero((role >= 2) & (end - begin > 1))
        done = np.cumsum(end[probes] - begin[probes])
        at = 0
        while at < len(probes):
            upto = max(at + 1, int(np.searchsorted(done, (done[at - 1] if at else 0) + PAIRS, side="right")))
            p = probes[at:upto]
            sizes = end[p] - begin[p]
            i = np.repeat(p, sizes)
            j = np.repeat(begin[p], sizes) + np.arange(len(i)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            at = upto
            near = size[j] >= size[i]
            i, j = i[near], j[near]
            ok = _verified(i, j, m, size, role == 3, split, words)
            i, j = i[ok], j[ok]
            back = size[j] > size[i]  # a longer word merges no list of this band
            i, j = np.r_[i, j[back]], np.r_[j, i[back]]
            column = t.column("word").combine_chunks()
            yield pa.RecordBatch.from_arrays([column.take(pa.array(i)), column.take(pa.array(j)), pa.array(n[j])], names=["word", "other", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for b in batches:
            t = pa.Table.from_batches([b])
            held = t if held is None else pa.concat_tables([held, t])
            keys = held.column("key").to_numpy()
            if not len(keys):
                continue
            cut = int(np.searchsorted(keys, keys[-1]))  # the last key may go on
            if cut:
                yield from pairs(held.slice(0, cut))
                held = held.slice(cut)
        if held is not None and held.num_rows:
            yield from pairs(held)

    return lists.repartition("key").sortWithinPartitions("key").mapInArrow(run, "word string, other string, n long")


def near_words(words: DataFrame) -> DataFrame:
    """word, other, n (the other's occurrences) for all near words of ``words`` (word, n)."""
    # at most 16 grams of a level a word, so at most GRAMS of them have more than 16 n / GRAMS words
    common = max(COMMON, 16 * words.count() // GRAMS)
    return _near(_listed(words, dictionary(words, common), max(HOT, common)))


def _roots(forms: DataFrame) -> DataFrame:
    """word, root of words that have a form: each round doubles the steps followed. A
    form occurs twice as often as its word at least, so few rounds suffice."""
    now = forms.select("word", F.col("form").alias("root"))
    while True:
        nxt = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        now = written(now.join(nxt, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        if not now.where("moved").take(1):
            return now.select("word", "root")
        now = now.select("word", "root")


def variants(docs: DataFrame) -> DataFrame:
    """word, form, root, n, n_near, form_n."""
    words = written(vocabulary(docs), "vocabulary")
    best = near_words(words).groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("n")).alias("less"), "other")).alias("b"))
    enough = -F.col("b.less") >= 2 * F.col("n")
    rows = written(words.join(best, "word", "left").select(
        "word", F.when(enough, F.col("b.other")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(enough, -F.col("b.less")).alias("form_n")), "forms")
    roots = _roots(rows.where(F.col("form").isNotNull()))
    return rows.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op12(docs: DataFrame) -> DataFrame:
    return variants(docs)


ORACLE = f"""
WITH RECURSIVE tab AS (SELECT list(c ORDER BY i) AS t FROM (
  SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
  FROM range(256) AS r(i))),
runs AS (SELECT doc_id, run, count(*) AS n FROM (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[A-Za-z\\x{{C0}}-\\x{{FF}}]+')) AS run FROM documents)
  GROUP BY ALL),
crc AS (SELECT run, n, xor(list_reduce(list_prepend(4294967295, list_transform(
    regexp_extract_all(hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)), '..'), lambda x: CAST('0x' || x AS BIGINT))),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS h FROM runs, tab),
cut AS (SELECT CASE WHEN h % {EVERY} = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM crc),
words AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM cut WHERE length(word) >= {MIN_LENGTH} GROUP BY word HAVING sum(n) >= {MIN_COUNT}),
del AS (SELECT DISTINCT word, n, k, substr(word, 1, k - 1) || substr(word, k + 1) AS v FROM words, unnest(range(1, length(word) + 1)) AS u(k)),
short AS (SELECT DISTINCT word, n, v FROM del),
near AS (SELECT a.word, b.word AS other, b.n FROM del a JOIN del b ON a.k = b.k AND a.v = b.v AND a.word <> b.word
  UNION ALL SELECT s.word, w.word, w.n FROM short s JOIN words w ON s.v = w.word
  UNION ALL SELECT w.word, s.word, s.n FROM short s JOIN words w ON s.v = w.word),
best AS (SELECT word, count(*) AS n_near, first(other ORDER BY n DESC, other) AS other, max(n) AS most FROM near GROUP BY word),
forms AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN most >= 2 * w.n THEN other END AS form,
  CASE WHEN most >= 2 * w.n THEN most END AS form_n FROM words w LEFT JOIN best USING (word)),
walk AS (SELECT word, word AS root, form AS next FROM forms
  UNION ALL SELECT k.word, f.word, f.form FROM walk k JOIN forms f ON k.next = f.word)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN (SELECT word, root FROM walk WHERE next IS NULL) USING (word)
"""
