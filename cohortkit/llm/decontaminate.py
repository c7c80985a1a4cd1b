"""Operator 13: benchmark decontamination by training suffix arrays.

Documents are taken in shards of about ``SHARD`` words. A shard's words become
ranks of their 64-bit hashes, and its suffix array is sorted by prefix doubling,
at least as deep as the longest benchmark item is long. Every suffix of every
item is then binary-searched in it, all at once: the array's two neighbours of
its place give its longest verbatim match and where that lies. An item's windows
(``WINDOW`` consecutive words; a shorter item is one window) that such a match
reaches are searched for the whole range of suffixes that begin with them, which
is every place where they occur.

The benchmark reaches the tasks as broadcasts of about ``BLOCK`` bytes of words
each, by a hash of the item; a task holds one at a time. Nothing is shuffled, so
a hot source or many copies load no task; a task's memory is a shard's and a
block's, or the longest document's.

Words are compared by 64-bit hashes. Defined results: null, empty and wordless
texts have no words; a null item_id counts as the empty string; items of equal
item_id are one for the counts; repeated rows each keep a row, also of a null
doc_id; other columns are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, UPPER, hash_words, written

WINDOW = 10
SHARD = 2_000_000
BLOCK = 32 << 20
PIECE = 1 << 20
WORD, GAP = re.compile(rb"[0-9a-z\x80-\xff]+"), re.compile(rb"[^0-9a-z\x80-\xff]")


def word_hashes(text: str | None) -> np.ndarray:
    """Hashes of a text's words, A-Z lower-cased, a piece of the text at a time."""
    raw, at, out = (text or "").encode("utf-8", "surrogatepass").lower(), 0, []
    while at < len(raw):
        gap = GAP.search(raw, at + PIECE)
        end = gap.start() if gap else len(raw)
        out.append(hash_words(WORD.findall(raw, at, end)))
        at = end
    return np.concatenate(out) if out else np.empty(0, np.uint64)


class Items:
    """A block of benchmark items: words, item of each suffix, and distinct windows."""

    def __init__(self, ids: list[str], words: list[np.ndarray], window: int):
        sizes = np.array([len(w) for w in words], np.int64)
        self.ids, self.words = ids, np.concatenate([*words, np.empty(0, np.uint64)])
        begin = np.cumsum(sizes) - sizes
        self.item = np.repeat(np.arange(len(ids)), sizes)
        self.place = np.arange(len(self.words)) - begin[self.item]
        self.left = sizes[self.item] - self.place
        self.size = np.minimum(sizes, window)[self.item]
        at = np.flatnonzero(self.left >= self.size)
        rows = np.zeros((len(at), window + 1), np.uint64)
        rows[:, 0] = self.size[at]
        for k in range(window):
            on = self.size[at] > k
            rows[on, k + 1] = self.words[at[on] + k]
        _, first, of = np.unique(rows, axis=0, return_index=True, return_inverse=True)
        self.window = at[first]  # a suffix that begins with each distinct window
        pairs = np.unique(np.stack([of.ravel(), self.item[at]]), axis=1) if len(at) else np.empty((2, 0), np.int64)
        self.owners, self.owned = pairs[1], np.searchsorted(pairs[0], np.arange(len(first) + 1))
        self.longest = int(sizes.max(initial=1))


def suffix_array(s: np.ndarray, depth: int) -> np.ndarray:
    """Places of the non-zero values of ``s``, ordered by the values from there on,
    to ``depth`` values at least. Groups that are told apart rest in later rounds."""
    n, bits = len(s), max(1, int(s.max(initial=0)).bit_length())
    packed = max(1, min(62 // bits, depth))
    key = np.zeros(n, np.int64)
    for k in range(packed):
        key <<= bits
        key[:max(n - k, 0)] |= s[k:]
    sa = np.flatnonzero(s)
    sa = sa[np.argsort(key[sa])]
    rank = np.zeros(n + 1, np.int64)

    def group(keys: np.ndarray, base: np.ndarray) -> np.ndarray:
        """Rank: one more than the array index at which a place's group begins."""
        new = np.r_[True, keys[1:] != keys[:-1]]
        return base[np.flatnonzero(new)[np.cumsum(new) - 1]] + 1

    if not len(sa):
        return sa
    rank[sa] = group(key[sa], np.arange(len(sa)))
    while packed < depth:
        r = rank[sa]
        tied = np.flatnonzero(np.r_[r[1:] == r[:-1], False] | np.r_[False, r[1:] == r[:-1]])
        if not len(tied):
            break
        at = sa[tied]
        keys = (rank[at] << 32) | rank[np.minimum(at + packed, n)]
        order = np.argsort(keys)
        sa[tied] = at[order]
        rank[at[order]] = group(keys[order], tied)
        packed *= 2
    return sa


def _common(s, t, p, at, size, known):
    """Words that the suffixes p of s and at of t share, up to size; known is a lower bound."""
    out, on = known.copy(), np.flatnonzero(known < size)
    while len(on):
        on = on[s[p[on] + out[on]] == t[at[on] + out[on]]]
        out[on] += 1
        on = on[out[on] < size[on]]
    return out


def _bound(sa, s, t, at, size, right: bool):
    """For each first ``size`` words of suffix ``at``: the array index before which
    all suffixes are below them (or, to the right, begin with them)."""
    lo, hi = np.zeros(len(at), np.int64), np.full(len(at), len(sa), np.int64)
    below, above = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
    on = np.flatnonzero(lo < hi)
    while len(on):
        mid = (lo[on] + hi[on]) // 2
        p = sa[mid]
        same = _common(s, t, p, at[on], size[on], np.minimum(below[on], above[on]))
        ended = same == size[on]
        less = np.where(ended, right, s[p + same] < t[np.minimum(at[on] + same, len(t) - 1)])
        lo[on] = np.where(less, mid + 1, lo[on])
        below[on] = np.where(less, same, below[on])
        hi[on] = np.where(less, hi[on], mid)
        above[on] = np.where(less, above[on], same)
        on = on[lo[on] < hi[on]]
    return lo


class Shard:
    """The suffix array of some documents' words."""

    def __init__(self, docs: list[np.ndarray], depth: int):
        sizes = np.array([len(d) for d in docs], np.int64)
        self.begin = np.cumsum(sizes + 1) - sizes - 1  # a zero follows each document
        all_words = np.concatenate([*docs, np.empty(0, np.uint64)])
        self.known, of = np.unique(all_words, return_inverse=True)
        self.s = np.zeros(int((sizes + 1).sum()) + 1, np.int64)
        within = np.arange(len(all_words)) + np.repeat(np.arange(len(docs)), sizes)
        self.s[within] = 2 * of.ravel() + 3
        self.sizes, self.sa = sizes, suffix_array(self.s, depth)

    def search(self, items: Items):
        """(longest match of every suffix of the items, where) and (places, window) of
        every occurrence of a window."""
        r = np.searchsorted(self.known, items.words)
        there = self.known[np.minimum(r, max(len(self.known) - 1, 0))] == items.words if len(self.known) else np.zeros(len(r), bool)
        t = np.r_[2 * r + 2 + there, -1]  # a word that the shard lacks falls between its neighbours
        at = np.arange(len(items.words))
        n, nil = len(self.sa), np.zeros(len(at), np.int64)
        if not n or not len(at):
            return nil, nil, np.empty(0, np.int64), np.empty(0, np.int64)
        lo = _bound(self.sa, self.s, t, at, items.left, False)
        best, where = nil, nil
        for p in (self.sa[np.maximum(lo - 1, 0)], self.sa[np.minimum(lo, n - 1)]):
            same = _common(self.s, t, p, at, items.left, nil)
            best, where = np.maximum(best, same), np.where(same > best, p, where)
        of = np.flatnonzero(best[items.window] >= items.size[items.window])
        begin, size = items.window[of], items.size[items.window[of]]
        lo, hi = (_bound(self.sa, self.s, t, begin, size, side) for side in (False, True))
        count = hi - lo
        within = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
        return best, where, self.sa[np.repeat(lo, count) + within], np.repeat(of, count)

    def document(self, p: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.begin, p, side="right") - 1


def _blocks(benchmark: DataFrame, window: int) -> tuple[list, int]:
    """Broadcasts of the items' word hashes, and the longest item's words."""
    spark = benchmark.sparkSession

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 512):
                part = b.slice(at, 512)
                words = [word_hashes(t) for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([w.tobytes() for w in words], pa.binary())], names=["item", "words"])

    rows = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), "text").distinct()
    items = written(rows.mapInArrow(hashed, "item string, words binary").where(F.octet_length("words") > 0), "bench-items")
    total = items.agg(F.sum(F.octet_length("words")).alias("n"), F.max(F.octet_length("words")).alias("m")).first()
    n = -(-(total.n or 0) // BLOCK)
    out = []
    for k in range(n):
        got = items.where(F.pmod(F.xxhash64("item", "words"), F.lit(n)) == k).orderBy("item", "words").toArrow()
        out.append(spark.sparkContext.broadcast((got.column(0).to_pylist(), [np.frombuffer(w, np.uint64) for w in got.column(1).to_pylist()], window)))
    return out, (total.m or 0) // 8


def _shards(texts: list[str | None]) -> Iterator[list[np.ndarray]]:
    docs, size = [], 0
    for t in texts:
        docs.append(word_hashes(t))
        size += len(docs[-1])
        if size >= SHARD:
            yield docs
            docs, size = [], 0
    if docs:
        yield docs


def scanned(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, out: str = "overlap") -> DataFrame:
    """``docs`` with a column ``out``: (n_words, n_hit, items), items sorted as strings.
    ``text`` is read; all columns but an earlier ``out`` stay."""
    blocks, depth = _blocks(benchmark, window)
    rows = docs.drop(out)
    at_text = rows.columns.index("text")

    def hits(shard: Shard, prepared: Items | None) -> tuple:
        n = len(shard.sizes)
        edge = np.zeros(len(shard.s) + 1, np.int64)
        names: list[set] = [set() for _ in range(n)]
        for b in blocks:
            items = prepared or Items(*b.value)
            _, _, places, of = shard.search(items)
            np.add.at(edge, places, 1)
            np.add.at(edge, places + items.size[items.window[of]], -1)
            pairs = np.unique((shard.document(places) << 32) | of)
            for d, w in zip((pairs >> 32).tolist(), (pairs & 0xFFFFFFFF).tolist()):
                names[d].update(items.ids[k] for k in items.owners[items.owned[w]:items.owned[w + 1]])
        covered = np.r_[0, np.cumsum(np.cumsum(edge[:-1]) > 0)]
        return shard.sizes, covered[shard.begin + shard.sizes] - covered[shard.begin], [sorted(x) for x in names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prepared = Items(*blocks[0].value) if len(blocks) == 1 else None  # a single block, once a task
        for b in batches:
            sizes, hit, names = [], [], []
            for docs_ in _shards(b.column(at_text).to_pylist()):
                s, h, x = hits(Shard(docs_, depth), prepared)
                sizes.append(s), hit.append(h)
                names += x
            if b.num_rows:
                cols = [pa.array(np.concatenate(sizes)), pa.array(np.concatenate(hit)), pa.array(names, pa.list_(pa.string()))]
                yield pa.RecordBatch.from_arrays([*b.columns, pa.StructArray.from_arrays(cols, names=["n_words", "n_hit", "items"])],
                                                 names=[*b.schema.names, out])

    kind = "struct<n_words:bigint,n_hit:bigint,items:array<string>>"
    return rows.mapInArrow(run, ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema), f"`{out}` {kind}"]))


def matches(docs: DataFrame, benchmark: DataFrame, least: int = WINDOW) -> DataFrame:
    """The longest verbatim match of every item suffix of at least ``least`` words:
    item_id (string), item_word, length, doc_id, doc_word. Of equally long ones the
    smallest (doc_id, doc_word) that the shards report."""
    blocks, depth = _blocks(benchmark, least)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, done = b.column(0).to_pylist(), 0
            for docs_ in _shards(b.column(1).to_pylist()):
                shard = Shard(docs_, depth)
                for block in blocks:
                    items = Items(*block.value)
                    best, where, _, _ = shard.search(items)
                    at = np.flatnonzero(best >= least)
                    d = shard.document(where[at])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([items.ids[k] for k in items.item[at]], pa.string()), pa.array(items.place[at]), pa.array(best[at]),
                         pa.array([ids[done + k] for k in d], pa.int64()), pa.array(where[at] - shard.begin[d])],
                        names=["item_id", "item_word", "length", "doc_id", "doc_word"])
                done += len(docs_)

    found = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "item_id string, item_word long, length long, doc_id long, doc_word long")
    best = F.min(F.struct((-F.col("length")).alias("less"), "doc_id", "doc_word")).alias("b")
    return found.groupBy("item_id", "item_word").agg(best).select(
        "item_id", "item_word", (-F.col("b.less")).alias("length"), "b.doc_id", "b.doc_word")


def decontaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` without the documents in which a benchmark window occurs."""
    mark = "__overlap"
    return scanned(docs, benchmark, window, mark).where(F.col(f"{mark}.n_hit") == 0).drop(mark)


def op13(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    o = F.col("overlap")
    return scanned(docs.select("doc_id", "text"), benchmark).select(
        "doc_id", o.n_words.alias("n_words"), o.n_hit.alias("n_hit"), F.size(o["items"]).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", o["items"]).cast("binary"), 256).alias("items_sha256"), (o.n_hit > 0).alias("contaminated"))


_WORDS = f"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

ORACLE = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_WORDS} AS ws FROM documents),
b AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, {_WORDS} AS ws FROM benchmark),
win AS (SELECT DISTINCT item, least({WINDOW}, len(ws)) AS k, array_to_string(ws[i:i + least({WINDOW}, len(ws)) - 1], ' ') AS w
  FROM b, unnest(range(1, greatest(len(ws) - {WINDOW - 1}, 1) + 1)) AS u(i) WHERE len(ws) > 0),
ks AS (SELECT DISTINCT k FROM win),
pos AS (SELECT rid, k, i, array_to_string(ws[i:i + k - 1], ' ') AS w FROM d CROSS JOIN ks, unnest(range(1, len(ws) - k + 2)) AS u(i)),
hit AS (SELECT rid, i, k, item FROM pos JOIN win USING (k, w)),
cov AS (SELECT rid, count(DISTINCT j) AS n FROM hit, unnest(range(i, i + k)) AS u(j) GROUP BY rid),
its AS (SELECT rid, count(*) AS n, sha256(string_agg(item, ',' ORDER BY item)) AS h
  FROM (SELECT DISTINCT rid, item FROM hit) GROUP BY rid)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(cov.n, 0) AS n_hit, coalesce(its.n, 0) AS n_items,
  coalesce(its.h, sha256('')) AS items_sha256, coalesce(cov.n, 0) > 0 AS contaminated
FROM d LEFT JOIN cov USING (rid) LEFT JOIN its USING (rid)
"""
