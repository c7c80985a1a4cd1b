"""Operator 8: n-gram Jaccard self-join by parity sketches.

A text's set holds the hashes of its distinct 5-word shingles (a shorter text
is one shingle). Two sets of n <= m elements with 100 |A and B| >= 80 |A or B|
differ in at most floor(2m / 9) elements. Every size band cuts the hash range
into blocks, and each element flips a bit of its block's parity sketch: a
differing element changes one block at most, and a bit at most, so the Hamming
distance of two sketches is a lower bound of the symmetric difference. A block
has 2^64 bits and is held as the XOR of its flipped positions, a 64-bit word, so
blocks of unrelated texts are not equal by chance (of 64 bits, blocks with few
elements were: pairs grew with the square of the table). A text with more
non-empty blocks than floor(2m / 9) therefore agrees with each smaller or equal
partner in one non-empty block exactly (pigeonhole); blocks meet in a shuffle by
(band, block, word). Texts near a band's upper end are also sketched for the
next band. Bands have more blocks than that needs, so linked texts agree in many,
and each text may leave out some: those with the fewest elements, which unrelated
texts that share a passage have in common most.
Sets of fewer than ``SMALL`` elements, and bands in which some text has too few
non-empty blocks, meet by the smallest hashes of which linked sets share one.

Equal sets are one node. A bucket of up to ``FEW`` nodes gives all its pairs;
in a larger one (of sets with many keys: in one of four) each node is paired with
the bucket's first, and once these are verified and joined to components, only nodes
of a bucket still in different components are compared, by the Hamming distance
of sketches of the whole sets, in blocks of ``BLOCK``. The pairs that this distance
leaves open grow with the square of a group of near copies, so none of them travels:
a task gives a spanning forest of them, the nodes so connected are a cluster, each
of its nodes brings its whole set once, and blocks of ``SET_BLOCK`` verify
open pairs where they meet and give a spanning forest of the links. So every link
between different texts is either verified or lies inside a component already.

Defined results: a null, empty or wordless text has an empty set and stands
alone; equal texts are linked; a null doc_id counts as the largest id of its
component; repeated rows each keep a row; other columns are ignored; an empty
table gives an empty table.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, hash_words, join_on, lean, mix64, words, written

SHINGLE = 5
SMALL = 48
RATIO = 1.6
SPARE = 0.1
FEW = 4
BLOCK = 2048
#: The same where whole sets are compared.
SET_BLOCK = 512
STARRED_BANDS = 2
#: A bucket of more nodes passes through its task in parts.
PART = 100_000
#: Bits of the filter that keeps sets of nodes without a candidate from being shuffled.
FILTER_BITS = 1 << 26
_C = [np.uint64(c) for c in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]


def linked(shared, n, m):
    """100 |A and B| >= 80 |A or B|, in integers."""
    return 100 * shared >= 80 * (n + m - shared)


def sets_of(texts: list[str | None]) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    parts = [words(t) for t in texts]
    flat = hash_words([w for p in parts for w in p])
    mixed = np.empty(0, np.uint64)
    if len(flat) >= SHINGLE:
        k = len(flat) - SHINGLE + 1
        mixed = np.zeros(k, np.uint64)
        for j in range(SHINGLE):
            mixed += flat[j:j + k] * _C[j]
        mixed = mix64(mixed)
    out, at = [], 0
    for p in parts:
        n = len(p)
        if n >= SHINGLE:
            out.append(np.unique(mixed[at:at + n - SHINGLE + 1]))
        elif n:
            out.append(mix64(np.array([(flat[at:at + n] * np.array(_C[:n])).sum() + np.uint64(n)], np.uint64)))
        else:
            out.append(np.empty(0, np.uint64))
        at += n
    return out


def node_of(s: np.ndarray) -> int:
    """64-bit identity of a set."""
    with np.errstate(over="ignore"):
        x = np.array([s.sum(dtype=np.uint64) * _C[1] + np.bitwise_xor.reduce(s) * _C[2] + np.uint64(len(s))], np.uint64)
    return int(mix64(x).view(np.int64)[0])


def _edges() -> list[int]:
    e = [SMALL]
    while e[-1] < 1 << 40:
        e.append(int(e[-1] * RATIO))
    return e


EDGES = _edges()


@functools.lru_cache(maxsize=None)
def blocks_of(band: int) -> int:
    """Blocks of a band: enough that a text has SPARE times its size more
    non-empty blocks than its greatest difference, five standard deviations of
    the empty ones aside."""
    b = EDGES[band] // 4
    for n in (EDGES[band], EDGES[band + 1] - 1):
        while b < 0.8 * EDGES[band]:
            none = np.exp(-n / b)
            sigma = np.sqrt(b * (none - (1 + n / b) * none * none))
            if b * (1 - none) - 2 * n / 9 >= 1 + SPARE * n + 5 * sigma:
                break
            b += max(1, b // 200)
    return int(b)


def sketch(s: np.ndarray, band: int) -> tuple[np.ndarray, np.ndarray]:
    """Word (XOR of the flipped positions) and number of elements of each block."""
    b = blocks_of(band)
    g = mix64(s + mix64(np.array([band + 1], np.uint64)))
    at = (((g >> np.uint64(32)) * np.uint64(b)) >> np.uint64(32)).astype(np.int64)
    out = np.zeros(b, np.uint64)
    np.bitwise_xor.at(out, at, mix64(g))
    return out, np.bincount(at, minlength=b)


def fold(s: np.ndarray) -> np.ndarray:
    """Parity sketch of the whole set in words of 64 bits: a power of two of
    bits, the set's size at least. Halves XORed give the sketch of half
    as many bits, so sets of different sizes compare."""
    bits = max(256, 1 << (len(s) - 1).bit_length())
    out = np.zeros(bits // 64, np.uint64)
    g = mix64(s ^ _C[4])
    np.bitwise_xor.at(out, ((g >> np.uint64(6)) & np.uint64(len(out) - 1)).astype(np.int64), np.uint64(1) << (g & np.uint64(63)))
    return out


def halved(f: np.ndarray, size: int) -> np.ndarray:
    while len(f) > size:
        f = f[:len(f) // 2] ^ f[len(f) // 2:]
    return f


def band_of(n: int) -> int:
    return int(np.searchsorted(EDGES, n, side="right")) - 1


def spare(s: np.ndarray) -> int:
    """Non-empty blocks in which this set, in its own band, agrees at least with
    any linked set that is not larger."""
    return int(np.count_nonzero(sketch(s, band_of(len(s)))[1])) - 2 * len(s) // 9


def left_out(least: int) -> int:
    """Of a band's least spare: keys that a set leaves out, those whose blocks have the
    fewest elements. One key remains that linked sets share."""
    return least - 1


def keys_of(s: np.ndarray, spares: dict[int, int]) -> np.ndarray:
    """Bucket keys of a set; the six low bits hold band + 1, or 0 for the smallest
    hashes. ``spares``: the least spare() in each band that has sets of its own.
    Linked sets share so many keys of the larger one's band, so each may leave out
    some of them, in an order that all sets share: here by the block's elements (equal
    words have equal elements), as few shingles are the likeliest to come from
    a passage alone."""
    n, out = len(s), []
    bands = []
    if n >= SMALL:
        k = band_of(n)
        bands = [b for b in ([k] + ([k + 1] if n >= 0.8 * EDGES[k + 1] else [])) if b in spares]
    if (n and 4 * n < 5 * SMALL) or any(spares[b] < 1 for b in bands):
        out.append(mix64(s[:n - -(-4 * n // 5) + 1] ^ _C[0]) & ~np.uint64(63))
    for b in bands:
        if spares[b] >= 1:
            w, count = sketch(s, b)
            at = np.flatnonzero(count)
            key = mix64(w[at] + mix64((at.astype(np.uint64) << np.uint64(8)) + np.uint64(b + 1))) & ~np.uint64(63) | np.uint64(b + 1)
            out.append(key[np.lexsort((key, count[at]))[left_out(spares[b]):]])
    return np.concatenate(out).view(np.int64) if out else np.empty(0, np.int64)


def _texts(b: pa.RecordBatch, step: int = 512) -> Iterator[tuple[list, list]]:
    for at in range(0, b.num_rows, step):
        part = b.slice(at, step)
        yield part.column(0).to_pylist(), part.column(1).to_pylist()


def members(docs: DataFrame) -> DataFrame:
    """doc_id, digest of the text, n (size of the set), node (null for an empty
    set), fold, and for sets of SMALL elements or more band and spare."""
    def run(batches):
        lean()
        for b in batches:
            for at in range(0, b.num_rows, 512):
                part = b.slice(at, 512)
                ss = sets_of(part.column(1).to_pylist())
                large = [len(s) >= SMALL for s in ss]
                yield pa.RecordBatch.from_arrays([
                    part.column(0), part.column(2), pa.array([len(s) for s in ss], pa.int64()),
                    pa.array([node_of(s) if len(s) else None for s in ss], pa.int64()),
                    pa.array([fold(s).tobytes() if len(s) else None for s in ss], pa.binary()),
                    pa.array([band_of(len(s)) if k else None for s, k in zip(ss, large)], pa.int32()),
                    pa.array([spare(s) if k else None for s, k in zip(ss, large)], pa.int32())],
                    names=["doc_id", "digest", "n", "node", "fold", "band", "spare"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("digest"))
    return rows.mapInArrow(run, f"doc_id {kind}, digest long, n long, node long, fold binary, band int, spare int")


def buckets(docs: DataFrame, spares: dict[int, int]) -> DataFrame:
    """(key, node); a batch names each set once."""
    def run(batches):
        lean()
        for b in batches:
            seen = set()
            for _, texts in _texts(b):
                keys, nodes = [], []
                for s in sets_of(texts):
                    if len(s) and (node := node_of(s)) not in seen:
                        seen.add(node)
                        keys.append(keys_of(s, spares))
                        nodes.append(np.full(len(keys[-1]), node, np.int64))
                if keys:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys)), pa.array(np.concatenate(nodes))],
                                                     names=["key", "node"])

    return docs.select("doc_id", "text").mapInArrow(run, "key long, node long")


def starred(key: np.ndarray) -> np.ndarray:
    """Whether a large bucket pairs its members with its first: all buckets of small
    sets, and one in four of sets that have many keys. Others compare what is left."""
    return ((key & 63) <= STARRED_BANDS) | (mix64(key.view(np.uint64)) & np.uint64(3) == 0)


def _runs(key: np.ndarray, node: np.ndarray, few: int) -> tuple[list, list, list]:
    """Pairs (a, b) and members (key, node) of large buckets from sorted distinct rows."""
    start = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    size = np.diff(np.r_[start, len(key)])
    a, b, big = [], [], []
    for g in range(2, few + 1):
        at = start[size == g]
        for i in range(g if len(at) else 0):
            for j in range(i + 1, g):
                a.append(node[at + i])
                b.append(node[at + j])
    large = np.repeat(size > few, size)
    if large.any():
        first = np.repeat(node[start], size)
        rest = large & (node != first) & starred(key)
        a.append(first[rest])
        b.append(node[rest])
        big.append((key[large], node[large]))
    return a, b, big


_KIND = pa.schema([("kind", pa.int8()), ("a", pa.int64()), ("b", pa.int64())])


def in_runs(batches: Iterator[pa.RecordBatch], few: int, part: int) -> Iterator[pa.RecordBatch]:
    """Candidates from batches of (key, node) that are sorted by both. Of a bucket of
    ``part`` nodes or more the rest follows as members of the same large bucket."""
    lean()
    key, node, going = np.empty(0, np.int64), np.empty(0, np.int64), None

    def out(a, b, big):
        if a:
            x, y = np.concatenate(a), np.concatenate(b)
            pairs = np.unique(np.stack([np.minimum(x, y), np.maximum(x, y)]), axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(np.zeros(pairs.shape[1], np.int8)), pa.array(pairs[0]), pa.array(pairs[1])], schema=_KIND)
        if big:
            x, y = (np.concatenate([m[i] for m in big]) for i in (0, 1))
            yield pa.RecordBatch.from_arrays([pa.array(np.ones(len(x), np.int8)), pa.array(x), pa.array(y)], schema=_KIND)

    for batch in batches:
        key = np.r_[key, batch.column(0).to_numpy()]
        node = np.r_[node, batch.column(1).to_numpy()]
        new = np.r_[True, (key[1:] != key[:-1]) | (node[1:] != node[:-1])]
        key, node = key[new], node[new]
        if going is not None:  # (key, first node, last node) of a bucket that has begun
            end = int(np.searchsorted(key, going[0], side="right"))
            rest = node[:end][node[:end] != going[2]]
            if len(rest):
                star = rest[starred(np.full(len(rest), going[0]))]
                yield from out([np.full(len(star), going[1])], [star], [(np.full(len(rest), going[0]), rest)])
                going = (*going[:2], int(rest[-1]))
            key, node, going = key[end:], node[end:], None if end < len(key) else going
        if len(key):
            last = int(np.searchsorted(key, key[-1]))  # the last bucket may go on in the next batch
            if last:
                yield from out(*_runs(key[:last], node[:last], few))
                key, node = key[last:], node[last:]
            if len(key) >= max(part, few + 1):
                yield from out(*_runs(key, node, few))
                going, key, node = (int(key[0]), int(node[0]), int(node[-1])), key[:0], node[:0]
    if len(key):
        yield from out(*_runs(key, node, few))


def candidates(docs: DataFrame, spares: dict[int, int], few: int = FEW, part: int = PART) -> DataFrame:
    """kind 0: pairs a < b of nodes; kind 1: members (key, node) of large buckets."""
    rows = buckets(docs, spares).repartition("key").sortWithinPartitions("key", "node")
    return rows.mapInArrow(lambda batches: in_runs(batches, few, part), "kind tinyint, a long, b long")


def _filter_of(nodes: DataFrame) -> np.ndarray:
    """Bits of the nodes; its size is fixed, so it may be sent to all tasks."""
    bit = F.pmod(F.col("node"), F.lit(FILTER_BITS))
    rows = (nodes.select((bit / 64).cast("int").alias("at"), F.expr(f"shiftleft(1L, cast(pmod(node, {FILTER_BITS}) % 64 as int))").alias("bit"))
            .groupBy("at").agg(F.bit_or("bit").alias("bits")).toPandas())
    out = np.zeros(FILTER_BITS // 64, np.int64)
    out[rows["at"].to_numpy(np.int64)] = rows["bits"].to_numpy(np.int64)
    return out.view(np.uint64)


def whole_sets(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """node and the set's hashes, of (at least) the given nodes."""
    sent = docs.sparkSession.sparkContext.broadcast(_filter_of(nodes))

    def run(batches):
        lean()
        bits = sent.value
        for b in batches:
            seen = set()
            for _, texts in _texts(b):
                rows = []
                for s in sets_of(texts):
                    if len(s):
                        node = node_of(s)
                        at = node % FILTER_BITS
                        if int(bits[at >> 6]) >> (at & 63) & 1 and node not in seen:
                            seen.add(node)
                            rows.append((node, s.tobytes()))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(
                        (pa.int64(), pa.binary()))], names=["node", "hashes"])

    found = docs.select("doc_id", "text").mapInArrow(run, "node long, hashes binary")
    return found.dropDuplicates(["node"])


def _near(n, m, distance):
    """Whether sketches so far apart leave it open that the sets are linked."""
    return (9 * distance <= 2 * np.maximum(n, m)) & (5 * np.minimum(n, m) >= 4 * np.maximum(n, m))


def _with_both(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Pairs (a, b) with the other columns of both nodes, named a_.. and b_.."""
    for side in ("a", "b"):
        pairs = pairs.join(nodes.select(F.col("node").alias(side), *[F.col(c).alias(f"{side}_{c}") for c in nodes.columns if c != "node"]), side)
    return pairs


def verified(docs: DataFrame, pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The linked ones of the pairs (a, b). ``nodes``: node, n, fold. Sketches go
    first; whole sets follow only for what their Hamming distance leaves open."""
    def possible(batches):
        lean()
        for t in batches:
            na, nb = t.column(2).to_numpy(), t.column(4).to_numpy()
            d = np.empty(len(na), np.int64)
            for i, (x, y) in enumerate(zip(t.column(3), t.column(5))):
                f, g = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                least = min(len(f), len(g))
                d[i] = np.bitwise_count(halved(f, least) ^ halved(g, least)).sum()
            yield t.select(["a", "b"]).filter(pa.array(_near(na, nb, d)))

    def exact(batches):
        lean()
        for t in batches:
            ok = []
            for x, y in zip(t.column(2), t.column(3)):
                p, q = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                ok.append(bool(linked(len(np.intersect1d(p, q, assume_unique=True)), len(p), len(q))))
            yield t.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    open_ = _with_both(pairs, nodes).select("a", "b", "a_n", "a_fold", "b_n", "b_fold").mapInArrow(possible, "a long, b long")
    open_ = written(open_, "jaccard-open")
    discard()
    asked = open_.select(F.col("a").alias("node")).unionByName(open_.select(F.col("b").alias("node"))).distinct()
    sets = whole_sets(docs, asked)
    links = written(_with_both(open_, sets).select("a", "b", "a_hashes", "b_hashes").mapInArrow(exact, "a long, b long"), "jaccard-links")
    discard(open_)
    return links


def components(edges: DataFrame) -> DataFrame:
    """node and ``label``, the smallest node reachable, of every node with an
    edge (a, b): alternating large and small stars until nothing changes."""
    def star(e: DataFrame, large: bool) -> DataFrame:
        both = e.select(F.col("a").alias("u"), F.col("b").alias("v"))
        if large:
            both = both.unionByName(e.select(F.col("b").alias("u"), F.col("a").alias("v")))
        else:
            both = both.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        low = written(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")), "star")
        at = both.join(low, "u")
        if large:
            out = at.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        else:
            out = at.where("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(
                low.select(F.col("u").alias("a"), F.col("m").alias("b")))
        return written(out.where("a <> b").distinct(), "edges")

    def state(e: DataFrame):
        return e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    edges, was = written(edges.where("a <> b").distinct(), "edges"), None
    while True:
        edges = star(star(edges, True), False)
        now = state(edges)
        if now == was:
            break
        was = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct())


class Folds:
    """Sketches of some rows, as matrices by length; shorter ones come from halving."""

    def __init__(self, folds: list[bytes]):
        self.size = np.array([len(f) // 8 for f in folds], np.int64)
        self.at, self.rows = np.zeros(len(folds), np.int64), {}
        for w in np.unique(self.size):
            own = np.flatnonzero(self.size == w)
            self.at[own] = np.arange(len(own))
            self.rows[int(w)] = np.frombuffer(b"".join(folds[k] for k in own), np.uint64).reshape(len(own), w)
        self.made: dict[tuple[int, int], np.ndarray] = {}

    def shrunk(self, own: int, w: int) -> np.ndarray:
        if own == w:
            return self.rows[own]
        if (own, w) not in self.made:
            f = self.rows[own]
            while f.shape[1] > w:
                f = f[:, :f.shape[1] // 2] ^ f[:, f.shape[1] // 2:]
            self.made[own, w] = f
        return self.made[own, w]

    def distance(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        out = np.empty(len(a), np.int64)
        for u in np.unique(self.size[a]):
            for v in np.unique(self.size[b]):
                w = int(min(u, v))
                pick = np.flatnonzero((self.size[a] == u) & (self.size[b] == v))
                f, g = self.shrunk(int(u), w), self.shrunk(int(v), w)
                for k in range(0, len(pick), max(1, (1 << 21) // w)):
                    part = pick[k:k + max(1, (1 << 21) // w)]
                    out[part] = np.bitwise_count(f[self.at[a[part]]] ^ g[self.at[b[part]]]).sum(axis=1, dtype=np.int64)
        return out


class Forest:
    """Trees over 64-bit numbers: of a graph's edges those that join two trees."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def root(self, x: int) -> int:
        r = x
        while (u := self.up.get(r, r)) != r:
            r = u
        while x != r:
            self.up[x], x = r, self.up.get(x, x)
        return r

    def join(self, x: int, y: int) -> bool:
        """Whether x and y were in two trees; they are in one now."""
        x, y = self.root(x), self.root(y)
        self.up[x] = y
        return x != y


def _open_pairs(t: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows x and y of pairs of different labels that the sketches leave open, of whole
    groups (key, i, j); a group of two parts compares rows of one with the other's."""
    key, i, j, part, label, n = (t.column(c).to_numpy() for c in ("key", "i", "j", "part", "label", "n"))
    folds = Folds(t.column("fold").to_pylist())
    new = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])])
    end = np.repeat(np.r_[new[1:], len(key)], np.diff(np.r_[new, len(key)]))
    partners = end - np.arange(len(key)) - 1
    done, at = np.cumsum(partners), 0
    while at < len(key):
        upto = max(at + 1, int(np.searchsorted(done, (done[at - 1] if at else 0) + (1 << 20), side="right")))
        rows = np.arange(at, upto)
        x = np.repeat(rows, partners[rows])
        y = x + 1 + np.arange(len(x)) - np.repeat(np.cumsum(partners[rows]) - partners[rows], partners[rows])
        at = upto
        ok = (label[x] != label[y]) & ((i[x] == j[x]) | (part[x] != part[y])) & (5 * np.minimum(n[x], n[y]) >= 4 * np.maximum(n[x], n[y]))
        x, y = x[ok], y[ok]
        ok = _near(n[x], n[y], folds.distance(x, y))
        yield x[ok], y[ok]


def _dealt(rows: DataFrame, nodes: DataFrame, block: int) -> DataFrame:
    """Rows (key, node, label) dealt to groups (key, i, j) of two parts of about ``block``
    of the key's nodes; the columns of ``nodes`` join once these are dealt."""
    sized = rows.join(rows.groupBy("key").agg(F.ceil(F.count("*") / block).cast("int").alias("parts")), "key")
    placed = sized.withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    pairs = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    pairs = pairs.select("key", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), "part", "node", "label")
    return pairs.join(nodes, "node").repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")


def _whole_groups(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.Table]:
    """Tables of whole groups (key, i, j) from sorted rows, many small ones together."""
    held: list[pa.RecordBatch] = []
    size = 0
    for b in (whole.slice(at, least) for whole in batches for at in range(0, whole.num_rows, least)):
        held.append(b)
        size += b.num_rows
        if size < least:
            continue
        t = pa.Table.from_batches(held)
        last = [t.column(c)[-1].as_py() for c in ("key", "i", "j")]
        key, i, j = (t.column(c).to_numpy() for c in ("key", "i", "j"))
        cut = int(np.argmax((key == last[0]) & (i == last[1]) & (j == last[2])))  # the last group may go on
        if cut:
            yield t.slice(0, cut)
            held, size = t.slice(cut).to_batches(), t.num_rows - cut
    if size:
        yield pa.Table.from_batches(held)


def _edges_of(a: list, b: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def _crossing(unresolved: DataFrame, nodes: DataFrame) -> DataFrame:
    """Of the pairs of different labels within a large bucket that the sketches leave
    open, as many (a, b) as connect the same nodes: a task gives less than it has nodes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean()
        trees = Forest()
        for t in _whole_groups(batches, 20_000):
            node = t.column("node").to_numpy()
            for x, y in _open_pairs(t):
                edges = [e for e in zip(node[x].tolist(), node[y].tolist()) if trees.join(*e)]
                if edges:
                    yield _edges_of(*zip(*edges))

    return _dealt(unresolved, nodes, BLOCK).mapInArrow(run, "a long, b long").distinct()


def _linking(docs: DataFrame, clusters: DataFrame, nodes: DataFrame) -> DataFrame:
    """Links (a, b) that connect all labels which links connect within a cluster: rows
    (key, node, label). Each group has its whole sets, so a pair is verified where it is
    found, and left out if its labels are connected already: a task gives less links than
    it has labels."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean()
        trees = Forest()
        for t in _whole_groups(batches, 2 * SET_BLOCK):
            node, label = t.column("node").to_numpy(), t.column("label").to_pylist()
            sets = [np.frombuffer(v.as_buffer(), np.uint64) for v in t.column("hashes")]
            edges = []
            for x, y in _open_pairs(t):
                for p, q in zip(x.tolist(), y.tolist()):
                    if trees.root(label[p]) != trees.root(label[q]) and linked(
                            len(np.intersect1d(sets[p], sets[q], assume_unique=True)), len(sets[p]), len(sets[q])):
                        trees.join(label[p], label[q])
                        edges.append((int(node[p]), int(node[q])))
            if edges:
                yield _edges_of(*zip(*edges))

    asked = written(clusters, "jaccard-clusters")
    sets = whole_sets(docs, asked.select("node")).join(nodes, "node")
    links = written(_dealt(asked, sets, SET_BLOCK).mapInArrow(run, "a long, b long"), "jaccard-linking")
    discard(asked)
    return links


def link(docs: DataFrame, rows: DataFrame, few: int = FEW) -> DataFrame:
    """Verified links (a, b) between nodes: all between different components of
    what they connect. ``rows``: members(docs)."""
    spares = {r.band: r.spare for r in rows.where("band is not null").groupBy("band").agg(F.min("spare").alias("spare")).collect()}
    found = written(candidates(docs, spares, few), "jaccard-candidates")
    discard()
    nodes = written(rows.where("node is not null").groupBy("node").agg(F.first("n").alias("n"), F.first("fold").alias("fold")), "jaccard-nodes")
    links = verified(docs, found.where("kind = 0").select("a", "b").distinct(), nodes)
    large = found.where("kind = 1").select(F.col("a").alias("key"), F.col("b").alias("node"))
    if not large.take(1):
        discard(found)
        return links
    labels = written(components(links), "jaccard-labels")
    large = large.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    open_ = large.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi").select("key")
    large = written(large.join(open_, "key"), "jaccard-large")
    open_ = None
    discard(found)  # and the shuffles of finished steps
    open_ = written(_crossing(large, nodes), "jaccard-crossing")
    discard(large)
    if not open_.take(1):
        return links
    clusters = components(open_).withColumnRenamed("label", "key").join(labels, "node", "left")
    more = _linking(docs, clusters.select("key", "node", F.coalesce("label", "node").alias("label")), nodes)
    discard(labels, open_)
    return links.unionByName(more)


def joined(docs: DataFrame, few: int = FEW) -> DataFrame:
    """doc_id, digest, n_shingles, component_id, ``node`` (its class) and ``label``
    (a node that names the component) of every row; the last two are null for an empty set."""
    rows = written(members(docs), "jaccard-members")
    labels = written(components(link(docs, rows, few)), "jaccard-labels")
    classes = rows.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("least"), F.count("*").alias("copies"))
    classes = classes.join(labels, "node", "left").where("copies > 1 or label is not null").withColumn("label", F.coalesce("label", "node"))
    classes = written(classes, "jaccard-classes")
    least = classes.groupBy("label").agg(F.min("least").alias("component_id"))
    classes = written(classes.select("node", "label").join(least, "label"), "jaccard-ids")
    return join_on(rows, classes, ["node"], "left").select(
        "doc_id", "digest", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"),
        "node", F.coalesce("label", "node").alias("label"))


def op8(docs: DataFrame, few: int = FEW) -> DataFrame:
    return joined(docs, few).select("doc_id", "n_shingles", "component_id")


def kept(docs: DataFrame) -> DataFrame:
    """One row of each component, that of the smallest doc_id (null is largest),
    ties by the text's digest; texts without words all stay. Columns as they are."""
    rows = written(joined(docs.select("doc_id", "text")).where("label is not null").select("doc_id", "digest", "label"), "jaccard-rows")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "digest")).alias("w")
    stay = written(rows.groupBy("label").agg(first, F.count("*").alias("n")).select("w.doc_id", F.col("w.digest").alias("__digest"), "n"), "jaccard-kept")
    again = rows.withColumnRenamed("digest", "__digest").groupBy("doc_id", "__digest").agg(F.count("*").alias("rows")).where("rows > 1")
    again = written(join_on(again, stay, ["doc_id", "__digest"], "left_semi").select("doc_id", "__digest"), "jaccard-again")
    wordless = ~F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    keyed = docs.where(~wordless).withColumn("__digest", F.xxhash64("text"))
    out = join_on(keyed, stay.select("doc_id", "__digest"), ["doc_id", "__digest"], "left_semi")
    if again.take(1):  # rows alike in id and text: one of them
        twice = join_on(out, again, ["doc_id", "__digest"], "left_semi").dropDuplicates(["doc_id", "__digest"])
        out = join_on(out, again, ["doc_id", "__digest"], "left_anti").unionByName(twice)
    return out.drop("__digest").unionByName(docs.where(wordless))
