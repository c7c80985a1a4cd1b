"""Operator 9: language-model scores by a hierarchical Pitman-Yor model.

Tokens are words (A-Z lower-cased) and one end per text. A token's context is
the token before it (the end, at a text's start): every training token is a
restaurant of its own, however many there are. They share one parent restaurant
over the vocabulary, whose own base is uniform over the training tokens and one
unknown; a context never seen in training falls back to the parent. Each
restaurant's customers are its tokens' counts; a Gibbs sweep seats every dish
anew given the totals of all restaurants from the sweep before. After ``BURN``
sweeps come ``SAMPLES`` more, and their predictive probabilities are averaged.
Draws depend on word, context and sweep alone: a seating is never stored but
drawn again, and scores do not depend on how rows are partitioned.

Texts are written once as chunks of token numbers. The distinct pairs of all
chunks meet by group of pairs, words by group of words; in a sweep the groups
send each other sums and totals. Pairs counted once have one table always, so
only those counted twice or more take part. At the end both kinds of groups
answer each chunk, which then has all it needs to score its texts. Groups grow
in number, not in size; nothing but a few sums passes through the driver.

``frequent``, ``counts``, ``gibbs`` and ``predictive`` are the smaller model over a
given list of contexts, others sharing one by last byte; the query uses none.

Defined results: a null or empty text is one token, its end; text rows alike in
id and text score alike; a null doc_id counts as the empty text in the split;
without training rows every token is unknown and its probability 1; other
columns are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, hash_words, lean, mix64, remainder, written

#: Of the smaller model: words that are contexts of their own; ids 0 to 255 are last bytes.
NAMED = 1024
START = 256
CONTEXTS = 257 + NAMED
END = b"\n"
DISCOUNT, STRENGTH = 0.7, 5.0
ROOT_DISCOUNT, ROOT_STRENGTH = 0.8, 5.0
BURN, SAMPLES = 2, 2
#: Tokens a group of pairs holds about, and at least; groups meet in so many passes.
PER_GROUP, LEAST, PASSES = 1 << 21, 500, 2
#: Bytes of texts that form a chunk, unless one text is longer.
ENTRIES = 14 << 20
#: Tokens or pairs of a chunk that are scored at a time.
AT_ONCE = 1 << 18
#: Customers seated one by one; later tables are reached by jumps.
ONE_BY_ONE = 64


#: A-Z lower-cased, the blanks of ``[^\x20\x09-\x0D]+`` made spaces.
FOLDED = np.arange(256, dtype=np.uint8)
FOLDED[ord("A"):ord("Z") + 1] += 32
FOLDED[0x09:0x0E] = 32
#: Bytes of a word that are hashed in steps of eight; longer words one by one.
IN_STEPS = 64
_FIRST = np.array([(1 << 8 * k) - 1 for k in range(8)], np.uint64)
_KEY = np.frombuffer(b"0123456789123456", "<u8")
_START = _KEY[[0, 1, 0, 1]] ^ np.frombuffer(b"uespemosmodnarodarenegylsetybdet", "<u8")


def _turn(x: np.ndarray, bits: int) -> None:
    high = x >> np.uint64(64 - bits)
    x <<= np.uint64(bits)
    x |= high


def _rounds(v: np.ndarray, n: int) -> None:
    for _ in range(n):
        for a, b, c, d, left, right in ((0, 1, 2, 3, 13, 16), (2, 1, 0, 3, 17, 21)):
            v[a] += v[b]
            _turn(v[b], left)
            v[b] ^= v[a]
            _turn(v[a], 32)
            v[c] += v[d]
            _turn(v[d], right)
            v[d] ^= v[c]


def hash_spans(b: np.ndarray, start: np.ndarray, size: np.ndarray, at_once: int = 1 << 14) -> np.ndarray:
    """``hash_words`` (pandas: SipHash-2-4, then mixed) of spans of the bytes ``b``,
    whose last eight pad it: the words of a step together."""
    at_byte = np.ndarray(max(0, len(b) - 7), "<u8", b.data, strides=(1,))
    h = np.empty(len(start), np.uint64)
    for i in range(0, len(start), at_once):
        s, n = start[i:i + at_once], size[i:i + at_once]
        v = np.repeat(_START[:, None], len(s), axis=1)
        for k in range(0, min(IN_STEPS, int(n.max())) - 7, 8):
            at = np.flatnonzero(n >= k + 8)
            m, part = at_byte[s[at] + k], v[:, at]
            part[3] ^= m
            _rounds(part, 2)
            part[0] ^= m
            v[:, at] = part
        m = (at_byte[s + (n & ~7)] & _FIRST[n & 7]) | (n.astype(np.uint64) << np.uint64(56))
        v[3] ^= m
        _rounds(v, 2)
        v[0] ^= m
        v[2] ^= np.uint64(0xFF)
        _rounds(v, 4)
        h[i:i + at_once] = mix64(v[0] ^ v[1] ^ v[2] ^ v[3])
    long = np.flatnonzero(size > IN_STEPS)
    if len(long):
        h[long] = hash_words([b[i:i + n].tobytes() for i, n in zip(start[long], size[long])])
    return h


def slices(column: pa.Array, texts: int = 1024, size: int = 1 << 23) -> Iterator[tuple[int, int]]:
    """Start and number of consecutive texts: at most ``texts`` of them with
    ``size`` bytes, or one longer."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(column):
        before = ends[at - 1] if at else 0
        n = max(1, min(texts, int(np.searchsorted(ends, before + size, "right")) - at))
        yield at, n
        at += n


def word_hashes(texts: pa.Array | list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash and last byte of each token, number of tokens of each text."""
    column = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
    if not len(column):
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
    blank, nothing = pa.scalar("\n", pa.large_string()), pa.scalar("", pa.large_string())
    column = pc.binary_join_element_wise(pc.fill_null(column.cast(pa.large_string()), nothing), blank, nothing)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    b = np.zeros(offsets[-1] - offsets[0] + 8, np.uint8)
    FOLDED.take(np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]], out=b[:-8])
    inside = np.r_[False, b[:-8] != 32]
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    start, end = edge[::2], edge[1::2]
    # a text's last byte is the blank that was added: no word passes into the next
    size = np.diff(np.searchsorted(start, offsets - offsets[0])) + 1
    is_word = np.ones(len(start) + len(size), bool)
    is_word[np.cumsum(size) - 1] = False
    w = np.full(len(is_word), hash_words([END])[0])
    w[is_word] = hash_spans(b, start, end - start)
    last = np.full(len(is_word), END[0], np.int64)
    last[is_word] = b[end - 1]
    return w.view(np.int64), last, size


def tokens(texts: pa.Array | list[str | None], named: np.ndarray | Finder) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, context and text number of each token; ``named``: sorted hashes."""
    w, as_context, size = word_hashes(texts)
    place, found = (named if isinstance(named, Finder) else Finder(_ordered(named))).find(_ordered(w))
    as_context[found] = 257 + place[found]
    context = np.r_[START, as_context[:-1]][:len(w)]
    context[np.cumsum(size) - size] = START
    return w, context, np.repeat(np.arange(len(size)), size)


def _ordered(hashes: np.ndarray) -> np.ndarray:
    """Unsigned numbers in the order of the signed hashes."""
    return hashes.view(np.uint64) ^ np.uint64(1 << 63)


class Finder:
    """Places of numbers in a sorted array of distinct, evenly spread ones: looked
    up by their leading bits, about one or two steps each."""

    def __init__(self, keys: np.ndarray):
        self.keys, width = keys, 8 * keys.dtype.itemsize
        self.shift = keys.dtype.type(width - min(22, max(1, len(keys).bit_length())))
        last = int(np.iinfo(keys.dtype).max) >> int(self.shift)
        self.first = np.searchsorted(keys >> self.shift, np.arange(last + 1, dtype=keys.dtype)).astype(np.int32)

    def find(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place (where found) and whether it is there, of each number."""
        if not len(self.keys):
            return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
        end = len(self.keys) - 1
        place = np.minimum(self.first[wanted >> self.shift], end).astype(np.int64)
        key = self.keys[place]
        found, on = key == wanted, np.flatnonzero(key < wanted)
        while len(on):
            on = on[place[on] < end]
            place[on] += 1
            key, want = self.keys[place[on]], wanted[on]
            found[on[key == want]] = True
            on = on[key < want]
        return place, found


Draw = Callable[[np.ndarray, int], np.ndarray]


def keyed(seed: int, sweep: int, word: np.ndarray, ctx: np.ndarray) -> Draw:
    """draw(rows, step): numbers between 0 and 1 that depend on seed, sweep, word,
    context and step alone."""
    start = np.array([(seed << 32) + sweep], np.uint64)
    key = mix64(word.view(np.uint64) ^ mix64(ctx.astype(np.int64).view(np.uint64) + mix64(start)))

    def draw(at: np.ndarray, step: int) -> np.ndarray:
        return ((mix64(key[at] + np.uint64(step)) >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0 ** -53

    return draw


def seat(c: np.ndarray, a: np.ndarray, discount: float, draw: Draw) -> np.ndarray:
    """Tables of a dish with ``c`` customers, seated one after the other: a new
    table with weight ``a``, an old one of the dish with customers so far less
    ``discount`` for each table. Beyond ONE_BY_ONE customers the next new
    table's customer is drawn at once from the product of the odds against."""
    t = np.minimum(c, 1).astype(np.float64)
    at = np.flatnonzero(c >= 2)
    for k in range(2, min(int(c.max(initial=0)), ONE_BY_ONE) + 1):
        at = at[c[at] >= k]
        w = a[at]
        t[at] += draw(at, k) * (w + k - 1 - discount * t[at]) < w
    at = np.flatnonzero(c > ONE_BY_ONE)
    k, step = np.full(len(at), float(ONE_BY_ONE)), ONE_BY_ONE
    while len(at):
        taken, step = discount * t[at], step + 1
        k = taken + (k - taken) * np.exp(np.minimum(-np.log(draw(at, step)) / np.maximum(a[at], 1e-12), 600.0))
        on = k <= c[at]
        at, k = at[on], np.ceil(k[on])
        t[at] += 1
    return np.minimum(t, c)


@dataclass
class Totals:
    """Of a seating: tables and customers of each context, tables of the root,
    number of distinct training tokens."""

    tables: np.ndarray
    customers: np.ndarray
    root_tables: float
    vocabulary: int

    def back(self) -> np.ndarray:
        """Weight of the parent in each context."""
        return (STRENGTH + DISCOUNT * self.tables) / (STRENGTH + self.customers)

    def floor(self) -> float:
        """The root's probability of a token without a table."""
        return (ROOT_STRENGTH + ROOT_DISCOUNT * self.root_tables) / (ROOT_STRENGTH + self.tables.sum()) / (self.vocabulary + 1)

    def root(self, customers, tables):
        return (customers - ROOT_DISCOUNT * tables) / (ROOT_STRENGTH + self.tables.sum()) + self.floor()


def frequent(docs: DataFrame) -> np.ndarray:
    """Sorted hashes of the ``NAMED`` most frequent training tokens, ties by hash."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at, size in slices(b.column(0)):
                w, n = np.unique(word_hashes(b.column(0).slice(at, size))[0], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(w), pa.array(n.astype(np.int64))], names=["word", "c"])

    n = _training(docs).mapInArrow(run, "word long, c long").groupBy("word").agg(F.sum("c").alias("c"))
    top = n.orderBy(F.desc("c"), "word").limit(NAMED).collect()
    return np.sort(np.array([r.word for r in top], np.int64))


def _training(docs: DataFrame) -> DataFrame:
    return docs.where(remainder(F.col("doc_id"), 10) != 0).select("text")


def counts(docs: DataFrame, named: np.ndarray) -> DataFrame:
    """Training counts: word, n (sum), ctx array<int>, c array<long>, in order of ctx."""
    finder = Finder(_ordered(named))

    def summed(w, ctx, n):
        # by one number a pair; pairs that share it by chance meet in Spark's sums
        order = np.argsort((w ^ ctx * 0x1E3779B97F4A7C15).view(np.uint64))
        w, ctx, n = w[order], ctx[order], n[order]
        new = np.flatnonzero(np.r_[True, (w[1:] != w[:-1]) | (ctx[1:] != ctx[:-1])])
        return w[new], ctx[new], np.add.reduceat(n, new)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            held = []
            for at, size in slices(b.column(0)):
                w, ctx, _ = tokens(b.column(0).slice(at, size), finder)
                held.append(summed(w, ctx, np.ones(len(w), np.int64)))
            if held:
                w, ctx, n = summed(*(np.concatenate(h) for h in zip(*held)))
                yield pa.RecordBatch.from_arrays([pa.array(w), pa.array(ctx.astype(np.int32)), pa.array(n)], names=["word", "ctx", "c"])

    rows = _training(docs).mapInArrow(run, "word long, ctx int, c long").groupBy("word", "ctx").agg(F.sum("c").alias("c"))
    by_word = rows.groupBy("word").agg(F.sum("c").alias("n"), F.array_sort(F.collect_list(F.struct("ctx", "c"))).alias("x"))
    return written(by_word.select("word", "n", F.col("x.ctx").alias("ctx"), F.col("x.c").alias("c")), "lm-counts")


def _dishes(b: pa.RecordBatch):
    word, ctx, c = (b.column(b.schema.get_field_index(k)) for k in ("word", "ctx", "c"))
    sizes = np.diff(ctx.offsets.to_numpy())
    starts = np.r_[0, np.cumsum(sizes)[:-1]].astype(np.int64)
    return word.to_numpy(), ctx.flatten().to_numpy().astype(np.int64), c.flatten().to_numpy().astype(np.float64), sizes, starts


def _sweep(word, ctx, c, sizes, starts, totals: Totals, seed: int, sweep: int) -> tuple[np.ndarray, np.ndarray]:
    """Tables of each (word, context) and of each word at the root."""
    t = np.ones(len(c))
    at = np.repeat(np.arange(len(sizes)), sizes)
    weight = np.full(len(sizes), (ROOT_STRENGTH + ROOT_DISCOUNT * totals.root_tables) / (totals.vocabulary + 1))
    root = np.full(len(sizes), -1)
    for turn in range(2):
        guests = np.add.reduceat(t, starts)
        p = totals.root(guests, seat(guests, weight, ROOT_DISCOUNT, keyed(seed, 4 * sweep + turn, word, root)))
        t = seat(c, (STRENGTH + DISCOUNT * totals.tables)[ctx] * p[at], DISCOUNT, keyed(seed, 4 * sweep + turn, word[at], ctx))
    return t, seat(np.add.reduceat(t, starts), weight, ROOT_DISCOUNT, keyed(seed, 4 * sweep + 2, word, root))


def gibbs(table: DataFrame, seed: int = 5) -> list[Totals]:
    """The totals before the first sweep and after each. A task adds its tables
    up: CONTEXTS + 1 sums of each task meet by context, as many are collected."""
    first = table.select(F.explode(F.arrays_zip("ctx", "c")).alias("x")).groupBy("x.ctx").agg(F.sum("x.c").alias("c"), F.count("*").alias("t")).collect()
    customers, tables = np.zeros(CONTEXTS), np.zeros(CONTEXTS)
    for r in first:
        customers[r.ctx], tables[r.ctx] = r.c, r.t
    vocabulary = table.count()
    chain = [Totals(tables, customers, float(vocabulary), vocabulary)]
    for sweep in range(BURN + SAMPLES):
        def one(batches, totals=chain[-1], sweep=sweep):
            got = np.zeros(CONTEXTS + 1)
            for b in batches:
                if b.num_rows:
                    rows = _dishes(b)
                    t, up = _sweep(*rows, totals, seed, sweep)
                    got[:-1] += np.bincount(rows[1], weights=t, minlength=CONTEXTS)
                    got[-1] += up.sum()
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(CONTEXTS + 1, dtype=np.int32)), pa.array(got)], names=["ctx", "t"])

        tables = np.zeros(CONTEXTS + 1)
        for r in table.select("word", "ctx", "c").mapInArrow(one, "ctx int, t double").groupBy("ctx").agg(F.sum("t").alias("t")).collect():
            tables[r.ctx] = r.t
        chain.append(Totals(tables[:-1], customers, float(tables[-1]), vocabulary))
    return chain


def predictive(table: DataFrame, chain: list[Totals], seed: int = 5) -> DataFrame:
    """word, n, ctx, own (array: averaged part of the word's own tables in each
    of its contexts) and root (array: the root's probability in each sample).
    The last sweeps are drawn again from the totals they began with."""
    def run(batches):
        for b in batches:
            if b.num_rows:
                word, ctx, c, sizes, starts = rows = _dishes(b)
                own, roots = np.zeros(len(c)), []
                for sweep in range(BURN, BURN + SAMPLES):
                    t, up = _sweep(*rows, chain[sweep], seed, sweep)
                    after = chain[sweep + 1]
                    own += (c - DISCOUNT * t) / (STRENGTH + after.customers[ctx]) / SAMPLES
                    roots.append(after.root(np.add.reduceat(t, starts), up))
                offsets = pa.array(np.r_[0, np.cumsum(sizes)].astype(np.int32))
                flat = np.stack(roots, axis=1).ravel()
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), b.column(1), b.column(2), pa.ListArray.from_arrays(offsets, pa.array(own)),
                     pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, SAMPLES, dtype=np.int32)), pa.array(flat))],
                    names=["word", "n", "ctx", "own", "root"])

    return table.mapInArrow(run, "word long, n long, ctx array<int>, own array<double>, root array<double>")


def pair(place: np.ndarray, ctx: np.ndarray, kind: type) -> np.ndarray:
    """place * CONTEXTS + ctx, spread evenly over the unsigned numbers of a
    ``kind`` that holds it: different for different pairs."""
    x = place.astype(kind) * kind(CONTEXTS) + ctx.astype(kind)
    if kind is np.uint64:
        return mix64(x)
    for shift, factor in ((16, 0x7FEB352D), (15, 0x846CA68B)):
        x ^= x >> np.uint32(shift)
        x *= np.uint32(factor)
    return x ^ (x >> np.uint32(16))


#: Lists of numbers travel packed into bytes, one kind a name; hashes as they are,
#: others by first bytes, second bytes and so on, which compress better.
HASHED = {"row": np.int64, "word": np.int64, "prev": np.int64}
NUMBERS = {"train": np.int32, "size": np.int32, "code": np.int32, "c": np.int32, "n": np.int64, "t": np.int32, "g": np.int32, "r": np.int32}
KINDS = {"int": pa.int32(), "long": pa.int64(), "double": pa.float64(), "binary": pa.binary()}


def packed(name: str, values: np.ndarray, sizes: np.ndarray) -> pa.Array:
    kind = np.dtype(HASHED.get(name) or NUMBERS[name])
    x, width = np.ascontiguousarray(values, kind).view(np.uint8).ravel(), kind.itemsize
    ends = np.r_[0, np.cumsum(sizes)] * width
    if name not in HASHED:
        plain, x = x, np.empty_like(x)
        for i, j in zip(ends[:-1].tolist(), ends[1:].tolist()):
            x[i:j].reshape(width, -1)[:] = plain[i:j].reshape(-1, width).T
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(x)])


def unpacked(name: str, value: pa.Scalar) -> np.ndarray:
    kind = np.dtype(HASHED.get(name) or NUMBERS[name])
    if name in HASHED:
        return np.frombuffer(value.as_buffer(), kind)
    return np.ascontiguousarray(np.frombuffer(value.as_buffer(), np.uint8).reshape(kind.itemsize, -1).T).view(kind).ravel()


def _flat(t: pa.Table, name: str, rows: np.ndarray | None = None) -> np.ndarray:
    """The lists of all rows, or of ``rows`` in their order, as one."""
    column, sizes = t.column(name), _sizes(t, name)
    rows = np.arange(len(sizes)) if rows is None else rows
    out, at = np.empty(int(sizes[rows].sum()), HASHED.get(name) or NUMBERS[name]), 0
    for i in rows[sizes[rows] > 0].tolist():
        out[at:at + sizes[i]] = unpacked(name, column[i])
        at += sizes[i]
    return out


def _sizes(t: pa.Table, name: str) -> np.ndarray:
    return pc.fill_null(pc.binary_length(t.column(name)), 0).to_numpy().astype(np.int64) // np.dtype(HASHED.get(name) or NUMBERS[name]).itemsize


def _rows(ddl: str, n: int, /, **columns) -> pa.Table:
    """``n`` rows of the columns of ``ddl``, null where not given; lists as all
    values and their sizes."""
    schema, full = pa.schema([(k, KINDS[kind]) for k, kind in (column.split() for column in ddl.split(", "))]), []
    for f in schema:
        x = columns.get(f.name)
        if isinstance(x, tuple):
            full.append(packed(f.name, *x))
        elif isinstance(x, pa.Array):
            full.append(x.cast(f.type))
        else:
            full.append(pa.nulls(n, f.type) if x is None else pa.array(np.full(n, x) if np.isscalar(x) else x).cast(f.type))
    return pa.Table.from_arrays(full, schema=schema)


def _where(t: pa.Table, name: str, value: int) -> np.ndarray:
    """The rows of a value. Their lists are read where they are: a filter copies them."""
    return np.flatnonzero(t.column(name).to_numpy() == value)


def distinct(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values and each one's place, like np.unique with fewer
    numbers held: an array that the caller does not hold is freed once it is sorted."""
    order = np.argsort(x)
    if len(x) < 1 << 31:
        order = order.astype(np.int32)
    x = x[order]
    new = np.ones(len(x), bool)
    np.not_equal(x[1:], x[:-1], out=new[1:])
    place = np.empty(len(x), order.dtype)
    place[order] = np.cumsum(new, dtype=order.dtype) - 1
    return x[new], place


def text_spans(size: np.ndarray, most: int = AT_ONCE) -> Iterator[tuple[slice, slice]]:
    """Consecutive texts and their tokens: at most ``most`` tokens, or one text."""
    ends, at = np.r_[0, np.cumsum(size)], 0
    while at < len(size):
        upto = max(at + 1, int(np.searchsorted(ends, ends[at] + most, "right")) - 1)
        yield slice(at, upto), slice(int(ends[at]), int(ends[upto]))
        at = upto


def pair_group(prev: np.ndarray, word: np.ndarray, groups: int) -> np.ndarray:
    return _small(mix64(word.view(np.uint64) ^ mix64(prev.view(np.uint64))) % np.uint64(groups), groups)


def word_group(word: np.ndarray, groups: int) -> np.ndarray:
    return _small(mix64(word.view(np.uint64)) % np.uint64(groups), groups)


def _small(group: np.ndarray, groups: int) -> np.ndarray:
    return group.astype(np.uint16 if groups <= 1 << 16 else np.int64)


def zipped(df: DataFrame, name: str) -> DataFrame:
    return written(df, name, compression="zstd")


def chunks(rows: DataFrame) -> DataFrame:
    """The texts (columns row, train, text) as chunks of a few thousand: distinct
    words in order of their hashes, and each token as a place among them."""
    ddl = "chunk long, tokens long, row binary, train binary, size binary, word binary, code binary"
    most = ENTRIES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        lean()
        number = TaskContext.get().partitionId() << 32
        for b in batches:
            for at, n in slices(b.column(2), 1 << 13, most):
                part = b.slice(at, n)
                got = [word_hashes(part.column(2).slice(i, k)) for i, k in slices(part.column(2))]
                size = np.concatenate([g[2] for g in got])
                w = [np.concatenate([g[0] for g in got])]
                del got
                word, code = distinct(w.pop())
                one = np.array([n])
                yield from _rows(ddl, 1, chunk=number, tokens=len(code), row=(part.column(0).to_numpy(), one),
                                 train=(part.column(1).to_numpy(zero_copy_only=False), one), size=(size, one),
                                 word=(word, np.array([len(word)])), code=(code, np.array([len(code)]))).to_batches()
                number += 1

    return written(rows.select("row", "train", "text").mapInArrow(run, ddl), "lm-chunks", compression="zstd", maxRecordsPerFile="8")


def keys(word: np.ndarray, code: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Each token's pair in a chunk: place of the word before, times the number of
    words, and place of the word. The word before a text's first is the end."""
    end = int(np.searchsorted(word, hash_words([END]).view(np.int64)[0]))
    key = np.empty(len(code), np.int64)
    key[1:] = code[:-1]
    key[np.cumsum(size) - size] = end
    key *= len(word)
    key += code
    return key


def grouped(word: np.ndarray, key: np.ndarray, groups: int, part: int = 0, parts: int = 1):
    """The sorted pairs ``key`` in the order of their groups, those with groups of
    a part: groups, places of the word before, of the word, and of the pair."""
    before, this = (np.empty(len(key), np.int32) for _ in range(2))
    group = np.empty(len(key), _small(np.empty(0, np.int64), groups).dtype)
    for at in range(0, len(key), AT_ONCE):
        i = slice(at, at + AT_ONCE)
        before[i], this[i] = np.divmod(key[i], len(word))
        group[i] = pair_group(word[before[i]], word[this[i]], groups)
    mine = np.flatnonzero(group % parts == part).astype(np.int32) if parts > 1 else np.arange(len(key), dtype=np.int32)
    mine = mine[np.argsort(group[mine], kind="stable")]
    return group[mine], before[mine], this[mine], mine


def _chunk(b: pa.RecordBatch | pa.Table, i: int):
    return [unpacked(k, b.column(k)[i]) for k in ("word", "code", "size", "train")]


MET = "kind int, group int, chunk long, prev binary, word binary, n binary, t binary, g binary, code binary"


def met(table: DataFrame, groups: int, word_groups: int) -> list[DataFrame]:
    """The pairs of all chunks meet by group. kind 0: a group's pairs counted
    twice or more in training (prev, word, n). kind 1: of a chunk's pairs in the
    group, in its order, the place among those, -1 if counted once, -2 if never.
    kind 2: by group of words, a word's tokens, and its pairs counted once, as
    the context (t) and as the dish (g): these have one table in every seating."""
    parts = min(PASSES, groups)

    def send(part: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            lean()
            for b in batches:
                for i in range(b.num_rows):
                    word, code, size, train = _chunk(b, i)
                    key = keys(word, code, size)
                    key *= 2
                    key += np.repeat(train, size)
                    key.sort()
                    c = (key & 1).astype(np.int32)
                    key >>= 1
                    new = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
                    c, key = np.add.reduceat(c, new), key[new]
                    del code, new
                    group, before, this, place = grouped(word, key, groups, part, parts)
                    to, sizes = np.unique(group, return_counts=True)
                    yield from _rows("group int, chunk long, prev binary, word binary, c binary", len(to),
                                     group=to.astype(np.int32), chunk=b.column("chunk")[i].as_py(), prev=(word[before], sizes),
                                     word=(word[this], sizes), c=(c[place], sizes)).to_batches()

        return run

    def meet(key, t):
        lean()
        prev, word = _flat(t, "prev"), _flat(t, "word")
        h = mix64(prev.view(np.uint64))
        h ^= word.view(np.uint64)
        h = mix64(h)
        order = np.argsort(h)
        if len(order) < 1 << 31:
            order = order.astype(np.int32)
        h = h[order]
        same = h[1:] == h[:-1]
        del h
        prev, word = prev[order], word[order]
        if np.any(same & (word[1:] != word[:-1])):  # two pairs share the number
            again = np.lexsort((prev, word))
            order, prev, word = order[again], prev[again], word[again]
            same = (word[1:] == word[:-1]) & (prev[1:] == prev[:-1])
        new = np.flatnonzero(np.r_[True, ~same])
        del same
        n = np.add.reduceat(_flat(t, "c")[order].astype(np.int64), new)
        prev, word = prev[new], word[new]
        code, often = (n - 2).astype(np.int32), np.flatnonzero(n >= 2)
        often = often[np.argsort(prev[often])]
        code[often] = np.arange(len(often), dtype=np.int32)
        of_entry = np.empty(len(order), np.int32)
        of_entry[order] = np.repeat(code, np.diff(np.r_[new, len(order)]))
        del order, new, code
        kept = [x[often] for x in (prev, word, n)]
        one = np.array([len(kept[0])])
        seen = n >= 1
        both = [np.concatenate([prev[seen], word[seen]])]
        del prev, word
        u, at = distinct(both.pop())
        as_prev, as_word, once = at[:len(at) // 2], at[len(at) // 2:], n[seen] == 1
        to = word_group(u, word_groups)
        by = np.argsort(to, kind="stable")
        there, sizes = np.unique(to, return_counts=True)
        sums = [np.bincount(p, weights=x, minlength=len(u))[by] for p, x in ((as_word, n[seen]), (as_prev, once), (as_word, once))]
        group = key[0].as_py()
        return pa.concat_tables([
            _rows(MET, 1, kind=0, group=group, prev=(kept[0], one), word=(kept[1], one), n=(kept[2], one)),
            _rows(MET, t.num_rows, kind=1, group=group, chunk=t.column("chunk").combine_chunks(), code=(of_entry, _sizes(t, "c"))),
            _rows(MET, len(there), kind=2, group=there.astype(np.int32), word=(u[by], sizes), n=(sums[0].astype(np.int64), sizes),
                  t=(sums[1].astype(np.int32), sizes), g=(sums[2].astype(np.int32), sizes))])

    tables = []
    for part in range(parts):
        sent = table.select("chunk", "word", "code", "size", "train").mapInArrow(
            send(part), "group int, chunk long, prev binary, word binary, c binary")
        tables.append(zipped(sent.groupBy("group").applyInArrow(meet, MET), "lm-met"))
        del sent
        discard()  # the pass's shuffle
    return tables


def words_of(sums: DataFrame) -> DataFrame:
    """The training words by group, in order of their hashes."""
    ddl = "group int, total long, vocabulary long, word binary, n binary, t binary, g binary"

    def add(key, t):
        word, at = np.unique(_flat(t, "word"), return_inverse=True)
        n, tables, guests = (np.bincount(at, weights=_flat(t, k), minlength=len(word)).astype(np.int64) for k in ("n", "t", "g"))
        one = np.array([len(word)])
        return _rows(ddl, 1, group=key[0].as_py(), total=int(n.sum()), vocabulary=len(word), word=(word, one), n=(n, one),
                     t=(tables, one), g=(guests, one))

    return zipped(sums.select("group", "word", "n", "t", "g").groupBy("group").applyInArrow(add, ddl), "lm-words")


@dataclass
class Root:
    """Of a seating, the root's customers and tables, and the number of training words."""

    customers: float
    tables: float
    vocabulary: int

    def weight(self) -> float:
        return (ROOT_STRENGTH + ROOT_DISCOUNT * self.tables) / (self.vocabulary + 1)

    def p(self, guests, tables):
        """Probability of words with so many customers and tables."""
        return (guests - ROOT_DISCOUNT * tables + self.weight()) / (ROOT_STRENGTH + self.customers)


def seated(prev, word, n, as_prev, as_word, tables, guests, root_tables, root: Root, seed: int, sweep: int) -> np.ndarray:
    """Tables of each pair in a sweep, given the seating before: tables of each
    context, and of each dish the root's customers and tables."""
    p = root.p(guests, root_tables)
    return seat(n, (STRENGTH + DISCOUNT * tables[as_prev]) * p[as_word], DISCOUNT, keyed(seed, 2 * sweep, word, prev))


def words_in(prev: np.ndarray, word: np.ndarray, groups: int):
    """Distinct words by group, their groups, and the places of prev and word."""
    u, at = distinct(np.concatenate([prev, word]))
    group = word_group(u, groups)
    order = np.argsort(group, kind="stable")
    place = np.empty(len(order), at.dtype)
    place[order] = np.arange(len(order))
    at = place[at]
    return u[order], group[order], at[:len(prev)], at[len(prev):]


SENT = "group int, frm int, word binary, t binary, g binary"
STATE = "kind int, group int, frm int, t binary, g binary, r binary, customers double, tables double"


def _pairs(t: pa.Table, rows: np.ndarray | None = None):
    return _flat(t, "prev", rows), _flat(t, "word", rows), _flat(t, "n", rows)


def _answer(t: pa.Table, names: tuple[str, ...], rows: np.ndarray | None = None) -> list[np.ndarray]:
    """The lists of a group's answers (all or ``rows``), in order of the groups they come from."""
    rows = np.arange(t.num_rows) if rows is None else rows
    rows = rows[np.argsort(t.column("frm").to_numpy()[rows], kind="stable")]
    return [_flat(t, k, rows) for k in names]


def sweeps(pairs: DataFrame, words: DataFrame, vocabulary: int, word_groups: int, seed: int = 5) -> tuple[list[DataFrame], list[Root]]:
    """The seatings before the first sweep and after each: of each word (kind 1)
    its tables t as the context, and its customers g and tables r at the root;
    kind 0: the same for the words of a group of pairs."""
    def messages(group: int, prev, word, t) -> pa.Table:
        u, to, as_prev, as_word = words_in(prev, word, word_groups)
        there, sizes = np.unique(to, return_counts=True)
        sums = [np.bincount(p, weights=t, minlength=len(u)).astype(np.int32) for p in (as_prev, as_word)]
        return _rows(SENT, len(there), group=there.astype(np.int32), frm=group, word=(u, sizes), t=(sums[0], sizes), g=(sums[1], sizes))

    def start(key, t):
        lean()
        prev, word, n = _pairs(t)
        return messages(key[0].as_py(), prev, word, np.ones(len(n)))

    def sweep_with(root: Root, sweep: int):
        def run(key, t, answers):
            lean()
            prev, word, n = _pairs(t)
            _, _, as_prev, as_word = words_in(prev, word, word_groups)
            tables = seated(prev, word, n, as_prev, as_word, *_answer(answers, ("t", "g", "r")), root, seed, sweep)
            return messages(key[0].as_py(), prev, word, tables)

        return run

    def add_with(root: Root, sweep: int):
        def run(key, asked, known):
            lean()
            word, own = _flat(known, "word"), _sizes(known, "word")
            at = np.searchsorted(word, _flat(asked, "word"))
            t, g = (_flat(known, k) + np.bincount(at, weights=_flat(asked, k), minlength=len(word)) for k in ("t", "g"))
            r = seat(g, np.full(len(g), root.weight()), ROOT_DISCOUNT, keyed(seed, 2 * sweep + 1, word, np.full(len(word), -1)))
            state, sizes, group = [x.astype(np.int32) for x in (t, g, r)], _sizes(asked, "word"), key[0].as_py()
            return pa.concat_tables([
                _rows(STATE, asked.num_rows, kind=0, group=asked.column("frm").combine_chunks(), frm=group,
                      **{k: (x[at], sizes) for k, x in zip("tgr", state)}),
                _rows(STATE, known.num_rows, kind=1, group=group, customers=float(g.sum()), tables=float(r.sum()),
                      **{k: (x, own) for k, x in zip("tgr", state)})])

        return run

    by_word = words.select("group", "word", "t", "g")
    states, roots, before = [], [], Root(0.0, float(vocabulary), vocabulary)
    for sweep in range(BURN + SAMPLES + 1):
        if sweep:
            sent = pairs.groupBy("group").cogroup(states[-1].where("kind = 0").groupBy("group")).applyInArrow(sweep_with(before, sweep), SENT)
        else:
            sent = pairs.groupBy("group").applyInArrow(start, SENT)
        state = zipped(sent.groupBy("group").cogroup(by_word.groupBy("group")).applyInArrow(add_with(before, sweep), STATE), "lm-state")
        got = state.where("kind = 1").agg(F.sum("customers"), F.sum("tables")).first()
        before = Root(got[0] or 0.0, got[1] or 0.0, vocabulary)
        states.append(state)
        roots.append(before)
        if len(states) > 1 + SAMPLES:
            discard(states[-2 - SAMPLES])
    return states, roots


def scores(docs: DataFrame, limit: int | None = None, seed: int = 5) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score, score of every row."""
    rows = docs.select("doc_id", "text", (remainder(F.col("doc_id"), 10) != 0).alias("train"),
                       F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("doc_id").isNull(), "text").alias("row"))
    table = chunks(rows)
    tokens_in_all = table.agg(F.sum("tokens")).first()[0] or 0
    groups = max(1, -(-tokens_in_all // max(PER_GROUP if limit is None else limit, LEAST)))
    word_groups = -(-groups // 6)
    tables = met(table, groups, word_groups)
    together = tables[0]
    for t in tables[1:]:
        together = together.unionAll(t)
    words = words_of(together.where("kind = 2"))
    total, vocabulary = (x or 0 for x in words.agg(F.sum("total"), F.sum("vocabulary")).first())
    pairs = together.where("kind = 0").select("group", "prev", "word", "n")
    states, roots = sweeps(pairs, words, vocabulary, word_groups, seed)
    discard()
    last = range(BURN + 1, BURN + SAMPLES + 1)
    before, after = [roots[s - 1] for s in last], [roots[s] for s in last]

    def tables_of(key, t, answers):
        """To each chunk, of its pairs: training count, and tables summed over the samples."""
        lean()
        prev, word, n = _pairs(t, _where(t, "kind", 0))
        _, _, as_prev, as_word = words_in(prev, word, word_groups)
        sums = np.zeros(len(n))
        for s, root in zip(last, before):
            sums += seated(prev, word, n, as_prev, as_word, *_answer(answers, ("t", "g", "r"), _where(answers, "sweep", s)), root, seed, s)
        n, sums = np.r_[n, 0, 1], np.r_[sums, 0, SAMPLES].astype(np.int32)  # last those of -2 and -1
        del prev, word, as_prev, as_word
        ask = _where(t, "kind", 1)
        code, sizes = _flat(t, "code", ask), _sizes(t, "code")[ask]
        return _rows(REPLY, len(ask), kind=0, chunk=t.column("chunk").combine_chunks().take(pa.array(ask)), frm=key[0].as_py(), n=(n[code], sizes), t=(sums[code], sizes))

    def ask_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                word = unpacked("word", b.column("word")[i])
                to = word_group(word, word_groups)
                there, sizes = np.unique(to, return_counts=True)
                yield from _rows("group int, chunk long, word binary", len(there), group=there.astype(np.int32), chunk=b.column("chunk")[i].as_py(),
                                 word=(word[np.argsort(to, kind="stable")], sizes)).to_batches()

    def words_for(key, ask, known):
        """To each chunk, of its words: training count, and in each sample the state."""
        lean()
        own = _where(known, "sweep", -1)
        word, asked, sizes = _flat(known, "word", own), _flat(ask, "word"), _sizes(ask, "word")
        at = np.searchsorted(word, asked)
        at[at == len(word)] = 0
        there = word[at] == asked if len(word) else np.zeros(len(asked), bool)
        n = np.zeros(len(asked), np.int64)
        n[there] = _flat(known, "n", own)[at[there]]
        state = {}
        for k in "tgr":
            x = np.zeros((len(asked), SAMPLES), np.int64)
            for i, s in enumerate(last):
                x[there, i] = _flat(known, k, _where(known, "sweep", s))[at[there]]
            state[k] = (x.ravel(), sizes * SAMPLES)
        return _rows(REPLY, ask.num_rows, kind=1, chunk=ask.column("chunk").combine_chunks(), frm=key[0].as_py(), n=(n, sizes), **state)

    def score(key, t, replies):
        lean()
        word, code, size, train = _chunk(t, 0)
        key, pair = distinct(keys(word, code, size))
        _, prev, this, place = grouped(word, key, groups)
        del key
        n, tables = _answer(replies, ("n", "t"), _where(replies, "kind", 0))
        got = _answer(replies, ("n", "t", "g", "r"), _where(replies, "kind", 1))
        back = np.argsort(np.argsort(word_group(word, word_groups), kind="stable"))
        of_word, t_, g, r = (x.reshape(len(word), -1)[back] for x in got)
        of_word = of_word[:, 0]
        of_sample = [((STRENGTH + DISCOUNT * t_[:, i]) / (STRENGTH + of_word), root.p(g[:, i], r[:, i])) for i, root in enumerate(after)]
        logp = np.empty(len(n))
        for first in range(0, len(n), AT_ONCE):
            i = slice(first, first + AT_ONCE)
            p = (n[i] - DISCOUNT * tables[i] / SAMPLES) / (STRENGTH + of_word[prev[i]])
            for weight, root_p in of_sample:
                p += weight[prev[i]] * root_p[this[i]] / SAMPLES
            logp[place[i]] = np.log10(p)
        del n, tables, prev, this, place
        known, base = of_word > 0, np.log10((of_word + 0.1) / (total + 0.1 * (vocabulary + 1)))
        sums = [np.empty(len(size)) for _ in range(3)]
        for texts, i in text_spans(size):
            doc = np.repeat(np.arange(texts.stop - texts.start), size[texts])
            for to, x in zip(sums, (known[code[i]], base[code[i]], logp[pair[i]])):
                to[texts] = np.bincount(doc, weights=x, minlength=texts.stop - texts.start)
        return _rows(PART, len(size), row=unpacked("row", t.column("row")[0]), n=size.astype(np.int64), known=sums[0].astype(np.int64), base=sums[1], score=sums[2])

    answers = known = None
    for s in last:
        a = states[s - 1].where("kind = 0").select("group", "frm", "t", "g", "r", F.lit(s).alias("sweep"))
        k = states[s].where("kind = 1").select("group", "t", "g", "r", F.lit(s).alias("sweep"))
        answers, known = (a, k) if answers is None else (answers.unionAll(a), known.unionAll(k))
    known = known.unionByName(words.select("group", "word", "n", F.lit(-1).alias("sweep")), allowMissingColumns=True)
    asked = together.where("kind < 2").select("kind", "group", "chunk", "prev", "word", "n", "code")
    replies = [zipped(asked.groupBy("group").cogroup(answers.groupBy("group")).applyInArrow(tables_of, REPLY), "lm-replies")]
    ask = table.select("chunk", "word").mapInArrow(ask_words, "group int, chunk long, word binary")
    replies.append(zipped(ask.groupBy("group").cogroup(known.groupBy("group")).applyInArrow(words_for, REPLY).where("chunk is not null"), "lm-replies"))
    discard(*tables, words, *states[-1 - SAMPLES:])
    to_chunk = replies[0].unionAll(replies[1])
    parts = written(table.groupBy("chunk").cogroup(to_chunk.groupBy("chunk")).applyInArrow(score, PART), "lm-parts")
    discard(table, *replies)
    # rows alike in id and text share their key and have the same sums
    sums = parts.groupBy("row").agg(*[F.first(c).alias(to) for c, to in (("n", "n_tokens"), ("known", "n_known"), ("base", "base_score"), ("score", "score"))])
    return rows.select("doc_id", "row").join(sums, "row").select(
        "doc_id", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), "base_score", "score")


REPLY = "kind int, chunk long, frm int, n binary, t binary, g binary, r binary"
PART = "row long, n long, known long, base double, score double"


def op9(docs: DataFrame, limit: int | None = None) -> DataFrame:
    """``limit``: tokens a group of pairs holds about (``PER_GROUP``)."""
    return scores(docs.select("doc_id", "text"), limit).select(
        "doc_id", (remainder(F.col("doc_id"), 10) == 0).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score",
        F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"))
