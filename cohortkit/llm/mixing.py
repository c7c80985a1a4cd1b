"""Operator 7: mixing sources to target weights.

Each source's texts, in a fixed order, form one stream of words that is cut
into blocks of equal length (``BLOCK`` words; a source of fewer than ``FINEST``
such blocks is cut finer). A target share turns into a number of slots of one
block each. For every source the slots are spread over output shards by a
multinomial draw; the j-th slot of a source takes block perm(j mod blocks) of
epoch j div blocks, where perm is a pseudorandom permutation of the source's
block indices, drawn anew for each epoch. Slots and blocks meet in a join by
(source, block index), so nothing is shuffled but indices and the words asked for.

The shard counts are multinomial given each source's total. That total is its
target in blocks, rounded, so a source's words come within half a block (and
what its short last block lacks) of the target instead of straying by the
draw's own variance; no block is used more than three times.

Targets: sources in code point order, null last, weigh 5, 2, 1 and so on again.
Of all words each gets its weight's share, but at most 3 times its own words;
the excess goes to the others by weight until none is above.

Whole documents (the pipeline's stage): a row's copies are what its blocks took
in whole texts, and one more for a share of the rows that equals the fractions
left: along the rows of a source and chunk in order of size, the fractions add
up from a seeded start, and the row at which the sum passes a whole number gets
the copy. So a row's expected words are those its blocks took, and a source's
words stay within about the largest text a chunk of what was drawn.

Defined results: a null or empty text has size 0 and is never taken; rows
alike in id, source and text share the whole copies they take evenly (what their
blocks took may differ by row); all draws depend on
``seed`` and the rows alone, so reruns agree; columns beyond doc_id, text and
source are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import join_on, mix64, written

BLOCK = 256
FINEST = 128
#: Slots of an output shard, on average.
SHARD = 4096
#: Slots a task makes, on average.
SLOTS = 1 << 18
#: Rows of a chunk in which offsets are summed.
CHUNK_ROWS = 20_000
WEIGHTS = (5, 2, 1)
#: A whole copy in the sums of fractions.
UNIT = 1 << 32
MOST = 3


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def permute(x: np.ndarray, n: np.ndarray, seed: np.ndarray) -> np.ndarray:
    """Pseudorandom permutation of 0..n-1 for each row's n and seed: a Feistel
    network on the next even number of bits, repeated until the value is below n."""
    x, n = x.astype(np.uint64), n.astype(np.uint64)
    half = np.maximum(1, (np.ceil(np.log2(np.maximum(n, 2).astype(float))).astype(np.int64) + 1) // 2).astype(np.uint64)
    mask = (np.uint64(1) << half) - np.uint64(1)
    out, todo = x.copy(), np.ones(len(x), dtype=bool)
    while todo.any():
        v, h, m, s = out[todo], half[todo], mask[todo], seed.astype(np.uint64)[todo]
        left, right = v >> h, v & m
        for r in range(4):
            left, right = right, left ^ (mix64(right + mix64(s + np.uint64(r))) & m)
        out[todo] = (left << h) | right
        todo[todo] = out[todo] >= n[todo]
    return out.astype(np.int64)


def sized(docs: DataFrame) -> DataFrame:
    """Narrow rows: doc_id, source, digest of the text, size, chunk."""
    rows = docs.select("doc_id", "source", F.xxhash64("text").alias("digest"), word_count(F.col("text")).alias("size"))
    rows = written(rows, "mix-sizes")
    chunks = max(1, math.ceil(rows.count() / CHUNK_ROWS))
    return rows.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "digest"), F.lit(chunks)))


def _rank(sources: DataFrame) -> DataFrame:
    """``place``: the source's place in code point order, null last."""
    kind = T.StructType([T.StructField("source", T.StringType()), T.StructField("words", T.LongType()),
                         T.StructField("place", T.LongType())])
    ordered = sources.orderBy(F.col("source").asc_nulls_last())
    return sources.sparkSession.createDataFrame(
        ordered.rdd.zipWithIndex().map(lambda x: (x[0].source, x[0].words, x[1])), kind)


def targets(rows: DataFrame) -> DataFrame:
    """Per source: words, target, block length, number of blocks and of slots."""
    src = written(_rank(rows.groupBy("source").agg(F.sum("size").alias("words"))), "mix-sources")
    place = F.col("place") % len(WEIGHTS)
    src = src.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in WEIGHTS]), (place + 1).cast("int")))
    most, level, full = F.col("words") * float(MOST), None, -1
    while True:
        at_most = F.lit(False) if level is None else most <= F.lit(level) * F.col("weight")
        got = src.agg(F.sum("words").alias("all"), F.sum(F.when(at_most, most)).alias("capped"),
                      F.sum(F.when(~at_most, F.col("weight"))).alias("open"), F.count(F.when(at_most, 1)).alias("n")).first()
        if got["n"] == full or not got["open"]:
            break
        full, level = got["n"], (float(got["all"] or 0) - float(got["capped"] or 0)) / got["open"]
    target = F.least(most, F.lit(float(level or 0)) * F.col("weight"))
    length = F.greatest(F.lit(1), F.least(F.lit(BLOCK), F.ceil(F.col("words") / FINEST))).cast("long")
    src = src.select("source", "words", target.alias("target"), length.alias("length"),
                     F.ceil(F.col("words") / length).cast("long").alias("blocks"))
    slots = F.when(F.col("words") > 0, F.least(F.col("blocks") * MOST, F.round(F.col("target") * F.col("blocks") / F.col("words"))))
    return src.withColumn("slots", F.coalesce(slots, F.lit(0)).cast("long"))


def placed(rows: DataFrame, src: DataFrame) -> DataFrame:
    """Each row with its source's figures and the offset of its first word in
    the source's stream. Offsets add up within chunks of a source, then over
    the chunks, so that a large source is not one task."""
    sums = rows.groupBy("source", "chunk").agg(F.sum("size").alias("chunk_words"))
    by_chunk = Window.partitionBy("source").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    base = sums.select("source", "chunk", F.coalesce(F.sum("chunk_words").over(by_chunk), F.lit(0)).alias("base"))
    inside = Window.partitionBy("source", "chunk").orderBy("doc_id", "digest", "size").rowsBetween(Window.unboundedPreceding, -1)
    r = rows.withColumn("before", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    r = join_on(r, base, ["source", "chunk"]).select(
        "doc_id", "source", "digest", "chunk", "size", (F.col("base") + F.col("before")).alias("start"))
    return join_on(r, src.drop("slots"), ["source"])


def draws(src: DataFrame, seed: int = 11) -> DataFrame:
    """One row per slot: source, shard, slot (the source's ordinal) and block.
    The shards' counts are dealt to tasks before they are laid out as slots."""
    total = src.agg(F.sum("slots")).first()[0] or 0
    shards = max(1, math.ceil(total / SHARD))

    def spread(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            for s, n, blocks in zip(p["source"], p["slots"], p["blocks"]):
                own = zlib.crc32(("s" + s if s is not None else "n").encode(), seed)
                rng, left, at = np.random.default_rng([seed, own]), int(n), 0
                for first in range(0, shards, 100_000):
                    k, rest = min(100_000, shards - first), shards - first
                    got = left if rest == k else int(rng.binomial(left, k / rest))
                    counts = rng.multinomial(got, np.full(k, 1 / k))
                    starts = at + np.cumsum(counts) - counts
                    at, left = at + got, left - got
                    yield pd.DataFrame({"source": s, "shard": np.arange(first, first + k), "first": starts,
                                        "n": counts, "blocks": blocks, "own": own})[counts > 0]

    each = (src.where("slots > 0").select("source", "slots", "blocks")
            .mapInPandas(spread, "source string, shard long, first long, n long, blocks long, own long")
            .repartition(max(1, math.ceil(total / SLOTS)), "source", "shard")
            .withColumn("slot", F.explode(F.expr("sequence(first, first + n - 1)"))))

    @F.pandas_udf("long")
    def block(slot: pd.Series, blocks: pd.Series, own: pd.Series) -> pd.Series:
        j, n = slot.to_numpy(np.int64), blocks.to_numpy(np.int64)
        key = mix64(own.to_numpy(np.uint64) * np.uint64(1 << 31) + (j // n).astype(np.uint64))
        return pd.Series(permute(j % n, n, key))

    return each.select("source", "shard", "slot", block("slot", "blocks", "own").alias("block"))


def pieces(rows: DataFrame) -> DataFrame:
    """The parts of each text that fall into each block: words from..to of the
    text (end exclusive) and their place in the block."""
    p = rows.where("size > 0").withColumn(
        "block", F.explode(F.expr("sequence(start div length, (start + size - 1) div length)")))
    lo = F.greatest(F.col("start"), F.col("block") * F.col("length"))
    hi = F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * F.col("length"))
    return p.select("doc_id", "source", "digest", "start", "size", "block", (lo - F.col("start")).alias("from"),
                    (hi - F.col("start")).alias("to"))


def block_counts(docs: DataFrame, seed: int = 11) -> DataFrame:
    """doc_id, source, digest, chunk, size, source_size, target and ``taken`` of
    every row: the words of it in the drawn blocks. Both joins of blocks sort and merge: their sides grow with the words,
    and shrink so well in a shuffle that Spark would take them for small."""
    rows = sized(docs)
    src = written(targets(rows), "mix-targets")
    at = placed(rows, src)
    times = draws(src, seed).groupBy("source", "block").agg(F.count("*").alias("times"))
    p = pieces(at)
    took = (join_on(p, times.hint("merge"), ["source", "block"]).groupBy("source", "start")
            .agg(F.sum((F.col("to") - F.col("from")) * F.col("times")).alias("taken")))
    taken = F.when(F.col("size") > 0, F.coalesce("taken", F.lit(0))).otherwise(0).cast("long")
    return join_on(at, took.hint("merge"), ["source", "start"], "left").select(
        "doc_id", "source", "digest", "chunk", "size", F.col("words").alias("source_size"), "target", taken.alias("taken"))


def copies(rows: DataFrame, seed: int = 11) -> DataFrame:
    """doc_id, source, digest, ``times``: whole copies of the rows of ``block_counts``
    that hold words. Fractions are summed in whole units of 1 / UNIT."""
    one = (rows.where("size > 0").groupBy("doc_id", "source", "digest", "chunk")
           .agg(F.sum("taken").alias("taken"), F.sum("size").alias("size")))
    one = one.withColumn("part", F.expr(f"(taken % size) * {UNIT} div size"))
    w = Window.partitionBy("source", "chunk").orderBy("size", "doc_id", "digest").rowsBetween(Window.unboundedPreceding, 0)
    first = F.pmod(F.xxhash64("source", "chunk", F.lit(seed)), F.lit(UNIT))
    one = one.withColumn("upto", F.sum("part").over(w) + first)
    return one.select("doc_id", "source", "digest", F.expr(
        f"int(taken div size + upto div {UNIT} - (upto - part) div {UNIT})").alias("times"))


def mix_counts(docs: DataFrame, seed: int = 11) -> DataFrame:
    """doc_id, source, digest, size, source_size, target and ``taken`` of every
    row, in whole copies: size times the copies of ``mixed_documents``."""
    rows = written(block_counts(docs, seed), "mix-taken")
    out = join_on(rows, copies(rows, seed), ["doc_id", "source", "digest"], "left")
    return out.select("doc_id", "source", "digest", "size", "source_size", "target",
                      (F.col("size") * F.coalesce("times", F.lit(0))).alias("taken"))


def mix(docs: DataFrame, seed: int = 11) -> DataFrame:
    """The mixture itself: shard, source, slot, block, words (array, in order)."""
    rows = sized(docs)
    src = written(targets(rows), "mix-targets")
    p = pieces(placed(rows, src))
    text = docs.select("doc_id", "source", F.xxhash64("text").alias("digest"), "text").dropDuplicates(["doc_id", "source", "digest"])
    p = (join_on(p, text, ["doc_id", "source", "digest"])
         .select("source", "block", "start", F.expr("slice(regexp_extract_all(text, '[^\\\\x20\\\\x09-\\\\x0D]+', 0), int(from) + 1, int(to - from))").alias("part")))
    whole = p.groupBy("source", "block").agg(F.array_sort(F.collect_list(F.struct("start", "part"))).alias("parts"))
    whole = whole.select("source", "block", F.expr("flatten(parts.part)").alias("words"))
    d = draws(src, seed)
    return join_on(d, whole, ["source", "block"]).select("shard", "source", "slot", "block", "words")


def op7(docs: DataFrame) -> DataFrame:
    return block_counts(docs).select("doc_id", "size", "source_size", "target", "taken")


def mixed_documents(docs: DataFrame, seed: int = 11) -> DataFrame:
    """Whole documents of the mixture, with the columns of ``docs``: each row as
    many times as ``copies`` says (0 to 3 times)."""
    counts = copies(block_counts(docs, seed), seed).withColumnsRenamed({"digest": "__digest", "times": "__times"}).where("__times > 0")
    d = docs.withColumn("__digest", F.xxhash64("text"))
    return (join_on(d, counts, ["doc_id", "source", "__digest"])
            .withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__times")))).select(*docs.columns))
