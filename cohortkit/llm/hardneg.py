"""Operator 11: hard negatives by a multiway hyperplane tree with distance ranges.

Scores are inner products. A further component, the root of M^2 - |x|^2 (M the
largest norm; 0 for an anchor), makes d^2 = |a|^2 + M^2 - 2 score a distance
between anchor and row, so that a score window is an annulus around the anchor.

The tree: a node holds up to ``FANOUT`` split points, each row goes to the child
of its nearest one (the hyperplanes between them part the rows), to ``DEPTH``
levels. Split points are chosen far apart in a bounded sample (``SAMPLE`` rows
and ``SAMPLE_BYTES``, by a hash of the id); every row is indexed, and the exact
distance range of each split point to the rows of each sibling subtree is
aggregated over all rows. At a node an anchor knows its distance to every split
point, and drops each child whose range misses what its annuli allow by the
triangle inequality, so the search is exact whatever the sample. Leaves are
scanned exactly, in blocks of at most ``BLOCK`` bytes by a hash of the id and of
``ASKED`` anchors, so a hot leaf (copies of one vector) is many blocks.

First the positives: the sample's best rows of the anchor's label bound the ball.
Then the negatives: a window for each positive, narrowed by the sample's best
rows within it. Blocks report their best few, which a ranked window merges.

Defined results: rows whose vec_id, label or vector is null, or holds a null or
non-finite component, take no part; of rows with one vec_id the smallest (label,
components) counts; vectors of another length never meet; scores are exact below
2^46; other columns are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import join_on, written

EVERY, POSITIVES, NEGATIVES = 50, 5, 3
LOW, HIGH = 50, 95
FANOUT, DEPTH, LEAF = 8, 2, 64
SAMPLE, SAMPLE_BYTES = 4096, 32 << 20
BLOCK, ASKED = 16 << 20, 4096
SLACK = 1e-9


def quantized(rows: DataFrame) -> DataFrame:
    """vec_id, label, x: the rows that take part, labels shifted where 7 divides the
    id, components floor(256 x)."""
    e = F.col("embedding").cast("array<double>")
    good = F.forall(e, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).cast("long")
    kept = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & good).select(
        F.col("vec_id").cast("long"), label.alias("label"), F.transform(e, lambda v: F.floor(v * 256).cast("double")).alias("x"))
    return kept.groupBy("vec_id").agg(F.min(F.struct("label", "x")).alias("r")).select("vec_id", "r.label", "r.x")


class Node:
    """Split points (lifted), and for each a child node or a leaf number."""

    def __init__(self, number: int, points: np.ndarray):
        self.number, self.points, self.children = number, points, []
        self.low = self.high = None  # ranges: split point x child


class Tree:
    """The trees of all vector lengths of the sample; other lengths are one leaf each."""

    def __init__(self, x: list[np.ndarray], square: float):
        self.square, self.nodes, self.leaves, self.roots = square, [], 0, {}
        for dim in sorted({len(v) for v in x}):
            self.roots[dim] = self._split(self.lift(np.stack([v for v in x if len(v) == dim])), 0)

    def lift(self, x: np.ndarray) -> np.ndarray:
        return np.c_[x, np.sqrt(np.maximum(self.square - (x * x).sum(1), 0.0))]

    def _split(self, y: np.ndarray, level: int):
        far = _distances(y, y[:1])[:, 0]
        picked = [0]
        while len(picked) < FANOUT and far.max() > 0:
            picked.append(int(far.argmax()))
            far = np.minimum(far, _distances(y, y[picked[-1:]])[:, 0])
        if level == DEPTH or len(y) < LEAF or len(picked) < 2:
            self.leaves += 1
            return self.leaves - 1
        node = Node(len(self.nodes), y[picked])
        self.nodes.append(node)
        of = _distances(y, node.points).argmin(1)
        node.children = [self._split(y[of == j], level + 1) for j in range(len(picked))]
        return node

    def leaf_of(self, x: np.ndarray, seen: dict) -> np.ndarray:
        """Leaf of each row; ``seen`` collects the ranges (node, point, child): (low, high)."""
        out = np.full(len(x), -1 - x.shape[1], np.int64)

        def down(node, at, y):
            if not isinstance(node, Node):
                out[at] = node
                return
            d = _distances(y, node.points)
            of = d.argmin(1)
            for j, child in enumerate(node.children):
                mine = np.flatnonzero(of == j)
                if len(mine):
                    for i in range(len(node.points)):
                        low, high = seen.get((node.number, i, j), (np.inf, -np.inf))
                        seen[node.number, i, j] = min(low, d[mine, i].min()), max(high, d[mine, i].max())
                    down(child, at[mine], y[mine])

        if x.shape[1] in self.roots:
            down(self.roots[x.shape[1]], np.arange(len(x)), self.lift(x))
        return out

    def set_ranges(self, ranges: list) -> None:
        for n in self.nodes:
            n.low, n.high = (np.full((len(n.points), len(n.children)), v) for v in (np.inf, -np.inf))
        for r in ranges:
            self.nodes[r.node].low[r.point, r.child], self.nodes[r.node].high[r.point, r.child] = r.low, r.high

    def visited(self, a: np.ndarray, annuli: np.ndarray) -> list[int]:
        """Leaves that the annuli (rows: near, far) around an anchor may meet."""
        if len(a) not in self.roots:
            return [-1 - len(a)]
        out, todo = [], [self.roots[len(a)]]
        while todo:
            node = todo.pop()
            if not isinstance(node, Node):
                out.append(node)
                continue
            d = _distances(np.r_[a, 0.0][None, :], node.points)[0]
            near, far = annuli[:, 0][:, None], annuli[:, 1][:, None]
            slack = SLACK * (1 + d + far)
            least, most = np.maximum(np.maximum(near - d, d - far), 0) - slack, d + far + slack  # annulus x point
            meets = (node.low[None] <= most[:, :, None]) & (node.high[None] >= least[:, :, None])
            todo += [c for c, m in zip(node.children, meets.all(axis=1).any(axis=0)) if m]
        return out


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum((a * a).sum(1)[:, None] + (b * b).sum(1) - 2 * a @ b.T, 0.0))


def _by_length(col) -> list[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, matrix) for each vector length of a list column."""
    col = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
    sizes, flat = np.diff(col.offsets.to_numpy()), col.flatten().to_numpy()
    starts = (np.cumsum(sizes) - sizes).astype(np.int64)
    return [(at := np.flatnonzero(sizes == d), flat[starts[at][:, None] + np.arange(d)].reshape(len(at), d)) for d in np.unique(sizes)]


class Index:
    """All rows by leaf, the tree with its ranges, and the sample."""

    def __init__(self, rows: DataFrame):
        """``rows``: vec_id, label, x."""
        spark = self.spark = rows.sparkSession
        square = F.aggregate("x", F.lit(0.0), lambda acc, v: acc + v * v)
        top = rows.agg(F.max(square).alias("square"), F.max(F.size("x")).alias("dim")).first()
        n = min(SAMPLE, SAMPLE_BYTES // (8 * max(top.dim or 1, 1)))
        sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(n).collect() if n else []
        self.sample = [np.array([r.vec_id for r in sample], np.int64), np.array([r.label for r in sample], np.int64), [np.array(r.x, float) for r in sample]]
        self.tree = Tree(self.sample[2], top.square or 0.0)
        tree = spark.sparkContext.broadcast(self.tree)

        def assigned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                leaf, seen = np.empty(b.num_rows, np.int64), {}
                for at, x in _by_length(b.column(2)):
                    leaf[at] = tree.value.leaf_of(x, seen)
                keys = list(seen)
                ranges = [[(n, i, j, *seen[n, i, j]) for n, i, j in keys]] + [[]] * (b.num_rows - 1)
                kind = pa.list_(pa.struct([("node", pa.int32()), ("point", pa.int32()), ("child", pa.int32()), ("low", pa.float64()), ("high", pa.float64())]))
                ranges = [[dict(zip(("node", "point", "child", "low", "high"), r)) for r in x] for x in ranges]
                if b.num_rows:
                    yield pa.RecordBatch.from_arrays([*b.columns, pa.array(leaf), pa.array(ranges, kind)], names=[*b.schema.names, "leaf", "seen"])

        kind = "array<struct<node:int,point:int,child:int,low:double,high:double>>"
        placed = written(rows.mapInArrow(assigned, f"vec_id long, label long, x array<double>, leaf long, seen {kind}"), "gnat-rows")
        self.rows = placed.drop("seen")
        ranges = placed.select(F.explode("seen").alias("s")).groupBy("s.node", "s.point", "s.child").agg(F.min("s.low").alias("low"), F.max("s.high").alias("high"))
        self.tree.set_ranges(ranges.collect())  # at most (1 + FANOUT) * FANOUT^2 a vector length of the sample
        self.sizes = written(self.rows.groupBy("leaf").agg(
            F.ceil(F.sum(F.size("x") * 8 + 16) / BLOCK).cast("int").alias("parts")), "gnat-sizes")

    def scanned(self, anchors: DataFrame, bounds, best, schema: str) -> DataFrame:
        """Each block of a leaf with the anchors that visit it. ``anchors``: vec_id,
        label, x, and more columns; bounds(tree, row, scores, same, other) gives a row's
        annuli in scores (rows: low, high); best(x, ids, labels, anchors) the block's
        result as an Arrow table of ``schema``."""
        shared = self.spark.sparkContext.broadcast((self.tree, self.sample))
        names = anchors.columns

        def sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            tree, (ids, labels, x) = shared.value
            by = {d: (np.flatnonzero([len(v) == d for v in x]), np.stack([v for v in x if len(v) == d])) for d in {len(v) for v in x}}
            for b in batches:
                rows, who, leaves = b.to_pylist(), [], []
                for k, r in enumerate(rows):
                    a = np.array(r["x"], float)
                    at, known = by.get(len(a), (np.empty(0, int), np.zeros((0, len(a)))))
                    windows = bounds(r, known @ a, ids[at], labels[at])
                    if not len(windows):
                        continue
                    whole = (a * a).sum() + tree.square
                    annuli = np.sqrt(np.maximum(whole - 2 * windows[:, ::-1], 0.0))
                    found = tree.visited(a, annuli)
                    who += [k] * len(found)
                    leaves += found
                if who:
                    picked = b.take(pa.array(who, pa.int64()))
                    yield pa.RecordBatch.from_arrays([*picked.columns, pa.array(leaves, pa.int64())], names=[*names, "leaf"])

        kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in anchors.schema)
        asked = written(anchors.mapInArrow(sent, f"{kinds}, leaf long"), "gnat-asked")
        sizes = written(self.sizes.join(asked.groupBy("leaf").agg(F.ceil(F.count("*") / ASKED).cast("int").alias("turns")), "leaf"), "gnat-blocks")

        def dealt(df, own, other, mine, theirs):
            df = join_on(df, sizes, ["leaf"]).withColumn(own, F.pmod(F.xxhash64("vec_id"), F.col(mine)).cast("int"))
            return df.withColumn(other, F.explode(F.sequence(F.lit(0), F.col(theirs) - 1))).drop("parts", "turns").groupBy("leaf", "i", "j")

        def run(key, rows, anchors):
            out = []
            if rows.num_rows and anchors.num_rows:
                rows = rows.sort_by("vec_id")
                for at, x in _by_length(rows.column("x")):  # a leaf holds one length
                    out.append(best(x, rows.column("vec_id").to_numpy()[at], rows.column("label").to_numpy()[at], anchors))
            return pa.concat_tables(out) if out else best(np.zeros((0, 0)), np.empty(0, np.int64), np.empty(0, np.int64), anchors.slice(0, 0))

        return dealt(self.rows, "i", "j", "parts", "turns").cogroup(dealt(asked, "j", "i", "turns", "parts")).applyInArrow(run, schema)


def _first(score: np.ndarray, allowed: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of each row's n highest allowed scores, ties to the first columns."""
    s = np.where(allowed, score, -np.inf)
    k = min(n, s.shape[1])
    if not k or not len(s):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    least = np.partition(s, s.shape[1] - k, axis=1)[:, s.shape[1] - k]
    r, c = np.nonzero((s >= least[:, None]) & allowed)
    by = np.lexsort((c, -s[r, c], r))
    r, c = r[by], c[by]
    keep = np.arange(len(r)) - np.searchsorted(r, r) < n
    return r[keep], c[keep]


def _anchors(t: pa.Table, step: int = 256) -> Iterator[tuple[pa.Table, np.ndarray, np.ndarray, np.ndarray]]:
    for at in range(0, t.num_rows, step):
        part = t.slice(at, step)
        for rows, a in _by_length(part.column("x")):
            yield part.take(pa.array(rows)), a, part.column("vec_id").to_numpy()[rows], part.column("label").to_numpy()[rows]


def _ranked(found: DataFrame, by: list[str], score: str, ident: str, n: int) -> DataFrame:
    w = Window.partitionBy(*by).orderBy(F.desc(score), ident)
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


def positives(index: Index, anchors: DataFrame, n: int = POSITIVES) -> DataFrame:
    """anchor_id, positive_id, positive_score, rank: the first ``n`` other rows of each
    anchor's label."""
    def bounds(row, scores, ids, labels):
        own = np.sort(scores[(labels == row["label"]) & (ids != row["vec_id"])])[::-1]
        return np.array([[own[n - 1] if len(own) >= n else -np.inf, np.inf]])

    def best(x, ids, labels, anchors):
        out = [[np.empty(0, np.int64)] for _ in range(3)]
        for _, a, who, of in _anchors(anchors):
            s = a @ x.T
            r, c = _first(s, (labels == of[:, None]) & (ids != who[:, None]), n)
            for o, v in zip(out, (who[r], ids[c], s[r, c].astype(np.int64))):
                o.append(v)
        return pa.table([pa.array(np.concatenate(o)) for o in out], names=["anchor_id", "positive_id", "positive_score"])

    found = index.scanned(anchors, bounds, best, "anchor_id long, positive_id long, positive_score long")
    return _ranked(found, ["anchor_id"], "positive_score", "positive_id", n)


def negatives(index: Index, anchors: DataFrame, pairs: DataFrame, n: int = NEGATIVES, low: int = LOW, high: int = HIGH) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score: the first
    ``n`` rows of other labels whose score is ``low`` to ``high`` hundredths of the positive's."""
    held = pairs.groupBy(F.col("anchor_id").alias("vec_id")).agg(
        F.sort_array(F.collect_list(F.struct("positive_score", "positive_id"))).alias("p"))  # POSITIVES entries at most
    asked = anchors.join(held, "vec_id").select("vec_id", "label", "x", "p.positive_id", "p.positive_score")

    def bounds(row, scores, ids, labels):
        out = []
        others = np.sort(scores[labels != row["label"]])[::-1]
        for p in row["positive_score"]:
            if low * p <= high * p:
                inside = others[(100 * others >= low * p) & (100 * others <= high * p)]
                out.append([inside[n - 1] if len(inside) >= n else low * p / 100, high * p / 100])
        return np.array(out)

    def best(x, ids, labels, anchors):
        out = [[np.empty(0, np.int64)] for _ in range(5)]
        for part, a, who, of in _anchors(anchors):
            s = a @ x.T
            other = labels != of[:, None]
            ps, names = part.column("positive_score").to_pylist(), part.column("positive_id").to_pylist()
            for k in range(max((len(p) for p in ps), default=0)):
                rows = np.array([i for i, p in enumerate(ps) if len(p) > k])
                p, name = np.array([ps[i][k] for i in rows]), np.array([names[i][k] for i in rows])
                t = s[rows]
                r, c = _first(t, other[rows] & (100 * t >= low * p[:, None]) & (100 * t <= high * p[:, None]), n)
                for o, v in zip(out, (who[rows[r]], name[r], ids[c], p[r], t[r, c].astype(np.int64))):
                    o.append(v)
        return pa.table([pa.array(np.concatenate(o)) for o in out], names=["anchor_id", "positive_id", "negative_id", "positive_score", "negative_score"])

    found = index.scanned(asked, bounds, best, "anchor_id long, positive_id long, negative_id long, positive_score long, negative_score long")
    return _ranked(found, ["anchor_id", "positive_id"], "negative_score", "negative_id", n).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def op11(rows: DataFrame) -> DataFrame:
    index = Index(written(quantized(rows), "gnat-vectors"))
    anchors = index.rows.where(F.col("vec_id") % EVERY == 0).select("vec_id", "label", "x")
    return negatives(index, anchors, written(positives(index, anchors), "gnat-positives"))


ORACLE = f"""
WITH r AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS l,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS a, b.vec_id AS b, a.l = b.l AS same, CAST(list_inner_product(a.e, b.e) AS BIGINT) AS s
  FROM r a JOIN r b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) WHERE a.vec_id % {EVERY} = 0),
p AS (SELECT a, b, s FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY s DESC, b) <= {POSITIVES})
SELECT p.a AS anchor_id, p.b AS positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, n.b AS negative_id,
  p.s AS positive_score, n.s AS negative_score
FROM p JOIN s n ON n.a = p.a AND NOT n.same AND {LOW} * p.s <= 100 * n.s AND 100 * n.s <= {HIGH} * p.s
WINDOW w AS (PARTITION BY p.a, p.b ORDER BY n.s DESC, n.b) QUALIFY row_number() OVER w <= {NEGATIVES}
"""
