"""Shapley attribution of a black-box score: how much each input moves a row's
score away from the mean score of some background rows.

Coalitions of inputs are drawn once, with a seed; every row is met by every
coalition and every background row, the coalition's inputs taken from the row,
the others from the background row, and the model scores the lot. The weighted
least-squares problem that turns coalition values into attributions has the same
matrix for all rows, so it is solved once (inputs x coalitions) and a row's
attributions are sums of its coalition values with known factors: an aggregate.

Rows to explain times coalitions times background rows are scored; the coalitions
and the background are bounded by parameters and travel as literals."""

from __future__ import annotations

import itertools
import math
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_BACKGROUND = 100


def coalitions(d: int, samples: int, seed: int = 42) -> tuple[np.ndarray, np.ndarray]:
    """(members, weights): 0/1 rows of inputs, neither empty nor full. All of them,
    with their kernel weights, if there are at most ``samples``; else whole sizes
    from the smallest and largest inwards for as long as they fit, and the rest
    drawn with their complements, sharing the weight of the sizes left."""
    kernel = {k: (d - 1) / (k * (d - k)) for k in range(1, d)}  # weight of all coalitions of a size
    found: dict[tuple, float] = {}
    sizes = sorted(range(1, d), key=lambda k: (min(k, d - k), k))
    while sizes:
        same = [k for k in sizes if min(k, d - k) == min(sizes[0], d - sizes[0])]
        need = sum(math.comb(d, k) for k in same)
        if len(found) + need > samples:
            break
        for k in same:
            for c in itertools.combinations(range(d), k):
                found[tuple(int(j in c) for j in range(d))] = kernel[k] / math.comb(d, k)
        sizes = [k for k in sizes if k not in same]
    if sizes:
        rng, drawn = np.random.default_rng(seed), {}
        p = np.array([kernel[k] for k in sizes])
        room = max(2, samples - len(found))
        while sum(drawn.values()) < room:
            c = np.zeros(d, int)
            c[rng.permutation(d)[:sizes[rng.choice(len(sizes), p=p / p.sum())]]] = 1
            for member in (tuple(c.tolist()), tuple((1 - c).tolist())):
                drawn[member] = drawn.get(member, 0) + 1
        for member, n in drawn.items():
            found[member] = n * p.sum() / sum(drawn.values())
    members = np.array(sorted(found, reverse=True), int).reshape(-1, d)
    return members, np.array([found[tuple(m)] for m in members.tolist()])


def factors(members: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(A, b): attributions are A v + b total, where v are a row's coalition values
    less the base and total is its score less the base. They add up to total."""
    d = members.shape[1]
    if d == 1:
        return np.zeros((1, len(members))), np.ones(1)
    z = members[:, :-1] - members[:, -1:]  # the last input is what the others leave of the total
    left = np.linalg.pinv(z.T @ (weights[:, None] * z)) @ (z.T * weights)
    a = np.vstack([left, -left.sum(0)])
    b = -left @ members[:, -1]
    return a, np.r_[b, 1 - b.sum()]


def shapley_values(rows: DataFrame, key: list[str], inputs: list[str], background: DataFrame,
                   score: Callable[[DataFrame], DataFrame], samples: int = 100, seed: int = 42,
                   score_col: str = "score") -> DataFrame:
    """key columns, input, value, attribution, base, score of every row and input.

    ``score`` adds ``score_col`` to any frame that has the inputs. ``background``
    gives at most ``MAX_BACKGROUND`` rows of inputs. A row's attributions add up to
    its score less ``base``, the background's mean score. With at most ``samples``
    coalitions in all they are the exact Shapley values."""
    back = background.select(*inputs).limit(MAX_BACKGROUND + 1).collect()
    if not 1 <= len(back) <= MAX_BACKGROUND:
        raise ValueError(f"1 to {MAX_BACKGROUND} background rows, please")
    members, weights = coalitions(len(inputs), samples, seed)
    a, b = factors(members, weights)
    types = {f.name: f.dataType for f in rows.schema}
    everyone = np.vstack([np.ones((1, len(inputs)), int), members])  # coalition 0: the row itself
    masks = F.array(*[F.array(*[F.lit(bool(x)) for x in m]) for m in everyone])
    backs = F.array(*[F.struct(*[F.lit(r[c]).cast(types[c]).alias(c) for c in inputs]) for r in back])

    base_score = score(background.select(*inputs)).agg(F.avg(score_col)).first()[0]
    met = rows.select(*key, *inputs, F.posexplode(masks).alias("_c", "_m"))
    met = met.select(*key, *inputs, "_c", "_m", F.explode(F.when(F.col("_c") == 0, F.slice(backs, 1, 1)).otherwise(backs)).alias("_b"))
    mixed = met.select(*key, "_c", *[F.col(c).alias(f"_own_{i}") for i, c in enumerate(inputs)],
                       *[F.when(F.get("_m", F.lit(i)), F.col(c)).otherwise(F.col(f"_b.{c}")).alias(c) for i, c in enumerate(inputs)])
    value = score(mixed)
    own = [f"_own_{i}" for i in range(len(inputs))]
    # one group a row holds the means of all its coalitions, and a row's copies come from
    # one task: what is shuffled is one record a row, not one for each of its coalitions
    means = value.groupBy(*key, *own).agg(*[(F.avg(F.when(F.col("_c") == c, F.col(score_col))) - F.lit(base_score)).alias(f"_v_{c}")
                                            for c in range(len(everyone))])

    table = np.hstack([b[:, None], a])  # input x coalition, coalition 0 first
    known = F.coalesce(*[F.col(f"_v_{c}") for c in range(len(everyone))]).isNotNull()

    def share(i: int):
        return F.when(known, sum((F.coalesce(F.lit(float(x)) * F.col(f"_v_{c}"), F.lit(0.0)) for c, x in enumerate(table[i])), F.lit(0.0)))

    out = means.select(*key, *own, *[share(i).alias(f"_a_{i}") for i in range(len(inputs))], (F.col("_v_0") + F.lit(base_score)).alias("_score"))
    flat = F.explode(F.array(*[F.struct(F.lit(c).alias("input"), F.col(own[i]).cast("double").alias("value"), F.col(f"_a_{i}").alias("attribution"))
                               for i, c in enumerate(inputs)])).alias("_x")
    return out.select(*key, flat, "_score").select(*key, "_x.input", "_x.value", "_x.attribution", F.lit(base_score).alias("base"), F.col("_score").alias(score_col))
