"""Model choice with the data in hand.

A comparator gets the feature rows and two trained models, the best so far and the
candidate, and returns the candidate's gain; the candidate replaces the best when
the gain exceeds the threshold.  Any function ``(features, best, candidate) ->
float`` will do: it may run Spark jobs over the rows (``kmeans.wssse``,
``kmeans.assign``, an aggregate of its own).

``Index`` comparators score every k with the rows' distances to their own and to the
next center, from one pass for all k (``cluster_spread``: sums per cluster, merged
by an aggregate), so the fold over k starts no further job:

* ``davies_bouldin``  mean over clusters of the largest (spread_i + spread_j) /
  distance of the centers; spread is the mean distance to the center.  Lower is better.
* ``silhouette``      simplified silhouette: mean over rows of (b - a) / max(a, b), a
  and b the distances to the own and the next center.  Higher is better.

Both leave empty clusters out.  A model of one live cluster has no index (NaN); it
never replaces a best model, and any model with an index replaces it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellar.operators import exact
from cellar.operators import kmeans as km


@dataclass(frozen=True)
class Model:
    """A trained model of a sweep, as comparators see it."""
    k: int
    centers: np.ndarray    # (k, d)
    wssse: float
    sizes: np.ndarray      # members of each cluster

    def frame(self, spark) -> DataFrame:
        return km.centers_frame(spark, {self.k: self.centers})


Comparator = Callable[[DataFrame, Model, Model], float]


def models_of(result: "km.SweepResult") -> list[Model]:
    return [Model(k, result.centers[k], result.wssse[k], result.sizes[k]) for k in sorted(result.centers)]


def choose_model(features: DataFrame, models: Sequence[Model], comparator: "Comparator | Index | str",
                 threshold: float = km.SWITCH_THRESHOLD) -> Model | None:
    """Scan the models by rising k.  The first is always taken; no models -> None."""
    if isinstance(comparator, str):
        comparator = INDICES[comparator]
    if not models:
        return None
    if isinstance(comparator, Index):
        comparator = comparator.over(features, models)
    best = None
    for model in sorted(models, key=lambda m: m.k):
        if best is None or comparator(features, best, model) > threshold:
            best = model
    return best


# --- indices from one pass ------------------------------------------------------------

_SPREAD_DDL = "k int, cluster int, n long, spread array<double>, shadow array<double>, nearer array<double>"


def cluster_spread(features: DataFrame, centers: "km.Centers", col: str = "features") -> DataFrame:
    """``(k, cluster, n, spread, silhouette)`` for every live cluster of every k: its
    members, their summed distance to the center and their summed simplified
    silhouette (members at distance 0 from both centers count 0).  One pass over the
    rows for all k; the sums are exact, so they do not depend on partitions.  Centers
    beyond ``kmeans.MAX_CENTER_BYTES`` in all take one pass a group of k."""
    parts = None
    for group in km._batches(sorted(centers), next(iter(centers.values())).shape[1]):
        one = _spread_parts(features, {k: centers[k] for k in group}, col)
        parts = one if parts is None else parts.unionAll(one)
    merged = km._sum_arrays(parts, ["k", "cluster"], ["spread", "shadow", "nearer"], ["n"])
    for name in ("spread", "shadow", "nearer"):
        schema = ", ".join(f"{f.name} {'double' if f.name == name else f.dataType.simpleString()}" for f in merged.schema)
        merged = merged.mapInArrow(km._rounded(name, name), schema)
    return merged.select("k", "cluster", "n", "spread", (F.col("nearer") - F.col("shadow")).alias("silhouette"))


def _spread_parts(features: DataFrame, centers: "km.Centers", col: str) -> DataFrame:
    """Per-partition sums as limbs.  The silhouette 1 - a / b of a member (0 <= a <= b)
    goes as two sums of numbers >= 0: one for each member with b > 0, and a / b."""
    spark = features.sparkSession
    d = next(iter(centers.values())).shape[1]
    bc = spark.sparkContext.broadcast({k: np.ascontiguousarray(c, np.float64) for k, c in centers.items()})

    def kernel(batches: Iterable[pa.RecordBatch]):
        cents = bc.value
        acc = {k: [np.zeros(len(c), np.int64)] + [np.zeros((len(c), exact.WIDTH)) for _ in range(3)]
               for k, c in cents.items()}
        for batch in batches:
            if batch.num_rows == 0:
                continue
            x = km._matrix(batch, col, d)
            x2 = np.einsum("ij,ij->i", x, x)
            for k, c in cents.items():
                idx, d2, _ = km._nearest(x, x2, c)
                a = np.sqrt(d2)
                b = np.sqrt(_next_distance(x, x2, c, idx))
                apart = np.isfinite(b) & (b > 0)
                n, spread, shadow, nearer = acc[k]
                n += np.bincount(idx, minlength=len(c))
                spread += exact.cell_sums(a, idx, len(c))
                shadow += exact.cell_sums((a[apart] / b[apart]), idx[apart], len(c))
                nearer += exact.cell_sums(np.ones(int(apart.sum())), idx[apart], len(c))
        for k, (n, *sums) in acc.items():
            live = np.flatnonzero(n)
            if len(live):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(live), k, np.int32)), pa.array(live.astype(np.int32)), pa.array(n[live])]
                    + [km._lists(s[live].ravel(), exact.WIDTH, len(live)) for s in sums],
                    names=["k", "cluster", "n", "spread", "shadow", "nearer"])

    return features.select(col).mapInArrow(kernel, _SPREAD_DDL)


def _next_distance(x: np.ndarray, x2: np.ndarray, c: np.ndarray, idx: np.ndarray) -> np.ndarray:
    """Squared distance to the nearest center but the own one, from the differences
    (inf with one center)."""
    if len(c) == 1:
        return np.full(len(x), np.inf)
    second, which = np.full(len(x), np.inf), np.arange(len(c))
    c2 = np.einsum("ij,ij->i", c, c)
    dist = x2[:, None] - 2.0 * (x @ c.T) + c2[None, :]
    dist[np.arange(len(x)), idx] = np.inf
    # the product's rounding may swap two centers at almost one distance: take all of them
    error = (x.shape[1] + 4) * 8e-16 * (x2 + c2.max())
    rows, cols = np.nonzero((dist <= (dist.min(axis=1) + error)[:, None]) & (which[None, :] != idx[:, None]))
    diff = x[rows] - c[cols]
    np.minimum.at(second, rows, np.einsum("ij,ij->i", diff, diff))
    return second


def index_values(features: DataFrame, models: Sequence[Model]) -> dict[int, dict[str, float]]:
    """k -> {"davies_bouldin", "silhouette"}; the pass's result is model-sized."""
    sums = cluster_spread(features, {m.k: m.centers for m in models}).collect()
    out = {}
    for m in models:
        mine = sorted((r for r in sums if r["k"] == m.k), key=lambda r: r["cluster"])
        if len(mine) < 2:
            out[m.k] = {"davies_bouldin": float("nan"), "silhouette": float("nan")}
            continue
        c = m.centers[[r["cluster"] for r in mine]]
        spread = np.array([r["spread"] / r["n"] for r in mine])
        apart = np.sqrt(((c[:, None, :] - c[None, :, :]) ** 2).sum(-1)) if len(c) <= 256 else _distances(c)
        with np.errstate(divide="ignore", invalid="ignore"):
            ratio = (spread[:, None] + spread[None, :]) / apart
        np.fill_diagonal(ratio, -np.inf)
        total = sum(r["n"] for r in mine)
        out[m.k] = {"davies_bouldin": float(np.mean(ratio.max(axis=1))),
                    "silhouette": float(sum(r["silhouette"] for r in mine) / total)}
    return out


def _distances(c: np.ndarray) -> np.ndarray:
    return np.stack([np.sqrt(((c - y) ** 2).sum(axis=1)) for y in c])


@dataclass(frozen=True)
class Index:
    """A comparator by one of the indices; ``over`` scores all models in one pass."""
    name: str
    higher_is_better: bool

    def over(self, features: DataFrame, models: Sequence[Model]) -> Comparator:
        values = {k: v[self.name] for k, v in index_values(features, models).items()}
        sign = 1.0 if self.higher_is_better else -1.0

        def gain(_: DataFrame, best: Model, candidate: Model) -> float:
            old, new = values[best.k], values[candidate.k]
            if np.isnan(new):
                return -np.inf
            return np.inf if np.isnan(old) else sign * (new - old)
        return gain

    def __call__(self, features: DataFrame, best: Model, candidate: Model) -> float:
        return self.over(features, [best, candidate])(features, best, candidate)


INDICES = {"davies_bouldin": Index("davies_bouldin", False), "silhouette": Index("silhouette", True)}
