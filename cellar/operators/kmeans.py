"""K-Means on feature rows: nearest-center assignment, cost, Lloyd updates for
many k at once, the k sweep, model choice, and the ``pyspark.ml`` trainer.

Execution model
---------------
Centers are model-sized (``sum(k) x d`` doubles) and are the only state kept
on the driver between passes.  Each pass ships them once per executor as a
broadcast variable (at most ``MAX_CENTER_BYTES`` at a time) and runs a
NumPy kernel over Arrow batches (``mapInArrow``): one matrix product per k
finds the nearest center of every row, and the kernel emits *partial* sums
``(k, cluster, n, cost, sum-vector)`` once per partition.  Spark then merges
the partials with a hash aggregate keyed by ``(k, cluster)``; the shuffle
carries ``partitions x sum(k)`` small rows, never the data.  A sweep over
k = 2..K therefore costs one scan of the features per iteration (not one per
k), and all k share it.

Lloyd passes are pruned: every row carries, for each k, its cluster, an upper bound
of the distance to that center and a lower bound to all others.  Centers that moved
loosen the bounds; a row whose bounds still do not meet keeps its cluster without
a distance being computed, and only rows that change their cluster are added to
and taken from the sums.

Determinism: rows are seeded by a fixed order (row key, or a seeded hash of it),
ties go to the lowest cluster id, an empty cluster keeps its center.  Costs and
member sums are exact whole numbers until they are rounded once
(``operators.exact``), so centers, costs and the choice of k do not depend on how the
rows are dealt to partitions.
"""

from __future__ import annotations

import inspect
import uuid
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellar.operators import exact

# Upper bound on the centers shipped to executors in one pass (a task holds
# them plus partial sums of the same size).  A sweep whose centers exceed it
# is split into batches of k; the centers of a single k that exceed it go out
# in several passes over the rows (``_wide_assign``).
MAX_CENTER_BYTES = 64 << 20

# --- fixed values -------------------------------------------------------------
SWITCH_THRESHOLD = 0.001   # a model replaces the best one when it gains more
DEFAULT_K_RANGE = (2, 100)  # sweep bounds, inclusive
DEFAULT_SWEEP_ITERATIONS = 80
DEFAULT_TRAIN_K = 5
DEFAULT_TRAIN_ITERATIONS = 30
DEFAULT_INIT_STEPS = 5      # k-means|| rounds of the trainer
DEFAULT_TOL = 1e-4
DEFAULT_SEED = 42
# -----------------------------------------------------------------------------

Centers = dict[int, np.ndarray]   # k -> array of shape (k, d)


def centers_bytes(centers: Centers) -> int:
    return int(sum(c.size for c in centers.values()) * 8)


def _broadcast(spark: SparkSession, centers: Centers):
    size = centers_bytes(centers)
    if size > MAX_CENTER_BYTES:
        raise ValueError(f"centers take {size} bytes, above {MAX_CENTER_BYTES}")
    return spark.sparkContext.broadcast({k: np.ascontiguousarray(c, dtype=np.float64)
                                         for k, c in centers.items()})


def _matrix(batch: pa.RecordBatch, col: str, d: int) -> np.ndarray:
    arr = batch.column(col)
    if arr.null_count:
        raise ValueError("NULL feature vector")
    lengths = pc.list_value_length(arr)
    if len(arr) and (pc.min(lengths).as_py() != d or pc.max(lengths).as_py() != d):
        raise ValueError(f"feature vectors must all have size {d}")
    flat = arr.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    return flat.reshape(len(arr), d)


def _nearest(x: np.ndarray, x2: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Index of the nearest center per row (lowest index on ties), the squared distance
    to it, and a squared distance that no other center is nearer than.

    The matrix product's rounding depends on the shape of the batch, so a row whose
    two best centers lie within its error is decided by the differences, which
    depend on the row alone."""
    c2 = np.einsum("ij,ij->i", c, c)
    dist = x2[:, None] - 2.0 * (x @ c.T) + c2[None, :]
    rows = np.arange(len(x))
    idx = np.argmin(dist, axis=1)
    error = (x.shape[1] + 4) * 4e-16 * (x2 + (c2.max() if len(c2) else 0.0))
    if len(c) > 1:
        best = dist[rows, idx]
        dist[rows, idx] = np.inf
        second = dist.min(axis=1)
        close = np.flatnonzero(second - best <= 2 * error)
        if len(close):
            dist[close, idx[close]] = best[close]
            r, j = np.nonzero(dist[close] <= (best + 2 * error)[close, None])
            diff = x[close[r]] - c[j]
            order = np.lexsort((j, np.einsum("ij,ij->i", diff, diff), r))
            r, j = r[order], j[order]
            idx[close] = j[np.concatenate([[True], r[1:] != r[:-1]])]
            second[close] = best[close]
        second = np.maximum(second - error, 0.0)
    else:
        second = np.full(len(x), np.inf)
    diff = x - c[idx]
    return idx, np.einsum("ij,ij->i", diff, diff), second


STATS_SCHEMA = "k int, cluster int, n long, cost array<double>, s array<double>"


def _add_member_sums(sums: np.ndarray, x: np.ndarray, idx: np.ndarray,
                     member: np.ndarray) -> None:
    """``sums[j] += x[idx == j].sum(0)`` for every center j: one sort and one
    segmented sum over the whole batch."""
    order = np.argsort(idx, kind="stable")
    live = np.nonzero(member)[0]
    starts = np.concatenate(([0], np.cumsum(member[live])[:-1]))
    sums[live] += np.add.reduceat(x[order], starts, axis=0)


def partial_stats(features: DataFrame, centers: Centers, col: str = "features",
                  bc=None, grid: exact.Fixed | None = None) -> DataFrame:
    """Per-partition ``(k, cluster, n, cost, s)``: members, summed squared distance
    (exact, as limbs) and summed vectors of each center's members (with a ``grid`` as
    limbs too, three a column).  ``bc`` may carry the centers already broadcast (the
    caller then owns its lifetime)."""
    spark = features.sparkSession
    d = next(iter(centers.values())).shape[1]
    width = d if grid is None else 3 * d
    bc = bc or _broadcast(spark, centers)

    def kernel(batches: Iterable[pa.RecordBatch]):
        cents = bc.value
        acc = {k: (np.zeros((len(c), width)), np.zeros(len(c), np.int64), np.zeros((len(c), exact.WIDTH)))
               for k, c in cents.items()}
        for batch in batches:
            if batch.num_rows == 0:
                continue
            x = _matrix(batch, col, d)
            x2 = np.einsum("ij,ij->i", x, x)
            for k, c in cents.items():
                idx, d2, _ = _nearest(x, x2, c)
                sums, counts, cost = acc[k]
                member = np.bincount(idx, minlength=len(c))
                counts += member
                cost += exact.cell_sums(d2, idx, len(c))
                _add_member_sums(sums, x if grid is None else grid.limbs(x), idx, member)
        # one row per non-empty (k, cluster), built from NumPy buffers
        ks, cl, ns, costs, vecs = [], [], [], [], []
        for k, (sums, counts, cost) in acc.items():
            live = np.nonzero(counts)[0]
            ks.append(np.full(len(live), k, np.int32))
            cl.append(live.astype(np.int32))
            ns.append(counts[live])
            costs.append(cost[live].ravel())
            vecs.append(sums[live].ravel())
        rows = int(sum(len(c) for c in cl))
        whole = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, kind)
        yield pa.RecordBatch.from_arrays(
            [pa.array(whole(ks, np.int32)), pa.array(whole(cl, np.int32)), pa.array(whole(ns, np.int64)),
             _lists(whole(costs, float), exact.WIDTH, rows), _lists(whole(vecs, float), width, rows)],
            names=["k", "cluster", "n", "cost", "s"])

    return features.select(col).mapInArrow(kernel, STATS_SCHEMA)


def _lists(flat: np.ndarray, width: int, rows: int) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.arange(rows + 1, dtype=np.int32) * np.int32(width)), pa.array(flat))


def _rounded(limbs: str, out: str):
    """Rows with summed limbs -> the exact sums as doubles (model-sized)."""
    def run(batches):
        for batch in batches:
            column = batch.column(limbs).flatten().to_numpy().reshape(batch.num_rows, exact.WIDTH)
            yield pa.RecordBatch.from_arrays(
                [pa.array([exact.cell_total(x) for x in column], pa.float64()) if name == limbs else batch.column(name)
                 for name in batch.schema.names], names=[out if name == limbs else name for name in batch.schema.names])
    return run


def cluster_stats(features: DataFrame, centers: Centers, col: str = "features",
                  bc=None, grid: exact.Fixed | None = None) -> DataFrame:
    """``(k, cluster, n, cost, s)`` merged over all partitions: one
    aggregate keyed by ``(k, cluster)``; the shuffle carries one row per
    group and partition.  Costs are exact sums.  Centers beyond ``MAX_CENTER_BYTES``
    go by in several passes."""
    if bc is None and centers_bytes(centers) > MAX_CENTER_BYTES:
        parts = _in_parts(features, centers, lambda some: partial_stats(features, some, col, None, grid),
                          lambda k, c: _wide_partial(features, k, c, col, grid))
    else:
        parts = partial_stats(features, centers, col, bc, grid)
    merged = _sum_arrays(parts, ["k", "cluster"], ["cost", "s"], ["n"])
    return merged.mapInArrow(
        _rounded("cost", "cost"), "k int, cluster int, n long, cost double, s array<double>")


def _in_parts(features: DataFrame, centers: Centers, some, wide) -> DataFrame:
    """Centers beyond the bound: groups of k that keep it, and each k that exceeds it
    alone by itself."""
    out = None
    for group in _batches(sorted(centers), next(iter(centers.values())).shape[1]):
        k = group[0]
        one = wide(k, centers[k]) if centers[k].size * 8 > MAX_CENTER_BYTES else some({k: centers[k] for k in group})
        out = one if out is None else out.unionAll(one)
    return out


def _sum_arrays(df: DataFrame, keys: Sequence[str], columns: Sequence[str], counts: Sequence[str] = (),
                tasks: int | None = None) -> DataFrame:
    """Partial rows -> one row per key with ``counts`` (long) and the array<double>
    ``columns`` summed element by element, as plain additions (a mean-based vector
    aggregate would round).  One shuffle of partial rows by key (int columns) to ``tasks``, or
    as many as the session says; a task holds the sums of its keys, a share of the model."""
    keys, columns, counts = list(keys), list(columns), list(counts)

    def add(batches):
        total: dict[tuple, list] = {}
        for batch in batches:
            numbers = [batch.column(c).to_pylist() for c in counts]
            arrays = [batch.column(c).flatten().to_numpy().reshape(batch.num_rows, -1) for c in columns]
            for i, key in enumerate(zip(*(batch.column(c).to_pylist() for c in keys))):
                old = total.get(key)
                if old is None:
                    total[key] = [x[i] for x in numbers] + [x[i].copy() for x in arrays]
                else:
                    for j, x in enumerate(numbers):
                        old[j] += x[i]
                    for j, x in enumerate(arrays, len(numbers)):
                        old[j] += x[i]
        if total:
            rows = list(total.values())
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[j] for k in total], pa.int32()) for j in range(len(keys))]
                + [pa.array([r[j] for r in rows], pa.int64()) for j in range(len(counts))]
                + [_lists(np.concatenate([r[len(counts) + j] for r in rows]), len(rows[0][len(counts) + j]), len(rows))
                   for j in range(len(columns))], names=keys + counts + columns)

    out = T.StructType([df.schema[c] for c in keys + counts + columns])
    return df.select(*keys, *counts, *columns).repartition(*[tasks] * (tasks is not None), *keys).mapInArrow(add, out)


def sum_vectors(df: DataFrame, keys: Sequence[str], col: str, d: int | None = None,
                extra=()) -> DataFrame:
    """Element-wise sum of an array<double> column per key: one vector
    aggregate (``pyspark.ml.stat.Summarizer``) with a map-side partial step,
    whatever the width."""
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer

    return df.groupBy(*keys).agg(
        *extra, vector_to_array(Summarizer.sum(array_to_vector(col))).alias(col))


ASSIGN_FIELDS = [T.StructField("k", T.IntegerType()), T.StructField("cluster", T.IntegerType()),
                 T.StructField("d2", T.DoubleType())]


def assign(features: DataFrame, centers: Centers, col: str = "features",
           keep: Sequence[str] = ("row_num",)) -> DataFrame:
    """Nearest center per row and k: ``(*keep, k, cluster, d2)``.  A row comes out
    once per k in ``centers``: pass the chosen model's k alone, as the flow and
    the queries do.  The broadcast centers (model-sized) live as long as the
    returned frame; centers beyond ``MAX_CENTER_BYTES`` go by in several passes, the
    nearest so far riding along with the row."""
    keep = list(keep)
    if centers_bytes(centers) > MAX_CENTER_BYTES:
        return _in_parts(features, centers, lambda some: assign(features, some, col, keep),
                         lambda k, c: _wide_assign(features, k, c, col, keep)
                         .select(*keep, F.lit(k).alias("k"), "cluster", "d2"))
    spark = features.sparkSession
    d = next(iter(centers.values())).shape[1]
    bc = _broadcast(spark, centers)
    src = features.select(*keep, col)
    schema = T.StructType([f for f in src.schema.fields if f.name in keep] + ASSIGN_FIELDS)

    def kernel(batches: Iterable[pa.RecordBatch]):
        cents = bc.value
        for batch in batches:
            if batch.num_rows == 0:
                continue
            x = _matrix(batch, col, d)
            x2 = np.einsum("ij,ij->i", x, x)
            for k, c in cents.items():
                idx, d2, _ = _nearest(x, x2, c)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(name) for name in keep]
                    + [pa.array(np.full(len(idx), k, np.int32)), pa.array(idx.astype(np.int32)),
                       pa.array(d2)],
                    names=keep + ["k", "cluster", "d2"])

    return src.mapInArrow(kernel, schema)


def wssse(features: DataFrame, centers: Centers, col: str = "features") -> DataFrame:
    """``(k, wssse)``: sum of squared distances to the nearest center (A4), exact and
    rounded once."""
    if centers_bytes(centers) > MAX_CENTER_BYTES:
        parts = _in_parts(features, centers, lambda some: partial_stats(features, some, col),
                          lambda k, c: _wide_partial(features, k, c, col))
    else:
        parts = partial_stats(features, centers, col)
    return _sum_arrays(parts, ["k"], ["cost"]).mapInArrow(_rounded("cost", "wssse"), "k int, wssse double")


# --- initial centers ------------------------------------------------------------

def init_centers(features: DataFrame, ks: Iterable[int], *, mode: str = "first",
                 key: str | Sequence[str] = "row_num", seed: int = DEFAULT_SEED,
                 col: str = "features") -> Centers:
    """Start centers for every k: the first k rows in a fixed order.

    ``first``: ascending ``key``; ``hash``: ascending ``xxhash64(key, seed)``
    (a seeded pseudo-random sample that does not depend on partitioning).
    Only ``max(k)`` rows are taken (per-partition top-k, then a merge).  A k
    above the number of rows has no start and is left out.
    """
    ks = sorted(set(int(k) for k in ks))
    kmax = ks[-1]
    keys = [key] if isinstance(key, str) else list(key)
    if mode not in ("first", "hash"):
        raise ValueError(f"unknown init mode {mode!r}")
    order = [*keys] if mode == "first" else [F.xxhash64(*keys, F.lit(seed)), *keys]
    rows = features.select(*keys, col).orderBy(*order).limit(kmax).collect()
    pts = np.array([r[col] for r in rows], dtype=np.float64)
    return {k: pts[:k].copy() for k in ks if k <= len(rows)}


# --- Lloyd iterations for many k at once ------------------------------------------

@dataclass
class SweepResult:
    centers: Centers
    wssse: dict[int, float]
    sizes: dict[int, np.ndarray]
    iterations: dict[int, int]
    converged: dict[int, bool]
    chosen: int | None = None
    skipped: list[int] = field(default_factory=list)   # k above the number of rows

    def frame(self, spark: SparkSession) -> DataFrame:
        rows = [(k, self.iterations[k], self.wssse[k], self.converged[k]) for k in sorted(self.wssse)]
        return spark.createDataFrame(rows, "k int, iterations int, wssse double, converged boolean")

    def centers_frame(self, spark: SparkSession) -> DataFrame:
        return centers_frame(spark, self.centers)


def centers_frame(spark: SparkSession, centers: Centers) -> DataFrame:
    """Driver-side centers -> ``(k, cluster, center array<double>)``."""
    rows = [(int(k), int(i), [float(v) for v in c[i]])
            for k, c in sorted(centers.items()) for i in range(c.shape[0])]
    return spark.createDataFrame(rows, "k int, cluster int, center array<double>")


def centers_from_frame(df: DataFrame) -> Centers:
    """``(k, cluster, center)`` -> driver-side centers (model-sized)."""
    by_k: dict[int, dict[int, list]] = {}
    for r in df.select("k", "cluster", "center").collect():
        by_k.setdefault(int(r["k"]), {})[int(r["cluster"])] = r["center"]
    return {k: np.array([v[i] for i in sorted(v)], dtype=np.float64) for k, v in by_k.items()}


def collect_stats(features: DataFrame, centers: Centers, col: str = "features",
                  grid: exact.Fixed | None = None) -> list[dict]:
    """Run one pass and return the merged stats (model-sized: one row per
    center) as dicts with ``k, cluster, n, cost, s``.  The broadcast of the
    centers is released right after."""
    if centers_bytes(centers) > MAX_CENTER_BYTES:
        return _dicts(cluster_stats(features, centers, col, None, grid))
    bc = _broadcast(features.sparkSession, centers)
    try:
        return _dicts(cluster_stats(features, centers, col, bc, grid))
    finally:
        bc.destroy()


def _dicts(stats: DataFrame) -> list[dict]:
    """Merged stats to the driver as Arrow, vectors as NumPy arrays; ordered, so
    that whatever is summed over them does not depend on the shuffle."""
    t = stats.select("k", "cluster", "n", "cost", "s").toArrow()
    rows = [{"k": k, "cluster": i, "n": n, "cost": cost, "s": np.asarray(s.values)}
            for k, i, n, cost, s in zip(*(t[x].to_pylist() for x in ("k", "cluster", "n", "cost")), t["s"])]
    return sorted(rows, key=lambda r: (r["k"], r["cluster"]))


def _wide_assign(features: DataFrame, k: int, c: np.ndarray, col: str, keep: Sequence[str] = ()) -> DataFrame:
    """``(*keep, col, cluster, d2)`` for one k whose centers exceed ``MAX_CENTER_BYTES``:
    the nearest center so far rides along with every row while the centers go by in
    parts, lowest cluster first, so that ties still go to the lowest id."""
    d = c.shape[1]
    per = max(1, MAX_CENTER_BYTES // (8 * d))
    src = features.select(*keep, col).withColumns({"cluster": F.lit(-1), "d2": F.lit(float("inf"))})

    def part(bc, first):
        def kernel(batches: Iterable[pa.RecordBatch]):
            cc = next(iter(bc.value.values()))
            for batch in batches:
                if batch.num_rows == 0:
                    continue
                x = _matrix(batch, col, d)
                idx, d2, _ = _nearest(x, np.einsum("ij,ij->i", x, x), cc)
                best, old = batch.column("d2").to_numpy(), batch.column("cluster").to_numpy()
                closer = d2 < best
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(name) for name in keep), batch.column(col),
                     pa.array(np.where(closer, idx + first, old).astype(np.int32)),
                     pa.array(np.where(closer, d2, best))], names=[*keep, col, "cluster", "d2"])
        return kernel

    for first in range(0, len(c), per):
        bc = _broadcast(features.sparkSession, {k: c[first:first + per]})
        src = src.mapInArrow(part(bc, first), src.schema)
    return src


def _wide_partial(features: DataFrame, k: int, c: np.ndarray, col: str, grid: exact.Fixed | None = None) -> DataFrame:
    """Rows of ``partial_stats`` for one k beyond the bound: one a feature row, merged
    by the aggregate that follows."""
    d = c.shape[1]

    def limbs(batches):
        for batch in batches:
            d2 = batch.column("d2").to_numpy()
            x = batch.column(col) if grid is None else _lists(
                grid.limbs(_matrix(batch, col, d)).ravel(), 3 * d, len(d2))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(d2), k, np.int32)), batch.column("cluster"), pa.array(np.ones(len(d2), np.int64)),
                 _lists(exact.cell_sums(d2, np.arange(len(d2)), len(d2)).ravel(), exact.WIDTH, len(d2)),
                 x], names=["k", "cluster", "n", "cost", "s"])
    return _wide_assign(features, k, c, col).mapInArrow(limbs, STATS_SCHEMA)


def _batches(ks: list[int], d: int) -> list[list[int]]:
    """Split k values so that each pass ships at most MAX_CENTER_BYTES."""
    out, cur, size = [], [], 0
    for k in ks:
        b = k * d * 8
        if cur and size + b > MAX_CENTER_BYTES:
            out.append(cur)
            cur, size = [], 0
        cur.append(k)
        size += b
    if cur:
        out.append(cur)
    return out


def grid_of(features: DataFrame, col: str = "features") -> exact.Fixed:
    """The grid of exact member sums: each column's largest absolute value (one
    vector aggregate, one row to the driver)."""
    from pyspark.ml.functions import array_to_vector
    from pyspark.ml.stat import Summarizer

    row = features.select(Summarizer.metrics("min", "max").summary(array_to_vector(col)).alias("s")).first().s
    return exact.Fixed.of(np.maximum(np.abs(row["min"].toArray()), np.abs(row["max"].toArray())))


def lloyd(features: DataFrame, init: Centers, *, max_iter: int, tol: float = DEFAULT_TOL,
          col: str = "features", prune: bool = True) -> SweepResult:
    """Lloyd's algorithm for every k in ``init`` together.  Each iteration is
    one pass over ``features`` for all still-moving k; a k stops when no
    center moves more than ``tol`` (Euclidean).  A final pass scores the
    final centers.  ``prune`` lets rows carry distance bounds from pass to pass; the
    result is the same without, bit for bit.  Centers of all k beyond
    ``MAX_CENTER_BYTES`` go by in groups, without bounds.  Cache ``features`` before
    calling."""
    grid = grid_of(features, col)
    if prune and centers_bytes(init) <= MAX_CENTER_BYTES:
        return _lloyd_pruned(features, init, max_iter, tol, col, grid)
    centers = {k: c.copy() for k, c in init.items()}
    d = next(iter(centers.values())).shape[1]
    iters = {k: 0 for k in centers}
    done = {k: False for k in centers}
    for _ in range(max_iter):
        active = [k for k in sorted(centers) if not done[k]]
        if not active:
            break
        for group in _batches(active, d):
            stats = collect_stats(features, {k: centers[k] for k in group}, col, grid)
            moved = {k: 0.0 for k in group}
            for k in group:
                mine = [r for r in stats if r["k"] == k]
                at = [r["cluster"] for r in mine]
                new = grid.mean(np.array([r["s"] for r in mine]), np.array([r["n"] for r in mine]))
                moved[k] = float(np.linalg.norm(new - centers[k][at], axis=1).max())
                centers[k][at] = new
                iters[k] += 1
                done[k] = moved[k] <= tol
    cost: dict[int, float] = {k: 0.0 for k in centers}
    sizes = {k: np.zeros(k, np.int64) for k in centers}
    for group in _batches(sorted(centers), d):
        some = {k: centers[k] for k in group}
        for r in collect_stats(features, some, col):
            sizes[int(r["k"])][int(r["cluster"])] = int(r["n"])
        for r in wssse(features, some, col).collect():
            cost[r["k"]] = r["wssse"]
    return SweepResult(centers, cost, sizes, iters, done)


# --- pruned passes -----------------------------------------------------------------

#: Rows of a block: a block's features and bounds are one row of the state.
BLOCK = 2048
#: The state is written to the shared folder after this many passes, so that a lost
#: executor repeats this many passes at most.
CUT = 16
#: Member sums that one task merges.
SUM_BYTES = 1 << 20
STATE_DDL = "kind int, n int, x binary, a binary, u binary, l binary, g int, m long, s array<double>"
_STATE = pa.schema([("kind", pa.int32()), ("n", pa.int32()), ("x", pa.binary()), ("a", pa.binary()),
                    ("u", pa.binary()), ("l", pa.binary()), ("g", pa.int32()), ("m", pa.int64()),
                    ("s", pa.list_(pa.float64()))])
#: Bounds are kept as single precision; this covers their rounding.
_SLACK = 1e-6


@dataclass(frozen=True)
class _Pass:
    """What a pass ships: all k's centers one below the other (``first[i]`` is the first
    of the i-th k), how far each moved since the rows last saw it, half the distance
    to its nearest neighbour, and which k to look at."""
    centers: np.ndarray
    first: np.ndarray
    moved: np.ndarray
    near: np.ndarray
    active: list[int]
    exponent: np.ndarray    # of the grid of the member sums
    cost: bool


def _state_rows(rows: int, **given) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [given[f.name] if f.name in given else pa.nulls(rows, f.type) for f in _STATE], schema=_STATE)


def _packed(col: str, d: int):
    """Feature rows -> blocks without bounds."""
    def run(batches):
        for batch in batches:
            x = _matrix(batch, col, d)
            parts = [x[i:i + BLOCK] for i in range(0, len(x), BLOCK)]
            if parts:
                yield _state_rows(len(parts), kind=pa.array(np.zeros(len(parts), np.int32)),
                                  n=pa.array([len(y) for y in parts], pa.int32()),
                                  x=pa.array([y.tobytes() for y in parts], pa.binary()))
    return run


def _looked_at(x: np.ndarray, a: np.ndarray, u: np.ndarray, l: np.ndarray, p: _Pass):
    """One block's clusters and bounds (rows, k) brought up to the pass's centers, in
    place; yields (k's number, rows that change, their old clusters)."""
    x2 = np.einsum("ij,ij->i", x, x)
    for i in p.active:
        low, high = p.first[i], p.first[i + 1]
        c, mine = p.centers[low:high], a[:, i]
        if mine[0] < 0:  # not seen yet
            rows = np.arange(len(x))
        else:
            move = p.moved[low:high]
            far = int(np.argmax(move))
            others = np.delete(move, far).max() if len(move) > 1 else 0.0
            upper = u[:, i] + move[mine]
            lower = l[:, i] - np.where(mine == far, others, move[far])
            meet = np.maximum(p.near[low:high][mine], lower)
            u[:, i], l[:, i] = upper * (1 + _SLACK), lower - np.abs(lower) * _SLACK
            rows = np.flatnonzero(~(upper * (1 + _SLACK) < meet * (1 - _SLACK)))
            if len(rows):
                diff = x[rows] - c[mine[rows]]
                upper = np.sqrt(np.einsum("ij,ij->i", diff, diff))
                u[rows, i] = upper * (1 + _SLACK)
                rows = rows[~(upper * (1 + _SLACK) < meet[rows] * (1 - _SLACK))]
        if not len(rows):
            continue
        idx, d2, second = _nearest(x[rows], x2[rows], c)
        u[rows, i] = np.sqrt(d2) * (1 + _SLACK)
        l[rows, i] = np.sqrt(second) * (1 - _SLACK)
        old = mine[rows].copy()
        a[rows, i] = idx
        turned = old != idx
        if turned.any():
            yield i, rows[turned], old[turned]


def _stepped(bc, d: int):
    """Blocks -> blocks with new clusters and bounds (kind 0), the changes of member
    counts and sums of each center of this task (1), and with ``cost`` the counts and
    squared distances of each center (2)."""
    def run(batches):
        p = _Pass(*bc.value)  # plain arrays: a broadcast is unpickled without this package
        grid = exact.Fixed(p.exponent)
        many, k = len(p.first) - 1, len(p.centers)
        count, sums = np.zeros(k, np.int64), np.zeros((k, 3 * d))
        size, cost = np.zeros(k, np.int64), np.zeros((k if p.cost else 0, exact.WIDTH))

        def change(center, limbs, sign):
            member = np.bincount(center, minlength=k)
            live = np.flatnonzero(member)
            order = np.argsort(center, kind="stable")
            starts = np.concatenate([[0], np.cumsum(member[live])[:-1]])
            sums[live] += sign * np.add.reduceat(limbs[order], starts, axis=0)
            count[live] += sign * member[live]

        for batch in batches:
            for n, raw, a, u, l in zip(*(batch.column(y).to_pylist() for y in ("n", "x", "a", "u", "l"))):
                x = np.frombuffer(raw, np.float64).reshape(n, d)
                if a is None:
                    a, u, l = np.full((n, many), -1, np.int32), np.zeros((n, many), np.float32), np.zeros((n, many), np.float32)
                else:
                    a, u, l = (np.frombuffer(y, kind).reshape(n, many).copy()
                               for y, kind in ((a, np.int32), (u, np.float32), (l, np.float32)))
                limbs = None
                for i, rows, old in _looked_at(x, a, u, l, p):
                    if limbs is None:
                        limbs = grid.limbs(x)
                    known = old >= 0
                    if known.any():
                        change(p.first[i] + old[known], limbs[rows[known]], -1)
                    change(p.first[i] + a[rows, i], limbs[rows], 1)
                if p.cost:
                    for i in range(many):
                        at = p.first[i] + a[:, i]
                        diff = x - p.centers[at]
                        low, high = p.first[i], p.first[i + 1]
                        cost[low:high] += exact.cell_sums(np.einsum("ij,ij->i", diff, diff), a[:, i].astype(np.int64), high - low)
                        size[low:high] += np.bincount(a[:, i], minlength=high - low)
                else:
                    yield _state_rows(1, kind=pa.array([0], pa.int32()), n=pa.array([n], pa.int32()),
                                      x=pa.array([raw], pa.binary()), **{name: pa.array([y.tobytes()], pa.binary())
                                                                         for name, y in (("a", a), ("u", u), ("l", l))})
        for kind, m, s in ((1, count, sums), (2, size, cost)):
            at = np.flatnonzero((m != 0) | (s != 0).any(axis=1)) if len(s) else []
            if len(at):
                yield _state_rows(len(at), kind=pa.array(np.full(len(at), kind, np.int32)), g=pa.array(at.astype(np.int32)),
                                  m=pa.array(m[at]), s=_lists(s[at].ravel(), s.shape[1], len(at)))
    return run


def _half_nearest(c: np.ndarray) -> np.ndarray:
    """Half the distance of each center to its nearest neighbour, rounded down."""
    if len(c) == 1:
        return np.full(1, np.inf)
    c2 = np.einsum("ij,ij->i", c, c)
    dist = c2[:, None] - 2.0 * (c @ c.T) + c2[None, :]
    np.fill_diagonal(dist, np.inf)
    return 0.5 * np.sqrt(np.maximum(dist.min(axis=1) - (c.shape[1] + 4) * 1e-15 * c2.max(), 0.0))


def _means(grid: exact.Fixed, wanted: np.ndarray):
    """Summed limbs of centers -> the means of those that have members and are ``wanted``."""
    exponent = grid.exponent

    def run(batches):
        for batch in batches:
            g, m = batch.column("g").to_numpy(), batch.column("m").to_numpy()
            take = np.flatnonzero(wanted[g] & (m > 0))
            if len(take):
                s = batch.column("s").flatten().to_numpy().reshape(len(g), -1)[take]
                mean = exact.Fixed(exponent).mean(s, m[take])
                yield pa.RecordBatch.from_arrays([pa.array(g[take]), _lists(mean.ravel(), mean.shape[1], len(take))],
                                                 names=["g", "mean"])
    return run


def _table_of(df: DataFrame, column: str) -> tuple[np.ndarray, np.ndarray, pa.Table]:
    """(centers, their vectors, the table) of model-sized rows, in the order of the centers."""
    t = df.toArrow().sort_by("g")
    g = t["g"].to_numpy()
    if not len(g):
        return g, np.zeros((0, 1)), t
    return g, pc.list_flatten(t[column].combine_chunks()).to_numpy().reshape(len(g), -1), t


def _lloyd_pruned(features: DataFrame, init: Centers, max_iter: int, tol: float, col: str,
                  grid: exact.Fixed) -> SweepResult:
    """``lloyd`` with bounds.  The state (blocks of rows with clusters and bounds) is
    cached from pass to pass, one generation at a time, and written to the shared
    folder every ``CUT`` passes.  The exact member sums of all centers, one row each, are
    written there in every pass: what a pass sends to the driver are the means of the centers that still move,
    however many tasks and rows there are."""
    from cellar.session import shared_path
    spark = features.sparkSession
    ks = sorted(init)
    d = init[ks[0]].shape[1]
    first = np.concatenate([[0], np.cumsum([len(init[k]) for k in ks])])
    centers = np.concatenate([init[k] for k in ks]).astype(np.float64)
    near = np.concatenate([_half_nearest(init[k]) for k in ks])
    moved = np.zeros(len(centers))
    iters, done = {k: 0 for k in ks}, {k: False for k in ks}
    state = features.select(col).mapInArrow(_packed(col, d), STATE_DDL)
    cached, totals, sent = None, None, []
    tasks = 1 + len(centers) * 3 * d * 8 // SUM_BYTES

    def step(active, cost):
        sent.append(spark.sparkContext.broadcast((centers, first, moved, near, active, grid.exponent, cost)))
        return state.where("kind = 0").mapInArrow(_stepped(sent[-1], d), STATE_DDL)

    try:
        for turn in range(max_iter):
            active = [i for i, k in enumerate(ks) if not done[k]]
            if not active:
                break
            state = step(active, False).persist(StorageLevel.MEMORY_AND_DISK)
            changes = state.where("kind = 1").select("g", "m", "s")
            merged = _sum_arrays(changes if totals is None else totals.unionAll(changes), ["g"], ["s"], ["m"], tasks)
            path = shared_path(spark, "kmeans", f"sums-{uuid.uuid4().hex}")
            merged.write.parquet(path)
            totals = spark.read.schema(merged.schema).parquet(path)
            wanted = np.zeros(len(centers), bool)
            for i in active:
                wanted[first[i]:first[i + 1]] = True
            at, means, _ = _table_of(totals.mapInArrow(_means(grid, wanted), "g int, mean array<double>"), "mean")
            if cached is not None:
                cached.unpersist()
            cached = state
            for i in active:
                span = slice(first[i], first[i + 1])
                mine = slice(*np.searchsorted(at, first[i:i + 2]))
                live, new = at[mine], means[mine]
                moved[span] = 0.0
                moved[live] = np.linalg.norm(new - centers[live], axis=1) * (1 + 1e-12)
                largest = float(np.linalg.norm(new - centers[live], axis=1).max())
                centers[live] = new
                near[span] = _half_nearest(centers[span])
                iters[ks[i]] += 1
                done[ks[i]] = largest <= tol
            if turn % CUT == CUT - 1:
                path = shared_path(spark, "kmeans", f"state-{uuid.uuid4().hex}")
                state.where("kind = 0").write.parquet(path)
                cached.unpersist()
                cached, state = None, spark.read.schema(STATE_DDL).parquet(path)
                while sent:
                    sent.pop().destroy()
        ends = step(list(range(len(ks))), True).where("kind = 2").select("g", "m", "s")
        g, s, t = _table_of(_sum_arrays(ends, ["g"], ["s"], ["m"]), "s")
    finally:
        if cached is not None:
            cached.unpersist()
        for bc in sent:
            bc.destroy()
    size, cost = np.zeros(len(centers), np.int64), np.zeros((len(centers), exact.WIDTH))
    size[g], cost[g] = t["m"].to_numpy(), s
    parts = [(k, slice(first[i], first[i + 1])) for i, k in enumerate(ks)]
    return SweepResult({k: centers[p].copy() for k, p in parts}, {k: exact.cell_total(cost[p].sum(axis=0)) for k, p in parts},
                       {k: size[p].copy() for k, p in parts}, iters, done)


# --- model choice -------------------------------------------------------------------

Chooser = Callable[[tuple[int, float], tuple[int, float]], float]

# --- fixed values: (k, wssse) of the best model so far, then of the candidate ->
# gain of the candidate
CHOOSERS: dict[str, Chooser] = {
    "wssse": lambda best, cur: best[1] - cur[1],
    "wssse_k_weighted": lambda best, cur: best[1] / cur[0] - cur[1] / best[0],
    "wssse_per_k": lambda best, cur: best[1] / best[0] - cur[1] / cur[0],
}


def choose_k(scores: Sequence[tuple[int, float]], chooser: str | Chooser = "wssse",
             threshold: float = SWITCH_THRESHOLD) -> int | None:
    """Scan k upward; the candidate replaces the best when its gain is above
    ``threshold``.  The first model is always taken; no models -> None."""
    fn = CHOOSERS[chooser] if isinstance(chooser, str) else chooser
    best = None
    for k, w in sorted(scores):
        if best is None or fn(best, (k, w)) > threshold:
            best = (k, w)
    return None if best is None else best[0]


def choose_k_frame(scores: DataFrame, threshold: float = SWITCH_THRESHOLD) -> DataFrame:
    """The default choice as a Spark expression over a ``(k, wssse)`` frame:
    an ordered fold over the (k-range-sized) list of scores."""
    ordered = F.array_sort(F.collect_list(F.struct(F.col("k").alias("k"),
                                                   F.col("wssse").alias("wssse"))))
    start = F.struct(F.lit(None).cast("int").alias("k"), F.lit(None).cast("double").alias("wssse"))
    best = F.aggregate(ordered, start,
                       lambda acc, x: F.when(acc["k"].isNull() |
                                             ((acc["wssse"] - x["wssse"]) > threshold), x)
                       .otherwise(acc))
    return scores.agg(best.alias("best")).select(F.col("best.k").alias("k"),
                                                 F.col("best.wssse").alias("wssse"))


def cache_for_passes(features: DataFrame, col: str = "features",
                     durable: bool = False) -> DataFrame:
    """Cache feature rows for iterative passes, in the partitions they come in.
    Cached blocks are recomputed from lineage if an executor is lost; ``durable``
    first writes the rows to the session's shared checkpoint folder, so a
    lost block is re-read from there instead of recomputed."""
    if durable:
        from cellar.session import checkpoint_dir
        checkpoint_dir(features.sparkSession)
        features = features.checkpoint(eager=True)
    return features.persist(StorageLevel.MEMORY_AND_DISK)


def _with_data(chooser) -> bool:
    """Whether a chooser compares models with the data: the name of an index, or a
    callable of three arguments (features, best, candidate)."""
    from cellar.operators import choice
    if isinstance(chooser, str):
        return chooser in choice.INDICES
    return isinstance(chooser, choice.Index) or len(inspect.signature(chooser).parameters) == 3


def sweep(features: DataFrame, k_min: int = DEFAULT_K_RANGE[0], k_max: int = DEFAULT_K_RANGE[1],
          *, max_iter: int = DEFAULT_SWEEP_ITERATIONS, tol: float = DEFAULT_TOL,
          init_mode: str = "hash", key: str | Sequence[str] = "row_num", seed: int = DEFAULT_SEED,
          chooser: str | Chooser = "wssse", threshold: float = SWITCH_THRESHOLD,
          col: str = "features", method: str = "lloyd", durable: bool = False) -> SweepResult:
    """Train k = k_min..k_max and pick one model.  ``method="lloyd"`` shares
    every scan among all k (start: ``init_mode`` seeded "hash" order or "first"
    rows by key); ``method="ml"`` runs ``pyspark.ml`` K-Means (k-means|| start)
    once per k.  Every k above the number of rows is skipped and listed in
    ``skipped``.  No k left -> ``chosen is None``.  ``chooser``: a rule over (k, cost)
    (``CHOOSERS`` or a callable of two), or a comparator that gets the cached rows and
    both models (``choice.INDICES`` or a callable of three)."""
    ks = list(range(int(k_min), int(k_max) + 1))
    if not ks:
        return SweepResult({}, {}, {}, {}, {}, None)
    keys = [key] if isinstance(key, str) else list(key)
    cached = cache_for_passes(features.select(*keys, col), col, durable)
    try:
        if method == "lloyd":
            init = init_centers(cached, ks, mode=init_mode, key=key, seed=seed, col=col)
            result = lloyd(cached, init, max_iter=max_iter, tol=tol, col=col) if init \
                else SweepResult({}, {}, {}, {}, {})
        elif method == "ml":
            n = cached.select(col).limit(ks[-1]).count()
            result = _ml_sweep(cached, [k for k in ks if k <= n], max_iter=max_iter, tol=tol, seed=seed,
                               col=col)
        else:
            raise ValueError(f"unknown method {method!r}")
        result.skipped = [k for k in ks if k not in result.centers]
        if _with_data(chooser):
            from cellar.operators import choice
            rows = cached if col == "features" else cached.withColumnRenamed(col, "features")
            best = choice.choose_model(rows, choice.models_of(result), chooser, threshold)
            result.chosen = None if best is None else best.k
        else:
            result.chosen = choose_k(list(result.wssse.items()), chooser, threshold)
    finally:
        cached.unpersist()
    return result


# --- pyspark.ml trainer -------------------------------------------------------------

def ml_kmeans(features: DataFrame, k: int = DEFAULT_TRAIN_K,
              max_iter: int = DEFAULT_TRAIN_ITERATIONS, *, seed: int = DEFAULT_SEED,
              init_mode: str = "k-means||", init_steps: int = DEFAULT_INIT_STEPS,
              tol: float = DEFAULT_TOL, col: str = "features"):
    """Train ``pyspark.ml.clustering.KMeans`` on an array<double> column."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    vec = features.select(array_to_vector(col).alias("_vec"))
    km = KMeans(k=k, maxIter=max_iter, seed=seed, initMode=init_mode, initSteps=init_steps,
                tol=tol, featuresCol="_vec", predictionCol="_cluster")
    return km.fit(vec)


def _ml_sweep(features: DataFrame, ks: list[int], *, max_iter: int, tol: float, seed: int,
              col: str) -> SweepResult:
    centers, cost, sizes, iters, conv = {}, {}, {}, {}, {}
    for k in ks:
        model = ml_kmeans(features, k, max_iter, seed=seed, tol=tol, col=col)
        centers[k] = np.array([np.asarray(c, dtype=np.float64) for c in model.clusterCenters()])
        cost[k] = float(model.summary.trainingCost)
        sizes[k] = np.array(model.summary.clusterSizes, dtype=np.int64)
        iters[k] = int(model.summary.numIter)
        conv[k] = iters[k] < max_iter
    return SweepResult(centers, cost, sizes, iters, conv)
