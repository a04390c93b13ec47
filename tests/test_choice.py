"""Exact sums, pruned passes and model choice with the data."""

import math
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from cellar.operators import choice as ch
from cellar.operators import exact
from cellar.operators import kmeans as km
from paths import SF_SMALL


@pytest.fixture(scope="module")
def emb(spark):
    return spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").select(
        F.col("vec_id").alias("row_num"), F.col("embedding").cast("array<double>").alias("features")).cache()


def test_cell_sums_are_the_rounded_exact_sums():
    rng = np.random.default_rng(1)
    values = np.concatenate([rng.random(500) * 10.0 ** rng.integers(-300, 300, 500), [0.0, 5e-324, 1e-310, 1.0, 2.0 ** 1000]])
    group = rng.integers(0, 4, len(values))
    limbs = exact.cell_sums(values, group, 4)
    for g in range(4):
        assert exact.cell_total(limbs[g]) == float(sum(Fraction(v) for v in values[group == g]))
    halves = exact.cell_sums(values[:250], group[:250], 4) + exact.cell_sums(values[250:], group[250:], 4)
    assert (halves == limbs).all()
    assert math.isnan(exact.cell_total(exact.cell_sums(np.array([1.0, np.nan]), np.zeros(2, int), 1)[0]))


def test_fixed_means_do_not_depend_on_the_order():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(1000, 5)) * [1e-8, 1, 1e6, 0, -3]
    grid = exact.Fixed.of(np.abs(x).max(0))
    a = grid.mean(grid.limbs(x).sum(0)[None], [1000])
    parts = [grid.limbs(y).sum(0) for y in np.array_split(x[rng.permutation(1000)], 13)]
    assert (grid.mean(np.sum(parts, 0)[None], [1000]) == a).all()
    assert np.allclose(a[0], x.mean(0), rtol=1e-12, atol=1e-22)


@pytest.mark.parametrize("parts", [7, 64])
def test_bit_equal_over_partitions(emb, parts):
    init = km.init_centers(emb, [2, 5, 9], mode="first")
    one, many = (km.lloyd(emb.repartition(n), init, max_iter=6, tol=-1.0) for n in (1, parts))
    for k in init:
        assert (one.centers[k] == many.centers[k]).all() and one.wssse[k] == many.wssse[k]
    cost = [km.wssse(emb.repartition(n), one.centers).orderBy("k").collect() for n in (1, parts)]
    assert cost[0] == cost[1] and [r["wssse"] for r in cost[0]] == [one.wssse[k] for k in (2, 5, 9)]
    spread = [sorted(map(tuple, ch.cluster_spread(emb.repartition(n), one.centers).collect())) for n in (1, parts)]
    assert spread[0] == spread[1]


@pytest.mark.parametrize("limit", [km.MAX_CENTER_BYTES, 64 * 8 * 12])
def test_pruned_equals_plain(emb, monkeypatch, limit):
    """With all rows' bounds, with the state written every 2 passes, and in groups of k."""
    init = km.init_centers(emb, range(1, 10), mode="hash", seed=4)
    plain = km.lloyd(emb, init, max_iter=30, prune=False)
    monkeypatch.setattr(km, "CUT", 2)
    monkeypatch.setattr(km, "BLOCK", 17)
    monkeypatch.setattr(km, "MAX_CENTER_BYTES", limit)
    pruned = km.lloyd(emb.repartition(3), init, max_iter=30)
    assert plain.iterations == pruned.iterations and plain.converged == pruned.converged and plain.wssse == pruned.wssse
    for k in init:
        assert (plain.centers[k] == pruned.centers[k]).all() and (plain.sizes[k] == pruned.sizes[k]).all()


def test_ties_and_repeated_rows(spark):
    rows = [(i, [float(i % 4), 1.0]) for i in range(40)]
    df = spark.createDataFrame(rows, "row_num bigint, features array<double>")
    centers = {3: np.array([[0.0, 1.0], [2.0, 1.0], [2.0, 1.0]])}
    got = {r["row_num"] % 4: r["cluster"] for r in km.assign(df, centers).collect()}
    assert got == {0: 0, 1: 0, 2: 1, 3: 1}
    for prune in (True, False):
        # an empty cluster keeps its center, and gets the rows at 2 when the other has moved on to 2.5
        assert km.lloyd(df, centers, max_iter=1, prune=prune).centers[3][2].tolist() == [2.0, 1.0]
        res = km.lloyd(df, centers, max_iter=5, prune=prune)
        assert res.sizes[3].tolist() == [20, 10, 10] and res.centers[3].tolist() == [[0.5, 1.0], [3.0, 1.0], [2.0, 1.0]]


def test_any_number_of_centers(emb, monkeypatch):
    init = km.init_centers(emb, [2, 7, 30], mode="hash", seed=11)
    whole = sorted(map(tuple, km.assign(emb, init).collect())), km.wssse(emb, init).orderBy("k").collect()
    monkeypatch.setattr(km, "MAX_CENTER_BYTES", 64 * 8 * 8)
    assert sorted(map(tuple, km.assign(emb, init).collect())) == whole[0]
    assert km.wssse(emb, init).orderBy("k").collect() == whole[1]


def test_indices_against_brute_force(emb):
    x = np.array([r["features"] for r in emb.collect()])
    res = km.sweep(emb, 2, 6, max_iter=3, chooser="silhouette")
    values = ch.index_values(emb, ch.models_of(res))
    for k, c in res.centers.items():
        dist = np.sqrt(((x[:, None] - c[None]) ** 2).sum(-1))
        own = dist.argmin(1)
        a, b = np.sort(dist, 1)[:, 0], np.sort(dist, 1)[:, 1]
        assert values[k]["silhouette"] == pytest.approx(np.mean(1 - a / b))
        live = [i for i in range(k) if (own == i).any()]
        s = {i: a[own == i].mean() for i in live}
        db = np.mean([max((s[i] + s[j]) / np.linalg.norm(c[i] - c[j]) for j in live if j != i) for i in live])
        assert values[k]["davies_bouldin"] == pytest.approx(db)
    fold, best = None, None
    for k in sorted(values):
        if best is None or values[k]["silhouette"] - best > km.SWITCH_THRESHOLD:
            fold, best = k, values[k]["silhouette"]
    assert res.chosen == fold


def test_comparator_sees_rows_and_models(emb):
    seen = []

    def compare(features, best, candidate):
        seen.append((best.k, candidate.k, features.count(), candidate.centers.shape, int(candidate.sizes.sum())))
        return 1.0 if candidate.k == 3 else 0.0

    n = emb.count()
    assert km.sweep(emb, 2, 4, max_iter=2, chooser=compare).chosen == 3
    assert seen == [(2, 3, n, (3, 64), n), (3, 4, n, (4, 64), n)]
    one = [ch.Model(1, np.zeros((1, 64)), 1.0, np.array([n]))]
    assert ch.choose_model(emb, one, "silhouette").k == 1 and ch.choose_model(emb, [], "silhouette") is None
