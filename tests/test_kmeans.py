"""K-Means: assignment is the argmin, Lloyd never raises the cost, the
multi-k pass equals one run per k, and the model choice rule."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cellar.operators import kmeans as km
from paths import SF_SMALL


@pytest.fixture(scope="module")
def emb(spark):
    df = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").select(
        F.col("vec_id").alias("row_num"),
        F.transform("embedding", lambda x: x.cast("double")).alias("features"))
    return df.cache()


@pytest.fixture(scope="module")
def points(emb):
    rows = sorted(emb.collect(), key=lambda r: r["row_num"])
    return np.array([r["features"] for r in rows]), [r["row_num"] for r in rows]


def test_assign_is_argmin(emb, points):
    x, keys = points
    centers = {3: x[[5, 17, 40]], 5: x[[1, 2, 3, 4, 9]]}
    got = {(r["row_num"], r["k"]): (r["cluster"], r["d2"])
           for r in km.assign(emb, centers).collect()}
    for k, c in centers.items():
        d2 = ((x[:, None, :] - c[None, :, :]) ** 2).sum(-1)
        for i, key in enumerate(keys):
            cl, dist = got[(key, k)]
            assert cl == int(np.argmin(d2[i]))
            assert dist == pytest.approx(d2[i].min(), rel=1e-9, abs=1e-12)


def brute_lloyd(x, k, iters):
    c = x[:k].copy()
    for _ in range(iters):
        a = ((x[:, None, :] - c[None]) ** 2).sum(-1).argmin(1)
        for j in range(k):
            if (a == j).any():
                c[j] = x[a == j].mean(0)
    cost = ((x[:, None, :] - c[None]) ** 2).sum(-1).min(1).sum()
    return c, cost


def test_lloyd_matches_brute_force(emb, points):
    x, _ = points
    init = km.init_centers(emb, [2, 3, 6], mode="first")
    res = km.lloyd(emb, init, max_iter=4, tol=-1.0)
    for k in (2, 3, 6):
        c, cost = brute_lloyd(x, k, 4)
        assert np.allclose(res.centers[k], c, atol=1e-9)
        assert res.wssse[k] == pytest.approx(cost, rel=1e-9)
        assert res.sizes[k].sum() == len(x)


def test_cost_never_rises(emb):
    init = km.init_centers(emb, [4], mode="hash", seed=7)
    costs = []
    for it in range(1, 6):
        costs.append(km.lloyd(emb, init, max_iter=it, tol=-1.0).wssse[4])
    assert all(b <= a + 1e-9 for a, b in zip(costs, costs[1:]))


def test_multi_k_equals_single_k(emb):
    init = km.init_centers(emb, [2, 3, 4], mode="hash", seed=3)
    together = km.lloyd(emb, init, max_iter=3)
    for k in (2, 3, 4):
        alone = km.lloyd(emb, {k: init[k]}, max_iter=3)
        assert np.allclose(alone.centers[k], together.centers[k])
        assert alone.wssse[k] == pytest.approx(together.wssse[k])


def test_batches_respect_limit(monkeypatch):
    monkeypatch.setattr(km, "MAX_CENTER_BYTES", 64 * 8 * 10)
    groups = km._batches([2, 3, 4, 5, 6], 64)
    assert [k for g in groups for k in g] == [2, 3, 4, 5, 6]
    assert all(sum(g) <= 10 or len(g) == 1 for g in groups)


def test_choose_k_threshold(spark):
    assert km.choose_k([(2, 10.0), (3, 9.9995)]) == 2        # gain 0.0005: stay
    assert km.choose_k([(2, 10.0), (3, 9.5)]) == 3           # gain 0.5: switch
    assert km.choose_k([]) is None
    scores = [(2, 10.0), (3, 9.9995), (4, 9.0), (5, 8.9999)]
    assert km.choose_k(scores) == 4
    frame = spark.createDataFrame(scores, "k int, wssse double")
    assert km.choose_k_frame(frame).collect()[0]["k"] == 4
    # 10/2 - 9.9995/3 and 9.0/4 - 8.9999/5 are gains per k at every step
    assert km.choose_k(scores, "wssse_per_k") == 5
    # 10/3 - 9.9995/2 < 0, 10/4 - 9/2 < 0, 10/5 - 8.9999/2 < 0: the first stays
    assert km.choose_k(scores, "wssse_k_weighted") == 2
    assert km.choose_k([(2, 10.0), (3, 6.0)], "wssse_k_weighted") == 3      # 10/3 - 6/2
    assert km.choose_k(scores, lambda best, cur: 1.0) == 5


def test_sweep_and_ml(emb):
    res = km.sweep(emb, 2, 4, max_iter=5, init_mode="hash")
    assert sorted(res.wssse) == [2, 3, 4] and res.chosen in (2, 3, 4)
    assert km.sweep(emb, 5, 4).chosen is None
    model = km.ml_kmeans(emb, 3, 5)
    assert len(model.clusterCenters()) == 3
    ml = km.sweep(emb, 2, 3, max_iter=5, method="ml")
    assert sorted(ml.wssse) == [2, 3] and ml.chosen in (2, 3)
    assert ml.centers[3].shape == (3, 64) and ml.sizes[3].sum() == emb.count()


def test_centers_of_one_k_in_several_passes(emb, monkeypatch):
    init = km.init_centers(emb, [2, 7], mode="hash", seed=11)
    one = {(r["k"], r["cluster"]): r for r in km.collect_stats(emb, init)}
    monkeypatch.setattr(km, "MAX_CENTER_BYTES", 64 * 8 * 3)      # three centers a pass
    parts = {(r["k"], r["cluster"]): r for r in km.collect_stats(emb, init)}
    assert one.keys() == parts.keys()
    for key in one:
        assert one[key]["n"] == parts[key]["n"]
        assert one[key]["cost"] == pytest.approx(parts[key]["cost"])
        assert np.allclose(one[key]["s"], parts[key]["s"])


def test_fewer_rows_than_k(spark):
    few = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(3)], "row_num bigint, features array<double>")
    res = km.sweep(few, 2, 6, max_iter=3)
    assert sorted(res.wssse) == [2, 3] and res.skipped == [4, 5, 6]
    ml = km.sweep(few, 2, 6, max_iter=3, method="ml")
    assert sorted(ml.wssse) == [2, 3] and ml.skipped == [4, 5, 6]
    none = km.sweep(few.limit(0), 2, 4)
    assert none.chosen is None and none.skipped == [2, 3, 4]


def test_durable_sweep_equals_cached(emb):
    a = km.sweep(emb, 2, 3, max_iter=3, init_mode="first")
    b = km.sweep(emb, 2, 3, max_iter=3, init_mode="first", durable=True)
    assert a.chosen == b.chosen
    assert a.wssse == pytest.approx(b.wssse)


def test_a_pass_sends_the_driver_means_alone(emb, monkeypatch):
    """Member sums stay with the tasks: a pass sends one mean a center that still moves,
    however many tasks there are, and the result is that of passes without bounds, also
    across states that are written."""
    sent = []
    table_of = km._table_of

    def note(df, column):
        out = table_of(df, column)
        sent.append((column, out[1].shape))
        return out

    monkeypatch.setattr(km, "_table_of", note)
    monkeypatch.setattr(km, "CUT", 2)
    rows = emb.repartition(6)
    init = km.init_centers(rows, [2, 5])
    pruned = km.lloyd(rows, init, max_iter=5, tol=-1.0)
    d = init[2].shape[1]
    assert [s for c, s in sent if c == "mean"] == [(7, d)] * 5 and len(sent) == 6
    plain = km.lloyd(rows, init, max_iter=5, tol=-1.0, prune=False)
    for k in init:
        assert np.array_equal(pruned.centers[k], plain.centers[k]) and np.array_equal(pruned.sizes[k], plain.sizes[k])
    assert pruned.wssse == plain.wssse
