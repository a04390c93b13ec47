import math
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from cellar.llm import maxent as mx


def _rows(rng):
    follow = {"a": "b", "b": "c", "c": "a"}
    rows = []
    for i in range(200):
        w, x = [], "a"
        for _ in range(30):
            w.append(x)
            x = follow[x] if rng.random() < 0.9 else str(rng.choice(list("abcxyz")))
            x = x if x in follow else "a"
        rows.append((i, " ".join(w)))
    return rows + [(300, None), (301, ""), (302, "never seen words " + "q" * 30_000), (303, "A b C"), (303, "A b C"), (None, "a b")]


def test_counts_base_and_model(spark, docs_of):
    rows = _rows(np.random.default_rng(0))
    got = mx.score_documents(docs_of(rows), mx.fifth_fold(), head_words=2).collect()  # nearly all words by the join
    fold = lambda d: zlib.crc32(("" if d is None else str(d)).encode()) % 5 == 1
    tokens = lambda t: (t or "").encode().lower().split() + [None]
    counts = Counter(x for d, t in rows if not fold(d) for x in tokens(t))
    n, v = sum(counts.values()), len(counts)
    want = sorted([(d, fold(d), len(tokens(t)), sum(counts[x] > 0 for x in tokens(t)), n) for d, t in rows], key=str)
    assert sorted([(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens) for r in got], key=str) == want
    base = {d: sum(math.log10((counts[x] + 0.5) / (n + 0.5 * (v + 1))) for x in tokens(t)) for d, t in rows}
    for r in got:
        assert abs(r.base_score - base[r.doc_id]) < 1e-6 * abs(base[r.doc_id])
        assert r.score < 0 and math.isfinite(r.score)
    held = [r for r in got if r.held_out and (r.doc_id or 0) < 200]
    assert sum(r.score for r in held) > sum(r.base_score for r in held) + 0.1 * sum(r.n_tokens for r in held)


def test_distribution_sums_to_one(spark, docs_of):
    """Over all words of a training vocabulary and one unseen word a cell."""
    rng = np.random.default_rng(1)
    model = {"b1": np.log(rng.dirichlet(np.ones(16))).astype(np.float32), "b2": np.log(rng.dirichlet(np.ones(16), 16)).astype(np.float32),
             "w1": rng.normal(size=(1 << mx.ROWS_1, 16)).astype(np.float32), "w2": rng.normal(size=(1 << mx.ROWS_2, 16)).astype(np.float32)}
    total = 0.0
    hist = np.array([11, 22], np.uint64)
    for c1 in range(16):
        for c2 in range(16):
            tok = np.append(hist, np.uint64((c1 << 60) | (c2 << 56) | 7))
            p1, p2, *_ = mx.forward(model, tok, np.zeros(3, np.int64))
            total += float(p1[2, c1]) * float(p2[2, c2])
    assert abs(total - 1) < 1e-4


def test_updates_follow_the_gradient(spark, docs_of):
    """Each update raises the training likelihood."""
    rows = _rows(np.random.default_rng(3))
    score = [mx.score_documents(docs_of(rows), F.lit(False), updates=u).agg(F.sum("score")).first()[0] for u in (0, 1, 3)]
    assert score[0] < score[1] < score[2]


def test_empty_table(spark, docs_of):
    assert mx.score_documents(docs_of([]), mx.fifth_fold()).count() == 0
    assert mx.score_documents(docs_of([(1, "a b")]), F.lit(True)).first().n_known == 0


def test_rows_are_copied_whole():
    """Sums and softmaxes are those of indexed rows, in less time than indexing takes (before: the same)."""
    import time
    rng = np.random.default_rng(7)
    rows = [rng.integers(0, 1 << 14, 80_000).astype(np.uint16) for _ in range(3)]
    p, bias = rng.random((80_000, 16), np.float32), np.zeros(16, np.float32)
    weights = rng.normal(size=(1 << 14, 16)).astype(np.float32)

    def indexed(total, r, values):
        order = np.argsort(r, kind="stable")
        s = r[order]
        first = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]]))
        total[s[first]] += np.add.reduceat(values[order], first, axis=0)

    def seconds(add):
        total, spent = np.zeros((1 << 14, 16)), []
        for _ in range(9):
            began = time.process_time()
            add(total, rows[0], p)
            spent.append(time.process_time() - began)
        return min(spent), total

    (old, want), (new, got) = seconds(indexed), seconds(mx._add)
    assert (got == want).all() and new < 0.85 * old
    z = np.exp(weights[rows[0]] + weights[rows[1]] + weights[rows[2]] + bias)
    assert np.allclose(mx.softmax(bias, weights, rows), z / z.sum(1, keepdims=True), rtol=1e-4)
