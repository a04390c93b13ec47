import re
from collections import Counter

import numpy as np

from cellar.llm import quality as q


def brute(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    win = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    n, cov = Counter(win), set()
    for i, x in enumerate(win):
        if n[x] > 1:
            cov.update(range(i, i + 5))
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(cov)


def _prose(rng, n=60):
    return " ".join("".join(rng.choice(list("etaoinshrdlu"), rng.integers(2, 8))) for _ in range(n)).capitalize() + "."


def test_counts_and_outliers(spark):
    rng = np.random.default_rng(3)
    rows = [(i, _prose(rng), "en", "a") for i in range(200)]
    junk = {500 + i: " ".join(x + "$$$" for x in _prose(rng).split()) for i in range(12)}
    rows += [(d, t, "en", "a") for d, t in junk.items()]
    odd = [(900, None), (901, ""), (902, " \n\t"), (903, "x" * 100_000), (904, "a b c d e f g h i j " * 3_000),
           (905, "one line here of ten words and a few more words\n" * 3), (None, _prose(rng))]
    rows += [(d, t, None, None) for d, t in odd] + [(0, rows[0][1], "en", "a")]
    df = spark.createDataFrame([(*r, 7, 1.0) for r in rows],
                               "doc_id long, text string, lang string, source string, n_words int, kept double")
    got = q.quality(df).collect()
    assert len(got) == len(rows)
    texts = {d: t for d, t, _, _ in rows}
    for r in got:
        want = brute(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0])
        assert not (r.kept and r.base_failed)
    kept = {r.doc_id for r in got if r.kept}
    assert not kept & set(junk)
    assert len(kept & set(range(200))) >= 195
    assert None in kept  # judged by the estimate over everything, its group being too small
    assert all(r.base_failed or r.distance is not None for r in got)
    assert q.quality(df.limit(0)).count() == 0


def test_estimate_matches_plain_mcd_steps():
    """Centre and inverse from the sums are those of the subset."""
    import pyarrow as pa
    rng = np.random.default_rng(0)
    v = rng.integers(0, 2000, (50, q.P))
    pairs = [(i, j) for i in range(q.P) for j in range(i, q.P)]
    batch = pa.RecordBatch.from_pydict({
        "grp": ["g"], "start": pa.array([1], pa.int32()), "n": [50], "s": [v.sum(0).tolist()], "q": [[int((v[:, i] * v[:, j]).sum()) for i, j in pairs]]})
    out = next(q._estimate(1.5)([batch]))
    np.testing.assert_allclose(out["centre"][0].as_py(), v.mean(0))
    cov = 1.5 * np.cov(v.T, bias=True) + np.diag(q.FLOORS ** 2)
    want = np.linalg.inv(cov)
    assert abs(out["log_det"][0].as_py() - np.linalg.slogdet(cov)[1]) < 1e-9
    np.testing.assert_allclose(np.array(out["inverse"][0].as_py()).reshape(q.P, q.P), want, rtol=1e-6, atol=1e-12)


def test_small_groups_are_judged(spark):
    """Junk of a new small source, and of a small new language, goes as it does in a large source."""
    rng = np.random.default_rng(4)
    junk = [" ".join(x + "$$$" for x in _prose(rng).split()) for _ in range(10)]
    rows = [(i, _prose(rng), "en", "a") for i in range(200)]
    rows += [(300 + i, t, "en", "new") for i, t in enumerate(junk)] + [(400 + i, t, "xx", None) for i, t in enumerate(junk)]
    rows += [(500 + i, _prose(rng), "en", "few") for i in range(5)] + [(600 + i, _prose(rng), "yy", "few") for i in range(5)]
    got = {r.doc_id: r for r in q.quality(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert len(got) == len(rows)
    assert not any(r.kept for d, r in got.items() if 300 <= d < 500)
    assert all(r.kept for d, r in got.items() if d >= 500)


def _brute_mcd(v, usual):
    """The three starts, five concentration steps each, the smallest determinant."""
    v, floors, best = v.astype(float), np.diag(q.FLOORS ** 2), None
    centre = np.sqrt(usual) * q.UNIT
    spread = 1.2533 * np.abs(v - np.round(centre)).sum(0) / len(v)
    starts = [(centre, floors), (centre, np.diag(np.maximum(q.FLOORS, spread) ** 2)), (v.mean(0), np.cov(v.T, bias=True) + floors)]
    for m, cov in starts:
        for _ in range(q.STEPS):
            d = np.einsum("ni,ij,nj->n", v - m, np.linalg.inv(cov), v - m)
            b = np.floor(np.log2(d + 1e-6) * q.BINS)
            near = v[b <= np.sort(b)[int(np.ceil(q.SUBSET * len(v))) - 1]]
            m, cov = near.mean(0), np.cov(near.T, bias=True) * q.CONSISTENCY + floors
        det = np.linalg.slogdet(cov)[1]
        if best is None or det < best[0] - 1e-12:
            best = (det, np.einsum("ni,ij,nj->n", v - m, np.linalg.inv(cov), v - m))
    return best[1]


def test_verdicts_against_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    stats = q.measure(docs).withColumns({"lang": q.F.lit("all"), "source": q.F.lit("one")})
    got = [r for r in q.judge(stats).collect() if not r.base_failed]
    rates = np.array([[np.round(q.UNIT * r[x] / r[n]) for x, n, _ in q.RATES.values()] for r in got])
    usual = np.sort(rates, axis=0)[int(np.ceil(0.5 * len(got))) - 1] / q.UNIT
    v = np.array([[np.round(q.UNIT * np.sqrt((r[x] + q.PRIOR * usual[i]) / (r[n] + q.PRIOR)))
                   for i, (x, n, _) in enumerate(q.RATES.values())] for r in got])
    want = _brute_mcd(v, usual)
    np.testing.assert_allclose([r.distance for r in got], want, rtol=1e-6, atol=1e-6)
    assert [r.kept for r in got] == list(want <= q.CUTOFF) and not all(r.kept for r in got)
