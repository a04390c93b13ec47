import numpy as np
import pytest

from cellar.llm import suffix_dedup as sd


def brute(rows):
    seen, out = set(), []
    done = {}
    for doc, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        raw = (text or "").encode()
        if (doc, text) in done:
            out.append(done[doc, text])
            continue
        cov = np.zeros(len(raw), bool)
        for s in range(len(raw) - 99):
            w = raw[s:s + 100]
            if w in seen:
                cov[s:s + 100] = True
            seen.add(w)
        spans = int((cov & ~np.concatenate([[False], cov[:-1]])).sum()) if len(cov) else 0
        done[doc, text] = (doc, len(raw), int(cov.sum()), spans, bytes(np.frombuffer(raw, np.uint8)[~cov]))
        out.append(done[doc, text])
    return sorted(out, key=str)


def make(seed):
    rng = np.random.default_rng(seed)
    prose = lambda n: "".join(rng.choice(list("abcdefghij ü\n"), n))
    passages = [prose(n) for n in (60, 99, 100, 101, 150, 400)]
    rows = []
    for i in range(60):
        parts = [prose(rng.integers(0, 120))]
        for _ in range(rng.integers(0, 3)):
            p = passages[rng.integers(0, len(passages))]
            cut = rng.integers(0, 20)
            parts += [p[cut:], prose(rng.integers(0, 60))]
        rows.append((int(rng.integers(0, 10_000)) * 100 + i, "".join(parts)))
    rows += [(i, passages[5] + prose(30)) for i in range(20_000_000, 20_000_060)]  # a passage with many different ends
    rows += [(1, None), (2, ""), (3, "z" * 5_000), (4, "ab" * 700), (5, prose(30_000)), (6, rows[0][1]), (7, "x" * 99),
             (rows[2][0], rows[2][1]), (None, passages[4])]
    return rows


@pytest.mark.parametrize("bits,hot", [(28, 50_000), (28, 5), (8, 20)])
def test_against_brute_force(spark, docs_of, bits, hot):
    """Also with a filter that is too small, and with most anchors hot."""
    rows = make(bits + hot)
    got = sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in
                  sd.dedup_substrings(docs_of(rows), bits, hot).collect()), key=str)
    assert got == brute(rows)


def test_small_batches_hold_whole_anchors(spark, docs_of, monkeypatch):
    monkeypatch.setattr(sd, "BATCH", 10)
    monkeypatch.setattr(sd, "HELD", 10)
    rows = make(1)
    got = sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in
                  sd.dedup_substrings(docs_of(rows)).collect()), key=str)
    assert got == brute(rows)


def test_empty_table(spark, docs_of):
    assert sd.dedup_substrings(docs_of([])).count() == 0
