import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from cellar.llm import phrase_automata as pa_


def brute(rows, length=20):
    """Rows equal in (doc_id, text) are one document."""
    order = sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0))
    seen, out = set(), {}
    for row in order:
        words = re.findall(r"[^\x20\x09-\x0D]+", row[1] or "")
        gone = [False] * len(words)
        for i in range(len(words) - length + 1):
            g = tuple(words[i:i + length])
            if g in seen:
                gone[i:i + length] = [True] * length
            seen.add(g)
        kept = " ".join(w for w, x in zip(words, gone) if not x)
        out[row] = (row[0], len(words), sum(gone), hashlib.sha256(kept.encode()).hexdigest())
    return sorted((out[r] for r in rows), key=str)


def rows():
    rng = np.random.default_rng(3)
    text = lambda n, v=400: [f"w{x}é" if x % 5 == 0 else f"W{x}" for x in rng.integers(0, v, n)]
    hot, other = text(45), text(25)
    out = [(i, " ".join(text(12) + hot + text(15))) for i in range(60)]
    out += [(100 + i, "\n".join(text(30) + hot[i:i + 22] + text(4))) for i in range(20)]
    out += [(200 + i, "\t ".join(text(i) + other + hot[:21] + other)) for i in range(6)]
    out += [(300, None), (301, ""), (302, " \n\t"), (303, " ".join(hot[:19])), (304, " ".join(hot[:20])), (None, " ".join(hot))]
    out += [(305, " ".join(["same"] * 400)), (306, " ".join(["same"] * 30)), (307, " ".join(["a", "b"] * 50))]
    out += [(308, " ".join(text(20_000, 10**6))), (309, " ".join(text(40, 3) * 30)), (310, "x" * 90_000)]
    out += [(311, " ".join(hot + other))] * 2
    return out


@pytest.mark.parametrize("bits, hot", [(None, pa_.HOT), (6, pa_.HOT), (None, 3)])
def test_against_brute_force(spark, docs_of, bits, hot):
    """Also with a filter of 64 bits (every piece travels) and with every anchor of more
    than 3 pieces dealt window by window."""
    got = pa_.dedup_phrases(docs_of(rows()), bits, hot).select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256))
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows())


def test_small_runs_of_a_shard(spark, docs_of, monkeypatch):
    """A shard works through many runs of pieces; no anchor is torn apart."""
    monkeypatch.setattr(pa_, "BATCH", 7)
    out = pa_.dedup_phrases(docs_of(rows())).select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256))
    assert sorted(map(tuple, out.collect()), key=str) == brute(rows())


def test_passages_are_maximal():
    a, b = list(range(30)), list(range(100, 140))
    codes = np.array(b + a + b + a[:25] + a)
    piece = np.array([0] * 40 + [1] * 30 + [2] * 40 + [3] * 25 + [4] * 30)
    begin, words = pa_.passages(codes, piece)
    found = sorted((codes[s:s + n].tolist() for s, n in zip(begin, words)), key=len)
    # windows 0..5 of a stand in three pieces, 6..10 in two
    assert found == [a[6:30], a[:25], b]


def test_letters_skip_surrogates():
    letters = pa_._letters(np.arange(60_000))
    assert len(set(letters.tolist())) == 60_000 and letters.min() == 1
    letters.astype("<u4").tobytes().decode("utf-32-le")


def test_empty_table(spark, docs_of):
    assert pa_.dedup_phrases(docs_of([])).count() == 0
