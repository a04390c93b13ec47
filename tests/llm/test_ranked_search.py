import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from cellar.llm import ranked_search as rs

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(chr(ord(x) + 32) if "A" <= x <= "Z" else x for x in text or ""))


def brute(docs, items, top=10):
    tf = [Counter(terms(t)) for _, t in docs]
    n_docs = sum(1 for x in tf if x)
    all_terms = sum(sum(x.values()) for x in tf)
    df = Counter(t for x in tf for t in x)
    out = []
    for item, text in sorted(set(items), key=str):
        scored = []
        for (doc, _), x in zip(docs, tf):
            n = sum(x.values())
            score = 0
            for t in terms(text):
                if x[t]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += w * ((1_000_000_000 * x[t]) // (1000 * x[t] + 8 * (25 + (75 * n * n_docs) // all_terms)))
            if score > 0:
                scored.append((-score, doc is not None, doc or 0, doc))
        out += [(item, i + 1, x[3], -x[0]) for i, x in enumerate(sorted(scored)[:top])]
    return sorted(out, key=str)


def corpus():
    rng = np.random.default_rng(11)
    word = lambda: f"w{min(int(rng.zipf(1.3)), 300)}"
    docs = [(i, " ".join(word() for _ in range(int(rng.integers(1, 80))))) for i in range(400)]
    docs += [(1000 + i, "Equal score here, W1 w2") for i in range(30)] + [(7, "equal score here"), (7, "equal score here")]
    docs += [(2000, None), (2001, ""), (2002, " .,- "), (None, "été Score équal"), (2003, "w1 " * 30_000 + "rare")]
    items = [(i, " ".join(word() for _ in range(12))) for i in range(20)]
    items += [(50, "equal SCORE here score"), (51, None), (52, "??"), (53, "nowhere at all"), (54, "équal-été"), (55, "rare w1")]
    items += [(56, "twice w3"), (56, "twice w3"), (57, "w1 w1 w1"), (58, " ".join(f"w{i}" for i in range(1, 300)))]
    return docs, items


def frames(spark, docs, items):
    d = spark.createDataFrame([(i, t, "en", 1, 0) for i, t in docs], "doc_id long, text string, lang string, item int, score int")
    return d, spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, doc_id int")


@pytest.mark.parametrize("block, shard, top, parts", [(rs.BLOCK_BYTES, rs.SHARD, 10, 3), (200, 37, 10, 2), (rs.BLOCK_BYTES, 5, 3, 1)])
def test_against_brute_force(spark, block, shard, top, parts):
    """Whole, with the queries in many blocks, and in shards of few documents."""
    docs, items = corpus()
    d, q = frames(spark, docs, items)
    got = rs.search(d.repartition(parts), q, top, block, shard).collect()
    assert sorted(map(tuple, got), key=str) == brute(docs, items, top)


def test_queries_of_one_id_are_ranked_apart(spark):
    d, q = frames(spark, [(1, "red"), (2, "blue"), (3, "other")], [(9, "red"), (9, "blue")])
    assert sorted((r.item_id, r["rank"], r.doc_id) for r in rs.search(d, q).collect()) == [(9, 1, 1), (9, 1, 2)]


def test_reads_stop_when_the_best_are_settled():
    """A list of one strong document settles the search before the weak list ends."""
    rng = np.random.default_rng(0)
    size = 50_000
    weak = (rng.permutation(size), np.full(size, 3))
    strong = (np.arange(20), np.arange(10_020, 10_000, -1))
    docs, score, read = rs.nra([strong, (np.concatenate([np.arange(20), 20 + rng.permutation(size - 20)]),
                                         np.concatenate([np.full(20, 9), np.full(size - 20, 3)]))], size, 1, 10)
    assert read < 1_000 and sorted(score.tolist())[-10:] == list(range(10_020, 10_030))
    # equal scores at the tenth place are all kept
    docs, score, read = rs.nra([weak], size, 1, 10)
    assert len(docs) == size and set(score.tolist()) == {3}


def test_small_marks(spark, monkeypatch):
    monkeypatch.setattr(rs, "MARKS", 40)
    docs, items = corpus()
    d, q = frames(spark, docs, items)
    assert sorted(map(tuple, rs.search(d, q).collect()), key=str) == brute(docs, items)


def test_empty_tables(spark):
    docs, items = corpus()
    d, q = frames(spark, docs, items)
    assert rs.search(d.limit(0), q).count() == 0
    assert rs.search(d, q.limit(0)).count() == 0
