import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from cellar.llm import collocations as co


def brute(rows, least, top):
    f = defaultdict(Counter)
    total = Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = "".join(chr(ord(x) + 32) if "A" <= x <= "Z" else x for x in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(w)
            for n in range(1, 6):
                f[lang].update(tuple(w[i:i + n]) for i in range(len(w) - n + 1))
    out = []
    for lang, count in f.items():
        cand = {g: a for g, a in count.items() if len(g) > 1 and a >= least}
        inside = lambda g, x: any(x[i:i + len(g)] == g for i in range(len(x) - len(g) + 1))
        scored = []
        for g, a in cand.items():
            if any(len(x) > len(g) and b >= a and inside(g, x) for x, b in cand.items()):
                continue
            score, _, left, right = min((1000 * a * total[lang] // (count[g[:k]] * count[g[k:]]), k, count[g[:k]], count[g[k:]])
                                        for k in range(1, len(g)))
            scored.append((-score, -a, " ".join(g).encode(), left, right))
        for i, (score, a, g, left, right) in enumerate(sorted(scored)[:top]):
            out.append((lang, i + 1, g.decode(), -a, left, right, total[lang], -score))
    return sorted(out)


def rows():
    rng = np.random.default_rng(5)
    vocabulary = ["alpha", "Beta", "été", "x", "gamma-ray", "of", "the", "a", "B2", "ÉTÉ"]
    out = []
    for i in range(120):
        words = [vocabulary[k] for k in rng.zipf(1.6, 60) % 10]
        glue = [" ", "  ", "\t", ", ", ".", "\n", " \t ", "! "]
        out.append((["en", "fr", None, "und"][i % 4], "".join(w + glue[k] for w, k in zip(words, rng.choice(8, 60, p=[.6, .1, .05, .05, .05, .05, .05, .05])))))
    out += [("en", "New York City. new york city")] * 40 + [("en", None), (None, ""), ("fr", " \t\n,")]
    out += [("de", "lang " * 4_000), ("de", "der " * 300 + "hund. " + "ein hund " * 50)]
    return out


def frame(spark, data):
    return spark.createDataFrame([(i, t, x, "en", 1, "p") for i, (x, t) in enumerate(data)],
                                 "doc_id long, text string, lang string, phrase string, n long, chunk string")


@pytest.mark.parametrize("bits, least, top", [(None, 5, 2000), (3, 5, 2000), (None, 30, 3)])
def test_against_brute_force(spark, bits, least, top):
    """Also with a table of 8 cells, which lets every n-gram through to the exact count."""
    got = co.collocations(frame(spark, rows()), least, top, bits).collect()
    assert sorted(map(tuple, got)) == brute(rows(), least, top)


def test_chunks_own_every_word_once_and_reach_over():
    text = ("one two three four five six seven eight nine ten " * 40 + ", " + "a b c d e f g h " * 9).encode()
    data = np.frombuffer(text, np.uint8)
    low, start, end, own, doc = co.parse(data, np.array([0, len(data)]), period=3)
    chunks = [low.tobytes()[s:e].decode().split(" ") for s, e in zip(start, end)]
    assert sum(own) == len(text.replace(b",", b"").split())
    assert all(len(x) - n in range(0, co.OVERLAP + 1) for x, n in zip(chunks, own)) and len(set(map(tuple, chunks))) < len(chunks)


def test_same_table_in_other_partitions(spark):
    df = frame(spark, rows())
    a = co.collocations(df.repartition(1), 5).collect()
    b = co.collocations(df.repartition(13), 5).collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))


def test_empty_table(spark):
    assert co.collocations(frame(spark, rows()).limit(0)).count() == 0
    assert co.collocations(frame(spark, [("en", None), (None, " ")]), 1).count() == 0
