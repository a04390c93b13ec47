import numpy as np

from cellar.llm import license_scan as ls


def _edit(template, words):
    """Plain semi-global word edit distance."""
    prev = [0] * (len(words) + 1)
    for i, w in enumerate(template, 1):
        cur = [i]
        for j, x in enumerate(words, 1):
            cur.append(min(prev[j - 1] + (x != w), prev[j] + 1, cur[-1] + 1))
        prev = cur
    return min(prev)


def test_differences_match_plain_edit_distance():
    rng = np.random.default_rng(1)
    for _ in range(200):
        t = [str(x) for x in rng.integers(0, 4, rng.integers(1, 7))]
        w = [str(x) for x in rng.integers(0, 4, rng.integers(0, 12))]
        n, start, end = ls.differences(t, w)
        assert n == _edit(t, w)
        assert _edit(t, w[start:end]) == n


def test_every_template_finds_itself_in_other_words():
    for name, text in ls.TEMPLATES.items():
        found = ls.judge("Foo bar: " + text + " And more words follow here.")
        assert found[:2] == (name, True), (name, found)


def test_other_version_is_not_confirmed():
    assert not ls.judge("Licensed under the Apache License, Version 1.1.")[1]


def test_scan_handles_odd_rows(docs_of):
    long = "word " * 30_000 + "\nReleased under the MIT License.\n" + "x" * 100_000
    rows = ls.scan_licenses(docs_of([(1, None), (2, ""), (3, long), (4, "LICENSED under the apache license version 2.0"),
                                     (4, "LICENSED under the apache license version 2.0"), (None, "All rights reserved."),
                                     (5, "a licence to sing")])).collect()
    got = sorted((r.doc_id or -1, r.first_line, r.license if r.confirmed else None) for r in rows)
    assert got == [(-1, 0, "All-rights-reserved"), (3, 1, "MIT"), (4, 0, "Apache-2.0"), (4, 0, "Apache-2.0"), (5, 0, None)] or \
        got[:4] == [(-1, 0, "All-rights-reserved"), (3, 1, "MIT"), (4, 0, "Apache-2.0"), (4, 0, "Apache-2.0")]
    assert ls.scan_licenses(docs_of([])).count() == 0
