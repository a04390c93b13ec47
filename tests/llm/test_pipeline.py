"""The pipeline on tables with planted cases, stage by stage against brute force."""

import re

import numpy as np
import pytest

import corpus_pipeline as cp
import test_jaccard_join
import test_line_dedup
from cellar.llm import packing

WORDS = {"en": "the of and that house water with which there where under over night light".split(),
         "de": "der und nicht schön straße über auch wenn ich ein haus wasser nacht licht".split()}


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    rng = np.random.default_rng(11)
    prose = lambda lang, n: " ".join(rng.choice(WORDS[lang], n)) + f" {rng.integers(1e9)}"
    items = [(i, " ".join(f"{w}{rng.integers(50)}" for w in rng.choice(WORDS["en"], 30))) for i in range(5)]
    rows = []
    for i in range(120):
        lang = "en" if i % 3 else "de"
        lines = [prose(lang, 40) for _ in range(4)]
        if i % 4 == 0:
            lines.insert(1, "the same footer line")
        rows.append((i, "\n".join(lines), lang))
    rows += [(200 + i, rows[5][1], "en") for i in range(15)]                       # exact copies
    rows += [(300 + i, rows[7][1].replace("house", "horse", 1 + i), "en") for i in range(3)]  # near copies
    rows += [(400 + i, prose("en", 30) + "\n" + items[i][1] + " " + prose("en", 20), "en") for i in range(3)]
    rows += [(500, None, "en"), (501, "", None), (502, "1234 5678 !!", "en"), (0, rows[0][1], rows[0][2]), (503, prose("en", 9_000), None)]
    d = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame([(a, t, lang, f"src{(a or 0) % 3}", len(t or ""), "extra") for a, t, lang in rows],
                          "doc_id long, text string, lang string, source string, n_chars long, row_key string"
                          ).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    return d


def test_stages(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    seen = {}
    for name, stage in cp.STAGES:
        out = stage(spark, docs, sf_dir)
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        seen[name] = docs
        if name != "packing":
            assert docs.columns == columns
    rows = lambda name: sorted(((r.doc_id, r.text) for r in seen[name].collect()), key=str)
    first = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    kept = rows("language_id")
    assert sorted([x for x in first if x[0] not in (500, 501, 502)], key=str) == kept
    assert {r.doc_id: r.lang for r in seen["language_id"].collect()}[503] == "en"

    deduped = {r.doc_id: r for r in seen["line_dedup"].collect()}
    want = test_line_dedup.brute(kept)
    import hashlib
    assert sorted((d, hashlib.sha256(r.text.encode()).hexdigest()) for d, r in deduped.items()) == sorted({(d, h) for d, _, _, h in want})
    assert all(r.n_chars == len(r.text) and r.row_key == "extra" for r in deduped.values())

    before = rows("line_dedup")
    comps = test_jaccard_join.brute(before, 5, 80)
    left = rows("near_duplicates")
    assert sorted(d for d, _ in left) == sorted({d for d, _, comp in comps if d == comp})

    items = [r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    plain = lambda t: " ".join(re.findall(r"[^\W_]+", t.lower()))
    clean = [(d, t) for d, t in left if not any(plain(x) in plain(t) for x in items)]
    assert rows("decontamination") == clean and len(clean) == len(left) - 3

    packed = seen["packing"].collect()
    assert {r.doc_id for r in packed} == {d for d, _ in clean}
    bins = {}
    for r in packed:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= packing.CAPACITY


def test_run_and_empty(spark, sf_dir, tmp_path):
    assert cp.run(spark, sf_dir).count() > 0
    empty = str(tmp_path / "empty")
    spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0).write.parquet(f"{empty}/documents.parquet")
    spark.read.parquet(f"{sf_dir}/benchmark.parquet").limit(0).write.parquet(f"{empty}/benchmark.parquet")
    assert cp.run(spark, empty).count() == 0
