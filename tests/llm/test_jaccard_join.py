import numpy as np
import pytest

from cellar.llm import jaccard_join as jj
from cellar.llm.graph import components


def sets_of(rows, n):
    out = []
    for _, text in rows:
        w = (text or "").encode().lower().split()
        out.append({tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set()))
    return out


def brute(rows, n, percent):
    sets, root = sets_of(rows, n), list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            linked = both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both)
            if linked or (rows[i][0] is not None and rows[i][0] == rows[j][0]):
                root[find(i)] = find(j)
    ids = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            ids[find(i)] = min(ids.get(find(i), d), d)
    return sorted([(d, len(s), ids.get(find(i))) for i, ((d, _), s) in enumerate(zip(rows, sets))], key=str)


def make(rng):
    word = lambda: "".join(rng.choice(list("abcdefgh"), 4))
    rows, base = [], [word() for _ in range(120)]
    for i in range(60):  # a large group of near copies, at all similarities
        w = list(base)
        for k in rng.integers(0, len(w), rng.integers(0, 6)):
            w[k] = word()
        rows.append((i, " ".join(w)))
    passage = [word() for _ in range(50)]
    for i in range(60, 110):  # a passage that many share, between own words
        rows.append((i, " ".join([word() for _ in range(rng.integers(0, 40))] + passage + [word() for _ in range(rng.integers(0, 12))])))
    for i in range(110, 140):  # chains: each near the one before
        w = rows[-1][1].split() if i > 110 else [word() for _ in range(90)]
        w[rng.integers(0, len(w))] = word()
        rows.append((i, " ".join(w)))
    rows += [(200, None), (201, ""), (202, " \n\t "), (203, "One two"), (204, "one  TWO\n"), (205, "one two three"), (206, "ünï Ünï"),
             (207, "long " * 20_000), (208, "x" * 50_000), (209, rows[3][1]), (3, rows[3][1]), (None, rows[70][1]), (None, "alone with null id"),
             (None, None), (5, "another text under the same number as five")]
    return rows


@pytest.mark.parametrize("n,percent,bits,rounds", [(4, 85, 24, jj.ROUNDS), (5, 80, 16, 1), (3, 60, 24, 2), (4, 85, 23, 0)])
def test_against_brute_force(spark, docs_of, n, percent, bits, rounds):
    rows = make(np.random.default_rng(n))
    got = jj.jaccard_components(docs_of(rows), n, percent, bits, rounds)
    assert sorted(map(tuple, got.select("doc_id", "n_shingles", "component_id").collect()), key=str) == brute(rows, n, percent)


def test_near_misses_about_one_text(spark, docs_of):
    """Edits of one text, with the same edits in some, on both sides of the threshold: few comparisons, all links."""
    rng = np.random.default_rng(11)
    word = lambda: "".join(rng.choice(list("abcdefgh"), 5))
    base = [word() for _ in range(90)]
    edits = [(int(k), word()) for k in rng.integers(0, 90, 30)]
    rows = []
    for i in range(250):
        w = list(base)
        for _ in range(rng.integers(1, 8)):
            k, new = edits[rng.integers(0, 30)] if rng.random() < 0.5 else (rng.integers(0, 90), word())
            w[k] = new
        rows.append((i, " ".join(w)))
    for rounds in (1, jj.ROUNDS):
        got = jj.jaccard_components(docs_of(rows), 4, 85, rounds=rounds)
        assert sorted(map(tuple, got.select("doc_id", "n_shingles", "component_id").collect()), key=str) == brute(rows, 4, 85)


def test_one_of_each_stays(spark, docs_of):
    rows = make(np.random.default_rng(8))
    kept = jj.keep_one_of_each(docs_of(rows))
    ids = [r.doc_id for r in kept.collect()]
    want = brute(rows, 5, 80)
    assert sorted(x for x in ids if x is not None) == sorted({d for d, _, comp in want if d is not None and d == comp})
    assert kept.columns == docs_of([]).columns
    assert jj.keep_one_of_each(docs_of([])).count() == 0


def test_components(spark):
    rng = np.random.default_rng(4)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 300, (200, 2))] + [(i, i + 1) for i in range(1_000, 1_100)]
    root = {x: x for e in edges for x in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert all(got.get(x, x) == find(x) for x in root)


def test_null_and_shared_ids(spark):
    """One row of near copies stays though their ids are null; of rows that share an id always the same one."""
    base = [f"w{i}" for i in range(60)]
    near = [" ".join(base[:59 - k] + [f"x{k}"] + base[60 - k:]) for k in range(1, 4)]
    rows = [(None, " ".join(base), 1)] + [(None, t, 1) for t in near] + [(7, "one two three four five six", 1),
            (7, "quite other words stand in this row", 2), (None, None, 3)]
    kept = []
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame(order, "doc_id long, text string, root long").repartition(3)
        kept.append(sorted(map(str, jj.keep_one_of_each(df, shingle=2, percent=80).collect())))
    assert kept[0] == kept[1] and len(kept[0]) == 3
    assert sum("Row(doc_id=None, text='w" in x for x in kept[0]) == 1


def test_kernels_hold_few_long_rows_and_one_process_a_core(spark, docs_of, monkeypatch):
    """A batch is a bounded number of texts or token sets, and no job of the join has two
    mapInArrow one behind the other (each has a Python process of its own)."""
    seen, plans = [], []
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    written, filtered = jj.c.written, jj.bloom._filter

    def note(df, name):
        seen.append(int(df.sparkSession.conf.get(key)))
        plans.append((name, df._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow")))
        return written(df, name)

    def note_filter(df, *args, **options):
        plans.append(("filter", 1 + df._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow")))
        return filtered(df, *args, **options)

    monkeypatch.setattr(jj.c, "written", note)
    monkeypatch.setattr(jj.bloom, "_filter", note_filter)
    text = " ".join(f"w{i}" for i in range(60))
    got = jj.jaccard_components(docs_of([(i, f"{text} end{i}") for i in range(30)]), 5, 80, sketch_bits=16)
    assert {r.component_id for r in got.collect()} == {0}
    inside = [x for x, (name, _) in zip(seen, [p for p in plans if p[0] != "filter"]) if name != "components"]
    assert inside and max(inside) <= jj.BATCH_ROWS and spark.conf.get(key) == before
    assert [p for p in plans if p[1] > 1] == []


def test_groups_take_no_filter_and_no_join_on_tokens(spark, docs_of, monkeypatch):
    """Keys of one set alone leave in the windows, whatever their number; all links are found."""
    rng = np.random.default_rng(5)
    word = lambda: "".join(rng.choice(list("abcdefgh"), 6))
    shared = [" ".join(word() for _ in range(4)) for _ in range(8)]
    rows = []
    for i in range(60):  # alike in one shingle alone
        w = [word() for _ in range(90)] if i % 3 else rows[-1][1].split() if i else [word() for _ in range(90)]
        rows.append((i, " ".join([*w[:90 - i % 3], shared[i % 8]])))
    rows_of, plans, written = {}, {}, jj.c.written

    def note(df, name):
        plans[name] = df._jdf.queryExecution().optimizedPlan().toString()
        out = written(df, name)
        rows_of[name] = out.count()
        return out

    monkeypatch.setattr(jj.c, "written", note)
    got = jj.jaccard_components(docs_of(rows), 4, 85)
    assert sorted(map(tuple, got.select("doc_id", "n_shingles", "component_id").collect()), key=str) == brute(rows, 4, 85)
    assert "Join" not in plans["round-0-groups"]
    assert 0 < rows_of["round-0-pairs"] <= rows_of["round-0-met"]


def test_bucket_counts_lose_no_link():
    """Pairs at the threshold pass, also where a bucket is full; sets without a common token do not."""
    import pyarrow as pa
    rng = np.random.default_rng(6)
    for n in (3, 20, 100, 2_000, 60_000):
        base = rng.integers(0, 1 << 62, n).astype(np.uint64)
        for percent in (60, 80, 85):
            miss = n * (100 - percent) // (100 + percent)  # so many others on each side
            other = np.concatenate([base[miss:], rng.integers(0, 1 << 62, miss).astype(np.uint64)])
            counts = [jj._bucket_counts(x, np.zeros(n, np.int64), 1)[0].tobytes() for x in (base, other)]
            batch = pa.RecordBatch.from_pydict({"set_id": [1], "leader": [2], "goes_on": [False], "x_n": [n], "r_n": [n],
                                                "x_counts": counts[:1], "r_counts": counts[1:]})
            common = n - miss
            assert 100 * common >= percent * (2 * n - common)
            assert sum(b.num_rows for b in jj._may_link(percent)([batch])) == 1
            if n in (20, 100):
                apart = jj._bucket_counts(rng.integers(0, 1 << 62, n).astype(np.uint64), np.zeros(n, np.int64), 1)[0].tobytes()
                batch = batch.set_column(6, "r_counts", pa.array([apart], pa.binary()))
                assert sum(b.num_rows for b in jj._may_link(percent)([batch])) == 0


def test_sets_alike_but_not_linked_settle_soon(spark, docs_of, monkeypatch):
    """Dozens of edits of one text below the threshold take no round each, and later
    rounds read no set that does not go on."""
    rng = np.random.default_rng(12)
    word = lambda: "".join(rng.choice(list("abcdefgh"), 6))
    rows, base, edits = [], [word() for _ in range(200)], [word() for _ in range(40)]
    for i in range(45):
        w = list(base)
        for k in rng.choice(40, 14, replace=False):
            w[5 * k] = edits[k]
        rows.append((i, " ".join(w)))
    for i in range(100, 160):  # linked pairs, settled in the first round
        w = rows[-1][1].split() if i % 2 else [word() for _ in range(100)]
        rows.append((i, " ".join([*w[:99], word()])))
    keys, tables, written = [], {}, jj.c.written

    def note(df, name):
        out = written(df, name)
        tables[name] = out.count()
        if "keys" in out.columns:
            keys.append(sum(len(r["keys"]) for r in out.collect()))
        return out

    monkeypatch.setattr(jj.c, "written", note)
    got = jj.jaccard_components(docs_of(rows), 4, 85)
    assert sorted(map(tuple, got.select("doc_id", "n_shingles", "component_id").collect()), key=str) == brute(rows, 4, 85)
    assert keys[0] > 0 and sum(keys[1:]) == 0
    assert 0 < tables["round-0-tokens"] == tables["round-0-sets"] <= 45 < tables["tokens"]
