import itertools
import zlib

import numpy as np

from cellar.llm import resharding as rs


def test_flow_is_cheapest():
    """Against every whole-number flow of small problems."""
    rng = np.random.default_rng(5)

    def flows(supply, room):
        if not supply:
            yield []
            return
        for first in itertools.product(*[range(min(supply[0], r) + 1) for r in room]):
            if sum(first) == supply[0]:
                for rest in flows(supply[1:], [r - f for r, f in zip(room, first)]):
                    yield [first, *rest]

    for _ in range(25):
        supply = rng.integers(0, 4, 3).tolist()
        room = rng.integers(1, 5, 3).tolist()
        if sum(room) < sum(supply):
            continue
        cost = rng.integers(0, 4, (3, 3)).tolist()
        flow = rs.min_cost_flow(supply, room, cost)
        price = lambda f: sum(f[i][j] * cost[i][j] for i in range(3) for j in range(3))
        got = [[flow.get((i, j), 0) for j in range(3)] for i in range(3)]
        assert [sum(x) for x in got] == supply and all(sum(x[j] for x in got) <= room[j] for j in range(3))
        assert price(got) == min(map(price, flows(supply, room)))


def test_documents_are_placed(spark, docs_of):
    rng = np.random.default_rng(1)
    rows = [(i, "w" * int(rng.integers(0, 400))) for i in range(1_500)]
    rows += [(5_000 + i, "the same text " * 9) for i in range(700)]  # a third of all bytes in one group
    rows += [(None, "null id"), (9_000, None), (9_001, ""), (9_002, "x" * 5_000), (9_003, "again"), (9_003, "again")]
    out = rs.reshard(docs_of(rows)).collect()
    assert sorted(((r.doc_id, r.text) for r in out), key=str) == sorted(rows, key=str)
    sizes = {}
    for r in out:
        sizes[r.shard] = sizes.get(r.shard, 0) + len((r.text or "").encode()) + 1
    assert sorted(sizes) == list(range(8))
    assert max(sizes.values()) - min(sizes.values()) <= 2 * 5_001
    for s in range(8):
        assert sorted(r.slot for r in out if r.shard == s) == list(range(sum(r.shard == s for r in out)))
    groups = {}
    for r in out:
        groups.setdefault(r.text, set()).add(r.shard)
    largest = 5_001
    whole = {t for t, _ in groups.items() if sum(len(t or "") + 1 for r in out if r.text == t) <= largest}
    assert all(len(groups[t]) == 1 for t in whole)
    moved = sum(len((r.text or "").encode()) + 1 for r in out if r.shard != r.old)
    old = {}
    for r in out:
        old[r.old] = old.get(r.old, 0) + len((r.text or "").encode()) + 1
    total = sum(old.values())
    need = sum(max(0, x - total // 8) for x in old.values())  # what no plan can leave in place
    assert abs(moved - need) <= 14 * largest
    assert rs.reshard(docs_of([])).count() == 0


def test_query_digests(spark, tmp_path, docs_of):
    docs_of([(1, "ä"), (2, None)]).select("doc_id", "text", "lang", "source").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in rs.op7(spark, str(tmp_path)).collect()}
    assert got[1].size == 3 and got[1].text_crc32 == zlib.crc32("ä".encode())
    assert got[2].size == 1 and got[2].text_crc32 == 0 and got[2].grown_shard is None
