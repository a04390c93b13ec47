"""Resharding by minimum-cost flow.

Documents lie in old shards and in each of them in the order of (text hash,
document hash), so equal texts stand together.  From the old shards' sizes and
the new shards' capacities a minimum-cost flow gives how many bytes go from each
old shard to each new one; a byte that stays costs nothing, one that moves costs
one, so the fewest bytes move.  The flow becomes cuts in each old shard's order:
the hash range is divided into blocks, the block that holds a cut is divided
again, and so on down to single texts or documents; each round is one
aggregation that brings a bounded number of block sizes to the driver.  A last
pass writes the documents to their new shards, ordered, through a range sort.

The law is ``bytes``: new shards differ by a few documents' sizes.  Documents of
equal text stay in one shard, unless they are together larger than the largest
document; then they may be cut apart, as a group may hold a third of all bytes.

Defined cases: a null text has no bytes (size 1) and is written as null;
repeated rows share a shard; a null doc_id is placed like any other; an empty
table gives no rows; further columns are not written.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellar.llm import common as c
from cellar.llm.registry import query

OLD_SHARDS = 6
NEW_SHARDS = 8
#: A hash range is divided into this many blocks a round.
FANOUT = 256
SPAN = 1 << 62


def min_cost_flow(supply: list[int], capacity: list[int], cost: list[list[int]]) -> dict[tuple[int, int], int]:
    """Bytes from each supply to each capacity, at the least total cost: shortest
    augmenting paths in the residual graph (a handful of nodes)."""
    n, m = len(supply), len(capacity)
    flow: dict[tuple[int, int], int] = defaultdict(int)
    left, room = list(supply), list(capacity)
    while any(left):
        if not any(room):
            raise ValueError("capacities are smaller than the shards")
        far = {("s", i): (0, None) for i in range(n) if left[i]}
        for _ in range(n + m):
            changed = False
            for i in range(n):
                for j in range(m):
                    a, b = ("s", i), ("t", j)
                    if a in far and (b not in far or far[a][0] + cost[i][j] < far[b][0]):
                        far[b], changed = (far[a][0] + cost[i][j], a), True
                    if b in far and flow[i, j] and (a not in far or far[b][0] - cost[i][j] < far[a][0]):
                        far[a], changed = (far[b][0] - cost[i][j], b), True
            if not changed:
                break
        end = min((far["t", j][0], j) for j in range(m) if room[j] and ("t", j) in far)[1]
        path = [("t", end)]
        while far[path[-1]][1] is not None:
            path.append(far[path[-1]][1])
        path.reverse()
        amount = min(left[path[0][1]], room[end],
                     *(flow[b[1], a[1]] for a, b in zip(path, path[1:]) if a[0] == "t"))
        for a, b in zip(path, path[1:]):
            if a[0] == "s":
                flow[a[1], b[1]] += amount
            else:
                flow[b[1], a[1]] -= amount
        left[path[0][1]] -= amount
        room[end] -= amount
    return {k: v for k, v in flow.items() if v}


def _prepared(docs: DataFrame, old_shard) -> DataFrame:
    half = lambda x: F.shiftrightunsigned(F.xxhash64(x), 2)
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        F.col("doc_id").alias("doc_id"), "text", old_shard(F.col("doc_id"), text).cast("int").alias("old"),
        half(text).alias("h1"), half(F.struct("doc_id", text)).alias("h2"),
        (F.octet_length(text) + 1).cast("long").alias("size"))


def by_text(n: int = OLD_SHARDS):
    """Old layout of the query: documents lie by the hash of their text."""
    return lambda doc_id, text: F.pmod(F.xxhash64(text), F.lit(n))


def find_cuts(light: DataFrame, targets: list[tuple[int, int]], largest: int) -> list[tuple[int, int]]:
    """For each (old shard, bytes before the cut): the key (h1, h2) from which
    documents lie behind the cut."""
    state = [{"old": old, "level": 1, "lo": 0, "width": SPAN, "h1": None, "want": want, "done": None}
             for old, want in targets]
    while todo := [s for s in state if s["done"] is None]:
        pieces = []
        for k, s in enumerate(todo):
            key = F.col("h1") if s["level"] == 1 else F.col("h2")
            step = -(-s["width"] // FANOUT)
            inside = (F.col("old") == s["old"]) & (key >= s["lo"]) & (key < s["lo"] + s["width"])
            if s["level"] == 2:
                inside &= F.col("h1") == s["h1"]
            block = F.expr(f"({'h1' if s['level'] == 1 else 'h2'} - {s['lo']}) div {step}")
            pieces.append(F.when(inside, F.struct(F.lit(k).alias("k"), block.cast("long").alias("block"))))
        sizes = (light.select("size", F.explode(F.array_compact(F.array(*pieces))).alias("at"))
                 .groupBy("at.k", "at.block").agg(F.sum("size").alias("bytes")).collect())  # cuts x FANOUT rows
        held = defaultdict(dict)
        for r in sizes:
            held[r.k][r.block] = r.bytes
        for k, s in enumerate(todo):
            step = -(-s["width"] // FANOUT)
            before, at = 0, None
            for block in sorted(held[k]):
                if before + held[k][block] > s["want"]:
                    at = block
                    break
                before += held[k][block]
            if at is None:  # everything lies before the cut
                end = s["lo"] + s["width"]
                s["done"] = (end, 0) if s["level"] == 1 else (s["h1"], end)
                continue
            rest, size, lo = s["want"] - before, held[k][at], s["lo"] + at * step
            s |= {"lo": lo, "width": step, "want": rest}
            if size <= largest or (step == 1 and s["level"] == 2):  # the nearer edge will do
                edge = lo + (step if 2 * rest > size else 0)
                s["done"] = (edge, 0) if s["level"] == 1 else (s["h1"], edge)
            elif step == 1:
                s |= {"level": 2, "h1": lo, "lo": 0, "width": SPAN}
    return [s["done"] for s in state]


def plan(light: DataFrame, n_old: int, n_new: int):
    """(intervals, flow): for each old shard the (new shard, first key) of its
    parts in order, and the bytes that flow."""
    rows = light.groupBy("old").agg(F.sum("size").alias("bytes"), F.max("size").alias("largest")).collect()
    supply = [0] * n_old
    for r in rows:
        supply[r.old] = r.bytes
    total = sum(supply)
    capacity = [total // n_new + (j < total % n_new) for j in range(n_new)]
    cost = [[int(i != j) for j in range(n_new)] for i in range(n_old)]
    flow = min_cost_flow(supply, capacity, cost)
    largest = max((r.largest for r in rows), default=0)
    targets, parts = [], defaultdict(list)
    for i in range(n_old):
        done = 0
        for j in sorted((j for a, j in flow if a == i), key=lambda j: (i != j, j)):
            if done:
                targets.append((i, done))
            parts[i].append((j, len(targets) - 1 if done else None))
            done += flow[i, j]
    cuts = find_cuts(light, targets, largest)
    return {i: [(j, (0, 0) if k is None else cuts[k]) for j, k in p] for i, p in parts.items()}, flow


def _slots(batches):
    part, seen = TaskContext.get().partitionId(), defaultdict(int)
    for batch in batches:
        shards = batch.column("shard").to_numpy()
        slots = np.zeros(len(shards), np.int64)
        for s in np.unique(shards).tolist():
            mine = np.flatnonzero(shards == s)
            slots[mine] = np.arange(len(mine)) + seen[s]
            seen[s] += len(mine)
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(np.full(len(shards), part, np.int32)), pa.array(slots)],
            names=[*batch.schema.names, "part", "local_slot"])


def reshard(docs: DataFrame, n_new: int = NEW_SHARDS, n_old: int = OLD_SHARDS, old_shard=None,
            path: str | None = None) -> DataFrame:
    """Writes the documents to ``path`` (by default in the shared folder), one
    folder for each new shard, and returns them as read back: doc_id, text, old,
    shard, slot."""
    spark = docs.sparkSession
    rows = _prepared(docs, old_shard or by_text(n_old))
    light = c.written(rows.select("old", "h1", "h2", "size"), "reshard-keys")
    intervals, _ = plan(light, n_old, n_new)
    shard = F.lit(0)
    for i, parts in intervals.items():
        mine = None
        for j, (h1, h2) in parts:  # the last part whose first key is not behind the row
            if mine is None:
                mine = F.lit(j)
            else:
                behind = (F.col("h1") > h1) | ((F.col("h1") == h1) & (F.col("h2") >= h2))
                mine = F.when(behind, F.lit(j)).otherwise(mine)
        shard = F.when(F.col("old") == i, mine).otherwise(shard)
    placed = rows.select("doc_id", "text", "old", shard.cast("int").alias("shard"), "h1", "h2")
    order = ["shard", "h1", "h2", "doc_id"]
    path = path or c.new_path(spark, "reshard")
    (placed.repartitionByRange(*order).sortWithinPartitions(*order).drop("h1", "h2")
     .mapInArrow(_slots, "doc_id long, text string, old int, shard int, part int, local_slot long")
     .write.partitionBy("shard").parquet(path))
    done = spark.read.schema("doc_id long, text string, old int, part int, local_slot long, shard int").parquet(path)
    # a task holds a range of (shard, key): tasks + shards rows
    counts = done.groupBy("shard", "part").agg(F.count(F.lit(1)).alias("n")).orderBy("shard", "part").collect()
    before, seen = [], defaultdict(int)
    for r in counts:
        before.append((r.shard, r.part, seen[r.shard]))
        seen[r.shard] += r.n
    offsets = spark.createDataFrame(before, "shard int, part int, before long")
    return done.join(F.broadcast(offsets), ["shard", "part"]).select(
        "doc_id", "text", "old", "shard", (F.col("before") + F.col("local_slot")).alias("slot"))


@query("op7_min_cost_resharding")
def op7(spark, sf_dir):
    text = F.coalesce(F.col("text"), F.lit(""))
    return reshard(c.documents(spark, sf_dir)).select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
        F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "old")
