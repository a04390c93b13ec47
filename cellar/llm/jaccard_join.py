"""N-gram Jaccard join with a token-group matrix.

Documents become sets of hashed word shingles, and equal sets become one.  Two sets
at or above the threshold share a token of their prefixes (tokens in one global
order, rarest first, as many as the threshold leaves room to miss) and fit in size.

Sets that share a prefix token form a group about a leader, the member that holds
the token earliest, and so has the fewest tokens of its own.  Each member is compared
with the leader exactly.  A group's token union is kept as the leader's tokens and
its members' differences from it (tokens added, then tokens removed).  Members that
link with the leader are connected and need no further look at each other.  For any
other pair x, y with differences of sizes a and b, a link means that the differences
have (a + b - allowed) / 2 tokens in common, which for y is over nearly half of b:
only members that share a token of these shortened differences can link, and form the
groups of the next round, which reads the sets that go on alone.  So a group of
thousands of near copies costs a comparison a member, not one a pair.  A group loses its
leader each round.  Groups of up to ``FEW`` sets (``FEW_LATER`` behind the first round, as
dozens of sets that are alike but not linked would take a round each), and what is left
after ``ROUNDS`` rounds, are compared pair by pair where sizes and the positions of the
shared token allow a link, so that no link is lost.  Groups are windows over the tokens,
dealt once: no filter whose size is fixed, no join on tokens.  Before the sets of a pair
meet, counts of their tokens by ``BUCKETS`` parts of the hash space do: the counts differ
by no more than the sets, so pairs that differ too much go at once.

The global order comes from a sketch of token counts of fixed size
(``SKETCH_BITS``); any order gives the same result, a good one keeps passages
that many documents share out of the prefixes.

Defined cases: null texts and texts without words are empty sets, linked with
nothing; fewer words than a shingle make one shingle; equal texts (and repeated
rows) share a component; rows with one doc_id are one document and share a
component; a null doc_id is a document of its own text and reports the smallest
doc_id of its component, null if there is none; further columns are not read.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellar.llm import bloom
from cellar.llm import common as c
from cellar.llm.graph import components
from cellar.llm.registry import query

#: Cells of the count sketch: one byte each when it is broadcast (8 MB).
SKETCH_BITS = 23
#: Cells of the filter of set numbers (4 MB).
ID_BITS = 25
CHUNK_BITS = 16
#: Text bytes at a time: a text's words take many times its size.
SMALL = 1 << 19
#: Rows of an Arrow batch: texts, token sets and pieces of filters are long rows, which
#: Spark, Arrow and the kernel each hold a batch of.
BATCH_ROWS = 256
#: Rounds of groups before the pairs that are left are compared one by one.
ROUNDS = 6
#: Groups of at most this many sets are compared pair by pair where positions allow a link.
FEW = 8
#: The same in the rounds that follow.
FEW_LATER = 64
#: Numbers of sets that go on, up to which they are broadcast (8 bytes each).
BROADCAST_IDS = 400_000
#: Counts of a set's tokens by parts of the hash space, one byte each.
BUCKETS = 128
_SEEDS = c.powers(3, 0xA0761D6478BD642F)[1:]


def shingle_sets(data: np.ndarray, offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, document) of the distinct shingles, sorted by document and hash."""
    starts, ends, docs = c.words_of(data, offsets)
    h, d = c.shingle_hash(c.span_hash(data, starts, ends), docs, n)
    order = np.lexsort((h, d))
    h, d = h[order], d[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
    return h[new], d[new]


# ---------------------------------------------------------------------------
# token counts

SKETCH = pa.schema([("chunk", pa.int32()), ("counts", pa.binary())])
SKETCH_DDL = "chunk int, counts binary"


def _sketch(n, bits):
    """Counts of a task's tokens, one byte a cell (sent on before one is full)."""
    def run(batches):
        total = np.zeros(1 << bits, np.uint8)
        size = 0

        def flush():
            parts = total.reshape(-1, 1 << CHUNK_BITS)
            used = np.flatnonzero(parts.any(1))
            out = pa.RecordBatch.from_pydict({
                "chunk": used.astype(np.int32),
                "counts": [parts[k].tobytes() for k in used]}, schema=SKETCH)
            total[:] = 0
            return out

        for batch in c.chunks(batches, SMALL):
            h, _ = shingle_sets(*c.text_bytes(batch.column("text")), n)
            at, times = np.unique((h >> np.uint64(64 - bits)).astype(np.uint32), return_counts=True)
            total[at] = np.minimum(total[at] + times, 255)
            size += len(h)
            if size > 16 << bits:
                yield flush()
                size = 0
        if size:
            yield flush()
    return run


def _merge_sketch(batches):
    chunk, total = None, None
    out = lambda: pa.RecordBatch.from_pydict({
        "chunk": [chunk], "counts": [np.minimum(np.log2(total + 1.0) * 8, 255).astype(np.uint8).tobytes()]}, schema=SKETCH)
    for batch in batches:
        for k, counts in zip(batch.column(0).to_pylist(), batch.column(1)):
            if k != chunk:
                if chunk is not None:
                    yield out()
                chunk, total = k, np.zeros(1 << CHUNK_BITS, np.int64)
            total += np.frombuffer(counts.as_buffer(), np.uint8)
    if chunk is not None:
        yield out()


def token_sketch(docs: DataFrame, n: int, bits: int) -> np.ndarray:
    """About eight times the logarithm of every cell's count: 2**bits bytes."""
    parts = (docs.select("text").mapInArrow(_sketch(n, bits), SKETCH_DDL).repartition("chunk")
             .sortWithinPartitions("chunk").mapInArrow(_merge_sketch, SKETCH_DDL))
    out = np.zeros(1 << max(bits, CHUNK_BITS), np.uint8)
    for r in parts.select("chunk", "counts").collect():
        out[r.chunk << CHUNK_BITS:(r.chunk + 1) << CHUNK_BITS] = np.frombuffer(r.counts, np.uint8)
    return out


# ---------------------------------------------------------------------------
# signatures

DIGEST = "rid long, doc_id long, n long, k1 long, k2 long"
SIGNATURE = "set_id long, n long, prefix array<long>, counts binary"


def _starts(d):
    return np.flatnonzero(np.concatenate([[True], d[1:] != d[:-1]])) if len(d) else np.zeros(0, np.int64)


def prefix_length(n: np.ndarray, percent: int) -> np.ndarray:
    return np.where(n > 0, n - -(-percent * n // 100) + 1, 0)


def _digests(n):
    """Size and 128-bit digest of each document's set."""
    def run(batches):
        for batch in c.chunks(batches, SMALL):
            h, d = shingle_sets(*c.text_bytes(batch.column("text")), n)
            rows = batch.num_rows
            first = _starts(d)
            keys = []
            for seed in _SEEDS[:2]:
                k = np.zeros(rows, np.uint64)
                if len(h):
                    k[d[first]] = np.add.reduceat(c.mix(h ^ seed), first)
                keys.append(pa.array(k.view(np.int64)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("rid"), batch.column("doc_id"), pa.array(np.bincount(d, minlength=rows).astype(np.int64)), *keys],
                names=["rid", "doc_id", "n", "k1", "k2"])
    return run


def _wanted(batches, ids, bits):
    """Chunks of the rows whose rid the filter of ids holds."""
    for batch in c.chunks(batches, SMALL):
        keep = bloom.holds(ids.value, batch.column("rid").to_numpy(), bits)
        if keep.any():
            yield batch.filter(pa.array(keep, pa.bool_()))


def _bucket_counts(h, d, rows):
    """The tokens of each document by buckets, up to 255."""
    at = d * np.int64(BUCKETS) + (h & np.uint64(BUCKETS - 1)).astype(np.int64)
    return np.minimum(np.bincount(at, minlength=rows * BUCKETS), 255).astype(np.uint8).reshape(rows, BUCKETS)


def _signatures(n, percent, sketch, bits, ids):
    """Prefix and bucket counts of the documents that stand for a set."""
    def run(batches):
        counts = sketch.value
        for batch in _wanted(batches, ids, ID_BITS):
            h, d = shingle_sets(*c.text_bytes(batch.column("text")), n)
            rows = batch.num_rows
            size = np.bincount(d, minlength=rows)
            first = _starts(d)
            order = np.lexsort((h, counts[h >> np.uint64(64 - bits)], d))
            rank = np.arange(len(h)) - np.repeat(first, size[d[first]]) if len(h) else np.zeros(0, np.int64)
            take = rank < prefix_length(size, percent)[d] if len(h) else np.zeros(0, bool)
            prefix = h[order][take].view(np.int64)
            ends = np.concatenate([[0], np.cumsum(np.bincount(d[take], minlength=rows))]).astype(np.int32)
            out = pa.RecordBatch.from_arrays([
                batch.column("rid"), pa.array(size.astype(np.int64)),
                pa.ListArray.from_arrays(pa.array(ends), pa.array(prefix)),
                pa.array([x.tobytes() for x in _bucket_counts(h, d, rows)], pa.binary()),
            ], names=["set_id", "n", "prefix", "counts"])
            yield out.filter(pa.array(size > 0))
    return run


def _tokens(n, ids):
    def run(batches):
        for batch in _wanted(batches, ids, ID_BITS):
            h, d = shingle_sets(*c.text_bytes(batch.column("text")), n)
            cuts = np.searchsorted(d, np.arange(batch.num_rows + 1))
            raw = h.tobytes()
            yield pa.RecordBatch.from_arrays([
                batch.column("rid"), pa.array([raw[8 * a:8 * b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())], pa.binary())],
                names=["set_id", "tokens"])
    return run


# ---------------------------------------------------------------------------
# rounds of groups

#: A set in a round: its difference from ``leader`` has ``diff`` tokens, of which those
#: in ``keys`` (hashed with the leader) may be shared with a set it links with; the first
#: ``n_probe`` count where the set is not linked with the leader, the first ``n_index`` where
#: the other one is not.
ROUND = "set_id long, n long, diff long, n_index long, n_probe long, linked boolean, leader long, keys array<long>"
PAIR = "set_id long, leader long, goes_on boolean"


def _may_link(percent):
    """Pairs to compare: those whose bucket counts differ by no more than linked sets may,
    and those with a leader, whose differences make the next round."""
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y = (np.frombuffer(b"".join(batch.column(name).to_pylist()), np.uint8).reshape(-1, BUCKETS).astype(np.int64)
                    for name in ("x_counts", "r_counts"))
            apart = np.abs(x - y).sum(1)
            both = batch.column("x_n").to_numpy() + batch.column("r_n").to_numpy()
            keep = batch.column("goes_on").to_numpy(zero_copy_only=False) | (apart * (100 + percent) <= both * (100 - percent))
            yield batch.select(["set_id", "leader", "goes_on"]).filter(pa.array(keep, pa.bool_()))
    return run


def _compare(percent, sketch, bits):
    """Sets with their leaders -> whether they link, and the shortened difference."""
    def difference(x, r, leader, goes_on, counts):
        at = np.searchsorted(r, x)
        same = np.zeros(len(x), bool)
        inside = at < len(r)
        same[inside] = r[at[inside]] == x[inside]
        added = x[~same]
        gone = np.ones(len(r), bool)
        gone[at[same]] = False
        removed = r[gone]
        common, diff = len(x) - len(added), len(added) + len(removed)
        linked = 100 * common >= percent * (len(x) + len(r) - common) and common > 0
        # the least a link with this set leaves in common, whoever the other is
        least = diff - (100 - percent) * len(x) // percent
        n_index = diff - max(percent * diff // (100 + percent) + 1, least) + 1
        n_probe = 0 if linked else diff - max(1, least) + 1
        take = max(n_index, n_probe) if goes_on else 0
        rank = lambda t: t[np.lexsort((t, counts[t >> np.uint64(64 - bits)]))]
        found = rank(added)[:take]
        if len(found) < take:
            found = np.concatenate([found, rank(removed)[:take - len(found)]])
        key = c.mix(found ^ c.mix(np.array([leader]).view(np.uint64)))
        return diff, n_index, n_probe, linked, key.view(np.int64)

    def run(batches):
        counts = sketch.value
        for batch in batches:
            if not batch.num_rows:
                continue
            out = [difference(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(r.as_buffer(), np.uint64), leader, goes_on, counts)
                   for x, r, leader, goes_on in zip(batch.column("x_tokens"), batch.column("r_tokens"),
                                                    *(batch.column(name).to_pylist() for name in ("leader", "goes_on")))]
            diff, n_index, n_probe, linked, keys = zip(*out)
            ends = np.concatenate([[0], np.cumsum([len(k) for k in keys])]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("set_id"), pa.array([len(x.as_buffer()) // 8 for x in batch.column("x_tokens")], pa.int64()),
                 *[pa.array(x, pa.int64()) for x in (diff, n_index, n_probe)], pa.array(linked, pa.bool_()), batch.column("leader"),
                 pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(keys)))],
                names=["set_id", "n", "diff", "n_index", "n_probe", "linked", "leader", "keys"])
    return run


def _counted(pairs, sets):
    """Pairs (set_id, leader) with the sizes and bucket counts of both."""
    return pairs.join(sets.select("set_id", F.col("n").alias("x_n"), F.col("counts").alias("x_counts")), "set_id").join(
        sets.select(F.col("set_id").alias("leader"), F.col("n").alias("r_n"), F.col("counts").alias("r_counts")), "leader").select(
        "set_id", "leader", "goes_on", "x_n", "r_n", "x_counts", "r_counts")


def _beside(pairs, opened):
    """Pairs (set_id, leader) with the tokens of both."""
    return pairs.join(opened.withColumnRenamed("tokens", "x_tokens"), "set_id").join(
        opened.select(F.col("set_id").alias("leader"), F.col("tokens").alias("r_tokens")), "leader").select(
        "set_id", "leader", "goes_on", "x_tokens", "r_tokens")


def _cells(state: DataFrame, percent: int) -> DataFrame:
    """Keys of sets that some other set of the key may link with, with the sets ``size`` of
    the key and its ``leader``.  ``state`` has the sets themselves (column ``prefix``), whose
    tokens count in two size classes each, as sets that fit in size have one in common, or
    those of a round.

    Sets x and y whose first common token stands at positions i and j have at most
    min(a - i, b - j) tokens in common, and need (a + b - allowed) / 2.  So b - 2 j + its
    part of the allowance (``reach``) is at least a - its part (``need``), and the reverse; the
    extremes of a key say which sets have any such partner."""
    count = F.count(F.lit(1))
    alone = lambda rows: rows.withColumn("size", count.over(Window.partitionBy("token"))).where("size > 1")
    if "prefix" in state.columns:
        width = max(np.log(100 / percent), 1e-3) * (1 + 1e-9)
        band = F.floor(F.log("n") / float(width))
        cells = alone(state.select("set_id", "n", F.posexplode("prefix").alias("pos", "token"))).withColumns(
            {"diff": F.col("n"), "index": F.lit(True), "probe": F.lit(True), "band": F.explode(F.array(band, band + 1))})
        first = "pos"
    else:
        cells = state.select("set_id", "n", "diff", "n_index", "n_probe", F.posexplode("keys").alias("pos", "token"))
        cells = alone(cells.withColumns({"index": F.col("pos") < F.col("n_index"), "probe": F.col("pos") < F.col("n_probe")})
                      .where("index or probe")).withColumn("band", F.lit(0).cast("long"))
        first = "diff"
    part = F.col("n") * (100 - percent)
    cells = cells.withColumn("need", F.col("diff") * (100 + percent) - part).withColumn(
        "reach", (F.col("diff") - 2 * F.col("pos")) * (100 + percent) + part)
    group = Window.partitionBy("token", "band")
    cells = cells.withColumns({f"{role}_{x}": f(F.when(F.col(role), F.col(x))).over(group)
                               for role in ("index", "probe") for f, x in ((F.min, "need"), (F.max, "reach"))}).where(
        "(probe and need <= index_reach and reach >= index_need) or (index and need <= probe_reach and reach >= probe_need)")
    cells = cells.withColumns({
        "size": count.over(group), "any_probe": F.max("probe").over(group), "any_index": F.max("index").over(group),
        "leader": F.min_by("set_id", F.struct(first, F.xxhash64("set_id"))).over(group)})
    return cells.where("size > 1 and any_probe and any_index").select(
        F.xxhash64("token", "band").alias("key"), "set_id", "n", "diff", "pos", "index", "probe", "need", "reach", "size", "leader")


def _pairs(cells: DataFrame, percent: int) -> DataFrame:
    """Pairs of sets of one key that positions and sizes let link."""
    x = cells.where("probe").select("key", "set_id", "n", "need", "reach")
    y = cells.where("index").select("key", *[F.col(name).alias(f"{name}_b") for name in ("set_id", "n", "need", "reach")])
    return x.join(y, "key").where(
        (F.col("set_id") != F.col("set_id_b")) & (F.col("need") <= F.col("reach_b")) & (F.col("need_b") <= F.col("reach"))
        & (F.col("n") * 100 >= F.col("n_b") * percent) & (F.col("n_b") * 100 >= F.col("n") * percent)).select(
        F.least("set_id", "set_id_b").alias("set_id"), F.greatest("set_id", "set_id_b").alias("leader"), F.lit(False).alias("goes_on"))


def _of_sets(table, ids):
    """The rows of ``table`` of the sets ``ids``; a short list of them goes to the table."""
    return table.join(F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids, "set_id", "left_semi")


def links_of(sets: DataFrame, rows: DataFrame, sketch, bits: int, n: int, percent: int, rounds: int = ROUNDS) -> DataFrame:
    """Links (u, v) between sets that give the components of all links."""
    spark = sets.sparkSession
    state, opened, links = sets, None, []
    for k in range(rounds + 1):
        cells = c.written(_cells(state, percent), f"round-{k}-groups")
        if k < rounds:
            big = F.col("size") > (FEW_LATER if k else FEW)
            pairs = cells.where(big).where("set_id <> leader").select("set_id", "leader", F.lit(True).alias("goes_on")).union(
                _pairs(cells.where(~big), percent))
        else:
            pairs = _pairs(cells, percent)
        pairs = c.written(pairs.groupBy("set_id", "leader").agg(F.max("goes_on").alias("goes_on")), f"round-{k}-met")
        pairs = c.written(_counted(pairs, sets).mapInArrow(_may_link(percent), PAIR), f"round-{k}-pairs")
        if pairs.isEmpty():
            break
        if opened is None:  # later rounds meet no other sets
            ids = spark.sparkContext.broadcast(bloom.number_filter(pairs.select(F.explode(F.array("set_id", "leader"))), ID_BITS))
            opened = c.written(rows.select("rid", "text").mapInArrow(_tokens(n, ids), "set_id long, tokens binary"), "tokens")
            ids.destroy()
        state = c.written(_beside(pairs, opened).mapInArrow(_compare(percent, sketch, bits), ROUND), f"round-{k}")
        links.append(state.where("linked").select(F.col("set_id").alias("u"), F.col("leader").alias("v")))
        going = c.written(state.where(F.size("keys") > 0).select("set_id").distinct(), f"round-{k}-going")
        if k == rounds or going.isEmpty():
            break
        # the next round joins only what goes on
        sets, opened = (c.written(_of_sets(table, going), f"round-{k}-{name}") for table, name in ((sets, "sets"), (opened, "tokens")))
    return reduce(DataFrame.union, links, spark.createDataFrame([], "u long, v long"))


# ---------------------------------------------------------------------------
# the join

def row_id():
    """A document's node: its doc_id, or for a null one a number of its text's."""
    return F.coalesce(F.col("doc_id").cast("long"), F.xxhash64("text").bitwiseOR(F.lit(-(1 << 63))))


def keep_one_of_each(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with one document of each component: the one of the smallest doc_id or,
    in a component of null ones, of the smallest text hash.  Rows that share a
    doc_id belong to one component, whatever their texts; of these the smallest row
    by its text and other columns stays."""
    found = c.written(jaccard_components(docs, **options), "components")
    # null ids have negative numbers, which come after all others
    last = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("rid"))
    stays = found.groupBy("root").agg(F.min_by("rid", last).alias("rid"))
    key = c.unused(docs, "row_id")
    rows = docs.withColumn(key, row_id()).join(stays.select(F.col("rid").alias(key)).distinct(), key, "left_semi")
    rest = [x.name for x in docs.schema if x.name != "text" and not isinstance(x.dataType, T.MapType)]
    order = F.struct(F.sha2(F.coalesce(F.col("text"), F.lit("")), 256), F.xxhash64("text", *rest))
    return rows.groupBy(key).agg(F.min_by(F.struct(*docs.columns), order).alias("kept")).select("kept.*")


def jaccard_components(docs: DataFrame, shingle: int = 5, percent: int = 80,
                       sketch_bits: int = SKETCH_BITS, rounds: int = ROUNDS) -> DataFrame:
    """One row for each document: doc_id, rid, root, n_shingles, component_id.  Two
    documents link when their sets' Jaccard similarity is ``percent``/100 or
    more."""
    with c.batch_rows(docs.sparkSession, BATCH_ROWS):
        return _components(docs, shingle, percent, sketch_bits, rounds)


def _components(docs: DataFrame, shingle: int, percent: int, sketch_bits: int, rounds: int) -> DataFrame:
    spark = docs.sparkSession
    bits = max(sketch_bits, CHUNK_BITS)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("rid", row_id())
    sketch = spark.sparkContext.broadcast(token_sketch(rows, shingle, bits))
    signed = c.written(rows.select("rid", "doc_id", "text").mapInArrow(_digests(shingle), DIGEST), "digests")
    # equal sets become one, named after their smallest row
    named = signed.where("n > 0").groupBy("k1", "k2", "n").agg(F.min("rid").alias("set_id"))
    member = c.written(signed.where("n > 0").select("rid", "n", "k1", "k2").distinct().join(
        named, ["k1", "k2", "n"]).select("rid", "set_id"), "set-members")
    own = member.where("rid <> set_id").select(F.col("rid").alias("u"), F.col("set_id").alias("v"))
    stands = spark.sparkContext.broadcast(bloom.number_filter(member.where("rid = set_id").select("set_id"), ID_BITS))
    sets = c.written(rows.select("rid", "text").mapInArrow(
        _signatures(shingle, percent, sketch, bits, stands), SIGNATURE), "sets")
    stands.destroy()
    links = links_of(sets, rows, sketch, bits, shingle, percent, rounds)
    everything = components(links.union(own))
    sketch.destroy()
    # the smallest doc_id of each component
    rooted = signed.select("rid", "doc_id", "n").join(
        everything.withColumnRenamed("node", "rid"), "rid", "left").withColumn("root", F.coalesce("root", "rid"))
    least = rooted.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    return rooted.join(least, "root").select(
        "doc_id", "rid", "root", F.col("n").alias("n_shingles"), "component_id")


@query("op8_jaccard_token_groups")
def op8(spark, sf_dir):
    return jaccard_components(c.documents(spark, sf_dir), shingle=4, percent=85).select("doc_id", "n_shingles", "component_id")
