"""Suffix dedup: removes every byte of a repeated 100-byte string but the first.

The collection is cut into pieces that carry all their repeats to one place.  In
every 100-byte window the 32-byte string with the smallest hash is its anchor;
equal windows have equal anchors at equal offsets.  A piece is a run of windows
with one anchor (at most 168 bytes).  Two Bloom filters keep the pieces whose
anchor occurs once at home.  The others meet by anchor, aligned on it, and their
order is built column by column from the right: each round puts one symbol in
front of every piece's suffix, re-sorts the suffixes by that symbol (a stable
sort of the order before, as in the column-wise construction of a collection's
Burrows-Wheeler transform), and updates the common prefixes of neighbours by
range minima.  As pieces of one anchor are aligned, equal windows stand in one
column, and a round needs only the column before.  Neighbours with 100 common
symbols are equal windows; all but the first in (doc_id, start) are marked.  The
columns are read in turn from the written table of pieces, a bounded number of
pieces at a time.

Equal pieces of one task are sent once, so a passage in a third of all documents
sends one row a task.  An anchor with more than ``HOT`` different pieces (the
edges of such a passage) goes on by single windows instead of by anchor.

Defined cases: null or empty texts, and texts under 100 bytes, keep all bytes;
rows equal in doc_id and text are one document and keep the same bytes; of rows
that share a doc_id only, the order is that of a hash of the text; a null doc_id
comes first; further columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellar.llm import bloom
from cellar.llm import common as c
from cellar.llm.registry import query

LENGTH = 100
ANCHOR = 32
FILTER_BITS = 28
#: Pieces a task holds before it sends them on; pieces of one construction.
HELD = 100_000
BATCH = 60_000
HOT = 50_000
PIECE = [("kind", pa.int32()), ("h", pa.int64()), ("did", pa.int64()), ("rk", pa.int64()), ("a", pa.int64()),
         ("n", pa.int32()), ("off", pa.int32()), ("seg", pa.binary())]
PIECE_DDL = "kind int, h long, did long, rk long, a long, n int, off int, seg binary"
FLAG_DDL = "did long, rk long, a long, n int"


def pieces(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH, anchor: int = ANCHOR):
    """(anchor hash, first window, last window, anchor place, document) of each
    run of windows with one anchor."""
    n, w = len(data), length - anchor + 1
    none = np.zeros(0, np.int64)
    if n < length:
        return none.astype(np.uint64), none, none, none, none
    m = n - anchor + 1
    at = np.arange(m)
    h = c.span_hash(data, at, at + anchor, c.EXACT_CODE)
    best, span = at, 1
    while span < w:  # leftmost smallest hash of ever wider spans
        step = min(span, w - span)
        left, right = best[:len(best) - step], best[step:]
        best = np.where(h[right] < h[left], right, left)
        span += step
    doc = np.repeat(np.arange(len(offsets) - 1, dtype=np.int32), np.diff(offsets))
    inside = doc[:n - length + 1] == doc[length - 1:]
    place = np.where(inside, best, -1)
    change = np.flatnonzero((place[1:] != place[:-1]) | (doc[1:n - length + 1] != doc[:n - length])) + 1
    first = np.concatenate([[0], change])
    last = np.concatenate([change, [len(place)]]) - 1
    keep = place[first] >= 0
    first, last = first[keep], last[keep]
    return h[place[first]], first, last, place[first], doc[first].astype(np.int64)


def _anchors(data, offsets):
    return pieces(data, offsets)[0]


def _batch(rows, schema=pa.schema(PIECE)):
    cols = list(zip(*rows)) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(cols, schema)], schema=schema)


def _joined(marked: list[tuple]) -> list[tuple]:
    """Marked runs ((did, rk, a), n) -> the fewest runs (did, rk, a, n)."""
    out: list[list] = []
    for (did, rk, a), n in sorted(marked):
        if out and out[-1][0] == did and out[-1][1] == rk and a <= out[-1][2] + out[-1][3]:
            out[-1][3] = max(out[-1][3], a + n - out[-1][2])
        else:
            out.append([did, rk, a, n])
    return out


def _suspects(seen, bits):
    """Pieces with a suspected anchor (kind 1), each different one once a task:
    that of the smallest place; the others are marked at once (kind 0)."""
    def run(batches):
        held: dict[bytes, tuple] = {}
        marked: list[tuple] = []

        def flush():
            out = _batch([(1, h, did, rk, a, n, off, seg) for seg, ((did, rk, a), h, n, off) in held.items()] +
                         [(0, 0, *run, 0, None) for run in _joined([(place, n) for place, _, n, _ in marked])])
            held.clear()
            marked.clear()
            return out

        for batch in c.chunks(batches):
            data, offsets = c.text_bytes(batch.column("text"))
            h, first, last, place, doc = pieces(data, offsets)
            keep = bloom.seen_twice(seen.value, h, bits)
            h, first, last, place, doc = (x[keep] for x in (h, first, last, place, doc))
            raw = data.tobytes()
            did, rk = (batch.column(x).to_numpy()[doc].tolist() for x in ("did", "rk"))
            for hh, d, r, start, s, e, p in zip(h.view(np.int64).tolist(), did, rk, (first - offsets[doc]).tolist(),
                                                first.tolist(), last.tolist(), place.tolist()):
                seg = raw[s:e + LENGTH]
                new = ((d, r, start), hh, e - s + 1, p - s)
                old = held.get(seg)
                if old is None:
                    held[seg] = new
                elif new[0] < old[0]:
                    held[seg] = new
                    marked.append(old)
                elif new[0] > old[0]:
                    marked.append(new)
                if len(held) + len(marked) > HELD:
                    yield flush()
        yield flush()
    return run


def repeats(group: np.ndarray, rank: np.ndarray, off: np.ndarray, segs: list[bytes], length: int = LENGTH) -> np.ndarray:
    """Which windows of which pieces are not the first of their kind.

    ``group``: the pieces' anchors, numbered; ``rank``: their places' order;
    ``off``: where in its bytes a piece has its anchor.  Returns a matrix
    (piece, window's distance before the anchor)."""
    n, back = len(segs), length - ANCHOR
    width = back + length
    table = np.zeros((width, n), np.int64)
    size = np.fromiter(map(len, segs), np.int64, n)
    at = np.repeat(back - off, size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    who = np.repeat(np.arange(n), size)
    table[:] = 256 + np.arange(n)  # beyond its ends a piece has symbols of its own
    table[at, who] = np.frombuffer(b"".join(segs), np.uint8)
    order = np.argsort(group, kind="stable")
    common = np.zeros(n + 1, np.int16)  # of each place of the order with the one before
    out = np.zeros((n, back + 1), bool)
    grp = group[order]
    edge = np.concatenate([[True], grp[1:] != grp[:-1]])
    common[:-1][~edge] = length  # the empty suffixes are equal
    for column in range(width - 1, -1, -1):
        symbol = table[column][order]
        move = np.lexsort((symbol, grp))  # stable: ties keep the order so far
        before = common
        same = np.zeros(n, bool)
        same[1:] = (symbol[move][1:] == symbol[move][:-1]) & (grp[move][1:] == grp[move][:-1])
        common = np.zeros(n + 1, np.int16)
        hit = np.flatnonzero(same)
        if len(hit):
            bounds = np.empty(2 * len(hit), np.int64)
            bounds[::2], bounds[1::2] = move[hit - 1] + 1, move[hit] + 1
            low = np.minimum.reduceat(before, bounds)[::2]
            common[hit] = np.minimum(low + 1, length)
        order = order[move]
        if column <= back:
            run = np.flatnonzero(common[:-1] < length)
            if len(run) < n:
                least = np.minimum.reduceat(rank[order], run)
                times = np.diff(np.append(run, n))
                late = rank[order] > np.repeat(least, times)
                out[order[late], back - column] = True
    return out


def _construct(length=LENGTH):
    """Pieces sorted by anchor -> the marked runs of windows."""
    def work(rows):
        h, did, rk, a, n, off, segs = rows
        group = np.cumsum(np.concatenate([[0], (h[1:] != h[:-1]).astype(np.int64)]))
        places = np.lexsort((a + off, rk, did))
        rank = np.empty(len(h), np.int64)
        same = np.concatenate([[False], (did[places][1:] == did[places][:-1]) & (rk[places][1:] == rk[places][:-1])
                               & ((a + off)[places][1:] == (a + off)[places][:-1])]) if len(h) else np.zeros(0, bool)
        rank[places] = np.cumsum(~same)
        late = repeats(group, rank, off, segs, length)
        # distance before the anchor -> window start, as runs
        piece, back = np.nonzero(late[:, ::-1])
        start = a[piece] + off[piece] - (late.shape[1] - 1) + back
        if not len(piece):
            return None
        new = np.concatenate([[True], (piece[1:] != piece[:-1]) | (start[1:] != start[:-1] + 1)])
        first = np.flatnonzero(new)
        count = np.diff(np.append(first, len(piece)))
        return pa.RecordBatch.from_arrays(
            [pa.array(did[piece[first]]), pa.array(rk[piece[first]]), pa.array(start[first]), pa.array(count.astype(np.int32))],
            names=["did", "rk", "a", "n"])

    def run(batches):
        held: list[pa.RecordBatch] = []
        size = 0

        def columns(table):
            return [table[x].to_numpy() for x in ("h", "did", "rk", "a", "n", "off")] + [table["seg"].to_pylist()]

        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size >= BATCH:
                table = pa.Table.from_batches(held).combine_chunks()
                h = table["h"].to_numpy()
                whole = int(np.searchsorted(h, h[-1]))  # the last anchor may go on
                if whole:
                    out = work(columns(table.slice(0, whole)))
                    if out is not None:
                        yield out
                held = table.slice(whole).to_batches()
                size = table.num_rows - whole
        if size:
            out = work(columns(pa.Table.from_batches(held).combine_chunks()))
            if out is not None:
                yield out
    return run


# hot anchors: window by window

WINDOW_DDL = "kind int, h long, did long, rk long, a long, n int, off int, seg binary"


def _single_windows(batches):
    """Every window of a piece as a row of its own, each different one once a
    task (``seg``: a 16-byte digest); the others are marked."""
    held: dict[bytes, tuple] = {}
    marked: list[tuple] = []

    def flush():
        out = _batch([(1, int.from_bytes(k[:8], "little", signed=True), *v, 1, 0, k) for k, v in held.items()] +
                     [(0, 0, *v, 1, 0, None) for v in marked])
        held.clear()
        marked.clear()
        return out

    for batch in batches:
        for did, rk, a, n, seg in zip(*(batch.column(x).to_pylist() for x in ("did", "rk", "a", "n", "seg"))):
            for i in range(n):
                k = hashlib.blake2b(seg[i:i + LENGTH], digest_size=16).digest()
                new, old = (did, rk, a + i), held.get(k)
                if old is None:
                    held[k] = new
                elif new < old:
                    held[k] = new
                    marked.append(old)
                elif new > old:
                    marked.append(new)
            if len(held) + len(marked) > HELD:
                yield flush()
    yield flush()


def _all_but_first(batches):
    """Rows sorted by (seg, did, rk, a): those behind the first of each seg."""
    last, first = None, None
    for batch in batches:
        rows = []
        for did, rk, a, seg in zip(*(batch.column(x).to_pylist() for x in ("did", "rk", "a", "seg"))):
            if seg != last:
                last, first = seg, (did, rk, a)
            elif (did, rk, a) != first:
                rows.append((did, rk, a, 1))
        cols = list(zip(*rows)) if rows else [()] * 4
        yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(cols, [pa.int64()] * 3 + [pa.int32()])],
                                         names=["did", "rk", "a", "n"])


def _cut(batches):
    for batch in c.chunks(batches):
        out: list[list] = [[], [], [], []]
        for text, runs in zip(batch.column("text").to_pylist(), batch.column("runs").to_pylist()):
            raw = (text or "").encode()
            spans: list[list[int]] = []
            for start, end in sorted((r["a"], r["a"] + r["n"] - 1 + LENGTH) for r in runs or ()):
                if spans and start <= spans[-1][1]:
                    spans[-1][1] = max(spans[-1][1], end)
                else:
                    spans.append([start, end])
            kept, at = [], 0
            for start, end in spans:
                kept.append(raw[at:start])
                at = end
            kept.append(raw[at:])
            for column, x in zip(out, (len(raw), sum(e - s for s, e in spans), len(spans), b"".join(kept))):
                column.append(x)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *(pa.array(x, k) for x, k in zip(out, [pa.int64()] * 3 + [pa.binary()]))],
            names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])


def dedup_substrings(docs: DataFrame, filter_bits: int = FILTER_BITS, hot: int = HOT) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept): every document without the
    bytes covered by a 100-byte string that also starts earlier."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumns({
        "did": F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))), "rk": F.xxhash64("doc_id", "text")})
    packed = spark.sparkContext.broadcast(bloom.twice_filter(rows, _anchors, filter_bits))
    found = c.written(rows.select("did", "rk", "text").mapInArrow(_suspects(packed, filter_bits), PIECE_DDL), "pieces")
    packed.destroy()
    sent = found.where("kind = 1")
    busy = c.written(sent.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > hot).select("h"), "hot-anchors")
    flags = [found.where("kind = 0").select("did", "rk", "a", "n")]
    cold = sent.join(F.broadcast(busy) if busy.count() < 100_000 else busy, "h", "left_anti")
    flags.append(cold.repartition("h").sortWithinPartitions("h").mapInArrow(_construct(), FLAG_DDL))
    single = c.written(sent.join(busy, "h", "left_semi").mapInArrow(_single_windows, WINDOW_DDL), "hot-windows")
    flags.append(single.where("kind = 0").select("did", "rk", "a", "n"))
    flags.append(single.where("kind = 1").repartition("seg").sortWithinPartitions("seg", "did", "rk", "a")
                 .mapInArrow(_all_but_first, FLAG_DDL))
    marked = flags[0].union(flags[1]).union(flags[2]).union(flags[3])
    runs = marked.groupBy("did", "rk").agg(F.collect_list(F.struct("a", "n")).alias("runs"))
    return rows.join(runs, ["did", "rk"], "left").select("doc_id", "text", "runs").mapInArrow(
        _cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")


@query("op10_suffix_dedup")
def op10(spark, sf_dir):
    return dedup_substrings(c.documents(spark, sf_dir)).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
