"""Substring dedup by repeated-phrase automata: removes every word of a repeated
window of 20 words but the first occurrence's.

The collection is dealt to shards by content.  In every window of 20 words the
6-word phrase with the smallest hash is its anchor; equal windows have equal anchors
at equal places, so a run of windows with one anchor (a piece, 34 words at most)
meets all its repeats in the shard of that anchor.  Two Bloom filters keep the pieces
whose anchor occurs once at home; the other pieces of all documents stream through
their shard.

A shard first confirms the recurring passages of a bounded run of pieces with whole
anchors: words get exact numbers, windows get exact numbers by doubling, and windows
that recur and always follow each other are joined to one passage.  The passages are
compiled to an Aho-Corasick automaton (words as its letters), all pieces stream
through it, and every occurrence of a passage but the earliest by (doc_id, start) is
marked.

Equal pieces of one task are sent once, the later ones marked at once.  An anchor
with more than ``HOT`` different pieces (the edges of a passage that stands in many
documents) would be one task: its pieces are dealt window by window, by the hash of
the whole window, to shards that work the same way.

The filter has 2**20 to 2**29 bits (64 MB), one for 3 bytes of text; when a corpus
outgrows it more pieces travel and the result stays the same.

Defined cases: null or empty texts have no words and an empty rest; texts under 20
words keep all; a text of any length is one row; rows equal in doc_id and text are one
document and keep the same words; of rows that share a doc_id only, the order is
that of a hash of the text; a null doc_id comes first; an empty table gives no rows;
further columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellar.llm import bloom
from cellar.llm import common as c
from cellar.llm.registry import query

LENGTH = 20
ANCHOR = 6
LEAST_BITS, MOST_BITS = 20, 29
#: Different pieces that a task holds before it sends them on.
HELD = 100_000
#: Pieces that one automaton is made of and reads, and the most of one anchor; 32,000
#: pieces of 34 words have fewer different words than an automaton has letters.
BATCH = HOT = 16_000
PIECE = pa.schema([("kind", pa.int32()), ("h", pa.int64()), ("did", pa.int64()), ("rk", pa.int64()),
                   ("a", pa.int64()), ("n", pa.int32()), ("seg", pa.string())])
PIECE_DDL = "kind int, h long, did long, rk long, a long, n int, seg string"
RUN_DDL = "did long, rk long, a long, n int"
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def pieces(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH, anchor: int = ANCHOR):
    """Words (start, end, document) and, for each run of windows with one anchor, the
    anchor's hash, the first window and the last (numbers of their first words)."""
    starts, ends, docs = c.words_of(data, offsets)
    n, width = len(starts), length - anchor + 1
    none = np.zeros(0, np.int64)
    if n < length:
        return starts, ends, docs, none.astype(np.uint64), none, none
    words = c.span_hash(data, starts, ends, c.EXACT_CODE)
    odd = c.powers(anchor + 1, 0xD1342543DE82EF95)[1:]
    h = np.zeros(n - anchor + 1, np.uint64)
    for j in range(anchor):
        h += words[j:n - anchor + 1 + j] * odd[j]
    h = c.mix(h)
    best, span = np.arange(len(h)), 1
    while span < width:  # the leftmost smallest of ever wider spans
        step = min(span, width - span)
        left, right = best[:len(best) - step], best[step:]
        best = np.where(h[right] < h[left], right, left)
        span += step
    place = np.where(docs[:n - length + 1] == docs[length - 1:], best, -1)
    heads = np.flatnonzero(np.concatenate([[True], (place[1:] != place[:-1]) |
                                           (docs[1:len(place)] != docs[:len(place) - 1])]))
    last = np.append(heads[1:], len(place)) - 1
    keep = place[heads] >= 0
    return starts, ends, docs, h[place[heads[keep]]], heads[keep], last[keep]


def _anchors(data, offsets):
    return pieces(data, offsets)[3]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * len(PIECE)
    return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(columns, PIECE)], schema=PIECE)


class _Held:
    """Pieces on their way: each different text once, at its smallest place; the other
    places are marked."""

    def __init__(self):
        self.first: dict[bytes, tuple] = {}
        self.late: list[tuple] = []

    def add(self, seg, place: tuple, h: int, n: int) -> None:
        old = self.first.get(seg)
        if old is None or place < old[0]:
            self.first[seg] = (place, h, n)
            if old is not None:
                self.late.append((*old[0], old[2]))
        elif place > old[0]:
            self.late.append((*place, n))

    def full(self) -> bool:
        return len(self.first) + len(self.late) > HELD

    def flush(self) -> pa.RecordBatch:
        out = _batch([(1, h, *place, n, seg) for seg, (place, h, n) in self.first.items()] +
                     [(0, 0, *run, None) for run in _joined(self.late)])
        self.__init__()
        return out


def _joined(runs: list[tuple]) -> Iterator[tuple]:
    """Runs of windows (did, rk, a, n) -> the fewest."""
    now = None
    for did, rk, a, n in sorted(runs):
        if now and now[0] == did and now[1] == rk and a <= now[2] + now[3]:
            now[3] = max(now[3], a + n - now[2])
        else:
            if now:
                yield tuple(now)
            now = [did, rk, a, n]
    if now:
        yield tuple(now)


def _suspects(seen, bits):
    """The pieces whose anchor may occur twice (kind 1) and the runs marked at once (0)."""
    def run(batches):
        held = _Held()
        for batch in c.chunks(batches):
            data, offsets = c.text_bytes(batch.column("text"))
            starts, ends, docs, h, first, last = pieces(data, offsets)
            keep = bloom.seen_twice(seen.value, h, bits)
            h, first, last = h[keep], first[keep], last[keep]
            # one blank between two words
            blank = c.SPACE[data]
            keep = ~blank
            keep[1:] |= blank[1:] & ~blank[:-1]
            low = data[keep]
            low[c.SPACE[low]] = 32
            raw = low.tobytes()
            place = np.concatenate([[0], np.cumsum(keep)])
            doc = docs[first]
            word0 = np.searchsorted(docs, doc)
            did, rk = (batch.column(x).to_numpy()[doc].tolist() for x in ("did", "rk"))
            for hh, d, r, a, n, s, e in zip(h.view(np.int64).tolist(), did, rk, (first - word0).tolist(),
                                            (last - first + 1).tolist(), place[starts[first]].tolist(),
                                            place[ends[last + LENGTH - 1]].tolist()):
                held.add(raw[s:e], (d, r, a), hh, n)
                if held.full():
                    yield held.flush()
        yield held.flush()
    return run


def _by_window(batches):
    """Pieces -> their single windows, keyed by the hash of the whole window."""
    held = _Held()
    for batch in batches:
        for did, rk, a, n, seg in zip(*(batch.column(x).to_pylist() for x in ("did", "rk", "a", "n", "seg"))):
            words = seg.encode().split(b" ")
            for i in range(n):
                held.add(b" ".join(words[i:i + LENGTH]), (did, rk, a + i), 0, 1)
            if held.full():
                yield held.flush()
    yield held.flush()


def passages(codes: np.ndarray, piece: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """The recurring passages of some pieces (``codes``: their words' numbers, one after
    the other; ``piece``: the piece of each): (first word, number of words) of one
    occurrence of each.  A passage is a longest chain of windows that recur and
    always stand one word apart, so every occurrence of one of its windows belongs to
    an occurrence of the whole passage."""
    none = np.zeros(0, np.int64)
    if len(codes) < length:
        return none, none
    # exact numbers of windows: 1, 2, 4 ... words, then the rest of the length
    number, size, known = codes.astype(np.int64), 1, {1: codes.astype(np.int64)}

    def pair(a: int, b: int) -> np.ndarray:
        many = len(codes) - a - b + 1
        right = known[b][a:a + many]
        return c.numbered(known[a][:many] * (int(known[b].max()) + 1) + right)[0].astype(np.int64)

    while 2 * size <= length:
        known[2 * size] = pair(size, size)
        size *= 2
    while size < length:
        step = max(x for x in known if x <= length - size)
        known[size + step] = pair(size, step)
        size += step
    inside = piece[:len(codes) - length + 1] == piece[length - 1:]
    at = np.flatnonzero(inside)
    if not len(at):
        return none, none
    number, many = c.numbered(known[length][at])
    times = np.bincount(number, minlength=many)
    # what stands one word on, -1 where the piece ends
    nexts = np.full(len(at), -1)
    follows = (at[1:] == at[:-1] + 1) & (piece[at[1:]] == piece[at[:-1]])
    nexts[:-1][follows] = number[1:][follows]
    befores = np.full(len(at), -1)
    befores[1:][follows] = number[:-1][follows]

    def only(x):
        low, high = np.full(many, many), np.full(many, -1)
        np.minimum.at(low, number, x)
        np.maximum.at(high, number, x)
        return np.where(low == high, high, -1)

    after, before = only(nexts), only(befores)
    linked = (after >= 0) & (before[after] == np.arange(many))
    inward = np.zeros(many, bool)
    inward[after[linked]] = True
    first = np.zeros(many, np.int64)
    first[number[::-1]] = np.arange(len(at))[::-1]
    heads = first[(times > 1) & ~inward]
    ends = np.flatnonzero(~linked[number])
    last = ends[np.searchsorted(ends, heads)]
    return at[heads], last - heads + length


def _letters(codes: np.ndarray) -> np.ndarray:
    """Word numbers as code points, from 1 on and without the surrogates."""
    out = codes.astype(np.uint32) + np.uint32(1)
    out[out >= 0xD800] += np.uint32(0x800)
    return out


def locate(did, rk, a, segs: pa.Array) -> pa.RecordBatch | None:
    """All occurrences of the passages that recur in these pieces but the earliest of
    each, as runs of windows."""
    data, offsets = c.text_bytes(segs)
    starts, ends, piece = c.words_of(data, offsets)
    codes = c.coded(data, starts, ends).indices.to_numpy()
    begin, words = passages(codes, piece)
    if not len(begin):
        return None
    # the pieces as one text of one letter a word, with a zero behind each piece
    letters = np.zeros(len(codes) + len(a), np.uint32)
    letters[np.arange(len(codes)) + piece] = _letters(codes)
    text = letters.tobytes().decode("utf-32-le")
    automaton = ahocorasick.Automaton()
    at = begin + piece[begin]
    for i, (s, e) in enumerate(zip(at.tolist(), (at + words).tolist())):
        automaton.add_word(text[s:e], i)
    automaton.make_automaton()
    found = np.fromiter(chain.from_iterable(automaton.iter(text)), np.int64).reshape(-1, 2)
    which = found[:, 1]
    start = found[:, 0] + 1 - words[which]
    first_letter = np.searchsorted(piece, np.arange(len(a))) + np.arange(len(a))
    of = np.searchsorted(first_letter, start, "right") - 1
    did, rk, place = did[of], rk[of], a[of] + start - first_letter[of]
    order = np.lexsort((place, rk, did, which))
    did, rk, place, which = did[order], rk[order], place[order], which[order]
    head = np.concatenate([[True], which[1:] != which[:-1]])
    lead = np.maximum.accumulate(np.where(head, np.arange(len(head)), 0))
    late = (did != did[lead]) | (rk != rk[lead]) | (place != place[lead])
    return pa.RecordBatch.from_arrays(
        [pa.array(did[late]), pa.array(rk[late]), pa.array(place[late]),
         pa.array((words[which[late]] - LENGTH + 1).astype(np.int32))], names=["did", "rk", "a", "n"])


def _shard(batches):
    """Pieces sorted by anchor -> late runs, ``BATCH`` pieces or more at a time."""
    held, size = [], 0

    def work(table):
        return locate(*(table[x].to_numpy() for x in ("did", "rk", "a")), table["seg"].combine_chunks())

    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size >= BATCH:
            table = pa.Table.from_batches(held).combine_chunks()
            h = table["h"].to_numpy()
            at = 0
            while size - at >= BATCH:
                stop = at + BATCH
                whole = int(np.searchsorted(h, h[stop - 1]))  # this anchor may go on
                if whole <= at:  # it fills the run: wait for its end
                    whole = int(np.searchsorted(h, h[stop - 1], "right"))
                    if whole == size:
                        break
                out = work(table.slice(at, whole - at))
                if out is not None:
                    yield out
                at = whole
            held = table.slice(at).to_batches()
            size -= at
    if size:
        out = work(pa.Table.from_batches(held).combine_chunks())
        if out is not None:
            yield out


def _cut(batches):
    for batch in c.chunks(batches):
        out: list[list] = [[], [], []]
        for text, runs in zip(batch.column("text").to_pylist(), batch.column("runs").to_pylist()):
            words = _WORD.findall((text or "").encode())
            kept, at = [], 0
            for _, _, a, n in _joined([(0, 0, r["a"], r["n"] + LENGTH - 1) for r in runs or ()]):
                kept.extend(words[at:a])
                at = a + n
            kept.extend(words[at:])
            for column, x in zip(out, (len(words), len(words) - len(kept), b" ".join(kept).decode())):
                column.append(x)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *(pa.array(x, k) for x, k in zip(out, (pa.int64(), pa.int64(), pa.string())))],
            names=["doc_id", "n_words", "n_removed", "kept_text"])


def dedup_phrases(docs: DataFrame, filter_bits: int | None = None, hot: int = HOT) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_text): every document without the words
    covered by a window of 20 words that also starts earlier; the words that stay are
    joined by one blank."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumns({
        "did": F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))), "rk": F.xxhash64("doc_id", "text")})
    if filter_bits is None:
        size = rows.agg(F.sum(F.octet_length("text")).alias("n")).first().n or 0
        filter_bits = min(MOST_BITS, max(LEAST_BITS, int(size // 3).bit_length()))
    packed = spark.sparkContext.broadcast(bloom.twice_filter(rows, _anchors, filter_bits))
    found = c.written(rows.select("did", "rk", "text").mapInArrow(_suspects(packed, filter_bits), PIECE_DDL), "phrases")
    packed.destroy()
    sent = found.where("kind = 1")
    busy = c.written(sent.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > hot).select("h"), "hot-anchors")
    few = busy.limit(100_001).count() <= 100_000
    cold = sent.join(F.broadcast(busy) if few else busy, "h", "left_anti")
    single = c.written(sent.join(F.broadcast(busy) if few else busy, "h", "left_semi")
                       .mapInArrow(_by_window, PIECE_DDL).withColumn("h", F.xxhash64("seg")), "hot-windows")
    late = [x.where("kind = 0").select("did", "rk", "a", "n") for x in (found, single)]
    late += [x.select("h", "did", "rk", "a", "seg").repartition("h").sortWithinPartitions("h").mapInArrow(_shard, RUN_DDL)
             for x in (cold, single.where("kind = 1"))]
    runs = late[0].unionAll(late[1]).unionAll(late[2]).unionAll(late[3]).groupBy("did", "rk").agg(
        F.collect_list(F.struct("a", "n")).alias("runs"))
    return rows.join(runs, ["did", "rk"], "left").select("doc_id", "text", "runs").mapInArrow(
        _cut, "doc_id long, n_words long, n_removed long, kept_text string")


ORACLE = r"""
WITH d AS (SELECT row_number() OVER (ORDER BY doc_id) AS r, doc_id,
                  regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (SELECT r, i, list_slice(w, i, i + 19) AS g
            FROM d, unnest(range(1, len(w) - 18)) AS t(i) WHERE len(w) >= 20),
late AS (SELECT r, i FROM windows QUALIFY row_number() OVER (PARTITION BY g ORDER BY r, i) > 1),
words AS (SELECT r, i, w[i] AS word FROM d, unnest(range(1, len(w) + 1)) AS t(i)),
marked AS (SELECT words.r, words.i, word, coalesce(max(CASE WHEN late.i IS NOT NULL THEN 1 ELSE 0 END)
             OVER (PARTITION BY words.r ORDER BY words.i ROWS BETWEEN 19 PRECEDING AND CURRENT ROW), 0) AS gone
           FROM words LEFT JOIN late ON late.r = words.r AND late.i = words.i),
kept AS (SELECT r, count(*) AS n_words, sum(gone) AS n_removed,
                coalesce(string_agg(CASE WHEN gone = 0 THEN word END, ' ' ORDER BY i), '') AS kept FROM marked GROUP BY r)
SELECT d.doc_id, CAST(coalesce(n_words, 0) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r)
"""


@query("op13_phrase_automata", ORACLE)
def op13(spark, sf_dir):
    return dedup_phrases(c.documents(spark, sf_dir)).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))
