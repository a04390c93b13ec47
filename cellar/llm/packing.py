"""Best-fit packing of token sequences.

Documents are cut into pieces of at most ``capacity`` tokens and range-sorted by
length; the sort gives every piece its rank among pieces of its length.  The
packing then goes in supersteps from the longest length down.  In each, the
pieces of one length meet their successor, the tightest gap that holds them;
pieces and gaps are paired by rank, so no two claim one place; the gaps shrink
and the next length follows.  Pieces of one length are interchangeable, and so
are bins with the same gap, so a superstep moves runs of bins, not single ones:
the state is bounded by the capacity (at most ``capacity`` lengths and as many
gap sizes), whatever the number of documents.  Row-level work (tokens, sort,
ranks, places) is distributed; a third of all pieces may share one length, as
the sort key goes on with the document.

Defined cases: a null or empty text is its end token alone; repeated rows are
packed once each; a null doc_id is packed; ties are broken by (doc_id, piece,
start, digest); an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import bisect
import sys
import unicodedata
import zlib
from array import array
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellar.llm import common as c
from cellar.llm.registry import query

CAPACITY = 4096
END_ID = 1
#: A worker keeps the ids of up to twice as many words and word parts.
CACHED = 150_000
#: Longer words are not cached.
LONG = 64
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


class Recent(dict):
    """A cache in two generations: a full one becomes the old one, from which
    entries in use come back, and the one before is forgotten."""

    def __init__(self, make):
        super().__init__()
        self.make, self.old = make, {}

    def __missing__(self, key):
        if len(key) > LONG:  # not kept, so that the cache is bounded in bytes too
            return self.make(key)
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= CACHED:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


class WordIds:
    """Word (no ASCII white space in it) -> its token ids, as the bytes of
    unsigned 32-bit numbers.  The tokenizer drops white space and never joins
    across it, so a text's ids are those of its words, one after the other.  A text
    in which an added token (such as a literal end-of-text mark) may stand goes
    through the tokenizer whole."""

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.added = regex.compile("|".join(map(regex.escape, added)).encode() or b"(?!)", regex.I).search
        # fixed values: how the tokenizer file splits, and its letters for bytes
        self.split = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+").findall
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        other = [b for b in range(256) if b not in plain]
        self.letters = dict(zip(plain, plain)) | {b: 256 + i for i, b in enumerate(other)}
        self.words, self.parts = Recent(self.word), Recent(self.part)

    def word(self, word: bytes) -> bytes:
        if word.isalpha():
            return self.parts[word.lower().decode()]
        if word[-1] in b".,;:|!?" and word[:-1].isalpha():
            return self.parts[word[:-1].lower().decode()] + self.parts[chr(word[-1])]
        text = word.decode()
        if max(text) < "ɐ" and "İ" not in text and min(text) > " " and "\x7f" not in text:
            if not text.isascii():
                text = unicodedata.normalize("NFC", text)
            return b"".join(map(self.parts.__getitem__, self.split(text.lower())))
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def text(self, text: str) -> bytes:
        raw = text.encode()
        if self.added(raw):
            return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        return b"".join(map(self.words.__getitem__, raw.split()))

    def part(self, text: str) -> bytes:
        spelled = text if text.isascii() else text.encode().decode("latin-1").translate(self.letters)
        return array("I", [t.id for t in self.model.tokenize(spelled)]).tobytes()


def word_ids(path: str) -> WordIds:
    """One per worker process, kept between tasks."""
    kept = vars(sys).setdefault("_cellar_word_ids", {})
    if path not in kept:
        kept[path] = WordIds(path)
    return kept[path]


def _pieces(tokenizer: str, capacity: int, with_ids: bool):
    def run(batches):
        ids_of = word_ids(tokenizer).text
        end = np.array([END_ID], np.uint32).tobytes()
        for batch in c.chunks(batches):
            out: list[list] = [[], [], [], [], [], []]
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                ids = ids_of(text or "") + end
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at:at + 4 * capacity]
                    for column, x in zip(out, (doc, piece, at // 4, len(part) // 4, zlib.crc32(part),
                                               np.frombuffer(part, np.int32) if with_ids else None)):
                        column.append(x)
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(out, kinds)][:6 if with_ids else 5],
                                             names=names[:6 if with_ids else 5])
    return run


def cut_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]) of every document."""
    return docs.select("doc_id", "text").mapInArrow(
        _pieces(tokenizer, capacity, with_ids), PIECES + (", ids array<int>" if with_ids else ""))


def _local_ranks(batches):
    """Adds the task's number and the rank among its rows of the same length."""
    part, seen = TaskContext.get().partitionId(), defaultdict(int)
    for batch in batches:
        lengths = batch.column("length").to_numpy()
        ranks = np.zeros(len(lengths), np.int64)
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(lengths)) + 1, [len(lengths)]])
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            if b > a:
                size = int(lengths[a])
                ranks[a:b] = np.arange(b - a) + seen[size]
                seen[size] += b - a
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(np.full(len(lengths), part, np.int32)), pa.array(ranks)],
            names=[*batch.schema.names, "part", "local_rank"])


def best_fit(counts: dict[int, int], capacity: int) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """Supersteps of best fit over run-lengths.  Returns runs (length, first
    rank, first bin, pieces a bin, offset) and the number of bins: the pieces of
    that length from that rank on fill the bins from that number on, so many in
    each, from that offset on, up to the next run's first rank."""
    runs, n_bins = [], 0
    gaps: dict[int, list[tuple[int, int]]] = defaultdict(list)  # gap -> runs of (first bin, bins)
    sizes: list[int] = []  # the gaps that have bins, ascending

    def put(gap: int, first: int, bins: int) -> None:
        if gap and bins:
            if not gaps[gap]:
                bisect.insort(sizes, gap)
            gaps[gap].append((first, bins))

    for size in sorted(counts, reverse=True):
        rank, left = 0, counts[size]
        while left:
            at = bisect.bisect_left(sizes, size)  # successor: the tightest gap that holds it
            if at < len(sizes):
                gap = sizes[at]
                first, bins = gaps[gap].pop()
                if not gaps[gap]:
                    sizes.pop(at)
            else:
                gap, first = capacity, n_bins
                bins = -(-left // (capacity // size))
                n_bins += bins
            each = gap // size
            full = min(bins, left // each)
            if full:
                runs.append((size, rank, first, each, capacity - gap))
                rank, left = rank + full * each, left - full * each
                put(gap - each * size, first, full)
            first, bins = first + full, bins - full
            if left and bins:  # the last few share one bin
                runs.append((size, rank, first, each, capacity - gap))
                put(gap - left * size, first, 1)
                rank, left, first, bins = rank + left, 0, first + 1, bins - 1
            put(gap, first, bins)
    return runs, n_bins


def _place(plan):
    def run(batches):
        key, sizes, ranks, bins, each, offsets = plan.value
        for batch in batches:
            size = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy()
            at = np.searchsorted(key, size * (1 << 44) + rank, "right") - 1
            within = rank - ranks[at]
            names = [n for n in batch.schema.names if n != "rank"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in names), pa.array(bins[at] + within // each[at]),
                 pa.array(offsets[at] + within % each[at] * size)], names=[*names, "sequence_id", "offset"])
    return run


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Every piece with its place: ``sequence_id`` and ``offset``."""
    spark = pieces.sparkSession
    pieces = c.written(pieces, "pieces")  # the range sort reads its input twice
    columns = pieces.columns
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    tie = [x for x in ("doc_id", "piece", "start", "ids_crc32") if x in columns]
    ranked = c.written(
        pieces.repartitionByRange("length", *tie).sortWithinPartitions("length", *tie)
        .mapInArrow(_local_ranks, f"{ddl}, part int, local_rank long"), "ranked-pieces")
    # at most one row for each task and each length a task holds: a task holds a
    # range of lengths, so tasks + capacity rows
    held = ranked.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n")).orderBy("length", "part").collect()
    counts: dict[int, int] = defaultdict(int)
    before = []
    for r in held:
        before.append((r.length, r.part, counts[r.length]))
        counts[r.length] += r.n
    runs, _ = best_fit(counts, capacity)
    table = np.array(sorted(runs) or [(0, 0, 0, 1, 0)], np.int64).T
    plan = spark.sparkContext.broadcast((table[0] * (1 << 44) + table[1], *table))
    offsets = spark.createDataFrame(before, "length long, part int, before long")
    placed = ranked.join(F.broadcast(offsets), ["length", "part"]).select(
        *columns, (F.col("before") + F.col("local_rank")).alias("rank"))
    return placed.mapInArrow(_place(plan), f"{ddl}, sequence_id long, offset long")


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


@query("op5_best_fit_packing")
def op5(spark, sf_dir):
    return pack(cut_pieces(c.documents(spark, sf_dir), default_tokenizer()))
