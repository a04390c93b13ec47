"""Phrase collocation mining by prefix-free parsing.

Pass 1 parses every text.  A piece (the words between two punctuation marks) is cut
wherever the hash of a window of ``OVERLAP`` words is a multiple of ``PERIOD``, so
equal passages are cut alike whatever stands around them; a chunk reaches
``OVERLAP`` words into the next one.  Spark groups equal chunks to a dictionary with
the frequency of each in the parse.  An n-gram starts in exactly one chunk (the words
before the next cut are that chunk's own, those behind it only complete n-grams),
so the counts of the corpus are the weighted counts inside distinct chunks, and no
overlap is counted twice.

The dictionary is then read once for each length.  Inside a run of chunks n-grams get
exact numbers, those of length n from (number of the first n - 1 words, last word).
Before n-grams of 2 to 4 words travel, their hashes are counted in cells, summed by
shard; a cell below ``min_count`` rules out all its n-grams, and a longer n-gram is
counted only if both shorter ones inside it passed.  What is left is grouped by its
text and counted exactly.  A cell table too small for the corpus lets more n-grams
travel, with the same result.  There is a cell for four words of the corpus, at most
2**29 (a broadcast of 64 MB of bits).

Defined cases: a null or empty text has no words; a null lang is ``und``; a text of
any length is one row and parsed whole; repeated rows count each; equal scores are
ordered by count, then by the bytes of the phrase; an empty table gives no rows;
other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cellar.llm import common as c
from cellar.llm.registry import query

MOST_WORDS = 5
OVERLAP = MOST_WORDS - 1
#: A cut falls on one window in this many.
PERIOD = 16
#: Text of the dictionary that is numbered at once.
RUN_BYTES = 4 << 20
SHARD_BITS = 16
#: A task passes its cells on when it holds this many.
FLUSH_CELLS = 1 << 22
LEAST_BITS, MOST_BITS = 20, 29

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] = _LOWER[97:123]
_BREAK = np.zeros(256, bool)
_BREAK[[ord(x) for x in ".,;:!?"] + [10, 11, 12, 13]] = True
_BLANK = np.zeros(256, bool)
_BLANK[[9, 32]] = True
_ODD = c.powers(MOST_WORDS + 2, 0xD1342543DE82EF95)[1:]

CHUNK_DDL = "lang string, own int, chunk string"
ROW_DDL = "lang string, words int, phrase string, n long, shard int, cells binary, counts binary"
ROW = pa.schema([("lang", pa.string()), ("words", pa.int32()), ("phrase", pa.string()), ("n", pa.int64()),
                 ("shard", pa.int32()), ("cells", pa.binary()), ("counts", pa.binary())])


# --- pass 1: texts -> chunks ----------------------------------------------------

def parse(data: np.ndarray, offsets: np.ndarray, period: int = PERIOD):
    """(bytes, chunk start, chunk end, own words, document) of each chunk; the bytes
    have one blank between the words of a piece and A-Z lower-cased."""
    blank = _BLANK[data]
    solid = ~(blank | _BREAK[data])
    keep = solid.copy()
    keep[1:] |= blank[1:] & solid[:-1]
    place = np.concatenate([[0], np.cumsum(keep)])
    marks = np.concatenate([[0], np.cumsum(~(solid | blank))])
    low = _LOWER[data[keep]]
    low[~solid[keep]] = 32
    starts, ends, docs = c.runs_of(solid, offsets)
    n = len(starts)
    if not n:
        none = np.zeros(0, np.int64)
        return low, none, none, none, none
    head = np.ones(n, bool)
    head[1:] = (docs[1:] != docs[:-1]) | (marks[starts[1:]] != marks[starts[:-1]])
    begin = np.flatnonzero(head)
    piece_end = np.repeat(np.append(begin[1:], n), np.diff(np.append(begin, n)))
    if n >= OVERLAP:
        words = c.span_hash(data, starts, ends)
        window = np.zeros(n - OVERLAP + 1, np.uint64)
        for j in range(OVERLAP):
            window += words[j:n - OVERLAP + 1 + j] * _ODD[j]
        cut = c.mix(window) % np.uint64(period) == 0
        head[:len(cut)] |= cut & (np.arange(len(cut)) + OVERLAP <= piece_end[:len(cut)])
    first = np.flatnonzero(head)
    after = np.append(first[1:], n)
    last = np.minimum(after + OVERLAP, piece_end[first])
    return low, place[starts[first]], place[ends[last - 1]], after - first, docs[first]


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in c.chunks(batches):
        low, start, end, own, doc = parse(*c.text_bytes(batch.column("text")))
        raw = low.tobytes()
        yield pa.RecordBatch.from_arrays(
            [batch.column("lang").take(pa.array(doc)), pa.array(own.astype(np.int32)),
             pa.array([raw[s:e] for s, e in zip(start.tolist(), end.tolist())], pa.binary()).cast(pa.string())],
            names=["lang", "own", "chunk"])


# --- passes over the dictionary -------------------------------------------------

def _runs(batches: Iterator[pa.RecordBatch], limit: int = RUN_BYTES) -> Iterator[pa.Table]:
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.column("chunk").nbytes
        if size >= limit:
            yield pa.Table.from_batches(held).combine_chunks()
            held, size = [], 0
    if size:
        yield pa.Table.from_batches(held).combine_chunks()


class Grams:
    """The n-grams that start in the own words of a run of chunks, length by length."""

    def __init__(self, run: pa.Table):
        one = lambda x: run[x].chunk(0) if run[x].num_chunks else run[x].combine_chunks()
        data, offsets = c.text_bytes(one("chunk"))
        self.raw = data.tobytes()
        self.starts, self.ends, docs = c.words_of(data, offsets)
        coded = c.coded(data, self.starts, self.ends)
        self.code = coded.indices.to_numpy().astype(np.int64)
        words, word_offsets = c.text_bytes(coded.dictionary.cast(pa.string()))
        self.total = len(coded.dictionary)
        self.word_hash = c.span_hash(words, word_offsets[:-1], word_offsets[1:], c.EXACT_CODE)
        langs = pc.dictionary_encode(one("lang"))
        self.langs = langs.dictionary
        text, at = c.text_bytes(self.langs)
        self.lang_hash = c.mix(c.span_hash(text, at[:-1], at[1:], c.EXACT_CODE))
        self.lang = langs.indices.to_numpy()[docs]
        first = np.searchsorted(docs, np.arange(len(offsets) - 1))
        last = np.append(first[1:], len(docs))
        #: words from here to the end of the chunk
        self.left = last[docs] - np.arange(len(docs))
        self.at = np.flatnonzero(np.arange(len(docs)) - first[docs] < one("own").to_numpy()[docs])
        self.weight = one("freq").to_numpy()[docs]
        self.length = 0
        self.number = self.lang.astype(np.int64)
        self.passed = np.ones(len(docs), bool)

    def extend(self) -> None:
        """From n - 1 to n words: where one starts, its number, and of each different
        one its first place, hash and weight.  Only where the n - 1 words from here
        and those from the next word passed (those behind the chunk's own words count
        as passed)."""
        self.length += 1
        n = self.length
        at = self.at[self.left[self.at] >= n]
        if n > 1:
            at = at[self.passed[at] & self.passed[at + 1]]
        key = self.number[at] * self.total + self.code[at + n - 1]
        ids, many = c.numbered(key)
        self.at, self.ids = at, ids
        self.number[at] = ids
        self.first = np.zeros(many, np.int64)
        self.first[ids[::-1]] = at[::-1]
        self.count = np.bincount(ids, weights=self.weight[at], minlength=many).astype(np.int64)
        h = self.lang_hash[self.lang[self.first]] if many else np.zeros(0, np.uint64)
        for j in range(n):
            h = h + self.word_hash[self.code[self.first + j]] * _ODD[j]
        self.hash = c.mix(h + np.uint64(n))
        self.good = np.ones(many, bool)

    def keep(self, good: np.ndarray) -> None:
        """Only n-grams whose cell passed go on."""
        self.good = good
        own = good[self.ids]
        self.passed[self.at[~own]] = False
        self.at = self.at[own]

    def rows(self) -> pa.RecordBatch:
        places = self.first[self.good]
        text = [self.raw[s:e] for s, e in zip(self.starts[places].tolist(),
                                              self.ends[places + self.length - 1].tolist())]
        return _batch(len(places), lang=self.langs.take(pa.array(self.lang[places])),
                      words=np.full(len(places), self.length, np.int32),
                      phrase=pa.array(text, pa.binary()).cast(pa.string()), n=self.count[self.good])


def _batch(rows: int, **given) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [(given[f.name] if isinstance(given[f.name], pa.Array) else pa.array(given[f.name], f.type))
         if f.name in given else pa.nulls(rows, f.type) for f in ROW], schema=ROW)


def _cell(h: np.ndarray, bits: int) -> np.ndarray:
    return (h >> np.uint64(64 - bits)).astype(np.uint32)


def _cell_rows(cells: list[np.ndarray], counts: list[np.ndarray], bits: int, least: int) -> pa.RecordBatch:
    """Counts of cells as rows by shard; a count is cut at ``least``, where it passes
    whatever the other tasks add."""
    cell, number = np.concatenate(cells), np.concatenate(counts)
    order = np.argsort(cell, kind="stable")
    cell = cell[order]
    heads = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]]))
    number = np.minimum(np.add.reduceat(number[order], heads), least).astype(_count_type(least))
    cell = cell[heads]
    shard_bits = min(SHARD_BITS, bits)
    shard = cell >> np.uint32(shard_bits)
    cuts = np.flatnonzero(np.diff(shard)) + 1
    inside = (cell & np.uint32((1 << shard_bits) - 1)).astype(np.uint16)
    return _batch(len(cuts) + 1, shard=shard[np.concatenate([[0], cuts])].astype(np.int32),
                  cells=[x.tobytes() for x in np.split(inside, cuts)],
                  counts=[x.tobytes() for x in np.split(number, cuts)])


def _count_type(least: int):
    return np.uint8 if least < 1 << 8 else np.uint32


def _level(n: int, filters, bits: int, least: int):
    """Dictionary rows -> the n-grams of ``n`` words that passed (the last length but
    one also gives the last one's), and the cells of those of n + 1 words."""
    def run(batches):
        cells, counts, size = [], [], 0
        for table in _runs(batches):
            grams = Grams(table)
            for length in range(1, n + 1):
                grams.extend()
                if length > 1:
                    packed, cell = filters[length - 2].value, _cell(grams.hash, bits)
                    grams.keep((packed[cell >> np.uint32(3)] >> (cell & np.uint32(7)).astype(np.uint8)
                                & np.uint8(1)).astype(bool))
            yield grams.rows()
            grams.extend()
            if n + 1 == MOST_WORDS:
                yield grams.rows()
                continue
            cells.append(_cell(grams.hash, bits))
            counts.append(grams.count)
            size += len(cells[-1])
            if size > FLUSH_CELLS:
                yield _cell_rows(cells, counts, bits, least)
                cells, counts, size = [], [], 0
        if size:
            yield _cell_rows(cells, counts, bits, least)
    return run


def _sum_cells(bits: int, least: int):
    """Cell rows sorted by shard -> for each shard the bits of the cells that reach ``least``."""
    def run(batches):
        shard, total = None, None
        done = lambda: pa.RecordBatch.from_arrays(
            [pa.array([shard], pa.int32()), pa.array([np.packbits(total >= least, bitorder="little").tobytes()], pa.binary())],
            names=["shard", "cells"])
        for batch in batches:
            for s, cell, count in zip(*(batch.column(x).to_pylist() for x in ("shard", "cells", "counts"))):
                if s != shard:
                    if shard is not None:
                        yield done()
                    shard, total = s, np.zeros(1 << min(SHARD_BITS, bits), np.int64)
                total[np.frombuffer(cell, np.uint16)] += np.frombuffer(count, _count_type(least))
        if shard is not None:
            yield done()
    return run


def _filter(cells: DataFrame, bits: int, least: int) -> np.ndarray:
    """The bits of all cells, 2**bits of them."""
    merged = (cells.select("shard", "cells", "counts").repartition("shard").sortWithinPartitions("shard")
              .mapInArrow(_sum_cells(bits, least), "shard int, cells binary"))
    step = (1 << min(SHARD_BITS, bits)) >> 3
    packed = np.zeros(1 << (bits - 3), np.uint8)
    for row in merged.collect():  # 64 MB at most
        packed[row.shard * step:(row.shard + 1) * step] = np.frombuffer(row.cells, np.uint8)
    return packed


def dictionary(docs: DataFrame) -> DataFrame:
    """(lang, own, chunk, freq): the distinct chunks of the parse."""
    lang = (F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string"))
    return (docs.select(F.coalesce(lang, F.lit("und")).alias("lang"), "text").mapInArrow(_chunks, CHUNK_DDL)
            .groupBy("lang", "own", "chunk").agg(F.count(F.lit(1)).alias("freq")))


def frequent_phrases(parsed: DataFrame, min_count: int, bits: int | None = None) -> DataFrame:
    """(lang, words, phrase, f): the phrases of 1 to 5 words that occur at least
    ``min_count`` times in their language, counted exactly."""
    spark = parsed.sparkSession
    if bits is None:
        words = parsed.agg(F.sum(F.col("own") * F.col("freq")).alias("n")).first().n or 0
        bits = min(MOST_BITS, max(LEAST_BITS, int(words // 4).bit_length()))
    found, filters = None, []
    for n in range(1, MOST_WORDS):
        rows = c.written(parsed.mapInArrow(_level(n, list(filters), bits, min_count), ROW_DDL), f"phrases-{n}")
        counted = rows.where("phrase IS NOT NULL").select("lang", "words", "phrase", "n")
        found = counted if found is None else found.unionAll(counted)
        if n + 1 < MOST_WORDS:
            packed = _filter(rows.where("shard IS NOT NULL"), bits, min_count)
            filters.append(spark.sparkContext.broadcast(packed))
    for x in filters:
        x.destroy()
    return found.groupBy("lang", "words", "phrase").agg(F.sum("n").alias("f")).where(F.col("f") >= min_count)


def collocations(docs: DataFrame, min_count: int = 100, top: int = 2000, bits: int | None = None) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``top`` phrases of 2 to
    5 words by cohesion, the lowest 1000 * a * n / (l * r) over all cuts in two, without
    those that only occur inside a longer one."""
    parsed = c.written(dictionary(docs), "parse")
    f = c.written(frequent_phrases(parsed, min_count, bits), "frequent")
    totals = parsed.groupBy("lang").agg(F.sum(F.col("own") * F.col("freq")).cast("long").alias("n"))
    words = F.split("phrase", " ")
    part = lambda first, many: F.array_join(F.slice(words, first, many), " ")
    cand = f.where("words > 1")
    # f of a longer phrase never exceeds that of one inside it, so one word more decides
    longer = (cand.where("words > 2").select("lang", "f", F.explode(F.array(
        part(F.lit(1), F.col("words") - 1), part(F.lit(2), F.col("words") - 1))).alias("phrase"))
        .groupBy("lang", "phrase").agg(F.max("f").alias("longer")))
    cand = c.written(cand.join(longer, ["lang", "phrase"], "left")
                     .where("longer IS NULL OR longer < f").select("lang", "words", "phrase", "f"), "candidates")
    cuts = cand.select("lang", "phrase", "words", F.col("f").alias("a"),
                       F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", part(F.lit(1), F.col("k")).alias("left"),
                       part(F.col("k") + 1, F.col("words") - F.col("k")).alias("right"))
    of = lambda key, name: f.select("lang", F.col("phrase").alias(key), F.col("f").alias(name))
    wide = lambda x: f"cast({x} as decimal(19, 0))"
    score = F.expr(f"(cast(1000 as decimal(4, 0)) * ({wide('a')} * {wide('n')})) div ({wide('l')} * {wide('r')})")
    scored = (cuts.join(of("left", "l"), ["lang", "left"]).join(of("right", "r"), ["lang", "right"])
              .join(totals, "lang")
              .groupBy("lang", "phrase").agg(F.min(F.struct(score.alias("score"), "k", "a", "l", "r", "n")).alias("m"))
              .select("lang", "phrase", "m.a", "m.l", "m.r", "m.n", "m.score"))
    best = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # first inside parts of a language, so that no task gets all its candidates
    scored = scored.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(64)))
    few = scored.withColumn("place", F.row_number().over(W.partitionBy("lang", "salt").orderBy(*best))).where(
        F.col("place") <= top)
    ranked = few.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(*best)).cast("long"))
    return ranked.where(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


ORACLE = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
total AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY lang),
g AS (SELECT lang, k.k AS words, unnest(list_transform(range(1, len(w) - k.k + 2), lambda i: list_slice(w, i, i + k.k - 1))) AS g
      FROM w, range(1, 6) AS k(k) WHERE len(w) >= k.k),
f AS (SELECT lang, words, g, count(*) AS f FROM g GROUP BY ALL HAVING count(*) >= 100),
longer AS (SELECT lang, g, max(f) AS longer FROM (
    SELECT lang, f, list_slice(g, 1, len(g) - 1) AS g FROM f WHERE words > 2
    UNION ALL SELECT lang, f, list_slice(g, 2, len(g)) FROM f WHERE words > 2) GROUP BY ALL),
cand AS (SELECT f.lang, f.g, f.words, f.f AS a FROM f LEFT JOIN longer x ON x.lang = f.lang AND x.g = f.g
         WHERE f.words > 1 AND (x.longer IS NULL OR x.longer < f.f)),
cuts AS (SELECT lang, g, a, unnest(range(1, words)) AS k FROM cand),
s AS (SELECT c.lang, c.g, c.a, c.k, l.f AS l, r.f AS r, t.n,
        CAST((1000::HUGEINT * c.a * t.n) // (l.f::HUGEINT * r.f) AS BIGINT) AS score
      FROM cuts c JOIN f l ON l.lang = c.lang AND l.g = list_slice(c.g, 1, c.k)
      JOIN f r ON r.lang = c.lang AND r.g = list_slice(c.g, c.k + 1, len(c.g)) JOIN total t ON t.lang = c.lang),
low AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1),
named AS (SELECT lang, array_to_string(g, ' ') AS phrase, a, l, r, n, score FROM low)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase,
  CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, n, score
FROM named QUALIFY rank <= 2000
"""


@query("op11_phrase_collocations", ORACLE)
def op11(spark, sf_dir):
    return collocations(c.documents(spark, sf_dir))
