"""Ranked lexical search by NRA (no random access).

Queries go in blocks of bounded size (``BLOCK_BYTES`` of text; a block's vocabulary,
weights and best scores are what a task holds and what is broadcast).  Pass 1 reads
every document, counts its terms and writes those of the block's vocabulary; totals
and document frequencies are Spark sums.  Pass 2 reads the written postings in shards
of ``SHARD`` documents.  A shard's lists are sorted by impact, a query reads its
terms' lists in turn from the highest impact down, block by block, and keeps for every
document met a lower bound (the impacts read) and an upper bound (with the last impact
read of each list in which the document was not met).  It goes on until

* no document that was not met can reach the tenth lower bound (membership),
* every document whose upper bound reaches it, equal scores included, has equal bounds
  (ties and final scores).

The tenth best score is carried from shard to shard of a task.  The shards' best, ten
a query and task, are merged by Spark.

Defined cases: null and empty texts have no term and are not counted; queries without
terms, or whose terms no document holds, give no rows; equal scores are ordered by
doc_id, a null one first; each row is a document of its own, also if it repeats; rows
of the query table that are equal in id and text are one query, others of one id are
ranked apart; texts of any length are one row; an empty table gives no rows; other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cellar.llm import common as c
from cellar.llm.registry import query

TOP = 10
SHARD = 1 << 14
#: Entries of each list in the first read; later reads are twice as long.
READ = 128
BLOCK_BYTES = 4 << 20
#: Bounds of (documents x terms) of one query that are kept at once.
MARKS = 1 << 24

# --- fixed values: the weights of the score -----------------------------------
UNIT, SATURATION, LENGTH_SHARE = 1_000_000_000, 8, 75
# ------------------------------------------------------------------------------

_TERM = np.zeros(256, bool)
_TERM[48:58] = _TERM[65:91] = _TERM[97:123] = _TERM[128:] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] = _LOWER[97:123]
POSTING_DDL = "doc_id long, n long, terms array<int>, tf array<int>"


def _terms(batch: pa.RecordBatch):
    """(distinct terms, each place's term, each place's row) of a run of texts."""
    data, offsets = c.text_bytes(batch.column("text"))
    starts, ends, docs = c.runs_of(_TERM[data], offsets)
    found = c.coded(_LOWER[data], starts, ends)
    return found.dictionary, found.indices.to_numpy(), docs


def _query_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in c.chunks(batches):
        words, code, docs = _terms(batch)
        count = np.searchsorted(docs, np.arange(batch.num_rows + 1)).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [batch.column("item_id"), pa.ListArray.from_arrays(pa.array(count), words.take(pa.array(code)).cast(pa.string()))],
            names=["item_id", "terms"])


def _postings(vocabulary):
    """Texts -> their length in terms, and the vocabulary's terms in them with counts."""
    def run(batches):
        known = pa.array(vocabulary.value, pa.large_binary())
        for batch in c.chunks(batches):
            words, code, docs = _terms(batch)
            place = pc.fill_null(pc.index_in(words, value_set=known), -1).to_numpy()
            n = np.bincount(docs, minlength=batch.num_rows)
            term = place[code] if len(code) else np.zeros(0, np.int32)
            hit = term >= 0
            key, tf = np.unique(docs[hit].astype(np.int64) << 32 | term[hit], return_counts=True)
            cuts = pa.array(np.searchsorted(key, np.arange(batch.num_rows + 1, dtype=np.int64) << 32).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n.astype(np.int64)),
                 pa.ListArray.from_arrays(cuts, pa.array((key & 0xFFFFFFFF).astype(np.int32))),
                 pa.ListArray.from_arrays(cuts, pa.array(tf.astype(np.int32)))], names=["doc_id", "n", "terms", "tf"])
    return run


def _frequencies(size: int):
    """Postings -> (term, documents of this task that hold it)."""
    def run(batches):
        total = np.zeros(size, np.int64)
        for batch in batches:
            total += np.bincount(batch.column(0).flatten().to_numpy(), minlength=size)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["term", "df"])
    return run


class Lists:
    """Postings of a shard by term, each list from the highest impact down."""

    def __init__(self, doc_id, n, term, tf, of, documents: int, all_terms: int):
        m = (100 - LENGTH_SHARE) + (LENGTH_SHARE * n * documents) // max(all_terms, 1)
        tf = tf.astype(np.int64)
        impact = (UNIT * tf) // (1000 * tf + SATURATION * m[of])
        order = np.lexsort((of, -impact, term))
        self.doc_id, self.size = doc_id, len(doc_id)
        self.of, self.impact, term = of[order], impact[order], term[order]
        self.terms = np.unique(term)
        self.start = np.searchsorted(term, self.terms)
        self.stop = np.append(self.start[1:], len(term))

    def of_query(self, terms: np.ndarray, gain: np.ndarray):
        """The lists of some terms: (documents, impacts times gain)."""
        at = np.minimum(np.searchsorted(self.terms, terms), max(len(self.terms) - 1, 0))
        return [(self.of[self.start[i]:self.stop[i]], self.impact[self.start[i]:self.stop[i]] * g)
                for i, t, g in zip(at.tolist(), terms.tolist(), gain.tolist())
                if g and len(self.terms) and self.terms[i] == t]


def nra(lists: list[tuple[np.ndarray, np.ndarray]], size: int, least: int, top: int, read: int = READ):
    """(documents, scores, entries read): every document that can be among the ``top``
    best with a score of ``least`` or more, with its final score.  ``lists``:
    (documents, impacts falling) of each term; documents are 0 .. size - 1."""
    lower = np.zeros(size, np.int64)
    met = np.zeros((len(lists), size), bool)
    bound = np.array([x[1][0] for x in lists], np.int64)
    at, used = 0, 0
    while True:
        for i, (docs, impact) in enumerate(lists):
            if at >= len(docs):
                continue
            part = slice(at, at + read)
            lower[docs[part]] += impact[part]
            met[i, docs[part]] = True
            used += len(docs[part])
            bound[i] = impact[part][-1] if at + read < len(docs) else 0
        at, read = at + read, 2 * read
        rest = int(bound.sum())
        tenth = least
        if size >= top:
            tenth = max(least, int(np.partition(lower, size - top)[size - top]))
        tenth = max(tenth, 1)
        if rest and rest >= tenth:
            continue  # a document not met yet could still belong to the best
        open_ = np.flatnonzero((lower > 0) & (lower + rest >= tenth))
        slack = rest - (bound[:, None] * met[:, open_]).sum(0)
        open_, slack = open_[lower[open_] + slack >= tenth], slack[lower[open_] + slack >= tenth]
        if not slack.any():
            return open_, lower[open_], used


def _search(items, weight, documents: int, all_terms: int, top: int, shard: int):
    """Postings -> (item, doc_id, score): each item's best documents of this task."""
    def run(batches):
        first, terms, times = items.value
        gain = weight.value[terms] * times
        best: list[list[tuple]] = [[] for _ in range(len(first) - 1)]

        def work(table: pa.Table):
            one = {x: table[x].combine_chunks() for x in ("doc_id", "n", "terms", "tf")}
            of = np.repeat(np.arange(table.num_rows), pc.list_value_length(one["terms"]).to_numpy())
            doc_id = one["doc_id"].to_pylist()
            lists = Lists(doc_id, one["n"].to_numpy(), one["terms"].flatten().to_numpy(),
                          one["tf"].flatten().to_numpy(), of, documents, all_terms)
            for q in range(len(first) - 1):
                span = slice(first[q], first[q + 1])
                found = lists.of_query(terms[span], gain[span])
                if not found:
                    continue
                held = best[q]
                step = max(1, MARKS // len(found))  # a long query looks at fewer documents at once
                for low in range(0, lists.size, step):
                    part = found if step >= lists.size else [
                        (d[x] - low, s[x]) for d, s in found for x in [(d >= low) & (d < low + step)] if x.any()]
                    if not part:
                        continue
                    least = held[top - 1][0] if len(held) >= top else 1
                    docs, score, _ = nra(part, min(step, lists.size - low), least, top)
                    held += [(s, doc_id[d + low]) for d, s in zip(docs.tolist(), score.tolist())]
                    held.sort(key=lambda x: (-x[0], x[1] is not None, x[1] or 0))
                    del held[top:]

        waiting, size = [], 0
        for batch in batches:
            waiting.append(batch)
            size += batch.num_rows
            if size >= shard:
                work(pa.Table.from_batches(waiting))
                waiting, size = [], 0
        if size:
            work(pa.Table.from_batches(waiting))
        rows = [(q, d, s) for q, held in enumerate(best) for s, d in held]
        columns = list(zip(*rows)) if rows else [()] * 3
        yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(columns, (pa.int32(), pa.int64(), pa.int64()))],
                                         names=["item", "doc_id", "score"])
    return run


def search(docs: DataFrame, queries: DataFrame, top: int = TOP, block_bytes: int = BLOCK_BYTES,
           shard: int = SHARD) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` documents of each query (``item_id``,
    ``text``) by score above 0, equal scores by doc_id."""
    spark = docs.sparkSession
    asked = queries.select(F.col("item_id").cast("long").alias("item_id"), "text").distinct()
    size = asked.agg(F.sum(F.octet_length("text")).alias("n")).first().n or 0
    blocks = -(-size // block_bytes) or 1
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    out = None
    for b in range(blocks):
        # a block's items: block_bytes of text in the mean, dealt by hash
        part = asked if blocks == 1 else asked.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b)
        found = _block(spark, texts, part.mapInArrow(_query_terms, "item_id long, terms array<string>")
                       .where("size(terms) > 0").collect(), top, shard)
        if found is not None:
            out = found if out is None else out.unionAll(found)
    return out if out is not None else spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")


def _block(spark: SparkSession, texts: DataFrame, asked: list, top: int, shard: int) -> DataFrame | None:
    if not asked:
        return None
    names = sorted({t for row in asked for t in row.terms})
    place = {t: i for i, t in enumerate(names)}
    counts = [np.unique([place[t] for t in row.terms], return_counts=True) for row in asked]
    first = np.concatenate([[0], np.cumsum([len(x) for x, _ in counts])])
    items = (first, np.concatenate([x for x, _ in counts]), np.concatenate([x for _, x in counts]))
    vocabulary = spark.sparkContext.broadcast([t.encode() for t in names])
    held = c.written(texts.mapInArrow(_postings(vocabulary), POSTING_DDL), "postings")
    vocabulary.destroy()
    totals = held.agg(F.count(F.when(F.col("n") > 0, 1)).alias("documents"), F.sum("n").alias("terms")).first()
    if not totals.documents:
        return None
    # one weight a term of the block
    df = (held.select("terms").mapInArrow(_frequencies(len(names)), "term int, df long")
          .groupBy("term").agg(F.sum("df").alias("df")))
    weight = np.zeros(len(names), np.int64)
    for row in df.select("term", F.floor(1000 * F.log((2 * F.lit(totals.documents) + 2) / (2 * F.col("df") + 1)))
                         .cast("long").alias("w")).collect():
        weight[row.term] = row.w
    sent = [spark.sparkContext.broadcast(x) for x in (items, weight)]
    best = c.written(held.where("size(terms) > 0").mapInArrow(
        _search(*sent, totals.documents, totals.terms, top, shard), "item int, doc_id long, score long"), "best")
    for x in sent:
        x.destroy()
    order = W.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_first("doc_id"))
    ids = spark.createDataFrame([(i, row.item_id) for i, row in enumerate(asked)], "item int, item_id long")
    return (best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
            .join(ids, "item").select("item_id", "rank", "doc_id", "score"))


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM documents),
q AS (SELECT item_id, unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
asked AS (SELECT item_id, term, count(*) AS c FROM q GROUP BY ALL),
total AS (SELECT count(*) AS n_docs, CAST(sum(len(t)) AS BIGINT) AS l FROM d WHERE len(t) > 0),
tf AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(t) AS term FROM d)
       WHERE term IN (SELECT term FROM asked) GROUP BY ALL),
w AS (SELECT term, CAST(floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
      FROM tf, total GROUP BY term),
x AS (SELECT tf.r, d.doc_id, tf.term, w.w * ((1000000000 * tf.tf) // (1000 * tf.tf + 8 * (100 - 75 + ((75 * len(d.t) * n_docs) // l)))) AS x
      FROM tf JOIN d USING (r) JOIN w USING (term), total),
s AS (SELECT item_id, r, any_value(doc_id) AS doc_id, CAST(sum(c * x) AS BIGINT) AS score
      FROM asked JOIN x USING (term) GROUP BY item_id, r)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM s WHERE score > 0 QUALIFY rank <= 10
"""


@query("op12_ranked_search", ORACLE)
def op12(spark, sf_dir):
    return search(c.documents(spark, sf_dir), spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet"))
