"""Line dedup with two Bloom filters.

Pass 1 hashes every line key and fills two filters: keys seen once and keys
seen twice.  Pass 2 tests each line against the second filter, and only the
suspected repeats travel, with their whole key, to an exact count per key and a
choice of the first occurrence.  A filter has a fixed, documented size
(``filter_bits``); a filter too small for the corpus only lets more lines
through to the exact count, so results are the same at every size.

Defined cases: a null text is one empty line; a line of white space only has an
empty key, which is shorter than ``min_chars`` and stays; repeated rows of one
(doc_id, text) count as separate documents and share one verdict; a null doc_id
is kept and sorts first; other columns of the input are carried, not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellar.llm import bloom
from cellar.llm import common as c
from cellar.llm.registry import query

#: 2**27 cells: 16 MB a filter, 8 cells a line up to 8 million distinct lines.
FILTER_BITS = 27


def line_keys(data, offsets):
    """Lines of the documents: (start, end, document, key start, key end); a key
    is the line without white space at its ends."""
    starts, ends, docs = c.lines_of(data, offsets)
    solid = np.flatnonzero(~c.SPACE[data])
    first = np.searchsorted(solid, starts)
    last = np.searchsorted(solid, ends)
    has = last > first
    key_start, key_end = starts.copy(), starts.copy()
    key_start[has] = solid[first[has]]
    key_end[has] = solid[last[has] - 1] + 1
    return starts, ends, docs, key_start, key_end


def _distinct(data, offsets):
    """One entry for each (document, key hash) with a key: hash, document, line."""
    starts, ends, docs, ks, ke = line_keys(data, offsets)
    has = ke > ks
    h = c.span_hash(data, ks[has], ke[has])
    order = np.lexsort((h, docs[has]))
    h, d, at = h[order], docs[has][order], np.flatnonzero(has)[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
    return h, d, at, new, ks, ke


def _key_hashes(data, offsets):
    h, _, _, new, _, _ = _distinct(data, offsets)
    return h[new]


def _suspects(seen, bits):
    def run(batches):
        for batch in c.chunks(batches):
            data, offsets = c.text_bytes(batch.column("text"))
            h, d, at, new, ks, ke = _distinct(data, offsets)
            keep = bloom.seen_twice(seen.value, h, bits)
            d, at, new = d[keep], at[keep], new[keep]
            raw = data.tobytes()
            line0 = np.searchsorted(c.lines_of(data, offsets)[2], np.arange(len(offsets)))
            yield pa.RecordBatch.from_arrays([
                batch.column("row_key").take(pa.array(d)),
                batch.column("doc_id").take(pa.array(d)),
                pa.array((at - line0[d]).astype(np.int64)),
                pa.array(new),
                pa.array([raw[s:e].lower().decode() for s, e in zip(ks[at].tolist(), ke[at].tolist())], pa.string()),
            ], names=["row_key", "doc_id", "line", "new", "key"])
    return run


def dedup_lines(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, keep_first: bool = False,
                filter_bits: int = FILTER_BITS) -> DataFrame:
    """(doc_id, text, n_lines, n_dropped, kept_text, rest): every line whose key has at
    least ``min_chars`` code points and stands in at least ``min_docs``
    documents goes, from all documents or, with ``keep_first``, from all places
    but the first (smallest doc_id, then line).  ``rest`` is a struct of the
    table's other columns, whatever their names."""
    if min_docs < 2:
        raise ValueError("min_docs counts repeats: 2 or more")
    spark = docs.sparkSession
    rest = [docs[x] for x in docs.columns if x not in ("doc_id", "text")]
    rows = docs.select("doc_id", "text", F.struct(*rest or [F.lit(None).alias("none")]).alias("rest")).withColumn(
        "row_key", F.xxhash64(F.col("doc_id"), F.coalesce("text", F.lit(""))))
    packed = spark.sparkContext.broadcast(bloom.twice_filter(rows, _key_hashes, filter_bits))
    found = rows.select("row_key", "doc_id", "text").mapInArrow(
        _suspects(packed, filter_bits), "row_key long, doc_id long, line long, new boolean, key string")
    suspects = c.written(found.where(F.length("key") >= min_chars), "suspect-lines")
    packed.destroy()
    counts = [F.count(F.when(F.col("new"), 1)).alias("n_docs")]
    if keep_first:
        counts.append(F.min(F.struct(F.col("doc_id").isNotNull(), "doc_id", "row_key", "line")).alias("first"))
    repeated = suspects.groupBy("key").agg(*counts).where(F.col("n_docs") >= min_docs)
    drops = suspects.join(repeated, "key")
    if keep_first:
        drops = drops.where(~((F.col("row_key") == F.col("first.row_key")) & (F.col("line") == F.col("first.line"))))
    drops = drops.groupBy("row_key").agg(F.collect_set("line").alias("drops"))
    return rows.join(drops, "row_key", "left").select(
        "doc_id", "text", *_cut(F.coalesce("text", F.lit("")), F.col("drops")), "rest")


def _cut(text, drops):
    lines = F.split(text, "\n", -1)
    places = F.array_except(F.sequence(F.lit(0).cast("long"), F.size(lines).cast("long") - 1), drops)
    kept = F.when(drops.isNull(), text).otherwise(F.array_join(
        F.transform(places, lambda i: F.get(lines, i.cast("int"))), "\n"))
    return [F.size(lines).cast("long").alias("n_lines"),
            F.coalesce(F.size(drops), F.lit(0)).cast("long").alias("n_dropped"), kept.alias("kept_text")]


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT r, doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS i FROM d),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
bad AS (SELECT key FROM k WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT r) >= 10)
SELECT any_value(doc_id) AS doc_id, CAST(count(*) AS BIGINT) AS n_lines,
       CAST(count(bad.key) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(CASE WHEN bad.key IS NULL THEN line END, chr(10) ORDER BY i), '')) AS kept_sha256
FROM k LEFT JOIN bad USING (key) GROUP BY r
"""


@query("op2_line_dedup", ORACLE)
def op2(spark, sf_dir):
    out = dedup_lines(c.documents(spark, sf_dir))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))
