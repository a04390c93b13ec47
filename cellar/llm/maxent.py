"""Hashed maximum-entropy language model.

A word is predicted in three factors: its class, its sub-class, and the word in
its cell (class and sub-class).  The first two are softmax models over hashed
features of the history (the word before, the two words before, and the skip
feature, the word before the last); the third is the word's smoothed share of its
cell's training tokens.  Words are known by their hash, so no table of words is
needed for the features.

Training is synchronous gradient updates: every task sums observed and expected
class counts of its documents for each feature row, Spark adds the sums up, and
the weights move by the scaled difference.  The first update starts from zero
weights, where the expectation is known without a pass.  The model has a fixed
size (``ROWS_1``, ``ROWS_2`` rows of ``CLASSES`` numbers, 5 MB); a task takes
about ``TASK_BYTES`` of text, so what is gathered stays below a sixth of it.

Word counts cover all training documents.  The most frequent words (at most
``HEAD_WORDS``) are broadcast for scoring; all others meet their counts in a join.

Defined cases: a null or empty text is its end token; repeated rows are learned
and scored each; a null doc_id counts as the empty text for the fold; without any
training document all counts are zero and scores are finite; further columns are
not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellar.llm import common as c
from cellar.llm.registry import query

CLASSES = 16
ROWS_1, ROWS_2 = 14, 16  # bits
UPDATES = 2
HEAD_WORDS = 1 << 20
TASK_BYTES = 32 << 20
#: Half a count for each word, as in the base model.
DELTA = 0.5
#: Expected counts behind which a feature row is not believed.
KAPPA = 4.0
#: Bound of a weight; three of them stay within the range of exp.
WEIGHT = 20.0
CHUNK_ROWS = 1 << 11
#: Text bytes at a time where every token has a row of class numbers.
SMALL = 1 << 19
END = np.uint64(0x5EEDE4D0C0FFEE11)
START = np.uint64(0x57A27000DECAF001)


def tokens(data, offsets):
    """(hash, document) of every token: the words, then one end a document."""
    starts, ends, docs = c.words_of(data, offsets)
    n = len(offsets) - 1
    words = np.bincount(docs, minlength=n)
    total = np.cumsum(words)
    tok = np.empty(len(docs) + n, np.uint64)
    doc = np.empty(len(docs) + n, np.int64)
    at = np.arange(len(docs)) + docs
    tok[at], doc[at] = c.span_hash(data, starts, ends), docs
    at = total + np.arange(n)
    tok[at], doc[at] = END, np.arange(n)
    return tok, doc


def features(tok, doc):
    """Hashes of the three history features of each token."""
    one = np.full(len(tok), START, np.uint64)
    two = np.full(len(tok), START, np.uint64)
    same = doc[1:] == doc[:-1]
    one[1:][same] = tok[:-1][same]
    same = doc[2:] == doc[:-2]
    two[2:][same] = tok[:-2][same]
    return [c.mix(one + np.uint64(1)), c.mix(one * np.uint64(0x9E3779B97F4A7C15) + c.mix(two)), c.mix(two + np.uint64(3))]


def classes(tok):
    return (tok >> np.uint64(60)).astype(np.int64), ((tok >> np.uint64(56)) & np.uint64(15)).astype(np.int64)


def rows_of(feats, c1):
    """Feature rows of both softmaxes; 16 bits each, which sort by radix."""
    first = [(f >> np.uint64(64 - ROWS_1)).astype(np.uint16) for f in feats]
    of_class = (c1 + 1).astype(np.uint64) * np.uint64(0xD1342543DE82EF95)
    second = [(c.mix(f + of_class) >> np.uint64(64 - ROWS_2)).astype(np.uint16) for f in feats]
    return first, second


def softmax(bias, weights, rows):
    z = weights.take(rows[0], 0)  # take copies whole rows, several times as fast as an index does
    for r in rows[1:]:
        z += weights.take(r, 0)
    z += bias
    np.exp(z, out=z)  # weights are clipped, so this cannot overflow
    z *= 1 / (z @ np.ones(CLASSES, np.float32))[:, None]
    return z


def forward(model, tok, doc):
    """Class and sub-class distributions, with their rows and the true classes."""
    c1, c2 = classes(tok)
    first, second = rows_of(features(tok, doc), c1)
    p1 = softmax(model["b1"], model["w1"], first)
    p2 = softmax(model["b2"].take(c1, 0), model["w2"], second)
    return p1, p2, first, second, c1, c2


def _add(total, rows, values):
    order = np.argsort(rows, kind="stable")
    r = rows[order]
    first = np.flatnonzero(np.concatenate([[True], r[1:] != r[:-1]]))
    total[r[first]] += np.add.reduceat(values.take(order, 0), first, axis=0)


SUMS = pa.schema([("kind", pa.int32()), ("chunk", pa.int32()), ("task", pa.int32()), ("sums", pa.binary())])
SUMS_DDL = "kind int, chunk int, task int, sums binary"


def _emit(arrays):
    task = TaskContext.get().partitionId()
    for kind, a in enumerate(arrays):
        for k in range(0, len(a), CHUNK_ROWS):
            part = a[k:k + CHUNK_ROWS]
            if part.any():
                yield pa.RecordBatch.from_pydict({"kind": [kind], "chunk": [k // CHUNK_ROWS], "task": [task],
                                                  "sums": [part.astype(np.float32).tobytes()]}, schema=SUMS)


def _observe(batches):
    """Observed class counts of each feature row, and of all tokens."""
    o1, o2 = np.zeros((1 << ROWS_1, CLASSES)), np.zeros((1 << ROWS_2, CLASSES))
    cells = np.zeros((CLASSES, CLASSES))
    for batch in c.chunks(batches):
        tok, doc = tokens(*c.text_bytes(batch.column("text")))
        c1, c2 = classes(tok)
        first, second = rows_of(features(tok, doc), c1)
        cells += np.bincount(c1 * CLASSES + c2, minlength=CLASSES ** 2).reshape(CLASSES, CLASSES)
        for r in first:
            o1 += np.bincount(r * np.int64(CLASSES) + c1, minlength=o1.size).reshape(o1.shape)
        for r in second:
            o2 += np.bincount(r * np.int64(CLASSES) + c2, minlength=o2.size).reshape(o2.shape)
    yield from _emit([o1, o2, cells])


def _expect(shared):
    """Expected class counts of each feature row under the model."""
    def run(batches):
        model = shared.value
        e1, e2 = np.zeros((1 << ROWS_1, CLASSES)), np.zeros((1 << ROWS_2, CLASSES))
        for batch in c.chunks(batches, SMALL):
            tok, doc = tokens(*c.text_bytes(batch.column("text")))
            p1, p2, first, second, _, _ = forward(model, tok, doc)
            for r in first:
                _add(e1, r, p1)
            for r in second:
                _add(e2, r, p2)
        yield from _emit([e1, e2])
    return run


def _add_up(batches):
    key, total = None, None
    out = lambda: pa.RecordBatch.from_pydict({"kind": [key[0]], "chunk": [key[1]], "task": [0],
                                              "sums": [total.tobytes()]}, schema=SUMS)
    for batch in batches:
        for kind, chunk, _, sums in zip(*(batch.column(i).to_pylist() for i in range(4))):
            if (kind, chunk) != key:
                if key is not None:
                    yield out()
                key, total = (kind, chunk), np.zeros(len(sums) // 4)
            total += np.frombuffer(sums, np.float32)
    if key is not None:
        yield out()


def _gather(train, kernel, shapes):
    """The tasks' sums, added up by Spark: arrays of the model's fixed size."""
    rows = (train.mapInArrow(kernel, SUMS_DDL).repartition("kind", "chunk").sortWithinPartitions("kind", "chunk", "task")
            .mapInArrow(_add_up, SUMS_DDL).select("kind", "chunk", "sums").collect())
    out = [np.zeros(s) for s in shapes]
    for r in rows:
        part = np.frombuffer(r.sums, np.float64).reshape(-1, CLASSES)
        out[r.kind][r.chunk * CHUNK_ROWS:r.chunk * CHUNK_ROWS + len(part)] = part
    return out


def train_model(train: DataFrame, updates: int = UPDATES) -> dict[str, np.ndarray]:
    sc = train.sparkSession.sparkContext
    shapes = [(1 << ROWS_1, CLASSES), (1 << ROWS_2, CLASSES), (CLASSES, CLASSES)]
    o1, o2, cells = _gather(train, _observe, shapes)
    share = (cells.sum(1) + 1) / (cells.sum() + CLASSES)
    inner = (cells + 1) / (cells.sum(1, keepdims=True) + CLASSES)
    model = {"b1": np.log(share).astype(np.float32), "b2": np.log(inner).astype(np.float32)}
    # from zero weights: three features share the log ratio of observed and expected
    expected = o1.sum(1, keepdims=True) * share
    model["w1"] = (np.log((o1 + KAPPA * share) / (expected + KAPPA * share)) / 3).astype(np.float32)
    n2 = o2.sum(1, keepdims=True)  # log ratios of counts: far below WEIGHT
    usual = inner.mean(0)
    model["w2"] = (np.log((o2 + KAPPA * usual) / ((n2 + KAPPA) * usual)) / 3).astype(np.float32)
    for _ in range(updates):
        shared = sc.broadcast(model)
        e1, e2 = _gather(train, _expect(shared), shapes[:2])
        shared.destroy()
        model = dict(model)
        for w, o, e in (("w1", o1, e1), ("w2", o2, e2)):
            step = np.clip((o - e) / (e + KAPPA), -1, 1) / 2
            model[w] = np.clip(model[w] + step, -WEIGHT, WEIGHT).astype(np.float32)
    return model


# ---------------------------------------------------------------------------
# word counts

def _words(batches):
    held, size = [], 0

    def flush():
        h, n = np.unique(np.concatenate(held), return_counts=True)
        held.clear()
        return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n.astype(np.int64))], names=["h", "n"])

    for batch in c.chunks(batches):
        tok, _ = tokens(*c.text_bytes(batch.column("text")))
        held.append(tok)
        size += len(tok)
        if size > 1 << 23:
            yield flush()
            size = 0
    if size:
        yield flush()


def word_counts(train: DataFrame) -> DataFrame:
    return c.written(train.mapInArrow(_words, "h long, n long").groupBy("h").agg(F.sum("n").alias("c")), "word-counts")


# ---------------------------------------------------------------------------
# scoring

SCORED = ("doc_id long, held_out boolean, n_tokens long, n_known long, base double, score double, "
          "tail array<long>, tail_n array<long>")


def _score(shared):
    def run(batches):
        model = shared.value
        head, count, n_all, v_all, cell_n, cell_v = (model[k] for k in ("head", "count", "N", "V", "cell_n", "cell_v"))
        for batch in c.chunks(batches, SMALL):
            rows = batch.num_rows
            tok, doc = tokens(*c.text_bytes(batch.column("text")))
            p1, p2, _, _, c1, c2 = forward(model, tok, doc)
            at = np.arange(len(tok))
            context = np.log10(np.maximum(p1[at, c1], 1e-30)).astype(np.float64) + np.log10(np.maximum(p2[at, c2], 1e-30))
            place = np.minimum(np.searchsorted(head, tok), max(0, len(head) - 1))
            known = head[place] == tok if len(head) else np.zeros(len(tok), bool)
            n = np.where(known, count[place] if len(head) else 0, 0)
            base = np.where(known, np.log10((n + 0.5) / (n_all + 0.5 * (v_all + 1))), 0)
            cell = c1 * CLASSES + c2
            word = np.where(known, np.log10((n + DELTA) / (cell_n[cell] + DELTA * (cell_v[cell] + 1))), 0)
            add = lambda x: np.bincount(doc, weights=x, minlength=rows)
            rare, rare_doc = tok[~known], doc[~known]
            order = np.lexsort((rare, rare_doc))
            rare, rare_doc = rare[order], rare_doc[order]
            new = np.ones(len(rare), bool)
            new[1:] = (rare[1:] != rare[:-1]) | (rare_doc[1:] != rare_doc[:-1])
            first = np.flatnonzero(new)
            times = np.diff(np.append(first, len(rare)))
            ends = pa.array(np.concatenate([[0], np.cumsum(np.bincount(rare_doc[first], minlength=rows))]).astype(np.int32))
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), batch.column("held_out"), pa.array(np.bincount(doc, minlength=rows).astype(np.int64)),
                pa.array(np.bincount(doc[known], minlength=rows).astype(np.int64)), pa.array(add(base)), pa.array(add(context + word)),
                pa.ListArray.from_arrays(ends, pa.array(rare[first].view(np.int64))),
                pa.ListArray.from_arrays(ends, pa.array(times.astype(np.int64)))],
                names=["doc_id", "held_out", "n_tokens", "n_known", "base", "score", "tail", "tail_n"])
    return run


def score_documents(docs: DataFrame, held_out, updates: int = UPDATES, head_words: int = HEAD_WORDS) -> DataFrame:
    """Every document's base and model log10 probability; the model learns from
    the rows where ``held_out`` (a Column over doc_id) is false."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("held_out", held_out)
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    tasks = max(spark.sparkContext.defaultParallelism, size // TASK_BYTES)
    train = rows.where(~F.col("held_out")).select("text").coalesce(int(tasks))
    words = word_counts(train)
    cell = F.shiftrightunsigned("h", 56).cast("int")
    per_cell = words.groupBy(cell.alias("cell")).agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v")).collect()
    model = train_model(train, updates)
    model |= {"cell_n": np.zeros(CLASSES ** 2), "cell_v": np.zeros(CLASSES ** 2)}
    for r in per_cell:
        model["cell_n"][r.cell], model["cell_v"][r.cell] = r.n, r.v
    n_all, v_all = int(model["cell_n"].sum()), int(model["cell_v"].sum())
    # the most frequent words, as many as the bound allows
    often = words.groupBy(F.least("c", F.lit(100_000)).alias("c")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("c")).collect()
    least, held = None, 0
    for r in often:
        if held + r.n > head_words:
            break
        least, held = r.c, held + r.n
    pairs = words.where(F.col("c") >= least).toArrow() if least is not None else pa.table({"h": pa.array([], pa.int64()), "c": pa.array([], pa.int64())})
    h = pairs["h"].to_numpy().view(np.uint64) if len(pairs) else np.zeros(0, np.uint64)
    order = np.argsort(h)
    model |= {"head": h[order], "count": pairs["c"].to_numpy()[order], "N": n_all, "V": v_all}
    shared = spark.sparkContext.broadcast(model)
    scored = c.written(rows.select("doc_id", "held_out", "text").mapInArrow(_score(shared), SCORED)
                       .withColumn("uid", F.monotonically_increasing_id()), "scores")
    shared.destroy()
    tail = scored.select("uid", F.explode(F.arrays_zip("tail", "tail_n")).alias("t")).select(
        "uid", F.col("t.tail").alias("h"), F.col("t.tail_n").alias("n"))
    table = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(zip(model["cell_n"], model["cell_v"]))],
                                  "cell int, cell_n double, cell_v double")
    tail = tail.join(words, "h", "left").withColumn("c", F.coalesce("c", F.lit(0))).withColumn("cell", cell).join(
        F.broadcast(table), "cell")
    base = F.log10((F.col("c") + 0.5) / (n_all + 0.5 * (v_all + 1)))
    word = F.log10((F.col("c") + DELTA) / (F.col("cell_n") + DELTA * (F.col("cell_v") + 1)))
    rest = tail.groupBy("uid").agg(F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("t_known"),
                                   F.sum(F.col("n") * base).alias("t_base"), F.sum(F.col("n") * word).alias("t_score"))
    add = lambda a, b: F.col(a) + F.coalesce(b, F.lit(0))
    return scored.join(rest, "uid", "left").select(
        "doc_id", "held_out", "n_tokens", add("n_known", "t_known").alias("n_known"), F.lit(n_all).cast("long").alias("train_tokens"),
        add("base", "t_base").alias("base_score"), add("score", "t_score").alias("score"))


def fifth_fold():
    """Held out: the documents whose crc32 of the doc_id's text leaves 1 mod 5."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 5 == 1


@query("op9_hashed_maxent")
def op9(spark, sf_dir):
    return score_documents(c.documents(spark, sf_dir), fifth_fold())
