"""Helpers shared by the corpus operators.

Tables between steps are written to the shared folder that the session names in
``spark.checkpoint.dir`` and read back, so a lost executor costs a re-read and
never a recomputation of the whole lineage.
"""

from __future__ import annotations

import re
import sys
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Texts are handed to the NumPy kernels in runs of about this many bytes.
CHUNK_BYTES = 2 << 20


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The shared folder of the session.  Only a session in one local JVM without
    one (as in tests) gets a scratch folder; a cluster session must name its own."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="cellar-llm-"))
        found = spark.sparkContext.getCheckpointDir()
    return found.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/llm/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table written to the shared folder and read again."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def batch_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Jobs that run inside hand their kernels Arrow batches of at most ``rows`` rows; the
    session's own setting comes back behind them."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    if not 0 < int(before) <= rows:
        spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def unused(df: DataFrame, name: str) -> str:
    """``name``, or the first of ``name_``, ``name__``, ... that ``df`` has no column of."""
    taken = {x.lower() for x in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(UTF-8 bytes, offsets) of a string column; a null counts as empty."""
    column = pc.fill_null(column, "")
    if pa.types.is_large_string(column.type):
        width = np.int64
    else:
        column, width = column.cast(pa.string()), np.int32
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], width)[column.offset:column.offset + len(column) + 1]
    offsets = offsets.astype(np.int64)
    if buffers[2] is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    data = np.frombuffer(buffers[2], np.uint8)[offsets[0]:offsets[-1]]
    return data, offsets - offsets[0]


def chunks(batches: Iterator[pa.RecordBatch], limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in slices of about ``limit`` text bytes (column ``text``)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)
        total = np.cumsum(sizes, dtype=np.int64)
        start = 0
        while start < batch.num_rows:
            before = total[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(total, before + limit, "right")))
            yield batch.slice(start, stop - start)
            start = stop


_RNG = np.random.default_rng(20240601)
#: A random number for each byte; A-Z share those of a-z, so hashes ignore ASCII case.
BYTE_CODE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
BYTE_CODE[65:91] = BYTE_CODE[97:123]
#: The same with case told apart.
EXACT_CODE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
_BASE = 0x9E3779B97F4A7C15
_MOD = 1 << 64


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser: every input bit reaches every output bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def powers(n: int, base: int = _BASE) -> np.ndarray:
    """base**0, base**1, ... modulo 2**64; a worker keeps them between calls."""
    kept = vars(sys).setdefault("_cellar_powers", {})
    if base not in kept or len(kept[base]) < n:
        out = np.full(max(n, 64), base, np.uint64)
        out[0] = 1
        np.multiply.accumulate(out, out=out)
        if n > 2 * CHUNK_BYTES:
            return out[:n]  # one very long text
        kept[base] = out
    return kept[base][:n]


def span_hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray,
              code: np.ndarray = BYTE_CODE) -> np.ndarray:
    """64-bit hash of the bytes of each span [start, end); ASCII case is ignored
    with ``BYTE_CODE`` and counts with ``EXACT_CODE``."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(code[data] * powers(len(data)), out=total[1:])
    back = powers(len(data) + 1, pow(_BASE, -1, _MOD))
    return mix((total[ends] - total[starts]) * back[starts] + (ends - starts).astype(np.uint64))


def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, document number) of each word ``[^\\x20\\x09-\\x0D]+``."""
    solid = ~SPACE[data]
    begins = solid.copy()
    begins[1:] &= ~solid[:-1]
    heads = offsets[:-1][np.diff(offsets) > 0]
    begins[heads] = solid[heads]
    starts = np.flatnonzero(begins)
    stops = solid.copy()
    stops[:-1] &= begins[1:] | ~solid[1:]
    ends = np.flatnonzero(stops) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def runs_of(solid: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, document number) of each maximal run of marked bytes of one document."""
    begins = solid.copy()
    begins[1:] &= ~solid[:-1]
    heads = offsets[:-1][np.diff(offsets) > 0]
    begins[heads] = solid[heads]
    starts = np.flatnonzero(begins)
    stops = solid.copy()
    stops[:-1] &= begins[1:] | ~solid[1:]
    ends = np.flatnonzero(stops) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def coded(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.DictionaryArray:
    """Runs of bytes, sorted and apart, as exact numbers and a dictionary (binary)."""
    size = ends - starts
    inside = np.zeros(len(data) + 1, np.int8)
    inside[starts] += 1
    inside[ends] -= 1
    offsets = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
    solid = data[np.cumsum(inside[:-1], dtype=np.int8).astype(bool)]
    return pc.dictionary_encode(pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(size), [None, pa.py_buffer(offsets), pa.py_buffer(solid)]))


def numbered(keys: np.ndarray) -> tuple[np.ndarray, int]:
    """Whole numbers -> (0, 1, ... for each different one, how many there are)."""
    out = pc.dictionary_encode(pa.array(keys))
    return out.indices.to_numpy(), len(out.dictionary)


def lines_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, document number) of each ``\\n``-split line; an empty
    document has one empty line."""
    breaks = np.flatnonzero(data == 10)
    docs = np.concatenate([np.arange(len(offsets) - 1), np.searchsorted(offsets, breaks, "right") - 1])
    starts = np.concatenate([offsets[:-1], breaks + 1])
    ends = np.concatenate([offsets[1:], breaks])
    return starts[np.lexsort((starts, docs))], ends[np.lexsort((ends, docs))], np.sort(docs)


def shingle_hash(words: np.ndarray, docs: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, document number) of each run of ``n`` words of one document; a
    document of fewer words gives its whole sequence as one shingle."""
    odd = powers(n + 1, 0xD1342543DE82EF95)[1:]
    if len(words) >= n:
        total = np.zeros(len(words) - n + 1, np.uint64)
        for j in range(n):
            total += words[j:len(words) - n + 1 + j] * odd[j]
        whole = docs[:len(total)] == docs[n - 1:]
        hashes, of = mix(total[whole]), docs[:len(total)][whole]
    else:
        hashes, of = np.zeros(0, np.uint64), np.zeros(0, docs.dtype)
    if len(docs):
        here, first, count = np.unique(docs, return_index=True, return_counts=True)
        short = count < n
        if short.any():
            few = np.zeros(int(short.sum()), np.uint64)
            for j in range(n - 1):
                has = count[short] > j
                at = np.minimum(first[short] + j, len(words) - 1)
                few += np.where(has, words[at] * odd[j], np.uint64(0))
            few = mix(few + count[short].astype(np.uint64))
            hashes = np.concatenate([hashes, few])
            of = np.concatenate([of, here[short]])
            order = np.argsort(of, kind="stable")
            hashes, of = hashes[order], of[order]
    return hashes, of


def keyed(df: DataFrame, *columns: str) -> DataFrame:
    """Only the named columns; one that the table lacks becomes null."""
    return df.select(*[F.col(c) if c in df.columns else F.lit(None).alias(c) for c in columns])
