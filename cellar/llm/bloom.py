"""A pair of Bloom filters, hashes seen once and hashes seen twice, filled by all
tasks and merged shard by shard.  Their size is fixed by ``bits``; a filter too
small for the corpus only reports more hashes as seen twice."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from cellar.llm import common as c

#: Cells of one shard of a filter, merged by one task.
SHARD_BITS = 20
#: A task passes its cells on when it holds this many.
FLUSH_CELLS = 1 << 21
ROWS = pa.schema([("shard", pa.int32()), ("cells", pa.binary()), ("twice", pa.binary())])
DDL = "shard int, cells binary, twice binary"


def cells(h: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The two cells of each hash."""
    other = (h << np.uint64(bits)) >> np.uint64(64 - bits)
    return (h >> np.uint64(64 - bits)).astype(np.uint32), other.astype(np.uint32)


def _rows(at: np.ndarray, count: np.ndarray, shard_bits: int) -> pa.RecordBatch:
    """Sorted cells and whether each was met twice, by shard."""
    shards = at >> np.uint32(shard_bits)
    cuts = np.flatnonzero(np.diff(shards)) + 1
    return pa.RecordBatch.from_pydict({
        "shard": shards[np.concatenate([[0], cuts])].astype(np.int32),
        "cells": [x.tobytes() for x in np.split(at, cuts)],
        "twice": [np.packbits(x > 1).tobytes() for x in np.split(count, cuts)]}, schema=ROWS)


def _fill(hash_runs, bits, shard_bits, once_will_do=False):
    def run(batches):
        held: list[np.ndarray] = []
        n = 0

        def flush():
            at, count = np.unique(np.concatenate(held), return_counts=True)
            held.clear()
            return _rows(at, count + 1 if once_will_do else count, shard_bits)

        for h in hash_runs(batches):
            a, b = cells(h, bits)
            held.extend([a, b[a != b]])
            n += len(a) + len(b)
            if n > FLUSH_CELLS:
                yield flush()
                n = 0
        if n:
            yield flush()
    return run


def _merge(shard_bits):
    """Rows sorted by shard -> one row for each shard: its twice-seen cells."""
    def run(batches):
        shard, once, twice = None, None, None
        out = lambda: pa.RecordBatch.from_pydict(
            {"shard": [shard], "cells": [np.packbits(twice).tobytes()], "twice": [b""]}, schema=ROWS)
        for batch in batches:
            for s, some, more in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                if s != shard:
                    if shard is not None:
                        yield out()
                    shard, once, twice = s, np.zeros(1 << shard_bits, bool), np.zeros(1 << shard_bits, bool)
                at = np.frombuffer(some.as_buffer(), np.uint32) & np.uint32((1 << shard_bits) - 1)
                again = np.unpackbits(np.frombuffer(more.as_buffer(), np.uint8), count=len(at)).astype(bool)
                twice[at[again | once[at]]] = True
                once[at] = True
        if shard is not None:
            yield out()
    return run


def _filter(df: DataFrame, hash_runs, bits: int, once_will_do: bool = False) -> np.ndarray:
    shard_bits = min(SHARD_BITS, bits)
    merged = (df.mapInArrow(_fill(hash_runs, bits, shard_bits, once_will_do), DDL)
              .repartition("shard").sortWithinPartitions("shard").mapInArrow(_merge(shard_bits), DDL))
    packed = np.zeros(1 << max(0, bits - 3), np.uint8)
    step = max(1, (1 << shard_bits) >> 3)
    for row in merged.select("shard", "cells").collect():
        packed[row.shard * step:row.shard * step + len(row.cells)] = np.frombuffer(row.cells, np.uint8)
    return packed


def _of_texts(hashes_of):
    def runs(batches):
        for batch in c.chunks(batches):
            yield hashes_of(*c.text_bytes(batch.column("text")))
    return runs


def _of_numbers(batches):
    for batch in batches:
        column = batch.column(0)
        if pa.types.is_list(column.type):
            column = column.flatten()
        yield c.mix(column.to_numpy(zero_copy_only=False).view(np.uint64))


def twice_filter(texts: DataFrame, hashes_of, bits: int) -> np.ndarray:
    """The packed filter of hashes seen twice or more; ``hashes_of(data, offsets)``
    gives the hashes of a run of texts.  2**bits bits whatever the corpus holds."""
    return _filter(texts.select("text"), _of_texts(hashes_of), bits)


def number_filter(df: DataFrame, bits: int) -> np.ndarray:
    """The filter of all numbers in the first column of ``df``."""
    return _filter(df, _of_numbers, bits, once_will_do=True)


def holds(packed: np.ndarray, numbers: np.ndarray, bits: int) -> np.ndarray:
    return seen_twice(packed, c.mix(numbers.view(np.uint64)), bits)


def seen_twice(packed: np.ndarray, h: np.ndarray, bits: int) -> np.ndarray:
    """Whether each hash may have been seen twice (never false for one that was)."""
    hit = lambda x: (packed[x >> np.uint32(3)] >> (np.uint8(7) - (x & np.uint32(7)).astype(np.uint8))) & 1
    a, b = cells(h, bits)
    return (hit(a) & hit(b)).astype(bool)
