"""Recodes whose code tables are data: a frame ``(column, code, value)`` of any size.

The observed codes of all recoded columns are counted first, one row for each different
(column, code) and partition in the shuffle, however common a code is, and joined once
with the table.  That join gives the audit (observed codes that the table lacks, with
their counts) and what the rows need: the part of the table that occurs.

Rows are then recoded where they stand, by position: when the occurring part is small
(``FEW_CODES``, ``FEW_BYTES``) it is sent to all tasks; otherwise codes that hold more than
one in ``COMMON`` of all cells, at most that many, are sent, and only the other cells
travel to the table, keyed by code, and back to their rows.  Both ways give the same
rows.

A (column, code) given twice in the table has the larger value; NULL codes stay NULL
and are not looked up; sheet row 0 (the header position) is left as it is.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellar.functions.cells import pretty_number
from cellar.session import shared_path

FEW_CODES = 200_000
FEW_BYTES = 16 << 20
COMMON = 1_000


def _recoded(table: DataFrame, codes: DataFrame, columns: Sequence[str] | None) -> list[str]:
    if columns is not None:
        return list(columns)
    named = codes.select("column").where(F.col("column").isin(table.columns)).distinct().collect()
    found = {r["column"] for r in named}   # no more than the table has columns
    return [c for c in table.columns if c in found]


def _cells(table: DataFrame, columns: Sequence[str], keep: Sequence[str], row_col: str | None) -> DataFrame:
    """``(*keep, column, code)``: the codes of all recoded columns, unpivoted."""
    src = table.where(F.col(row_col) != 0) if row_col and row_col in table.columns else table
    one = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("code")) for c in columns]))
    return src.select(*keep, one.alias("_o")).select(*keep, "_o.column", "_o.code").where(F.col("code").isNotNull())


def observed_codes(table: DataFrame, codes: DataFrame, columns: Sequence[str] | None = None,
                   row_col: str | None = "row_num") -> DataFrame:
    """``(column, code, n, value)``: every observed code with its count and its value,
    NULL where the table lacks it."""
    columns = _recoded(table, codes, columns)
    if not columns:
        return table.sparkSession.createDataFrame([], "column string, code string, n long, value double")
    counts = _cells(table, columns, [], row_col).groupBy("column", "code").agg(F.count(F.lit(1)).alias("n"))
    known = codes.groupBy("column", F.col("code").cast("string").alias("code")).agg(
        F.max(F.col("value").cast("double")).alias("value"))
    return counts.join(known, ["column", "code"], "left").select("column", "code", "n", "value")


def audit_from(table: DataFrame, codes: DataFrame, columns: Sequence[str] | None = None,
               row_col: str | None = "row_num") -> DataFrame:
    """``(column, code, n)`` for every observed code that the table lacks."""
    return observed_codes(table, codes, columns, row_col).where("value IS NULL").select("column", "code", "n")


def recode_from(table: DataFrame, codes: DataFrame, columns: Sequence[str] | None = None, *,
                on_unmapped: str = "error", row_col: str | None = "row_num",
                key: Sequence[str] | None = None) -> DataFrame:
    """Replace the codes in ``columns`` (default: those that ``codes`` names) by the texts
    of their values.  Unknown codes: "error" (the first by column and code is named
    before any row is recoded), "null" or "keep".  ``key`` identifies a row (default:
    workbook, sheet and row number); it is used only when the codes do not fit into
    memory."""
    if on_unmapped not in ("error", "null", "keep"):
        raise ValueError(f"unknown on_unmapped {on_unmapped!r}")
    columns = _recoded(table, codes, columns)
    if not columns:
        return table
    spark = table.sparkSession
    path = shared_path(spark, "recode", f"codes-{uuid.uuid4().hex}")
    observed_codes(table, codes, columns, row_col).withColumn("text", pretty_number("value")).write.parquet(path)
    used = spark.read.parquet(path)
    if on_unmapped == "error":
        bad = used.where("value IS NULL").orderBy("column", "code").limit(1).collect()
        if bad:
            raise ValueError(f"unmapped code {bad[0]['code']!r} in column {bad[0]['column']!r} ({bad[0]['n']} rows)")
    if on_unmapped == "keep":
        used = used.withColumn("text", F.coalesce("text", "code"))
    head = F.col(row_col) == 0 if row_col and row_col in table.columns else F.lit(False)
    size = used.agg(F.count(F.lit(1)).alias("n"), F.sum("n").alias("cells"),
                    F.sum(F.octet_length("code") + F.coalesce(F.octet_length("text"), F.lit(0))).alias("bytes")).first()
    if size.n <= FEW_CODES and (size.bytes or 0) <= FEW_BYTES:
        return _in_place(table, used, columns, head)
    return _by_join(table, used, columns, head, row_col, key, size.cells)


def _in_place(table: DataFrame, used: DataFrame, columns: Sequence[str], head) -> DataFrame:
    """Rows stay where they are; every task looks codes up in the broadcast part."""
    spark = table.sparkSession
    per: dict[str, tuple[list, list]] = {c: ([], []) for c in columns}
    for r in used.select("column", "code", "text").collect():
        per[r["column"]][0].append(r["code"])
        per[r["column"]][1].append(r["text"])
    sent = spark.sparkContext.broadcast(per)
    texts = table.withColumns({c: F.col(c).cast("string") for c in columns}).withColumn("_head", head)

    def look_up(batches):
        import pandas as pd
        index = {c: (pd.Index(np.array(codes, object)), pa.array(out, pa.string())) for c, (codes, out) in sent.value.items()}
        for batch in batches:
            is_head = batch.column("_head").to_numpy(zero_copy_only=False)
            done = []
            for name in batch.schema.names[:-1]:
                column = batch.column(name)
                if name in index:
                    known, out = index[name]
                    place = known.get_indexer(column.to_pandas()) if len(known) else np.full(len(column), -1)
                    if is_head.any():
                        out = pa.concat_arrays([out, column.cast(pa.string())])
                        place = np.where(is_head, len(known) + np.arange(len(column)), place)
                    column = out.take(pa.array(place, mask=place < 0))
                done.append(column)
            yield pa.RecordBatch.from_arrays(done, names=batch.schema.names[:-1])

    return texts.mapInArrow(look_up, texts.drop("_head").schema)


def _by_join(table: DataFrame, used: DataFrame, columns: Sequence[str], head, row_col: str | None,
             key: Sequence[str] | None, cells: int) -> DataFrame:
    key = list(key or [c for c in ("workbook", "sheet", "row_num") if c in table.columns])
    if not key:
        raise ValueError("a code table of this size needs the rows' key")
    common = F.broadcast(used.where(F.col("n") > F.lit(cells / COMMON)))   # fewer than COMMON rows
    rare = used.where(F.col("n") <= F.lit(cells / COMMON))
    long = _cells(table, columns, key, row_col)
    found = long.join(common, ["column", "code"]).select(*key, "column", "text").unionAll(
        long.join(common, ["column", "code"], "left_anti").join(rare, ["column", "code"]).select(*key, "column", "text"))
    by_row = found.groupBy(*key).agg(F.map_from_entries(F.collect_list(F.struct("column", "text"))).alias("_texts"))
    by_row = by_row.select(*[F.col(c).alias(f"_k_{c}") for c in key], "_texts")
    on = F.lit(True)
    for c in key:
        on = on & F.col(c).eqNullSafe(F.col(f"_k_{c}"))
    joined = table.join(by_row, on, "left")
    return joined.withColumns({c: F.when(head, F.col(c).cast("string")).otherwise(F.col("_texts")[c]) for c in columns}).select(
        *table.columns)
