"""Cells -> dense grid rows, column selection and header handling.

Operators (DataFrame in, DataFrame out):

* ``render``        typed cells -> cell text (P10; a blank marks its row only)
* ``sheet_width``   max column index per sheet of each workbook (P1/A1)
* ``drop_columns``  drop cells by 0-based position (P3)
* ``densify``       cells -> one array per row, gaps filled (P9, P4 hook)
* ``discard_header`` / ``extract_header`` / ``route_rows``  row routing (P5-P8)
* ``align_workbooks``  rows of several workbooks -> one column order
* ``grid_to_table`` / ``table_to_grid``  positional rows <-> named columns

Scale notes.  ``densify`` is one shuffle keyed by ``(workbook, sheet, row_num)``; every
group is one sheet row, so its size is bounded by the sheet width no matter
how skewed the data is.  Every cell goes through the shuffle; behind it rows are runs
of sorted cells, and the gaps between them are filled in time linear in the width.
Facts about a sheet (its width, its column order) are joined to the rows: sent to all
tasks when few sheets have them (``FEW_SHEETS``, ``FEW_BYTES``), else by a shuffle.  When
the source is a table, ``sources.tables.grid_from_table`` builds the same grid without
any shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellar.functions.cells import FILLER, render_cell
from cellar.operators.lookup import one_name_per_position

ColumnFilter = Callable[[Column, Column], Column]

#: Facts of at most this many sheets, and of this many bytes, are sent to all tasks.
FEW_SHEETS = 10_000
FEW_BYTES = 32 << 20


def render(cells: DataFrame, *, pretty_numbers: bool = True,
           bool_as_number: bool = False) -> DataFrame:
    """Replace ``value`` with its cell text.  A blank cell becomes a marker of
    its row (``col_num`` NULL): the gap fill treats it as missing, and a row of
    blank cells stays a row."""
    text = render_cell("cell_type", "value", "row_num", "col_num",
                       pretty_numbers=pretty_numbers, bool_as_number=bool_as_number)
    ctype = F.col("cell_type")
    present = (F.when(ctype == "blank", F.lit(False))
               .when(ctype.isin("string", "numeric", "boolean"), F.col("value").isNotNull())
               .otherwise(F.lit(True)))
    return cells.withColumns({"col_num": F.when(present, F.col("col_num")),
                              "value": F.when(present & F.col("col_num").isNotNull(), text)})


def _sheet_keys(df: DataFrame) -> list[str]:
    return [c for c in ("workbook", "sheet") if c in df.columns]


def sheet_width(cells: DataFrame) -> DataFrame:
    """``([workbook,] sheet, max_col)``: the largest 0-based column index of each sheet
    of each workbook (-1 for a sheet without cells).  A partial aggregate: one row per
    sheet and partition is shuffled."""
    return cells.groupBy(*_sheet_keys(cells)).agg(F.coalesce(F.max("col_num"), F.lit(-1)).alias("max_col"))


def _with_sheet(rows: DataFrame, facts: DataFrame, few: bool) -> DataFrame:
    """Rows joined to one row of facts about their sheet (null workbooks match)."""
    keys = [k for k in _sheet_keys(rows) if k in facts.columns]
    facts = facts.select(*[F.col(k).alias(f"_of_{k}") for k in keys], *[c for c in facts.columns if c not in keys])
    on = F.lit(True)
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"_of_{k}"))
    return rows.join(F.broadcast(facts) if few else facts, on).drop(*[f"_of_{k}" for k in keys])


def max_column(cells: DataFrame) -> int:
    """Largest column index over ``cells`` (-1 when there are none).  One
    partial/final aggregate; a single number reaches the driver."""
    row = cells.agg(F.coalesce(F.max("col_num"), F.lit(-1)).alias("m")).collect()[0]
    return int(row["m"])


def drop_columns(cells: DataFrame, positions: Sequence[int]) -> DataFrame:
    """Drop cells at the given original 0-based positions."""
    positions = sorted({int(p) for p in positions})
    if not positions:
        return cells
    return cells.where(F.col("col_num").isNull() | ~F.col("col_num").isin(positions))


def kept_positions(width: int, drop: Sequence[int] = ()) -> list[int]:
    """Positions 0..width (inclusive) minus the dropped ones."""
    dropped = {int(p) for p in drop}
    return [i for i in range(width + 1) if i not in dropped]


def densify(cells: DataFrame, *, width: "int | DataFrame | None" = None, drop: Sequence[int] = (),
            col_filter: ColumnFilter | None = None, filler: str = FILLER,
            extra_rows: DataFrame | None = None, rendering: dict | None = None) -> DataFrame:
    """Long cells -> ``grid([workbook,] sheet, row_num, cells array<string>)``.

    Every row is padded to ``width`` (a max column index; cells beyond it are left out).
    Without one, each sheet of each workbook has its own width (``sheet_width``: a scan of
    the key and position columns; a frame of it may be passed).  Missing leading, inner
    and trailing cells get ``filler``.  A cell given twice keeps the larger text.  Dropped
    cells are blanked before the shuffle (their row stays).  ``col_filter(pos, value)``
    may rewrite a cell or return NULL to drop it; it also sees the filler of gap cells,
    so a position-based filter drops whole columns.  ``extra_rows`` ``([workbook,] sheet,
    row_num)`` are rows that exist without any cell; they come out filled with
    ``filler``.  ``rendering``: options of ``render`` for typed cells that are to be
    rendered behind the shuffle, by as many tasks as that has.
    """
    drop = sorted({int(p) for p in drop})
    # a row is identified by its sheet and number, and by its workbook when
    # the cells come from several workbooks
    keys = _keys(cells)
    carried = ["col_num", "value"] + (["cell_type"] if rendering is not None else [])
    body = cells.select(*keys, *carried)
    facts, few, top = None, True, width
    if width is None or isinstance(width, DataFrame):
        facts, few, top = _widths(body if width is None else width)
    if drop:
        # a dropped cell keeps its row present but carries no data into the shuffle
        kept = ~F.col("col_num").isin(drop)
        body = body.select(*keys, *[F.when(kept, F.col(c)).alias(c) for c in carried])
    if extra_rows is not None:
        missing = [k for k in keys if k not in extra_rows.columns]
        if missing:
            raise ValueError(f"extra_rows lacks {missing}")
        body = body.unionByName(extra_rows.select(*keys), allowMissingColumns=True)
    runs = body.repartition(*keys).sortWithinPartitions(
        *sorted(keys, key=lambda k: k != "row_num"), "col_num", "value")
    if rendering is not None:
        runs = render(runs, **rendering)
    types = {f.name: f.dataType for f in cells.schema.fields}
    schema = T.StructType([T.StructField(k, types[k]) for k in keys] + [T.StructField("cells", T.ArrayType(T.StringType()))])
    grid = runs.select(*keys, "col_num", "value").mapInArrow(_filled_runs(keys, drop, filler), schema)
    if facts is not None:
        # an extra row of a sheet without cells is as wide as nothing
        wide = _with_sheet(grid, facts, few) if extra_rows is None else grid.join(
            (F.broadcast(facts) if few else facts), _sheet_keys(grid), "left").withColumn("max_col", F.coalesce("max_col", F.lit(-1)))
        size = F.col("max_col") + 1 - sum((F.when(F.col("max_col") >= p, 1).otherwise(0) for p in drop), F.lit(0))
    else:
        wide, size = grid, F.lit(len(kept_positions(top, drop)))
    row = F.concat(F.slice("cells", F.lit(1), size), F.array_repeat(F.lit(filler), size - F.size("cells")))
    if col_filter is not None:
        places = F.array(*[F.lit(p) for p in kept_positions(top, drop)]).cast("array<int>")
        at = (lambda i: F.get(places, i)) if drop else (lambda i: i)
        row = F.filter(F.transform(row, lambda v, i: col_filter(at(i), v)), lambda v: v.isNotNull())
    return wide.select(*keys, row.alias("cells"))


def _widths(cells: DataFrame) -> tuple[DataFrame | None, bool, int]:
    """Widths of the sheets of ``cells`` (or a frame of ``sheet_width``): (frame, whether
    they are few, the largest); no frame when all sheets are equally wide."""
    known = cells if "max_col" in cells.columns else sheet_width(cells)
    rows = known.limit(FEW_SHEETS + 1).collect()
    if len(rows) > FEW_SHEETS:
        return known, False, known.agg(F.max("max_col")).first()[0]
    top = max((r["max_col"] for r in rows), default=-1)
    if all(r["max_col"] == top for r in rows):
        return None, True, top
    return known.sparkSession.createDataFrame(rows, known.schema), True, top


def _runs_of_rows(batches: Iterator[pa.RecordBatch], keys: Sequence[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Sorted cells -> tables of whole rows, with the place of each row's first cell."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([*held, batch]).combine_chunks()
        heads = _heads(table, keys)
        if len(heads) > 1:
            yield table.slice(0, heads[-1]), heads[:-1]
            held = table.slice(heads[-1]).to_batches()
        else:  # one row goes on
            held.append(batch)
    if held:
        table = pa.Table.from_batches(held).combine_chunks()
        yield table, _heads(table, keys)


def _heads(table: pa.Table, keys: Sequence[str]) -> np.ndarray:
    new = np.zeros(table.num_rows, bool)
    new[0] = True
    for k in keys:
        code = pc.dictionary_encode(table[k].combine_chunks(), null_encoding="encode").indices.to_numpy()
        new[1:] |= code[1:] != code[:-1]
    return np.flatnonzero(new)


def _filled_runs(keys: Sequence[str], drop: Sequence[int], filler: str):
    """Cells sorted by row and column -> one array per row, up to the row's last cell;
    dropped positions are skipped.  Linear in cells and positions."""
    dropped = np.array(drop, np.int64)

    def run(batches):
        for table, heads in _runs_of_rows(batches, keys):
            value = table["value"].combine_chunks()
            column = pc.fill_null(table["col_num"].combine_chunks(), -1).to_numpy().astype(np.int64)
            column -= np.searchsorted(dropped, column)
            row = np.repeat(np.arange(len(heads)), np.diff(np.append(heads, len(column))))
            size = np.maximum.reduceat(column, heads) + 1
            offset = np.concatenate([[0], np.cumsum(size)])
            # behind the values stands the filler; a later cell of one place overwrites
            source = np.full(offset[-1], len(value))
            cell = np.flatnonzero((column >= 0) & ~pc.is_null(value).to_numpy(zero_copy_only=False))
            source[offset[row[cell]] + column[cell]] = cell
            text = pa.concat_arrays([value, pa.array([filler], value.type)]).take(pa.array(source))
            yield pa.RecordBatch.from_arrays(
                [table[k].combine_chunks().take(pa.array(heads)) for k in keys]
                + [pa.ListArray.from_arrays(pa.array(offset.astype(np.int32)), text)], names=[*keys, "cells"])
    return run


# --- row routing (P5-P8) ------------------------------------------------------

def discard_header(grid: DataFrame) -> DataFrame:
    """Drop sheet row 0 (the header position, whether or not it holds names)."""
    return grid.where(F.col("row_num") != 0)


def route_rows(grid: DataFrame, save: Column, extract: Column) -> tuple[DataFrame, DataFrame]:
    """Custom router: rows where ``save`` holds go to the data frame, rows
    where ``extract`` holds go to the second frame (both, one or neither)."""
    return grid.where(F.coalesce(save, F.lit(False))), \
        grid.where(F.coalesce(extract, F.lit(False)))


def route_labels(grid: DataFrame, routes: dict[str, Column]) -> DataFrame:
    """Custom router in one scan: every row once per route whose condition holds
    (none, one or several), with the route's name in ``route``."""
    taken = F.array_compact(F.array(*[F.when(F.coalesce(cond, F.lit(False)), F.lit(name))
                                      for name, cond in routes.items()]))
    return grid.withColumn("route", F.explode(taken))


def header_frame(rows: DataFrame) -> DataFrame:
    """Header rows -> ``([workbook,] sheet, pos, name)`` (``posexplode`` of the
    cells)."""
    keys = [c for c in ("workbook", "sheet") if c in rows.columns]
    return rows.select(*keys, F.posexplode("cells").alias("pos", "name"))


def extract_header(grid: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Row 0 -> header ``([workbook,] sheet, pos, name)``; the other rows -> data."""
    data, head = route_rows(grid, F.col("row_num") != 0, F.col("row_num") == 0)
    return data, header_frame(head)


def header_names(header: DataFrame, sheet: str | None = None) -> list[str]:
    """Header names by position, one short string per column of the sheet.  Fails
    when workbooks name a position differently."""
    if sheet is not None:
        header = header.where(F.col("sheet") == sheet)
    names = {int(r["pos"]): r["name"] for r in one_name_per_position(header).collect()}
    return [names.get(i) or "" for i in range(max(names, default=-1) + 1)]


def align_workbooks(data: DataFrame, header: DataFrame, filler: str = FILLER) -> tuple[DataFrame, DataFrame]:
    """Data rows of several workbooks whose headers may differ -> rows of one
    column order, and that order as a header ``(sheet, pos, name)``.

    A column is its header name (the n-th of equal names).  Columns stand in the
    order of the first workbook, those that only later ones have behind them;
    a workbook without a column has ``filler`` there.  When all headers agree the
    rows are returned as they are.

    Each workbook gets one permutation, the place of every wanted column in its own
    rows, made once from the header; its rows gather their cells by index.
    """
    if "workbook" not in header.columns:
        return data, header
    books = header.groupBy("workbook", "sheet").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("pos", "name"))), lambda x: x["name"]).alias("names"))
    if books.select("sheet", "names").distinct().groupBy("sheet").count().where("count > 1").isEmpty():
        return data, header.drop("workbook").distinct()
    again = W.partitionBy("workbook", "sheet", "name").orderBy("pos")
    columns = header.withColumns({"name": F.coalesce("name", F.lit("")), "time": F.row_number().over(again)})
    # one row per wanted column, no more than a row of the result has cells
    wanted = columns.groupBy("sheet", "name", "time").agg(F.min(F.struct("workbook", "pos")).alias("first"))
    wanted = wanted.withColumn("to", (F.row_number().over(
        W.partitionBy("sheet").orderBy("first", "name", "time")) - 1).cast("int")).drop("first")
    places = columns.join(wanted, ["sheet", "name", "time"]).groupBy("workbook", "sheet").agg(
        F.array_sort(F.collect_list(F.struct("to", "pos"))).alias("p"))
    places = places.join(wanted.groupBy("sheet").agg(F.count(F.lit(1)).cast("int").alias("n")), "sheet")
    p = F.col("p")
    gap = lambda i: F.when(i == 0, F.lit(-1)).otherwise(F.get(p, i - 1)["to"])
    spread = F.flatten(F.transform(p, lambda x, i: F.concat(
        F.array_repeat(F.lit(-1), x["to"] - gap(i) - 1), F.array(x["pos"]))))
    places = places.select("workbook", "sheet", "n", spread.alias("place"))
    few = places.agg(F.count(F.lit(1)).alias("n"), F.sum(F.size("place").cast("long")).alias("m")).first()
    joined = _with_sheet(data, places, few.n <= FEW_SHEETS and (few.m or 0) * 4 <= FEW_BYTES)
    own = F.col("cells")
    cells = F.transform("place", lambda i: F.when(i >= 0, F.coalesce(F.get(own, i), F.lit(filler))).otherwise(F.lit(filler)))
    cells = F.concat(cells, F.array_repeat(F.lit(filler), F.col("n") - F.size("place")))
    return (joined.withColumn("cells", cells).select(*data.columns),
            wanted.select("sheet", F.col("to").alias("pos"), "name"))


def unique_names(names: Sequence[str]) -> list[str]:
    """Column names for ``grid_to_table``: the first occurrence of a header
    name keeps it; empty names become ``_c<pos>``, later duplicates
    ``<name>__<pos>``."""
    seen: set[str] = set()
    out = []
    for pos, name in enumerate(names):
        name = name or ""
        col = name if name and name not in seen else (f"{name}__{pos}" if name else f"_c{pos}")
        seen.add(name)
        out.append(col)
    return out


def _keys(df: DataFrame) -> list[str]:
    return [c for c in ("workbook", "sheet", "row_num") if c in df.columns]


def grid_to_table(grid: DataFrame, names: Sequence[str], keep: Sequence[str] | None = None) -> DataFrame:
    """Positional rows -> one string column per header name (a projection).
    Names that differ only by case, or equal a key column, need
    ``positional_table``."""
    cols = unique_names(names)
    return grid.select(*(_keys(grid) if keep is None else keep),
                       *[F.col("cells")[i].alias(c) for i, c in enumerate(cols)])


def table_to_grid(table: DataFrame, names: Sequence[str], keep: Sequence[str] | None = None) -> DataFrame:
    """Named string columns -> positional ``cells`` array (a projection)."""
    cols = unique_names(names)
    return table.select(*(_keys(table) if keep is None else keep),
                        F.array(*[F.col(f"`{c}`").cast("string") for c in cols]).alias("cells"))


def position_name(pos: int) -> str:
    return f"_p{pos}"


def replace_cells(grid: DataFrame, positions: Sequence[int], change: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Apply ``change`` to the cells at some positions: it gets a table of the grid's
    keys and one string column per position (``position_name``) and returns one of the
    same columns; the other cells pass by untouched, in runs between them."""
    at = sorted({int(p) for p in positions})
    held = grid.select(*_keys(grid), F.col("cells").alias("_row"), *[F.get("cells", F.lit(p)).alias(position_name(p)) for p in at])
    parts, start = [], 0
    for p in at:
        if p > start:
            parts.append(F.slice("_row", start + 1, p - start))
        parts.append(F.array(F.col(position_name(p)).cast("string")))
        start = p + 1
    parts.append(F.slice("_row", F.lit(start + 1), F.greatest(F.size("_row") - start, F.lit(0))))
    return change(held).select(*_keys(grid), F.concat(*parts).alias("cells"))


def positional_table(grid: DataFrame, width: int) -> DataFrame:
    """Positional rows -> one string column per position (``_p0``, ``_p1``, ...),
    whatever the header says."""
    return grid.select(*_keys(grid), *[F.col("cells")[i].alias(position_name(i)) for i in range(width)])


def positional_grid(table: DataFrame, width: int) -> DataFrame:
    return table.select(*_keys(table), F.array(*[F.col(position_name(i)) for i in range(width)]).alias("cells"))


# --- custom row transform (P17 / U3 escape hatch) ---------------------------------

BatchFn = Callable[["pandas.DataFrame"], "pandas.DataFrame"]  # noqa: F821


def map_rows(grid: DataFrame, fn: BatchFn, *, skip_header: bool = True) -> DataFrame:
    """Apply a Python function to whole Arrow batches of grid rows
    (``mapInPandas``): it gets a pandas frame with all columns of the grid and
    returns one of the same columns.  Prefer Column expressions (recode specs,
    ``DataFrame.transform``); this is the hatch for logic they cannot say.
    Row 0 passes through untouched when ``skip_header``."""
    def run(batches):
        for pdf in batches:
            yield fn(pdf)

    if not skip_header:
        return grid.mapInPandas(run, grid.schema)
    return grid.where(F.col("row_num") != 0).mapInPandas(run, grid.schema).union(
        grid.where(F.col("row_num") == 0))
