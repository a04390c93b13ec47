"""Spark tables and text files as sources of cells, grids and feature rows.

* ``melt``            any table -> long ``cells`` frame (S7), one Expand, no shuffle
* ``grid_from_table`` any table -> dense ``grid`` directly (no shuffle); equal to
                      ``densify(melt(...))`` and the path to prefer at scale
* ``select_sheet``    filter one sheet and fail clearly when it is absent (S2)
* ``read_feature_text`` delimited text lines -> features (S3)
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellar.functions.cells import (FILLER, parse_cells, pretty_number, render_cell,
                                   tokenize)

CELLS_SCHEMA = T.StructType([
    T.StructField("workbook", T.StringType()),
    T.StructField("sheet", T.StringType()),
    T.StructField("row_num", T.LongType()),
    T.StructField("col_num", T.IntegerType()),
    T.StructField("cell_type", T.StringType()),
    T.StructField("value", T.StringType()),
])

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
            T.DecimalType)


def cell_type_of(dtype: T.DataType) -> str:
    """Spark type -> cell type.  Dates and timestamps become string cells
    holding their ISO text; nested types become ``other``."""
    if isinstance(dtype, _NUMERIC):
        return "numeric"
    if isinstance(dtype, T.BooleanType):
        return "boolean"
    if isinstance(dtype, (T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType)):
        return "string"
    return "other"


def _row_number(key) -> Column:
    if key is None:
        # unique per row, no shuffle; dense numbering would need a global sort
        return F.monotonically_increasing_id()
    return (F.col(key) if isinstance(key, str) else key).cast("long")


def _present(c: Column, ctype: str, drop_zero: bool) -> Column:
    cond = c.isNotNull()
    if drop_zero and ctype == "numeric":
        cond = cond & (c.cast("double") != 0)
    return cond


def melt(df: DataFrame, key=None, columns: Sequence[str] | None = None, *,
         sheet: str = "data", workbook: str = "table", header: bool = True,
         row_offset: int = 1, drop_zero: bool = False) -> DataFrame:
    """Wide table -> long ``cells`` frame.

    ``col_num`` is the position in ``columns``; ``row_num`` is ``key +
    row_offset`` so that row 0 is free for the header (written when
    ``header=True``).  NULL values give no cell (a blank in a sheet);
    ``drop_zero`` also leaves numeric zeros out, the usual sparse encoding —
    the gap fill writes them back as the filler "0".  A row without any cell
    left gives one marker (``col_num`` NULL), so that the row stays.
    """
    columns = list(columns or [c for c in df.columns if c != key])
    types = {f.name: cell_type_of(f.dataType) for f in df.schema.fields}
    spark = df.sparkSession
    nothing = F.lit(True)
    for c in columns:
        nothing = nothing & ~_present(F.col(c), types[c], drop_zero)
    marker = F.when(nothing, F.struct(F.lit(None).cast("int").alias("col_num"), F.lit("blank").alias("cell_type"),
                                      F.lit(None).cast("string").alias("value")))
    packed = df.select(
        (_row_number(key) + F.lit(row_offset)).alias("row_num"),
        *[F.struct(F.lit(i).alias("col_num"), F.lit(types[c]).alias("cell_type"),
                   F.when(_present(F.col(c), types[c], drop_zero), F.col(c).cast("string"))
                   .alias("value")).cast("struct<col_num:int,cell_type:string,value:string>").alias(f"_c{i}")
          for i, c in enumerate(columns)],
        marker.cast("struct<col_num:int,cell_type:string,value:string>").alias("_row"))
    long = (packed.unpivot("row_num", [*(f"_c{i}" for i in range(len(columns))), "_row"], "_name", "_cell")
            .where(F.col("_cell.value").isNotNull() | ((F.col("_name") == "_row") & F.col("_cell").isNotNull()))
            .select(F.lit(workbook).alias("workbook"), F.lit(sheet).alias("sheet"),
                    "row_num", "_cell.col_num", "_cell.cell_type", "_cell.value"))
    if header:
        head = spark.createDataFrame(
            [(workbook, sheet, 0, i, "string", c) for i, c in enumerate(columns)], CELLS_SCHEMA)
        long = head.unionByName(long)
    return long


def grid_from_table(df: DataFrame, key=None, columns: Sequence[str] | None = None, *,
                    sheet: str = "data", header: bool = True, row_offset: int = 1,
                    drop_zero: bool = False, pretty_numbers: bool = True,
                    filler: str = FILLER, keep: Sequence[str] = ()) -> DataFrame:
    """Wide table -> ``grid`` rows without a shuffle.

    Equivalent to ``densify(render(melt(df, ...)))``: every cell is rendered
    like a typed sheet cell and missing cells get ``filler``.  The cells of a
    table row already sit together, so no grouping is needed.  ``keep``
    columns ride along outside the cells (NULL on the header row).
    """
    columns = list(columns or [c for c in df.columns if c != key])
    types = {f.name: cell_type_of(f.dataType) for f in df.schema.fields}
    row_num = _row_number(key) + F.lit(row_offset)
    rendered = []
    exact = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DoubleType)
    dtypes = {f.name: f.dataType for f in df.schema.fields}
    for i, c in enumerate(columns):
        present = _present(F.col(c), types[c], drop_zero)
        if pretty_numbers and isinstance(dtypes[c], exact):
            # integers and doubles print straight from the number (their text
            # form would parse back to the same double)
            text = F.when(present, pretty_number(F.col(c)))
        else:
            value = F.when(present, F.col(c).cast("string"))
            text = render_cell(F.lit(types[c]), value, row_num, F.lit(i),
                               pretty_numbers=pretty_numbers)
        rendered.append(F.coalesce(text, F.lit(filler)))
    grid = df.select(F.lit(sheet).alias("sheet"), row_num.alias("row_num"),
                     F.array(*rendered).alias("cells"), *keep)
    if header:
        head = df.sparkSession.createDataFrame(
            [(sheet, 0, list(columns))], "sheet string, row_num bigint, cells array<string>")
        for k in keep:
            head = head.withColumn(k, F.lit(None).cast(df.schema[k].dataType))
        grid = head.unionByName(grid)
    return grid


def table_header(df: DataFrame, columns: Sequence[str], sheet: str = "data") -> DataFrame:
    """The header ``(sheet, pos, name)`` of a table's sheet, as its own frame:
    nothing of the table is read."""
    return df.sparkSession.createDataFrame([(sheet, i, c) for i, c in enumerate(columns)],
                                           "sheet string, pos int, name string")


def select_sheet(cells: DataFrame, sheet: str, check: bool = True) -> DataFrame:
    """Cells of one sheet.  With ``check`` an absent sheet raises ValueError
    (a ``limit(1)`` probe, which stops at the first match)."""
    picked = cells.where(F.col("sheet") == sheet)
    if check and not picked.select("sheet").limit(1).collect():
        raise ValueError(f"sheet {sheet!r} not found")
    return picked


#: Offsets of at most this many blocks of files are sent to all tasks.
FEW_BLOCKS = 10_000


def _numbered(rows: DataFrame, block: Sequence[str], place: Column, first: int) -> DataFrame:
    """Rows with ``row_num``: ``first`` + rows of the blocks before + place in the block.
    Counts per block (one row each) reach the driver, which sums them up in the order
    of ``block``; rows do not."""
    spark = rows.sparkSession
    counts = sorted(rows.groupBy(*block).agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("low")).collect(),
                    key=lambda r: tuple(r[b] for b in block))
    starts, total = [], first
    for r in counts:
        starts.append((*(r[b] for b in block), total, r["low"]))
        total += r["n"]
    schema = ", ".join(f"_b{i} {rows.schema[b].dataType.simpleString()}" for i, b in enumerate(block))
    offsets = spark.createDataFrame(starts, f"{schema}, _start long, _low long")
    on = [F.col(b) == F.col(f"_b{i}") for i, b in enumerate(block)]
    joined = rows.join(F.broadcast(offsets) if len(starts) <= FEW_BLOCKS else offsets, on)
    return joined.withColumn("row_num", F.col("_start") + place - F.col("_low")).drop(
        "_start", "_low", *[f"_b{i}" for i in range(len(block))])


def read_feature_text(spark: SparkSession, path: str, sep: str = ",",
                      line_sep: str | None = None, default: float = 0.0, work: str | None = None) -> DataFrame:
    """Delimited text -> ``(row_num, features)``.  Lines may carry the
    ``[a,b]`` brackets the vector text sink writes.  Tokens that do not parse
    become ``default``; trailing empty tokens are dropped as a plain split
    does.

    ``row_num`` counts the lines from 1 (0 is the header's number), files in the order
    of their names, however the files are split among tasks.  The text is read once:
    features go to the shared folder (``work``, or the session's) with the block of the
    file they stand in; the blocks' counts give each its first number."""
    import uuid

    from cellar.session import shared_path
    reader = spark.read
    if line_sep:
        reader = reader.option("lineSep", line_sep)
    lines = reader.text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("place"))   # rising within a block
    body = F.regexp_replace(F.col("value"), r"^\[|\]$", "")
    parsed = lines.select("file", "block", "place", parse_cells(
        tokenize(body, sep, drop_trailing_empty=True), default).alias("features"))
    kept = f"{work}/features-{uuid.uuid4().hex}" if work else shared_path(spark, "text", f"features-{uuid.uuid4().hex}")
    parsed.write.parquet(kept)
    return _numbered(spark.read.schema(parsed.schema).parquet(kept), ["file", "block"], F.col("place"), 1).select(
        "row_num", "features")


def number_rows(table: DataFrame, first: int = 1) -> DataFrame:
    """A Parquet table with ``row_num``: ``first``, ``first`` + 1, ... in the order of its
    files' names and the rows in them, however the files are split among tasks.  Two
    passes: rows per file, then the numbers."""
    placed = table.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_place"))
    return _numbered(placed, ["_file"], F.col("_place"), first).drop("_file", "_place")
