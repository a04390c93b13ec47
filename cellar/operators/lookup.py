"""Name lookups as joins: position -> header name, name -> first position,
name -> description, and the column dictionary ("codebook") read from cells.

The header has one row per column of a sheet and workbook.  The codebook is a
sheet of its own.  Joins carry no hint, so adaptive execution picks the join
from the measured sizes at run time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# --- fixed values -------------------------------------------------------------
CODEBOOK_SHEET = "Codebook"
CODEBOOK_NAME_COL = 1          # 0-based column holding the variable name
CODEBOOK_DESCRIPTION_COL = 2   # 0-based column holding its description
CODEBOOK_NAME_PREFIX = "H"     # names of interest start with this text
# -----------------------------------------------------------------------------


def one_name_per_position(header: DataFrame) -> DataFrame:
    """``(pos, name)`` of a header that may stem from several workbooks.  Fails
    the job when they name a position differently (``grid.align_workbooks``
    brings such sheets to one order)."""
    clash = F.raise_error(F.format_string("position %d has several header names", F.col("pos")))
    return header.groupBy("pos").agg(F.min("name").alias("name"), F.max("name").alias("_other")).select(
        "pos", F.when(F.col("name") == F.col("_other"), F.col("name")).otherwise(clash).alias("name"))


def with_header_name(df: DataFrame, header: DataFrame, pos_col: str = "pos",
                     out: str = "name") -> DataFrame:
    """Attach the header name of ``pos_col``; out of range or no header -> "".
    Rows that know their workbook get that workbook's name.  The join carries
    no hint: a header grows with the number of workbooks."""
    if "workbook" in df.columns and "workbook" in header.columns:
        names = header.select(F.col("workbook").alias("_hbook"), F.col("pos").alias("_hpos"),
                              F.col("name").alias("_hname"))
        on = (F.col(pos_col) == F.col("_hpos")) & F.col("workbook").eqNullSafe(F.col("_hbook"))
    else:
        names = one_name_per_position(header).select(F.col("pos").alias("_hpos"), F.col("name").alias("_hname"))
        on = F.col(pos_col) == F.col("_hpos")
    return (df.join(names, on, "left")
            .withColumn(out, F.coalesce(F.col("_hname"), F.lit("")))
            .drop("_hpos", "_hname", "_hbook"))


def header_positions(header: DataFrame) -> DataFrame:
    """``(name, pos)`` with the first position of every header name."""
    return header.groupBy("name").agg(F.min("pos").alias("pos"))


def find_position(header: DataFrame, name: str) -> int:
    """First position of ``name`` in the header, -1 when absent."""
    row = header.where(F.col("name") == name).agg(F.min("pos").alias("p")).collect()[0]
    return -1 if row["p"] is None else int(row["p"])


def with_description(df: DataFrame, codebook: DataFrame, name_col: str = "name",
                     out: str = "description") -> DataFrame:
    """Attach the codebook description of ``name_col``; absent -> ""."""
    book = codebook.select(F.col("name").alias("_cname"),
                           F.col("description").alias("_cdesc"))
    return (df.join(book, F.col(name_col) == F.col("_cname"), "left")
            .withColumn(out, F.coalesce(F.col("_cdesc"), F.lit("")))
            .drop("_cname", "_cdesc"))


def codebook_from_cells(cells: DataFrame, sheet: str | None = CODEBOOK_SHEET,
                        prefix: str = CODEBOOK_NAME_PREFIX,
                        name_col: int = CODEBOOK_NAME_COL,
                        description_col: int = CODEBOOK_DESCRIPTION_COL) -> DataFrame:
    """``(name, description)`` from a two-column dictionary sheet.

    Only string cells count.  A row gives an entry when its name cell starts
    with ``prefix`` (empty names are ignored) and it has a description cell.
    A name defined on several rows keeps the description of the last row; of
    several workbooks, that of the last workbook by path.
    """
    keys = [c for c in ("workbook", "sheet", "row_num") if c in cells.columns]
    last = F.struct(*[c for c in ("workbook", "row_num", "sheet") if c in keys])
    src = cells if sheet is None else cells.where(F.col("sheet") == sheet)
    pairs = (src.where(F.col("col_num").isin(name_col, description_col)
                       & (F.col("cell_type") == "string"))
             .groupBy(*keys)
             .agg(F.max(F.when(F.col("col_num") == name_col, F.col("value"))).alias("name"),
                  F.max(F.when(F.col("col_num") == description_col, F.col("value")))
                  .alias("description")))
    good = pairs.where((F.length("name") > 0) & F.col("name").startswith(prefix)
                       & F.col("description").isNotNull())
    return good.groupBy("name").agg(F.max_by("description", last).alias("description"))
