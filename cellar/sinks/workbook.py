"""Table rows -> XLSX workbooks, one file per range of keys, written by tasks to a
shared folder (a ``file:`` path that every executor mounts)."""

from __future__ import annotations

import os
import zipfile
from collections.abc import Sequence
from xml.sax.saxutils import escape

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
_REL = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
_PKG = "http://schemas.openxmlformats.org/package/2006"


def column_letters(index: int) -> str:
    """0 -> "A", 25 -> "Z", 26 -> "AA"."""
    out = ""
    index += 1
    while index:
        index, rest = divmod(index - 1, 26)
        out = chr(65 + rest) + out
    return out


def cell_xml(ref: str, kind: str, value) -> str:
    """One cell element; ``kind``: string, numeric, boolean, other (a formula with
    its cached value) or blank."""
    if kind == "blank" or value is None or value != value:
        return f'<c r="{ref}"/>'
    if kind == "string":
        return f'<c r="{ref}" t="inlineStr"><is><t xml:space="preserve">{escape(str(value))}</t></is></c>'
    if kind == "boolean":
        return f'<c r="{ref}" t="b"><v>{int(value)}</v></c>'
    if kind == "other":
        return f'<c r="{ref}"><f>{escape(str(value))}</f><v>{escape(str(value))}</v></c>'
    return f'<c r="{ref}"><v>{value!r}</v></c>'


def save_workbook(path: str, sheet: str, rows) -> None:
    """``rows``: (0-based row number, [(kind, value), ...])."""
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as zf:
        zf.writestr("[Content_Types].xml", f'<Types xmlns="{_PKG}/content-types"><Default Extension="xml" ContentType="application/xml"/></Types>')
        zf.writestr("xl/workbook.xml", f'<workbook xmlns="{_MAIN}" xmlns:r="{_REL}"><sheets><sheet name="{escape(sheet)}" sheetId="1" r:id="r1"/></sheets></workbook>')
        zf.writestr("xl/_rels/workbook.xml.rels", f'<Relationships xmlns="{_PKG}/relationships"><Relationship Id="r1" Type="{_REL}/worksheet" Target="worksheets/sheet1.xml"/></Relationships>')
        with zf.open("xl/worksheets/sheet1.xml", "w") as out:
            out.write(f'<worksheet xmlns="{_MAIN}"><sheetData>'.encode())
            for row, cells in rows:
                body = "".join(cell_xml(f"{column_letters(i)}{row + 1}", k, v) for i, (k, v) in enumerate(cells))
                out.write(f'<row r="{row + 1}">{body}</row>'.encode())
            out.write(b"</sheetData></worksheet>")


def write_workbooks(df: DataFrame, key: str, columns: Sequence[tuple[str, str]], path: str, *,
                    sheet: str = "data", rows_per_file: int = 50_000) -> DataFrame:
    """``columns``: (column, cell kind).  Rows with keys in one range of
    ``rows_per_file`` make one workbook; the sheet row is the key within the
    range plus 1, row 0 holds the names.  Returns ``(workbook, rows)``."""
    folder = path.removeprefix("file:").replace("///", "/")
    names, kinds = [c for c, _ in columns], [k for _, k in columns]

    def save(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_row")
        book = int(pdf["_book"].iloc[0])
        os.makedirs(folder, exist_ok=True)
        final = f"{folder}/book-{book:06d}.xlsx"
        part = f"{final}.part-{os.getpid()}"  # a retried task replaces a whole file
        rows = [(0, [("string", n) for n in names])]
        rows += [(int(r), list(zip(kinds, values))) for r, values in
                 zip(pdf["_row"], pdf[names].itertuples(index=False, name=None))]
        save_workbook(part, sheet, rows)
        os.replace(part, final)
        return pd.DataFrame({"workbook": [final], "rows": [len(pdf)]})

    placed = df.select((F.col(key) / rows_per_file).cast("long").alias("_book"),
                       (F.pmod(key, F.lit(rows_per_file)) + 1).alias("_row"), *names)
    return placed.groupBy("_book").applyInPandas(save, "workbook string, rows long")
