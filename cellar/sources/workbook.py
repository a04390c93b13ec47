"""Folder of XLSX workbooks -> long ``cells`` frame.

``spark.read.format("binaryFile")`` lists the files and hands each one to a
task; a small stdlib parser (``zipfile`` + streaming ``iterparse``) walks the
sheets inside ``mapInPandas`` and emits cells in bounded chunks.  A workbook
is not splittable, so one file is the unit of work; the XLSX format itself
bounds a sheet (1,048,576 rows x 16,384 columns).

Cell types follow the spreadsheet's own: shared / inline strings -> string,
numbers (dates included, as serial numbers) -> numeric, booleans -> boolean,
formulas and errors -> other, cells without a value -> blank.
"""

from __future__ import annotations

import io
import posixpath
import zipfile
import zlib
from collections.abc import Iterator, Sequence
from urllib.parse import unquote
from xml.etree.ElementTree import ParseError, iterparse

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from cellar.sources.tables import CELLS_SCHEMA

_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
_PKG_REL = "{http://schemas.openxmlformats.org/package/2006/relationships}"
CHUNK = 50_000


class WorkbookError(ValueError):
    pass


def column_index(ref: str) -> int:
    """"A" -> 0, "Z" -> 25, "AA" -> 26 (letters of a cell reference)."""
    n = 0
    for ch in ref:
        if not ch.isalpha():
            break
        n = n * 26 + (ord(ch.upper()) - 64)
    return n - 1


def _row_of(ref: str) -> int | None:
    digits = "".join(ch for ch in ref if ch.isdigit())
    return int(digits) if digits else None


def _text_of(el) -> str:
    """Concatenated text runs (``t`` elements) of a string item, skipping
    phonetic runs."""
    parts = []
    for node in el.iter():
        if node.tag == _MAIN + "rPh":
            continue
        if node.tag == _MAIN + "t" and node.text:
            parts.append(node.text)
    return "".join(parts)


def _shared_strings(zf: zipfile.ZipFile) -> list[str]:
    name = "xl/sharedStrings.xml"
    if name not in zf.namelist():
        return []
    out = []
    with zf.open(name) as fh:
        for _, el in iterparse(fh, events=("end",)):
            if el.tag == _MAIN + "si":
                out.append(_text_of(el))
                el.clear()
    return out


def sheet_paths(zf: zipfile.ZipFile) -> list[tuple[str, str]]:
    """``(sheet name, part path)`` in workbook order."""
    try:
        with zf.open("xl/workbook.xml") as fh:
            wb = [(el.get("name"), el.get(_REL + "id"))
                  for _, el in iterparse(fh) if el.tag == _MAIN + "sheet"]
        with zf.open("xl/_rels/workbook.xml.rels") as fh:
            rels = {el.get("Id"): el.get("Target")
                    for _, el in iterparse(fh) if el.tag == _PKG_REL + "Relationship"}
    except KeyError as exc:
        raise WorkbookError(f"not a workbook: {exc}") from exc
    out = []
    for name, rid in wb:
        target = rels.get(rid, "")
        path = target.lstrip("/") if target.startswith("/") else posixpath.normpath(
            posixpath.join("xl", target))
        out.append((name, path))
    return out


def iter_cells(content: bytes, sheets: Sequence[str] | None = None
               ) -> Iterator[tuple[str, int, int | None, str, str | None]]:
    """``(sheet, row_num, col_num, cell_type, value)`` for every cell, with
    0-based row and column numbers.  A row element without cells gives one
    marker with ``col_num`` None.  Whatever is broken in the file raises
    ``WorkbookError``."""
    try:
        yield from _cells_of(content, sheets)
    except (zipfile.BadZipFile, zlib.error, ParseError, KeyError, IndexError, ValueError, EOFError,
            NotImplementedError) as exc:
        if isinstance(exc, WorkbookError):
            raise
        raise WorkbookError(f"broken workbook: {exc!r}") from exc


def _cells_of(content: bytes, sheets: Sequence[str] | None):
    try:
        zf = zipfile.ZipFile(io.BytesIO(content))
    except zipfile.BadZipFile as exc:
        raise WorkbookError("not a workbook (no zip container)") from exc
    with zf:
        strings = _shared_strings(zf)
        for sheet, path in sheet_paths(zf):
            if sheets is not None and sheet not in sheets:
                continue
            with zf.open(path) as fh:
                row, col, cells = -1, -1, 0
                for event, el in iterparse(fh, events=("start", "end")):
                    tag = el.tag
                    if event == "start":
                        if tag == _MAIN + "row":
                            r = el.get("r")
                            row = int(r) - 1 if r else row + 1
                            col, cells = -1, 0
                        continue
                    if tag != _MAIN + "c":
                        if tag == _MAIN + "row":
                            if not cells:
                                yield sheet, row, None, "blank", None
                            el.clear()
                        continue
                    cells += 1
                    ref = el.get("r")
                    col = column_index(ref) if ref else col + 1
                    if ref and _row_of(ref) is not None:
                        row = _row_of(ref) - 1
                    kind = el.get("t", "n")
                    v = el.find(_MAIN + "v")
                    text = v.text if v is not None else None
                    if el.find(_MAIN + "f") is not None or kind in ("str", "e"):
                        ctype, value = "other", text
                    elif kind == "s":
                        ctype, value = "string", strings[int(text)] if text is not None else None
                        if value is None:
                            ctype = "blank"
                    elif kind == "inlineStr":
                        node = el.find(_MAIN + "is")
                        ctype, value = "string", _text_of(node) if node is not None else ""
                    elif kind == "b":
                        ctype, value = ("boolean", "true" if text == "1" else "false") \
                            if text is not None else ("blank", None)
                    else:
                        ctype, value = ("numeric", text) if text is not None else ("blank", None)
                    el.clear()
                    yield sheet, row, col, ctype, value


def read_workbooks(spark: SparkSession, path: str, *, sheets: Sequence[str] | None = None,
                   glob: str = "*.xlsx", recursive: bool = False,
                   on_error: str = "fail") -> DataFrame:
    """Every workbook under ``path`` -> ``cells``.  ``sheets`` limits the sheets
    parsed.  A file that is empty or broken fails the job, which names it; with
    ``on_error="skip"`` the whole file is left out (``workbook_errors`` lists
    such files)."""
    if on_error not in ("fail", "skip"):
        raise ValueError(f"unknown on_error {on_error!r}")
    files, empty = _files(spark, path, glob, recursive)
    if empty and on_error == "fail":
        raise WorkbookError(f"empty files: {', '.join(empty)}")
    wanted = None if sheets is None else list(sheets)
    cols = [f.name for f in CELLS_SCHEMA.fields]

    def frame(buf):
        return pd.DataFrame(buf, columns=cols).astype({"col_num": "Int32"})

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for file_path, content in zip(pdf["path"], pdf["content"]):
                content = bytes(content)
                if on_error == "skip" and error_of(content, wanted):
                    continue  # found out before the first cell is passed on
                buf = []
                try:
                    for sheet, row, col, ctype, value in iter_cells(content, wanted):
                        buf.append((file_path, sheet, row, col, ctype, value))
                        if len(buf) >= CHUNK:
                            yield frame(buf)
                            buf = []
                except WorkbookError as exc:
                    raise WorkbookError(f"{file_path}: {exc}") from exc
                if buf:
                    yield frame(buf)

    return files.mapInPandas(parse, CELLS_SCHEMA)


def _files(spark, path, glob, recursive):
    """The files, and the paths of the empty ones, which a file scan passes over.
    Only the listing is read here."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", glob)
             .option("recursiveFileLookup", str(recursive).lower()).load(path)
             .select("path", "content"))
    plain = lambda p: unquote(p).replace("file:///", "file:/")
    found = {plain(r.path) for r in files.select("path").collect()}  # one path per workbook
    return files, sorted({plain(p) for p in files.inputFiles()} - found)


def error_of(content: bytes, sheets: Sequence[str] | None = None) -> str | None:
    """Why the file is no whole workbook, or None."""
    try:
        for _ in iter_cells(content, sheets):
            pass
    except WorkbookError as exc:
        return str(exc)
    return None


def workbook_errors(spark: SparkSession, path: str, *, sheets: Sequence[str] | None = None,
                    glob: str = "*.xlsx", recursive: bool = False) -> DataFrame:
    """``(workbook, error)`` of the files that ``on_error="skip"`` leaves out."""
    files, empty = _files(spark, path, glob, recursive)
    wanted = None if sheets is None else list(sheets)

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [(p, error_of(bytes(x), wanted)) for p, x in zip(pdf["path"], pdf["content"])]
            yield pd.DataFrame([r for r in rows if r[1]], columns=["workbook", "error"])

    schema = "workbook string, error string"
    return files.mapInPandas(check, schema).union(
        spark.createDataFrame([(p, "empty file") for p in empty], schema))
