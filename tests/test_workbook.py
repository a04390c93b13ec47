"""Workbook folder scan and the sheet -> features path, checked against the
golden feature matrices of the original test suite."""

import os

import pytest
from pyspark.sql import functions as F

from cellar.functions.cells import vector_text
from cellar.operators import grid as g
from cellar.plans.flow import sheet_to_features
from cellar.sources.workbook import read_workbooks, workbook_errors
from xlsx import SAMPLE_HEADER, SAMPLE_MATRIX, SAMPLE_ROWS, write_xlsx

DROPS = {"all_cols": [], "no_1st_col": [0], "no_2nd_col": [1], "no_2nd_to_4th_cols": [1, 2, 3],
         "no_last_col": [6]}


def _fmt(v):
    return repr(float(v))


def golden(drop, with_header):
    rows = [[v for i, v in enumerate(r) if i not in drop] for r in SAMPLE_MATRIX]
    if with_header:
        rows = [[0.0] * (7 - len(drop))] + rows
    return ["[" + ",".join(_fmt(v) for v in r) + "]" for r in rows]


@pytest.fixture(scope="module")
def cells(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("books")
    write_xlsx(os.path.join(d, "sample.xlsx"), {
        "test": SAMPLE_ROWS,
        "types": {0: {0: True, 1: ("f", "A1+1"), 2: None, 3: 2.5, 4: "txt"},
                  2: {1: 7}},
    })
    return read_workbooks(spark, str(d)).cache()


def lines(features):
    rows = features.select("row_num", vector_text("features").alias("v")).collect()
    return [r["v"] for r in sorted(rows, key=lambda r: r["row_num"])]


@pytest.mark.parametrize("rows_mode", ["keep", "discard"])
@pytest.mark.parametrize("name", list(DROPS))
def test_goldens(cells, rows_mode, name):
    sf = sheet_to_features(cells, "test", rows=rows_mode, drop=DROPS[name])
    assert lines(sf.features) == golden(DROPS[name], rows_mode == "keep")


@pytest.mark.parametrize("name", list(DROPS))
def test_header_extract(cells, name):
    drop = DROPS[name]
    sf = sheet_to_features(cells, "test", rows="extract", drop=drop)
    assert lines(sf.features) == golden(drop, False)
    assert g.header_names(sf.header) == [h for i, h in enumerate(SAMPLE_HEADER) if i not in drop]
    assert sf.width == 7 - len(drop)


def test_cell_types(cells):
    got = {(r["row_num"], r["col_num"]): (r["cell_type"], r["value"])
           for r in cells.where(F.col("sheet") == "types").collect()}
    assert got[(0, 0)] == ("boolean", "true")
    assert got[(0, 1)][0] == "other"
    assert got[(0, 2)] == ("blank", None)
    assert got[(0, 3)] == ("numeric", "2.5")
    assert got[(0, 4)] == ("string", "txt")
    grid = g.densify(g.render(cells.where(F.col("sheet") == "types")))
    rows = {r["row_num"]: r["cells"] for r in grid.collect()}
    assert rows[0] == ["true", "Unknown value at Row: 1 Column: 2", "0", "2.5", "txt"]
    assert rows[2] == ["0", "7", "0", "0", "0"]
    assert 1 not in rows   # absent rows stay absent


def test_missing_sheet(cells):
    with pytest.raises(ValueError, match="not found"):
        sheet_to_features(cells, "test_a_surplus_wrong_suffix")


def test_broken_files(spark, tmp_path):
    """A file that breaks anywhere is left out whole, or fails the job."""
    write_xlsx(os.path.join(tmp_path, "good.xlsx"), {"x": {i: {0: i} for i in range(100)}})
    (tmp_path / "bad.xlsx").write_bytes(b"this is not a zip container")
    (tmp_path / "empty.xlsx").write_bytes(b"")
    import zipfile
    with zipfile.ZipFile(tmp_path / "good.xlsx") as zf:
        parts = {n: zf.read(n) for n in zf.namelist()}
    sheet = next(n for n in parts if "sheet1" in n)
    for name, changed in (("cut", {**parts, sheet: parts[sheet][:len(parts[sheet]) * 3 // 4]}),
                          ("gone", {n: x for n, x in parts.items() if n != sheet})):
        with zipfile.ZipFile(tmp_path / f"{name}.xlsx", "w") as zf:
            for n, x in changed.items():
                zf.writestr(n, x)
    with pytest.raises(ValueError, match="empty files: .*empty.xlsx"):
        read_workbooks(spark, str(tmp_path))
    for name in ("bad", "cut", "gone"):
        with pytest.raises(Exception, match=f"{name}.xlsx"):
            read_workbooks(spark, str(tmp_path), glob=f"{name}.xlsx").collect()
    assert read_workbooks(spark, str(tmp_path), on_error="skip").count() == 100
    errors = {r["workbook"].split("/")[-1] for r in workbook_errors(spark, str(tmp_path)).collect()}
    assert errors == {"bad.xlsx", "cut.xlsx", "gone.xlsx", "empty.xlsx"}


def test_rows_without_cells(spark, tmp_path):
    """A row of blank cells and a bare row element are rows; a missing one is not."""
    from cellar.sinks.workbook import save_workbook
    path = os.path.join(tmp_path, "rows.xlsx")
    save_workbook(path, "s", [(0, [("string", "h"), ("string", "i")]), (1, [("blank", None)] * 2), (2, []),
                              (4, [("numeric", 5), ("boolean", True)])])
    cells = read_workbooks(spark, str(tmp_path))
    rows = {r["row_num"]: r["cells"] for r in g.densify(g.render(cells)).collect()}
    assert rows == {0: ["h", "i"], 1: ["0", "0"], 2: ["0", "0"], 4: ["5", "true"]}


def test_sheet_filter(spark, tmp_path):
    write_xlsx(os.path.join(tmp_path, "a.xlsx"), {"x": {0: {0: 1}}, "y": {0: {0: 2}}})
    cells = read_workbooks(spark, str(tmp_path), sheets=["y"])
    assert [(r["sheet"], r["value"]) for r in cells.collect()] == [("y", "2")]


def test_several_workbooks_same_sheet(spark, tmp_path):
    write_xlsx(os.path.join(tmp_path, "a.xlsx"), {"Data": {0: {0: "h"}, 1: {0: 1, 1: 2}}})
    write_xlsx(os.path.join(tmp_path, "b.xlsx"), {"Data": {0: {0: "h"}, 1: {0: 3}}})
    cells = read_workbooks(spark, str(tmp_path))
    sf = sheet_to_features(cells, "Data", rows="extract")
    got = sorted(tuple(r["features"]) for r in sf.features.collect())
    assert got == [(1.0, 2.0), (3.0, 0.0)]


def test_workbooks_with_other_column_order(spark, tmp_path):
    """The recode hits the column of its name in each workbook, the codebooks
    are joined without loss, the report names each position once."""
    from cellar.operators import recode as rc
    from cellar.plans.flow import cluster_flow, codebook_for
    book = {0: {1: "HQ17", 2: "from A"}, 1: {1: "HA1", 2: "only A"}}
    other = {0: {1: "HQ17", 2: "from B"}, 1: {1: "HZ99", 2: "only B"}}
    write_xlsx(os.path.join(tmp_path, "a.xlsx"), {"Data": {0: {0: "HQ17", 1: "b"}, 1: {0: 1, 1: 9}, 2: {0: 2, 1: 8}}, "Codebook": book})
    write_xlsx(os.path.join(tmp_path, "b.xlsx"), {"Data": {0: {0: "b", 1: "HQ17"}, 1: {0: 7, 1: 3}, 2: {0: 6, 1: 1}}, "Codebook": other})
    cells = read_workbooks(spark, str(tmp_path))
    sf = sheet_to_features(cells, "Data", specs=[rc.Category("HQ17")])
    got = sorted((r["workbook"][-6:], r["row_num"], tuple(r["features"])) for r in sf.features.collect())
    assert got == [("a.xlsx", 1, (250.0, 9.0)), ("a.xlsx", 2, (750.0, 8.0)), ("b.xlsx", 1, (1500.0, 7.0)), ("b.xlsx", 2, (250.0, 6.0))]
    described = codebook_for(cells)
    assert {r["name"]: r["description"] for r in described.collect()} == {"HQ17": "from B", "HA1": "only A", "HZ99": "only B"}
    flow = cluster_flow(sf, codebook=described, k_min=2, k_max=2, max_iter=5)
    rows = flow.report.collect()
    assert len(rows) == len({(r["cluster"], r["pos"]) for r in rows}) == 4
    assert {r["name"]: r["description"] for r in rows} == {"HQ17": "from B", "b": ""}


def test_names_that_differ_by_case(spark, tmp_path):
    from cellar.operators import recode as rc
    write_xlsx(os.path.join(tmp_path, "a.xlsx"), {"Data": {
        0: {0: "Name", 1: "name", 2: "sheet", 3: "row_num"}, 1: {0: 1, 1: 2, 2: 3, 3: 4}}})
    sf = sheet_to_features(read_workbooks(spark, str(tmp_path)), "Data", specs=[rc.Category("name", "HQ17"), rc.Category("row_num", "HQ15")])
    assert sf.features.first()["features"] == [1.0, 750.0, 3.0, 3500.0]
    with pytest.raises(Exception, match="unmapped code '3' in column 'sheet'"):
        sheet_to_features(read_workbooks(spark, str(tmp_path)), "Data", specs=[rc.Year("sheet")]).features.collect()
