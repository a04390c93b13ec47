"""Write minimal XLSX workbooks for tests (stdlib only)."""

import zipfile
from xml.sax.saxutils import escape

_CT = """<?xml version="1.0" encoding="UTF-8" standalone="yes"?>
<Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types">
<Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/>
<Default Extension="xml" ContentType="application/xml"/>
<Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/>
{sheets}
<Override PartName="/xl/sharedStrings.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sharedStrings+xml"/>
</Types>"""


def col_letters(i):
    s = ""
    i += 1
    while i:
        i, r = divmod(i - 1, 26)
        s = chr(65 + r) + s
    return s


def write_xlsx(path, sheets):
    """``sheets``: {name: {row: {col: value}}}; str -> shared string, bool ->
    boolean, int/float -> number, ("f", text) -> formula with cached value,
    None -> blank cell (styled, no value)."""
    strings, index = [], {}

    def sid(s):
        if s not in index:
            index[s] = len(strings)
            strings.append(s)
        return index[s]

    parts = {}
    for n, (name, rows) in enumerate(sheets.items(), start=1):
        xml_rows = []
        for r in sorted(rows):
            cells = []
            for c in sorted(rows[r]):
                v = rows[r][c]
                ref = f"{col_letters(c)}{r + 1}"
                if v is None:
                    cells.append(f'<c r="{ref}" s="1"/>')
                elif isinstance(v, bool):
                    cells.append(f'<c r="{ref}" t="b"><v>{int(v)}</v></c>')
                elif isinstance(v, (int, float)):
                    cells.append(f'<c r="{ref}"><v>{v!r}</v></c>')
                elif isinstance(v, tuple) and v[0] == "f":
                    cells.append(f'<c r="{ref}"><f>{escape(v[1])}</f><v>1</v></c>')
                else:
                    cells.append(f'<c r="{ref}" t="s"><v>{sid(str(v))}</v></c>')
            xml_rows.append(f'<row r="{r + 1}">{"".join(cells)}</row>')
        parts[f"xl/worksheets/sheet{n}.xml"] = (
            '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
            '<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main">'
            f'<sheetData>{"".join(xml_rows)}</sheetData></worksheet>')
    names = list(sheets)
    wb = ('<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
          '<workbook xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" '
          'xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets>'
          + "".join(f'<sheet name="{escape(nm)}" sheetId="{i}" r:id="rId{i}"/>'
                    for i, nm in enumerate(names, start=1))
          + "</sheets></workbook>")
    rels = ('<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
            '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
            + "".join(f'<Relationship Id="rId{i}" Type="http://schemas.openxmlformats.org/'
                      f'officeDocument/2006/relationships/worksheet" Target="worksheets/sheet{i}.xml"/>'
                      for i in range(1, len(names) + 1))
            + "</Relationships>")
    sst = ('<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
           '<sst xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main">'
           + "".join(f"<si><t>{escape(s)}</t></si>" for s in strings) + "</sst>")
    overrides = "".join(
        f'<Override PartName="/xl/worksheets/sheet{i}.xml" ContentType="application/'
        f'vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>'
        for i in range(1, len(names) + 1))
    with zipfile.ZipFile(path, "w") as zf:
        zf.writestr("[Content_Types].xml", _CT.format(sheets=overrides))
        zf.writestr("_rels/.rels",
                    '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
                    '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/'
                    'relationships"><Relationship Id="rId1" Type="http://schemas.openxmlformats'
                    '.org/officeDocument/2006/relationships/officeDocument" '
                    'Target="xl/workbook.xml"/></Relationships>')
        zf.writestr("xl/workbook.xml", wb)
        zf.writestr("xl/_rels/workbook.xml.rels", rels)
        zf.writestr("xl/sharedStrings.xml", sst)
        for name, body in parts.items():
            zf.writestr(name, body)
    return path


# The sample sheet of the original test suite: a header row and four data
# rows with a missing cell and text in numeric columns.
SAMPLE_HEADER = [f"headerCol{i}" for i in range(1, 8)]
SAMPLE_ROWS = {
    0: dict(enumerate(SAMPLE_HEADER)),
    1: {0: 101.1, 1: 102.1, 2: 103.1, 3: 104.1, 4: 105.1, 5: 106.1, 6: 107.1},
    2: {0: 201.2, 2: 203.2, 3: 204.2, 4: 205.2, 5: 206.2, 6: 207.2},
    3: {0: 301.3, 1: "3za", 2: "3zb", 3: 304.3, 4: 305.3, 5: 306.3, 6: 307.3},
    4: {0: 401.4, 1: "4zt", 2: "4zu", 3: "4zv", 4: 405.4, 5: 406.4, 6: 407.4},
}
# Expected feature matrix (header dropped, all columns kept).
SAMPLE_MATRIX = [
    [101.1, 102.1, 103.1, 104.1, 105.1, 106.1, 107.1],
    [201.2, 0.0, 203.2, 204.2, 205.2, 206.2, 207.2],
    [301.3, 0.0, 0.0, 304.3, 305.3, 306.3, 307.3],
    [401.4, 0.0, 0.0, 0.0, 405.4, 406.4, 407.4],
]
