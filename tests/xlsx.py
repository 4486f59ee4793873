"""Write a minimal workbook: rows of text or numbers, links on column F."""

from __future__ import annotations

import io
import zipfile
from xml.sax.saxutils import escape, quoteattr

_NS = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
_REL = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
_PKG = 'xmlns="http://schemas.openxmlformats.org/package/2006/relationships"'


def workbook(rows, links=None, sheet="Sheet1") -> bytes:
    """``rows``: lists of cells, None for no cell, ("date", serial) for a day; ``links``: row -> target."""
    strings, body = [], []
    for r, cells in enumerate(rows, start=1):
        out = []
        for c, value in enumerate(cells):
            if value is None:
                continue
            ref = f"{chr(65 + c)}{r}"
            if isinstance(value, tuple):
                out.append(f'<c r="{ref}" s="1"><v>{value[1]}</v></c>')
            elif isinstance(value, (int, float)):
                out.append(f'<c r="{ref}"><v>{value}</v></c>')
            else:
                if value not in strings:
                    strings.append(value)
                out.append(f'<c r="{ref}" t="s"><v>{strings.index(value)}</v></c>')
        body.append(f'<row r="{r}">{"".join(out)}</row>')
    links = links or {}
    marks = "".join(f'<hyperlink ref="F{r}" r:id="rId{r}"/>' for r in links)
    targets = "".join(
        f'<Relationship Id="rId{r}" Type="x" Target={quoteattr(t)} TargetMode="External"/>'
        for r, t in links.items()
    )
    files = {
        "xl/workbook.xml": f'<workbook {_NS} xmlns:r="{_REL}"><sheets>'
                           f'<sheet name="{sheet}" sheetId="1" r:id="rId1"/></sheets></workbook>',
        "xl/_rels/workbook.xml.rels": f'<Relationships {_PKG}>'
                                      '<Relationship Id="rId1" Target="worksheets/sheet1.xml"/></Relationships>',
        "xl/sharedStrings.xml": f"<sst {_NS}>" + "".join(
            f"<si><t>{escape(s)}</t></si>" for s in strings) + "</sst>",
        "xl/styles.xml": f'<styleSheet {_NS}><cellXfs><xf numFmtId="0"/><xf numFmtId="14"/></cellXfs></styleSheet>',
        "xl/worksheets/sheet1.xml": f'<worksheet {_NS} xmlns:r="{_REL}"><sheetData>{"".join(body)}</sheetData>'
                                    f"<hyperlinks>{marks}</hyperlinks></worksheet>",
        "xl/worksheets/_rels/sheet1.xml.rels": f"<Relationships {_PKG}>{targets}</Relationships>",
    }
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, text in files.items():
            z.writestr(name, text)
    return out.getvalue()
