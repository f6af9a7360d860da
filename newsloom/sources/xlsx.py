"""Workbooks as zipped XML: plain cells of one sheet, as text."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterable, Iterator
from xml.etree import ElementTree
from xml.sax.saxutils import escape

#: Rows that a sheet can have at most, set by the format.
MOST_ROWS = 1_048_576
_NS = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_HEAD = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
_MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
_REL = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
_PACK = "http://schemas.openxmlformats.org/package/2006"
_FORBIDDEN = re.compile("[\x00-\x08\x0b\x0c\x0e-\x1f]")


def _column(ref: str) -> int:
    n = 0
    for c in ref:
        if not c.isalpha():
            break
        n = 26 * n + ord(c.upper()) - 64
    return n - 1


def _text(node) -> str:
    return "".join(t.text or "" for t in node.iter(f"{_NS}t"))


def rows(content: bytes, sheet: int = 1) -> Iterator[list[str]]:
    """The rows of a sheet; cells that are not there are empty."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        names = z.namelist()
        shared = [_text(s) for s in ElementTree.fromstring(z.read("xl/sharedStrings.xml")).iter(f"{_NS}si")] if "xl/sharedStrings.xml" in names else []
        with z.open(f"xl/worksheets/sheet{sheet}.xml") as f:
            for _, row in ElementTree.iterparse(f):
                if row.tag != f"{_NS}row":
                    continue
                out: list[str] = []
                for cell in row.iter(f"{_NS}c"):
                    at = _column(cell.get("r", "")) if cell.get("r") else len(out)
                    value = cell.find(f"{_NS}v")
                    kind = cell.get("t")
                    text = _text(cell) if kind == "inlineStr" else "" if value is None else value.text or ""
                    out += [""] * (at + 1 - len(out))
                    out[at] = shared[int(text)] if kind == "s" and text else text
                yield out
                row.clear()


def blocks(found: Iterable[list[str]], width: int, size: int = 5000) -> Iterator[list[list[str]]]:
    """Rows of this width, so many at a time."""
    part: list[list[str]] = []
    for r in found:
        part.append((r + [""] * width)[:width])
        if len(part) == size:
            yield part
            part = []
    if part:
        yield part


def workbook(header: list[str], body: Iterable[list]) -> bytes:
    """A workbook with one sheet of text cells; raises ValueError beyond what a sheet can hold."""

    def line(cells: list) -> str:
        return "<row>" + "".join('<c t="inlineStr"><is><t xml:space="preserve">' + escape(_FORBIDDEN.sub("", "" if c is None else str(c))) + "</t></is></c>" for c in cells) + "</row>"

    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("[Content_Types].xml", f'{_HEAD}<Types xmlns="{_PACK}/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/><Override PartName="/xl/worksheets/sheet1.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/></Types>')
        z.writestr("_rels/.rels", f'{_HEAD}<Relationships xmlns="{_PACK}/relationships"><Relationship Id="rId1" Type="{_REL}/officeDocument" Target="xl/workbook.xml"/></Relationships>')
        z.writestr("xl/workbook.xml", f'{_HEAD}<workbook xmlns="{_MAIN}" xmlns:r="{_REL}"><sheets><sheet name="Sheet1" sheetId="1" r:id="rId1"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", f'{_HEAD}<Relationships xmlns="{_PACK}/relationships"><Relationship Id="rId1" Type="{_REL}/worksheet" Target="worksheets/sheet1.xml"/></Relationships>')
        with z.open("xl/worksheets/sheet1.xml", "w") as f:
            f.write(f'{_HEAD}<worksheet xmlns="{_MAIN}"><sheetData>{line(header)}'.encode())
            for i, r in enumerate(body, 2):
                if i > MOST_ROWS:
                    raise ValueError(f"a sheet holds {MOST_ROWS} rows; write Parquet or CSV instead")
                f.write(line(r).encode())
            f.write(b"</sheetData></worksheet>")
    return out.getvalue()
