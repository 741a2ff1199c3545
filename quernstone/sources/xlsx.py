"""The active sheet of an OOXML workbook, with the standard library."""

from __future__ import annotations

import io
import re
import zipfile
from datetime import datetime, timedelta
from xml.etree import ElementTree as ET

from quernstone.errors import ParseError

_M = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_R = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
#: Number formats that are dates by number.
_DATE_FORMATS = {*range(14, 23), *range(45, 48)}
_DAY_ONE = datetime(1899, 12, 30)


def _column(ref: str) -> int:
    n = 0
    for c in re.match(r"[A-Z]+", ref)[0]:
        n = n * 26 + ord(c) - 64
    return n - 1


def _date_styles(book: zipfile.ZipFile) -> set[int]:
    if "xl/styles.xml" not in book.namelist():
        return set()
    root = ET.fromstring(book.read("xl/styles.xml"))
    own = {int(f.get("numFmtId")) for f in root.iter(f"{_M}numFmt") if re.search(r"[dmyhs]", re.sub(r'"[^"]*"|\[[^\]]*\]', "", f.get("formatCode") or "").lower())}
    xfs = root.find(f"{_M}cellXfs")
    return {i for i, x in enumerate(xfs if xfs is not None else []) if int(x.get("numFmtId") or 0) in _DATE_FORMATS | own}


def _value(cell: ET.Element, shared: list[str], dates: set[int]) -> object:
    kind, v = cell.get("t"), cell.find(f"{_M}v")
    if kind == "inlineStr":
        return "".join(x.text or "" for x in cell.iter(f"{_M}t"))
    if v is None or v.text is None:
        return None
    if kind == "s":
        return shared[int(v.text)]
    if kind in ("str", "e"):
        return v.text
    if kind == "b":
        return v.text == "1"
    number = float(v.text)
    if int(cell.get("s") or 0) in dates:
        return (_DAY_ONE + timedelta(seconds=round(number * 86400))).isoformat()
    return int(number) if number.is_integer() and "." not in v.text and "e" not in v.text.lower() else number


def records(content: bytes) -> list[dict]:
    """Rows under the first row that is not blank; blank rows and empty cells are left out."""
    try:
        book = zipfile.ZipFile(io.BytesIO(content))
        root = ET.fromstring(book.read("xl/workbook.xml"))
    except (zipfile.BadZipFile, KeyError, ET.ParseError) as e:
        raise ParseError(f"not a workbook: {e}") from e
    sheets = list(root.iter(f"{_M}sheet"))
    if not sheets:
        raise ParseError("the workbook has no sheet")
    view = next(root.iter(f"{_M}workbookView"), None)
    active = int(view.get("activeTab") or 0) if view is not None else 0
    rels = {r.get("Id"): r.get("Target") for r in ET.fromstring(book.read("xl/_rels/workbook.xml.rels"))}
    where = rels[sheets[active].get(f"{_R}id")].lstrip("/")
    sheet = ET.fromstring(book.read(where if where.startswith("xl/") else f"xl/{where}"))
    shared = []
    if "xl/sharedStrings.xml" in book.namelist():
        shared = ["".join(t.text or "" for t in si.iter(f"{_M}t")) for si in ET.fromstring(book.read("xl/sharedStrings.xml")).iter(f"{_M}si")]
    dates = _date_styles(book)
    header: dict[int, str] | None = None
    out = []
    for row in sheet.iter(f"{_M}row"):
        cells = {}
        for k, c in enumerate(row.iter(f"{_M}c")):
            v = _value(c, shared, dates)
            if v is not None and v != "":
                cells[_column(c.get("r")) if c.get("r") else k] = v
        if not cells:
            continue
        if header is None:
            header = {i: str(v).strip() for i, v in cells.items()}
            if len(set(header.values())) != len(header):
                raise ParseError("the header repeats a name")
            continue
        out.append({header[i]: v for i, v in cells.items() if i in header})
    if header is None:
        raise ParseError("the sheet has no header")
    return out
