"""Workbooks (xlsx) as a Spark source.

Spark reads the files whole (``binaryFile``, any file system) and spreads
them over tasks; inside a task the XML parts of a workbook are streamed, so
only its compressed bytes and its shared texts are held. A sheet ends at
1,048,576 rows by its format; larger inputs are folders of workbooks.

Every value becomes text: whole numbers without a fraction, dates as
``YYYY-MM-DD HH:MM:SS``, truth values as True / False, errors and missing
cells as ''. Texts stay as they are, also 'NA' and 'null'. Blank rows between
others stay, those after the last value go.
"""

from __future__ import annotations

import datetime as dt
import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree as ET
from xml.sax.saxutils import escape

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gatewise.session import ship

# Fixed values of the file format.
MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
DATE_FORMATS = {14, 15, 16, 17, 18, 19, 20, 21, 22, 45, 46, 47}   # built-in number formats of dates and times
SHEET_ROWS = 1_048_576

#: Rows handed to Spark at once.
BATCH_ROWS = 1_000


def _elements(book: zipfile.ZipFile, part: str, tag: str) -> Iterator[ET.Element]:
    """The elements ``tag`` of a part, one after the other; nothing if the part is absent."""
    if part not in book.namelist():
        return
    with book.open(part) as f:
        root = None
        for event, e in ET.iterparse(f, ("start", "end")):
            if root is None:
                root = e
            elif event == "end" and e.tag == MAIN + tag:
                yield e
                e.clear()
                if tag == "row":   # the parent would keep every empty row element
                    for parent in root.iter(MAIN + "sheetData"):
                        parent.clear()


def _text(e: ET.Element) -> str:
    """Text of a string item: its runs, without phonetic hints; ``_xHHHH_`` is one character."""
    parts = [t.text or "" for t in e.findall(MAIN + "t")] + [t.text or "" for r in e.findall(MAIN + "r")
                                                             for t in r.findall(MAIN + "t")]
    return re.sub("_x([0-9A-Fa-f]{4})_", lambda m: chr(int(m[1], 16)), "".join(parts))


def _date_styles(book: zipfile.ZipFile) -> set[int]:
    """Numbers of the cell styles that show a number as a date or time."""
    custom = {int(e.get("numFmtId")) for e in _elements(book, "xl/styles.xml", "numFmt")
              if re.search("[dmyhs]", re.sub(r'"[^"]*"|\\.|\[[^\]]*\]', "", e.get("formatCode", "")), re.I)}
    for styles in _elements(book, "xl/styles.xml", "cellXfs"):
        kinds = [int(x.get("numFmtId", 0)) for x in styles.findall(MAIN + "xf")]
        return {i for i, k in enumerate(kinds) if k in DATE_FORMATS or k in custom}
    return set()


def _number(raw: str) -> str:
    """A number's text: whole ones without a fraction."""
    value = float(raw)
    if re.fullmatch(r"[+-]?\d+", raw):
        return str(int(raw))
    return str(int(value)) if value.is_integer() else repr(value)


def _moment(raw: str, from_1904: bool) -> str:
    """A day number's text; below one it is a time of day."""
    value = float(raw)
    start = dt.datetime(1904, 1, 1) if from_1904 else dt.datetime(1899, 12, 31 if value < 60 else 30)
    at = start + dt.timedelta(seconds=round(value * 86_400))
    return f"{at:%H:%M:%S}" if 0 <= value < 1 else f"{at:%Y-%m-%d %H:%M:%S}"


def _column(reference: str) -> int:
    """'C7' -> 2."""
    n = 0
    for c in re.match("[A-Z]+", reference)[0]:
        n = n * 26 + ord(c) - 64
    return n - 1


def _sheet_part(book: zipfile.ZipFile, sheet: int | str) -> str:
    sheets = [(e.get("name"), e.get(REL)) for e in _elements(book, "xl/workbook.xml", "sheet")]
    wanted = [r for i, (name, r) in enumerate(sheets) if sheet in (i, name)]
    if not wanted:
        raise ValueError(f"no sheet {sheet!r} among {[name for name, _ in sheets]}")
    rels = ET.fromstring(book.read("xl/_rels/workbook.xml.rels"))
    target = next(r.get("Target") for r in rels if r.get("Id") == wanted[0])
    return target.lstrip("/") if target.startswith("/") else f"xl/{target}"


def sheet_rows(content: bytes, sheet: int | str = 0) -> Iterator[list[str]]:
    """The rows of one sheet as texts, shorter rows unpadded."""
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        part = _sheet_part(book, sheet)
        shared = [_text(e) for e in _elements(book, "xl/sharedStrings.xml", "si")]
        dates = _date_styles(book)
        from_1904 = any(e.get("date1904") in ("1", "true") for e in _elements(book, "xl/workbook.xml", "workbookPr"))

        def value(c: ET.Element) -> str:
            kind, v = c.get("t", "n"), c.find(MAIN + "v")
            if kind == "inlineStr":
                inline = c.find(MAIN + "is")
                return "" if inline is None else _text(inline)
            if v is None or v.text is None or kind == "e":
                return ""
            if kind == "s":
                return shared[int(v.text)]
            if kind == "b":
                return str(v.text == "1")
            if kind == "n":
                return _moment(v.text, from_1904) if int(c.get("s", 0)) in dates else _number(v.text)
            return v.text

        done = 0      # rows given out
        last = 0      # number of the row before
        for row in _elements(book, part, "row"):
            last = int(row.get("r", last + 1))
            cells: list[str] = []
            for c in row.findall(MAIN + "c"):
                at = _column(c.get("r")) if c.get("r") else len(cells)
                cells += [""] * (at - len(cells))
                cells.append(value(c))
            if any(cells):
                for _ in range(last - 1 - done):
                    yield []
                yield cells
                done = last


def column_names(header: list[str]) -> list[str]:
    """Names of the columns: an empty one by its place, a repeated one numbered."""
    names: list[str] = []
    for i, name in enumerate(header):
        name, n = name or f"Unnamed: {i}", 0
        while (f"{name}.{n}" if n else name) in names:
            n += 1
        names.append(f"{name}.{n}" if n else name)
    return names


def workbook_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, content) of the workbooks of a folder."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", "*.xlsx").option("recursiveFileLookup", "true")
            .load(path).select("path", "content"))


def read_workbooks(files: DataFrame, sheet: int | str = 0) -> DataFrame:
    """Q38 on workbooks: one sheet of each file of ``files`` (path, content),
    all columns text, named by the first row; '' where a cell is missing.

    The first file (by path) names the columns. Columns of another file are
    matched by name; a file that lacks one, or has another, is an error, as is
    one without the sheet. An empty sheet gives no rows."""
    ship(files.sparkSession)

    def header(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for content in batch["content"]:
                yield pd.DataFrame({"names": [column_names(next(sheet_rows(content, sheet), []))]})

    first = files.orderBy("path").limit(1).mapInPandas(header, "names array<string>").first()
    names = list(first["names"]) if first else []
    if not names:
        return files.sparkSession.createDataFrame([], "struct<>")

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                lines = sheet_rows(content, sheet)
                own = column_names(next(lines, []))
                if own and sorted(own) != sorted(names):
                    raise ValueError(f"{path}: columns {own}, not {names}")
                places = [own.index(n) for n in names] if own else []
                held: list[list[str]] = []
                for line in lines:
                    held.append([line[p] if p < len(line) else "" for p in places])
                    if len(held) == BATCH_ROWS:
                        yield pd.DataFrame(held, columns=names, dtype=object)
                        held = []
                if held:
                    yield pd.DataFrame(held, columns=names, dtype=object)

    return files.select("path", "content").mapInPandas(rows, ", ".join(f"`{n.replace('`', '``')}` string" for n in names))


# Fixed parts of a workbook with one sheet.
PARTS = {
    "[Content_Types].xml": '<Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types">'
    '<Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/>'
    '<Override PartName="/xl/workbook.xml" '
    'ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/>'
    '<Override PartName="/xl/worksheets/sheet1.xml" '
    'ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/></Types>',
    "_rels/.rels": '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
    '<Relationship Id="rId1" Target="xl/workbook.xml" '
    'Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/officeDocument"/></Relationships>',
    "xl/workbook.xml": '<workbook xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" '
    'xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships">'
    '<sheets><sheet name="Sheet1" sheetId="1" r:id="rId1"/></sheets></workbook>',
    "xl/_rels/workbook.xml.rels": '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
    '<Relationship Id="rId1" Target="worksheets/sheet1.xml" '
    'Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/worksheet"/></Relationships>',
}


def workbook(header: list[str], rows: list[list[str | None]]) -> bytes:
    """A workbook with one sheet of text cells; None leaves the cell out."""
    def cells(values):
        out = []
        for v in values:
            if v is None:
                out.append("<c/>")
                continue
            coded = re.sub("[\x00-\x08\x0b-\x1f]|_(?=x[0-9A-Fa-f]{4}_)", lambda m: f"_x{ord(m[0]):04X}_", v)
            out.append(f'<c t="inlineStr"><is><t xml:space="preserve">{escape(coded)}</t></is></c>')
        return f"<row>{''.join(out)}</row>"

    file = io.BytesIO()
    with zipfile.ZipFile(file, "w", zipfile.ZIP_DEFLATED) as book:
        for name, part in PARTS.items():
            book.writestr(name, part)
        with book.open("xl/worksheets/sheet1.xml", "w") as sheet:
            sheet.write(f'<worksheet xmlns="{MAIN[1:-1]}"><sheetData>'.encode())
            for values in (header, *rows):
                sheet.write(cells(values).encode())
            sheet.write(b"</sheetData></worksheet>")
    return file.getvalue()


def to_workbooks(df: DataFrame, rows_per_file: int = 50_000) -> DataFrame:
    """``df`` as workbooks (path, content) of at most ``rows_per_file`` rows,
    each built from one task's rows, values as text."""
    if not 0 < rows_per_file < SHEET_ROWS:
        raise ValueError(f"a sheet holds up to {SHEET_ROWS - 1} rows and the header")
    ship(df.sparkSession)
    names = df.columns

    def books(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import uuid
        held: list[list[str | None]] = []

        def book(rows):
            return pd.DataFrame({"path": [f"{uuid.uuid4().hex}.xlsx"], "content": [workbook(names, rows)]})

        for batch in batches:
            held += [[None if v is None else str(v) for v in row] for row in batch.itertuples(index=False, name=None)]
            while len(held) >= rows_per_file:
                yield book(held[:rows_per_file])
                held = held[rows_per_file:]
        if held:
            yield book(held)

    return (df.select([F.col(f"`{c}`").cast("string").alias(c) for c in names])
            .mapInPandas(books, "path string, content binary"))
