"""Workbooks: cell kinds, blank rows, several files, round trip of texts."""

from __future__ import annotations

import io
import zipfile

import pytest

from gatewise.sources import spreadsheet as sh
from gatewise.sources import tables as tb

NS = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
SHEET = f"""<worksheet {NS}><cols><col min="1" max="3"/></cols><sheetData>
<row r="1"><c r="A1" t="s"><v>0</v></c><c r="B1" t="s"><v>1</v></c><c r="D1" t="s"><v>0</v></c></row>
<row r="2"><c r="A2"><v>5.0</v></c><c r="B2" s="1"><v>45293.5</v></c><c r="C2" t="b"><v>1</v></c><c r="D2" t="e"><v>#N/A</v></c></row>
<row r="4"><c r="B4" s="2"><v>0.25</v></c><c r="D4" t="str"><f>A1</f><v>NA</v></c></row>
<row r="5"><c r="A5"><v>1E-3</v></c><c r="B5" s="3"><v>7</v></c><c r="C5" t="inlineStr"><is><t>a_x000D_b</t></is></c></row>
<row r="6"><c r="A6" s="1"/></row><row r="9"/>
</sheetData></worksheet>"""
SHARED = f"""<sst {NS}><si><t>k</t></si><si><r><t>wh</t></r><r><t>en</t></r><rPh sb="0" eb="1"><t>hint</t></rPh></si></sst>"""
STYLES = f"""<styleSheet {NS}><numFmts><numFmt numFmtId="170" formatCode="[Red]0.0&quot;days&quot;"/></numFmts>
<cellXfs><xf numFmtId="0"/><xf numFmtId="22"/><xf numFmtId="20"/><xf numFmtId="170"/></cellXfs></styleSheet>"""
BOOK = f"""<workbook {NS} xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships">
<sheets><sheet name="Guests" sheetId="1" r:id="rId1"/></sheets></workbook>"""


def _book(sheet=SHEET):
    file = io.BytesIO()
    with zipfile.ZipFile(file, "w") as z:
        for name, part in {**sh.PARTS, "xl/workbook.xml": BOOK, "xl/worksheets/sheet1.xml": sheet,
                           "xl/sharedStrings.xml": SHARED, "xl/styles.xml": STYLES}.items():
            z.writestr(name, part)
    return file.getvalue()


def test_cells_of_every_kind():
    assert list(sh.sheet_rows(_book(), "Guests")) == [
        ["k", "when", "", "k"], ["5", "2024-01-02 12:00:00", "True", ""], [], ["", "06:00:00", "", "NA"],
        ["0.001", "7", "a\rb"]]
    with pytest.raises(ValueError, match="no sheet"):
        list(sh.sheet_rows(_book(), 1))


def test_days_before_the_missing_leap_day():
    assert sh._moment("1", False) == "1900-01-01 00:00:00"
    assert sh._moment("61", False) == "1900-03-01 00:00:00"
    assert sh._moment("0.5", False) == "12:00:00"
    assert sh._moment("1", True) == "1904-01-02 00:00:00"


def test_column_names():
    assert sh.column_names(["a", "", "a", "a.1", "a"]) == ["a", "Unnamed: 1", "a.1", "a.1.1", "a.2"]


def test_folder_of_workbooks(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.xlsx").write_bytes(_book())
    (tmp_path / "in" / "notes.txt").write_text("no workbook")
    (tmp_path / "in" / "b.xlsx").write_bytes(sh.workbook(["when", "k", "k", None], [["later", "9", None, "x"]]))
    files = sh.workbook_files(spark, str(tmp_path / "in"))
    with pytest.raises(Exception, match="columns"):   # the fourth column has another name there
        sh.read_workbooks(files).collect()
    (tmp_path / "in" / "b.xlsx").write_bytes(sh.workbook(["when", "k", None, "k"], [["later", "9", None, "x"]]))
    got = sh.read_workbooks(sh.workbook_files(spark, str(tmp_path / "in")))
    assert got.columns == ["k", "when", "Unnamed: 2", "k.1"]
    assert sorted(tuple(r) for r in got.collect()) == sorted([
        ("5", "2024-01-02 12:00:00", "True", ""), ("", "", "", ""), ("", "06:00:00", "", "NA"),
        ("0.001", "7", "a\rb", ""), ("9", "later", "", "x")])


def test_texts_come_back_and_are_audited(spark):
    texts = ["  a b  ", "x\ny", 'say "hi"', "<&>", "r\r\nn", "\ttab", "_x000D_", "\x01", "0012", "NULL", "\U0001f600", None]
    df = spark.createDataFrame(list(enumerate(texts)), "k int, `s p` string").repartition(3)
    files = tb.materialize(sh.to_workbooks(df, rows_per_file=2), "books")
    assert files.count() >= 6
    stored = sh.read_workbooks(files)
    assert sorted((int(r[0]), r[1]) for r in stored.collect()) == [(i, t or "") for i, t in enumerate(texts)]
    assert tb.ingest_audit(df, stored).first().complete


def test_without_files_or_rows(spark):
    none = spark.createDataFrame([], "path string, content binary")
    assert sh.read_workbooks(none).count() == 0
    only = spark.createDataFrame([("a", bytearray(sh.workbook(["k"], [])))], "path string, content binary")
    got = sh.read_workbooks(only)
    assert (got.columns, got.count()) == (["k"], 0)
