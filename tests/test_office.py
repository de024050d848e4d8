"""XLSX and DOCX files made here."""

import zipfile

from lectern.sources.office import read_docx_tables, read_xlsx

S = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
R = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
W = "http://schemas.openxmlformats.org/wordprocessingml/2006/main"


def test_xlsx(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.xlsx", "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook xmlns="{S}" xmlns:r="{R}"><sheets><sheet name="Plan" sheetId="1" r:id="r1"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships><Relationship Id="r1" Target="worksheets/sheet1.xml"/></Relationships>')
        z.writestr("xl/sharedStrings.xml", f'<sst xmlns="{S}"><si><t>program</t></si><si><t>Статистика</t></si></sst>')
        rows = '<row r="1"><c r="A1" t="s"><v>0</v></c><c r="B1" t="inlineStr"><is><t>discipline</t></is></c><c r="D1"><v>hours</v></c></row>'
        rows += '<row r="2"><c r="A2" t="inlineStr"><is><t>P</t></is></c><c r="B2" t="s"><v>1</v></c><c r="C2"><v>9</v></c></row><row r="3"><c r="D3"><v>72</v></c></row>'
        z.writestr("xl/worksheets/sheet1.xml", f'<worksheet xmlns="{S}"><sheetData>{rows}</sheetData><mergeCells><mergeCell ref="A2:A3"/></mergeCells></worksheet>')
    (tmp_path / "b.xlsx").write_bytes(b"no zip")
    got = {(r.path.rsplit("/", 1)[1], r.row): r for r in read_xlsx(spark, str(tmp_path / "*.xlsx")).collect()}
    assert got["a.xlsx", 2]["values"] == {"program": "P", "discipline": "Статистика"}
    assert got["a.xlsx", 3]["values"] == {"program": "P", "hours": "72"}
    assert got["b.xlsx", None].status == "error: BadZipFile"
    assert {r.status for r in read_xlsx(spark, str(tmp_path / "a.xlsx"), "Other").collect()} == {"empty"}


def test_docx(spark, tmp_path):
    cell = lambda *p: "<w:tc>" + "".join(f"<w:p><w:r><w:t>{x}</w:t></w:r></w:p>" for x in p) + "</w:tc>"
    with zipfile.ZipFile(tmp_path / "a.docx", "w") as z:
        z.writestr("word/document.xml", f'<w:document xmlns:w="{W}"><w:body><w:tbl><w:tr>{cell("a", "b")}{cell("c")}</w:tr><w:tr>{cell("d")}</w:tr></w:tbl></w:body></w:document>')
    got = {(r.table_index, r.row_index, r.column_index): r.text for r in read_docx_tables(spark, str(tmp_path / "a.docx")).collect()}
    assert got == {(0, 0, 0): "a\nb", (0, 0, 1): "c", (0, 1, 0): "d"}
