import os
import zipfile

import pytest

from foliant.operators import sheets as s
from foliant.schemas import CELLS, RANGES
from foliant.sources import xlsx


def book(path, sheet_xml, names=("Products",)):
    sheets = "".join(f'<sheet name="{n}" sheetId="{i}" r:id="rId{i}"/>' for i, n in enumerate(names, 1))
    rels = "".join(f'<Relationship Id="rId{i}" Target="worksheets/sheet{i}.xml"/>' for i in range(1, len(names) + 1))
    main = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook {main} xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets>{sheets}</sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", f'<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">{rels}</Relationships>')
        z.writestr("xl/sharedStrings.xml", f"<sst {main}><si><t>Product ID</t></si><si><r><t>Unit </t></r><r><t>Price</t></r></si></sst>")
        for i in range(1, len(names) + 1):
            z.writestr(f"xl/worksheets/sheet{i}.xml", f"<worksheet {main}>{sheet_xml}</worksheet>")


SHEET = """<sheetData><row r="1"><c r="A1" t="s"><v>0</v></c><c r="B1" t="s"><v>1</v></c></row>
<row r="2"><c r="A2" t="inlineStr"><is><t> P001 </t></is></c><c r="B2"><v>7</v></c></row><row r="3"><c r="A3" t="b"><v>1</v></c><c r="B3"><f>B2*2</f><v>14</v></c></row>
<row r="4"><c r="B4"><v>0.5</v></c></row></sheetData><mergeCells><mergeCell ref="A3:A4"/></mergeCells>"""


def test_workbook_to_stored_tables(spark, tmp_path, rows):
    from foliant.cli import ingest_sheets

    book(tmp_path / "My Book.xlsx", SHEET)
    done = ingest_sheets(spark, str(tmp_path / "*.xlsx"), str(tmp_path / "t"), "pre")
    assert done == {"sheet_content": 3, "sheet": 1}
    got = rows(spark.read.parquet(str(tmp_path / "t/sheet_content")).select("collection_path", "sort_order", "row_text", "word_count"))
    assert got == [("pre.my_book.products", 1, "Product ID: P001\nUnit Price: 7", 6), ("pre.my_book.products", 2, "Product ID: True\nUnit Price: =B2*2", 6), ("pre.my_book.products", 3, "Product ID: True\nUnit Price: 0.5", 6)]
    assert ingest_sheets(spark, str(tmp_path / "*.xlsx"), str(tmp_path / "t"), "pre") == {"sheet_content": 0, "sheet": 0}
    assert ingest_sheets(spark, str(tmp_path / "*.xlsx"), str(tmp_path / "t"), "pre", True)["sheet_content"] == 3
    assert spark.read.parquet(str(tmp_path / "t/sheet")).count() == 1


STYLES = """<styleSheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><numFmts><numFmt numFmtId="164" formatCode="yyyy\\-mm\\-dd"/><numFmt numFmtId="165" formatCode="0.00 &quot;days&quot;"/><numFmt numFmtId="166" formatCode="[h]:mm"/></numFmts>
<cellXfs><xf numFmtId="0"/><xf numFmtId="14"/><xf numFmtId="164"/><xf numFmtId="165"/><xf numFmtId="166"/><xf numFmtId="20"/></cellXfs></styleSheet>"""


def test_dates_and_shared_formulas(spark, tmp_path, rows):
    sheet = """<sheetData><row r="1"><c r="A1" s="1"><v>45366</v></c><c r="B1" s="2"><v>45366.5</v></c><c r="C1" s="3"><v>45366</v></c><c r="D1" s="4"><v>1.5</v></c><c r="E1" s="5"><v>0.25</v></c><c r="F1" s="1"><v>59</v></c></row>
    <row r="2"><c r="A2"><f t="shared" ref="A2:A4" si="0">B2*$C$1+SUM(D:D)+"B2"+'B2 x'!B2+LOG10(2)</f><v>1</v></c></row><row r="3"><c r="A3"><f t="shared" si="0"/><v>2</v></c><c r="B3"><f t="shared" si="9"/><v>7</v></c></row></sheetData>"""
    book(tmp_path / "d.xlsx", sheet)
    with zipfile.ZipFile(tmp_path / "d.xlsx", "a") as z:
        z.writestr("xl/styles.xml", STYLES)
    got = {(r, c): v for _, r, c, v in xlsx.cells(str(tmp_path / "d.xlsx"))}
    assert [got[1, c] for c in range(1, 7)] == ["2024-03-15 00:00:00", "2024-03-15 12:00:00", "45366", "1 day, 12:00:00", "06:00:00", "1900-02-28 00:00:00"]
    assert got[2, 1] == "=B2*$C$1+SUM(D:D)+\"B2\"+'B2 x'!B2+LOG10(2)" and got[3, 1] == "=B3*$C$1+SUM(D:D)+\"B2\"+'B2 x'!B3+LOG10(2)" and got[3, 2] == "7"
    assert xlsx.moved("A1+$A1+A$1+AA9:AB9+2:3", -1, 1) == "#REF!+#REF!+B$1+AB8:AC8+1:2"
    files = spark.read.format("binaryFile").load(str(tmp_path / "*.xlsx"))
    assert {(r.r, r.c): r.value for r in xlsx.read_cells(files).collect()} == got
    assert [r.sheet for r in xlsx.read_cells(files, "sheets").collect()] == ["Products"] and xlsx.read_cells(files, "merged").count() == 0


def test_clashing_columns_keep_apart(spark, rows):
    content = spark.createDataFrame([("a", 1, "Unit Price: 1\nunit price: 2\nno colon\nUNIT-PRICE: \nB: 3"), ("a", 2, None), ("a", 3, "")], "collection_path string, sort_order int, row_text string")
    sheets = spark.createDataFrame([("a", "t")], "collection_path string, structured_table string")
    assert rows(s.long_form(content, sheets).select("column", "value")) == [("col_b", "3"), ("col_unit_price", "1"), ("col_unit_price_2", "2"), ("col_unit_price_3", None)]


def test_sheet_list(tmp_path):
    book(tmp_path / "b.xlsx", SHEET, ("B", "A"))
    assert [n for n, _ in xlsx.sheet_list(str(tmp_path / "b.xlsx"))] == ["B", "A"]
    (tmp_path / "c.xlsx").write_text("no")
    with pytest.raises(ValueError):
        xlsx.sheet_list(str(tmp_path / "c.xlsx"))


def cells(spark, grid, name="s"):
    return spark.createDataFrame([("f", name, r, c, v) for r, row in enumerate(grid, 1) for c, v in enumerate(row, 1) if v is not None], CELLS)


def test_bounds_blank_rows_and_footers(spark, rows):
    c = cells(spark, [["Col A", "Col B", None, "Stray"], ["1", None, None, "x"], [None, None, None, "y"], [None, "2"], ["foot"]])
    span = s.bounds(c)
    assert rows(span) == [("f", "s", 1, 2, 2, 5)]
    texts = s.text_rows(s.data_rows(c, span, s.headers(c, span)).withColumn("collection_path", s.F.lit("p")))
    assert rows(texts.select("sort_order", "row_text")) == [(1, "Col A: 1\nCol B: "), (2, "Col A: \nCol B: 2"), (3, "Col A: foot\nCol B: ")]
    assert rows(s.bounds(c, data_end=4).select("last_row")) == [(4,)]


def test_header_problems(spark, rows):
    c = cells(spark, [["Name", "name ", "Name", "B"], ["1", "2", "3", "4"]])
    assert rows(s.header_problems(s.headers(c, s.bounds(c))).select("problem", "header")) == [("duplicate", "Name"), ("duplicate_name", "Name")]


def test_merged(spark, rows):
    c = cells(spark, [["H", "I"], ["v", None], [None, "w"]])
    r = spark.createDataFrame([("f", "s", 1, 2, 1, 3), ("f", "s", 2, 2, 2, 3)], RANGES)
    assert rows(s.fill_merged(c, r).select("r", "c", "value")) == [(1, 1, "H"), (1, 2, "I"), (2, 1, "v"), (3, 1, "v"), (3, 2, "w")]


def test_overlap_guard():
    assert s.overlap(["a", "b"], ["c"]) == (0.0, 0.0, False)
    assert s.overlap(["a", "b"], ["a", "c"])[2] and s.overlap([], ["a"])[2] is False
    assert s.overlap(["a"], list("abcdefgh"))[2]


def test_catalog_of_empty_table(spark):
    assert s.catalog(spark.createDataFrame([], "collection_path string, sort_order int, row_text string, word_count int")).count() == 0


def test_input_failures(tmp_path):
    book(tmp_path / "a.xlsx", SHEET)
    (tmp_path / "b.xlsx").write_text("no")
    asked = [("a.xlsx", {"sheet": "Products"}), ("a.xlsx", {"sheet": "X"}), ("b.xlsx", {"sheet": "X"}), ("c.xlsx", {"sheet": "X"}), ("a.xlsx", {"sheet": "Products", "header_row": 9}), ("a.xlsx", {"sheet": "Products", "collection_path": "A"})]
    assert [r[2] for r in xlsx.input_failures(asked, str(tmp_path))] == ["no such sheet", "no workbook", "no file", "no rows", "invalid path"]


def test_wide_all_keeps_every_table_and_column(spark, rows):
    content = spark.createDataFrame([("a", 1, "Item: x\nFlag: y"), ("b", 1, "HC Code: 7\nItem: "), ("c", 1, "Item: z"), ("d", 1, "Lost: 1")], "collection_path string, sort_order int, row_text string")
    targets = spark.createDataFrame([("a", "attribution"), ("b", "fees"), ("c", "attribution"), ("c", "fees"), ("d", None)], "collection_path string, structured_table string")
    got = s.wide_all(s.long_form(content, targets))
    assert got.columns == ["structured_table", "collection_path", "sort_order", "col_flag", "col_hc_code", "col_item"]
    assert rows(got) == [("attribution", "a", 1, "y", None, "x"), ("attribution", "c", 1, None, None, "z"), ("fees", "b", 1, None, "7", None), ("fees", "c", 1, None, None, "z")]
    assert s.wide_all(s.long_form(content, targets.where("false"))).count() == 0


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no test data here")
def test_wide_all_query_holds_every_value_of_the_long_form(spark):
    import __spark_entry__ as entry

    wide, long = (entry.queries()[q](spark, "/root/testdata/sf0.001") for q in ("structured_wide_all", "structured_long"))
    cells = long.where("value is not null").select("structured_table", "collection_path", "sort_order", "column").distinct().count()
    names = [c for c in wide.columns if c.startswith("col_")]
    assert {r[0] for r in long.select("column").distinct().collect()} == set(names)
    assert sum(sum(v is not None for v in (r[c] for c in names)) for r in wide.collect()) == cells > 0
