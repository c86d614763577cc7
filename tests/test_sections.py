from foliant.operators import quality, sections
from foliant.schemas import ELEMENTS


def el(doc, seq, kind, label, text=None, caption=None, grid=None, pages=(1,)):
    return (doc, seq, kind, label, text, caption, grid, list(pages))


def frame(spark):
    return spark.createDataFrame(
        [
            el("d", 1, "text", "page_header", "head"), el("d", 2, "text", "text", " before "), el("d", 3, "text", "section_header", " Title "), el("d", 4, "text", "text", "body", pages=(2,)),
            el("d", 5, "table", "table", grid=[["a", "b"], ["1", None]], caption="cap", pages=(3,)), el("d", 6, "text", "section_header", "  "), el("d", 7, "picture", "picture", caption="shown"),
            el("d", 8, "table", "table", grid=[[" "]]), el("d", 9, "text", "section_header", "Last", pages=(4, 5)), el("d", 10, "group", "list", "lost"), el("e", 1, "text", "text", None), el("f", 1, "text", "section_header", "Only"),
        ],
        ELEMENTS,
    )


def test_sections(spark, rows):
    got = rows(sections.sections(frame(spark).where("elem_type <> 'group'")))
    table = "cap\n\n| a | b |\n| --- | --- |\n| 1 |  |"
    assert got == [("d", 1, None, "before", 1, 1, 1), ("d", 2, "Title", f"body\n\n{table}\n\nshown", 1 + 1 + len(table.split()) + 1, 1, 3), ("d", 3, "Last", None, 1, 4, 5), ("f", 1, "Only", None, 1, 1, 1)]
    assert rows(sections.unknown_elements(frame(spark))) == [("d", 10, "group", "list")]


def test_a_document_with_an_unknown_element_fails(spark, rows):
    assert {r.doc_id for r in sections.sections(frame(spark)).collect()} == {"f"}
    assert rows(sections.section_failures(frame(spark))) == [("d", "clean", "unknown element list (1)")]


def test_documents_and_records(spark, rows):
    s = sections.sections(frame(spark).where("elem_type <> 'group'"))
    assert [(r.doc_id, r.n_parsed_sections, r.first_page, r.last_page) for r in sections.documents(s).orderBy("doc_id").collect()] == [("d", 3, 1, 5), ("f", 1, 1, 1)]
    r = sections.cleaned(s, spark.createDataFrame([("f", 7)], "doc_id string, binary_hash bigint")).collect()
    assert r[0].record == '{"document":{"n_parsed_sections":1,"binary_hash":7},"sections":[{"sort_order":1,"heading_text":"Only","content_text":null,"word_count":1,"page_start":1,"page_end":1}]}'


def test_page_classes_and_census(spark):
    got = {(r.doc_id, r.page): r.kind for r in quality.page_classes(frame(spark)).collect()}
    assert got[("d", 1)] == "body" and got[("d", 5)] == "body"
    e = spark.createDataFrame([el("x", 1, "table", "table", grid=[[""]], pages=(1,)), el("x", 2, "picture", "picture", pages=(2,)), el("x", 3, "text", "page_footer", "f", pages=(3,)), el("x", 4, "text", "text", "t", pages=(5,))], ELEMENTS)
    assert [r.kind for r in quality.page_classes(e).orderBy("page").collect()] == ["blank_table", "image_only", "furniture_only", "no_elements", "body"]
    assert any(r.unhandled for r in quality.census(frame(spark)).collect())


def test_table_gap(spark, rows):
    e = frame(spark)
    kept = spark.createDataFrame([("d", "a 1")], "doc_id string, content_text string")
    assert rows(quality.table_gap(e, kept)) == [("d", 1, ["b"])]


def test_empty(spark):
    assert sections.sections(frame(spark).where("false")).count() == 0
