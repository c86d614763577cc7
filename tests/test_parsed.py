import json

import pytest

from foliant.operators import documents as d
from foliant.operators import sections, store
from foliant.sources import config, parsed

TREE = {
    "origin": {"binary_hash": 18446744073709551615},
    "body": {"children": [{"$ref": "#/texts/0"}, {"$ref": "#/groups/0"}, {"$ref": "#/tables/0"}]},
    "groups": [{"label": "list", "children": [{"$ref": "#/texts/1"}]}],
    "texts": [{"label": "section_header", "text": "Head", "prov": [{"page_no": 1}]}, {"label": "list_item", "text": "item", "prov": [{"page_no": 2}]}, {"label": "caption", "text": "Cap"}],
    "tables": [{"label": "table", "captions": [{"$ref": "#/texts/2"}], "data": {"grid": [[{"text": "a"}], [{"text": "b"}]]}, "prov": [{"page_no": 3}]}],
}


def good(**change):
    s = {"sort_order": 1, "heading_text": "H a", "content_text": "x", "word_count": 3, "page_start": 1, "page_end": 2}
    return {"document": {"n_parsed_sections": 1, "binary_hash": 7}, "sections": [s | change]}


def test_trees_to_sections(spark, tmp_path, rows):
    (tmp_path / "one.json").write_text(json.dumps(TREE))
    (tmp_path / "bad.json").write_text("{")
    (tmp_path / "none.json").write_text("{}")
    p = parsed.parse(spark.read.format("binaryFile").load(str(tmp_path))).cache()
    assert rows(sections.sections(parsed.elements(p))) == [("one", 1, "Head", "item\n\nCap\n\n| a |\n| --- |\n| b |", 12, 1, 3)]
    assert sorted(r.doc_id for r in parsed.parse_failures(p).collect()) == ["bad", "none"]
    assert int(p.where("doc_id = 'one'").first().binary_hash) == 2**64 - 1
    assert rows(parsed.paired(parsed.elements(p), spark.createDataFrame([("two",)], "doc_id string"))) == [("one", "not cleaned"), ("two", "not parsed")]


def test_cleaned_contract(spark, tmp_path):
    two = good()
    two["sections"] = [two["sections"][0], two["sections"][0]]
    cases = {
        "fine": good(), "words": good(word_count=4), "order": good(sort_order=2), "pages": good(page_start=3), "low": good(page_end=0), "nothing": good(heading_text=None, content_text=None, word_count=0), "bool": good(word_count=True), "extra": good(other=1),
        "count": two, "empty": {"document": {"n_parsed_sections": 1, "binary_hash": 7}, "sections": []}, "hash": {**good(), "document": {"n_parsed_sections": 1, "binary_hash": -1}}, "big": {**good(), "document": {"n_parsed_sections": 1, "binary_hash": 2**64}}, "top": {**good(), "x": 1}, "null": good(page_start=None, page_end=None),
    }
    for name, value in cases.items():
        (tmp_path / f"{name}.json").write_text(json.dumps(value))
    (tmp_path / "bytes.json").write_bytes(b"\xff\xfe{")
    (tmp_path / "broken.json").write_text('{"document": ')
    got = {r.doc_id: r.reason for r in parsed.cleaned_failures(parsed.cleaned_records(spark.read.format("binaryFile").load(str(tmp_path)))).collect()}
    assert got == {
        "words": "word count", "order": "order", "pages": "pages", "low": "pages", "nothing": "nothing in a section", "bool": "wrong type", "extra": "unknown key", "count": "number of sections", "empty": "no sections", "hash": "hash range",
        "big": "hash range", "top": "unknown key", "bytes": "not UTF-8", "broken": "malformed",
    }


def test_kept_documents(spark, rows):
    e = lambda *r: spark.createDataFrame(list(r), "file string, collection_path string")
    assert rows(d.kept(e(("a/x.pdf", "p.x"), ("y.pdf", "Bad"), ("z.pdf", None))).select("stem")) == [("x",)]
    for bad in (e(("a/x.pdf", "p.x"), ("b/x.docx", "Bad")), e(("x.pdf", "p.x"), ("y.pdf", "p.x")), e(("x.pdf", "Bad"))):
        with pytest.raises(d.DocumentError):
            d.kept(bad)
    k = spark.createDataFrame([("100",), ("100-01",)], "key string")
    assert rows(d.selected(k, ["100-introduction"], alias={"100-introduction": "100"})) == [("100",)] and d.selected(k, []).count() == 2


def test_exports(spark):
    s = spark.createDataFrame([("a", 2, "Two & <b>", None), ("a", 1, None, "one\n\nmore")], "doc_id string, sort_order int, heading_text string, content_text string")
    got = {f: d.exported(s, f).first().text for f in ("markdown", "text", "html", "json", "yaml")}
    assert got["markdown"] == "one\n\nmore\n\n## Two & <b>" and got["text"] == "one\n\nmore\n\nTwo & <b>" and got["html"] == "<p>one</p>\n<p>more</p>\n<h2>Two &amp; &lt;b&gt;</h2>"
    assert [x["sort_order"] for x in json.loads(got["json"])] == [1, 2] and got["yaml"] == '- heading: null\n  content: "one\\n\\nmore"\n- heading: "Two & <b>"\n  content: null'
    with pytest.raises(ValueError):
        d.exported(s, "pdf")


def test_configs():
    assert config.check_files({"documents": [{"file": "a"}]}) and config.check_sheets({"files": [{"file": "a", "sheets": [{"sheet": "s", "start_col": "B"}]}]})
    assert config.check_acquisition({"discovery": {"kind": "explicit", "targets": []}})["kind"] == "explicit"
    bad = [
        (config.check_files, {}), (config.check_files, {"documents": [{"file": "a"}, {"file": "a"}]}), (config.check_files, {"documents": [{"file": "a", "do_ocr": "false"}]}), (config.check_sheets, {"files": [{"file": "a", "sheets": [{"sheet": "s"}, {"sheet": "s"}]}]}),
        (config.check_sheets, {"files": [{"file": "a", "sheets": [{"sheet": "s", "structured_table": "A b"}]}]}), (config.check_acquisition, {"discovery": {"kind": "x"}}), (config.check_acquisition, {"discovery": {"kind": "templated"}}),
    ]
    for check, c in bad:
        with pytest.raises(config.ConfigError):
            check(c)


def test_titles(spark, rows):
    e = d.kept(spark.createDataFrame([("a/x.pdf", "p.x", "T"), ("y.pdf", "p.y", None)], "file string, collection_path string, title string"))
    assert rows(d.titled(spark.createDataFrame([("x",), ("z",)], "doc_id string"), e)) == [("x", "p.x", "T")]
    s = spark.createDataFrame([("a/b.xlsx", "S", None), ("b.xlsx", "S", "own")], "file string, sheet string, title string")
    assert [r[0] for r in s.select(d.default_title()).collect()] == ["b — S", "own"]
    d.create(spark, "made_once", "k string, v int", ["k"])
    d.create(spark, "made_once", "k string", ["k"])
    assert d.missing_tables(spark, ["made_once", "never"]) == ["never"] and spark.table("made_once").columns == ["k", "v"]
    assert d.keys_of(spark, "made_once") == ["k"] and d.columns_of(spark, "made_once") == [("k", "string"), ("v", "int")]
    assert store.apply_comments(spark, "default", "all", {"made_once": "it's", "x": None}) == 2
    assert spark.sql("DESCRIBE TABLE EXTENDED made_once").where("col_name = 'Comment'").first()["data_type"] == "it's"
    spark.sql("DROP TABLE made_once")
    assert d.create_structured(spark, "made_wide", ["Unit Price", "unit-price", "%"]) == ["col_unit_price", "col_unit_price_2", "col_col_2"]
    assert d.keys_of(spark, "made_wide") == ["collection_path", "sort_order"] and len(d.columns_of(spark, "made_wide")) == 5
    spark.sql("DROP TABLE made_wide")
