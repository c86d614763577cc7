"""The pipelines end to end, over small files."""

import http.server
import json
import threading
import zipfile

import pytest

from foliant import cli, pipelines
from foliant.operators import acquire, store
from foliant.sources.config import ConfigError
from test_parsed import TREE
from test_sheets import book


def documents(tmp_path):
    for name, tree in (("one", TREE), ("two", TREE)):
        (tmp_path / f"{name}.json").write_text(json.dumps(tree))
    (tmp_path / "bad.json").write_text("{")
    return {"documents": [{"file": "one.json", "collection_path": "c.one", "title": "One"}, {"file": "two.json", "collection_path": "c.two"}, {"file": "bad.json", "collection_path": "c.bad"}, {"file": "gone.json", "collection_path": "c.gone"}, {"file": "three.json", "collection_path": "Not Valid"}], "cleaned": "cleaned"}


def test_documents_from_files_to_checked_tables(spark, tmp_path, rows):
    config, t = documents(tmp_path), str(tmp_path / "t")
    done = pipelines.ingest_files(spark, config, str(tmp_path), t)
    assert done["document"] == 2 and done["document_content"] == 2 and done["failed"] == 2
    assert rows(store.read(spark, f"{t}/document").select("collection_path", "title")) == [("c.one", "One"), ("c.two", "two")]
    assert pipelines.ingest_files(spark, config, str(tmp_path), t) == {"document": 0, "document_content": 0, "failed": 2}
    assert pipelines.ingest_files(spark, config, str(tmp_path), t, True)["document"] == 2
    assert spark.read.parquet(str(tmp_path / "cleaned")).count() == 2
    assert pipelines.validate_tables(spark, t).count() == 0
    config["documents"] = config["documents"][:1]
    assert pipelines.ingest_files(spark, config | {"prune": True}, str(tmp_path), t) == {"document": 0, "document_content": 0, "failed": 0}
    assert rows(store.read(spark, f"{t}/document").select("collection_path")) == [("c.one",)] and pipelines.validate_tables(spark, t).count() == 0
    with pytest.raises(ConfigError):
        pipelines.ingest_files(spark, config | {"parser": "no.such:thing"}, str(tmp_path), t)


SHEET = """<sheetData><row r="1"><c r="A1" t="inlineStr"><is><t>Prices of the year</t></is></c></row>
<row r="3"><c r="B3" t="inlineStr"><is><t>Code</t></is></c><c r="C3" t="inlineStr"><is><t>Unit Price</t></is></c></row>
<row r="4"><c r="B4" t="inlineStr"><is><t>a</t></is></c><c r="C4"><v>7</v></c></row><row r="5"><c r="B5" t="inlineStr"><is><t>b</t></is></c></row></sheetData>"""


def test_workbooks_with_settings_and_structured_tables(spark, tmp_path, rows):
    book(tmp_path / "w.xlsx", SHEET, ("P", "Q"))
    own = {"header_row": 3, "start_col": "B", "structured_table": "prices"}
    config = {"files": [{"file": "w.xlsx", "sheets": [{"sheet": "P", "title": "Prices", "collection_path": "s.p", **own}, {"sheet": "Q", **own}, {"sheet": "X"}]}]}
    t = str(tmp_path / "t")
    done = pipelines.ingest_sheets(spark, None, t, "pre", settings=config, root=str(tmp_path))
    assert done == {"sheet_content": 4, "sheet": 2, "prices": 4}
    assert rows(store.read(spark, f"{t}/sheet").select("collection_path", "title", "structured_table")) == [("pre.w.q", "w — Q", "prices"), ("s.p", "Prices", "prices")]
    assert rows(store.read(spark, f"{t}/prices")) == [("pre.w.q", 1, "a", "7"), ("pre.w.q", 2, "b", None), ("s.p", 1, "a", "7"), ("s.p", 2, "b", None)]
    assert pipelines.ingest_sheets(spark, None, t, "pre", settings=config, root=str(tmp_path)) == {"sheet_content": 0, "sheet": 0, "prices": 0}
    assert pipelines.validate_tables(spark, t).count() == 0 and pipelines.validate_inputs(spark, config, str(tmp_path)).count() == 1
    store.replace(store.read(spark, f"{t}/prices").where("collection_path = 's.p'"), f"{t}/prices")
    assert rows(pipelines.validate_tables(spark, t).select("check", "key")) == [("missing", "pre.w.q")]


def test_embeddings_with_headers_model_and_counter(spark, tmp_path, rows):
    source = spark.createDataFrame([("a", 1, "Head", "w " * 30), ("a", 2, None, "short"), ("b", 1, "Only", "  ")], "k string, n int, heading string, body string")
    source.write.parquet(str(tmp_path / "source"))
    table = {"source": "source", "target": "target", "keys": ["k", "n"], "embed_columns": ["heading", "body"], "header_columns": ["heading"], "model": "foliant.operators.embed:hashed_words"}
    config = {"max_tokens": 20, "overlap": 4, "tables": {"t": table, "bad": {**table, "keys": ["x"]}, "none": {"source": "source"}}}
    assert pipelines.embed_tables(spark, config, str(tmp_path)) == 2
    got = store.read(spark, str(tmp_path / "target")).orderBy("k", "n", "chunk_number").collect()
    assert all(r.chunk_text.startswith(f"heading: {'Head' if r.n == 1 else ''}\nbody: " if r.chunk_number == 1 else "heading: Head\n") for r in got if r.k == "a") and len([r for r in got if r.k == "a"]) > 2
    assert all(len(r.embedding) == 64 for r in got)
    config["tables"] = {"t": table}
    assert pipelines.embed_tables(spark, config, str(tmp_path)) == 0 and store.read(spark, str(tmp_path / "target")).count() == len(got)
    assert pipelines.validate_embeddings(spark, config, str(tmp_path)).where("check not like 'warning%' and check not like 'over%'").count() == 0
    config["tables"] = {"t": {**table, "target": "other", "header_columns": [], "counter": "foliant.operators.chunks:words_counter"}}
    assert pipelines.embed_tables(spark, config, str(tmp_path)) == 0 and store.read(spark, str(tmp_path / "other")).where("n = 1 and k = 'a'").count() > 1


def test_downloads_in_tasks(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("in/x.pdf", "%PDF-1")
        z.writestr("y.txt", "no")
    (tmp_path / "b.pdf").write_text("no pdf")

    class Handler(http.server.SimpleHTTPRequestHandler):
        def __init__(self, *args):
            super().__init__(*args, directory=str(tmp_path))

        def log_message(self, *args):
            pass

    with http.server.ThreadingHTTPServer(("127.0.0.1", 0), Handler) as server:
        threading.Thread(target=server.serve_forever, daemon=True).start()
        base, root = f"http://127.0.0.1:{server.server_port}", tmp_path / "root"
        config = {"retries": 0, "extract": {"keep": ["*.pdf"]}, "discovery": {"kind": "templated", "variable": "n", "values": ["a.zip", "b.pdf", "c.pdf"], "url": base + "/{n}", "destination": "raw/{n}"}}
        assert [x["status"] for x in pipelines.acquire_targets(spark, config, str(root), dry_run=True)] == ["skipped"] * 3 and not (root / "manifest.json").exists()
        first = pipelines.acquire_targets(spark, config, str(root), tasks=2)
        assert [x["status"] for x in first] == ["fetched", "fetched", "failed"] and first[0]["artifacts"] == [{"path": "raw/in/x.pdf", "size": 6}]
        assert [x["status"] for x in pipelines.acquire_targets(spark, config, str(root))] == ["skipped", "skipped", "failed"]
        server.shutdown()
    bad = {r.check for r in pipelines.validate_downloads(spark, str(root / "manifest.json"), str(root)).collect()}
    assert bad == {"failed", "content"}
    (root / "raw/z.zip").write_bytes(b"PK\x03\x04 broken")
    assert {r.path: r.readable for r in acquire.stored_files(spark, str(root)).collect()}["raw/z.zip"] is False


def test_command_line(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("foliant.runtime.session", lambda *_: spark)
    book(tmp_path / "w.xlsx", SHEET.replace('r="1"', 'r="11"').replace("A1", "A11").replace('r="3"', 'r="1"').replace("B3", "A1").replace("C3", "B1").replace("B4", "A4").replace("C4", "B4").replace("B5", "A5"))
    t = str(tmp_path / "t")
    assert cli.main(["sheets", "--files", str(tmp_path / "*.xlsx"), "--tables", t]) == 0
    assert cli.main(["validate", "--tables", t]) == 0 and cli.main(["validate"]) == 1 and cli.main(["validate", "--tables", str(tmp_path / "no")]) == 1
    (tmp_path / "c.toml").write_text('[[documents]]\nfile = "one.json"\ncollection_path = "c.one"\n')
    documents(tmp_path)
    assert cli.main(["--root", str(tmp_path), "files", "--config", str(tmp_path / "c.toml"), "--tables", t]) == 0
    assert cli.main(["validate", "--tables", t]) == 0
    assert cli.main(["report", "--tables", t, "--out", str(tmp_path / "r")]) == 0 and spark.read.json(str(tmp_path / "r")).count() == 1
