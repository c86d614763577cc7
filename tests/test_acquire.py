import io
import zipfile

import pytest

from foliant.operators import acquire as a
from foliant.sources import archives, html, slices
from foliant.sources.config import ConfigError, EmbedSettings, load, load_env, typed
from foliant.sources.fetch import FetchError, declared_length, fetch

ENTRY = "url string, pos int, status string, artifacts array<struct<path:string,size:bigint>>"


def test_targets(spark, rows):
    v = spark.createDataFrame([("1",), ("2",)], "n string")
    t = a.templated_targets(v, "n", "u/{n}", "d/{n}.pdf")
    assert rows(t) == [("u/1", "d/1.pdf", None, None), ("u/2", "d/2.pdf", None, None)] and a.checked(t, 2) is t
    with pytest.raises(a.TargetError, match="expected"):
        a.checked(t, 3)
    with pytest.raises(a.TargetError, match="placeholders"):
        a.templated_targets(v, "n", "u/{x}", "d")
    for bad in ([{"url": "u", "destination": "../x"}], [{"url": "u", "destination": "x"}, {"url": "v", "destination": "x"}]):
        with pytest.raises(a.TargetError):
            a.checked(a.explicit_targets(spark, bad))
    with pytest.raises(a.TargetError):
        a.explicit_targets(spark, [{"url": "u"}])


def test_decisions_and_manifest_checks(spark, rows):
    e = spark.createDataFrame([("a", 0, "failed", []), ("a", 1, "fetched", [("pa", 3)]), ("b", 2, "fetched", [("pb", 3), ("pb2", 1)]), ("c", 3, "failed", [("pa", 3)]), ("d", 4, "skipped", []), ("e", 5, "fetched", [("pe", 0)])], ENTRY)
    f = spark.createDataFrame([("pa", 3, bytearray(b"%PDF")), ("pb", 4, bytearray(b"xxxx")), ("pe", 0, bytearray())], "path string, size bigint, head binary")
    t = spark.createDataFrame([(u, u) for u in "abcdez"], "url string, destination string")
    assert [r.url for r in a.decisions(t, e, f).where("skip").collect()] == ["a", "e"]
    assert rows(a.manifest_failures(e, f)) == [("a", None, "failed"), ("b", "pb", "size"), ("b", "pb2", "missing"), ("c", "pa", "failed"), ("d", None, "no_artifacts"), ("e", "pe", "empty")]
    pdf = spark.createDataFrame([("x", 0, "fetched", [("x.pdf", 4)])], ENTRY)
    bad = spark.createDataFrame([("x.pdf", 4, bytearray(b"<htm"))], "path string, size bigint, head binary")
    assert rows(a.manifest_failures(pdf, bad, {"pdf": "25504446"})) == [("x", "x.pdf", "content")]


def test_run_and_manifest(spark, tmp_path):
    def get(url, dest):
        if url == "bad":
            raise FetchError("no")
        dest.write_text(url)

    t = [{"url": "u1", "destination": "a/1"}, {"url": "bad", "destination": "a/2"}, {"url": "u3", "destination": "a/3", "expected_size": 9}]
    got = a.run(t, str(tmp_path), get)
    assert [e["status"] for e in got] == ["fetched", "failed", "failed"] and not (tmp_path / "a/3").exists()
    a.write_manifest(str(tmp_path / "m.json"), got)
    back = a.read_manifest(spark, str(tmp_path / "m.json")).orderBy("pos").collect()
    assert [r.status for r in back] == ["fetched", "failed", "failed"]
    prior = {r.url: r.asDict(recursive=True) for r in back}
    assert [e["status"] for e in a.run(t, str(tmp_path), get, prior)] == ["skipped", "failed", "failed"]
    (tmp_path / "a/1").write_text("longer")
    assert a.run(t[:1], str(tmp_path), get, prior)[0]["status"] == "fetched" and a.run(t[:1], str(tmp_path), get, prior, dry_run=True)[0]["artifacts"] in ([], back[0].asDict(True)["artifacts"])
    (tmp_path / "m.json").write_text('{"entries": [{"url": 1}]}')
    with pytest.raises(ValueError, match="entry 0"):
        a.read_manifest(spark, str(tmp_path / "m.json"))


class Answer(io.BytesIO):
    def __init__(self, body, headers):
        super().__init__(body)
        self.headers = headers


def test_fetch(tmp_path):
    import urllib.error

    calls = []

    def flaky(url, timeout):
        calls.append(url)
        if len(calls) < 3:
            raise urllib.error.HTTPError(url, 503, "busy", None, None)
        return Answer(b"body", {"Content-Length": "4"})

    assert fetch("u", tmp_path / "f", wait=0, open_url=flaky) == 4 and (tmp_path / "f").read_bytes() == b"body" and len(calls) == 3
    calls.clear()

    def gone(url, timeout):
        calls.append(url)
        raise urllib.error.HTTPError(url, 404, "no", None, None)

    with pytest.raises(FetchError):
        fetch("u", tmp_path / "g", wait=0, open_url=gone)
    assert len(calls) == 1
    with pytest.raises(FetchError):
        fetch("u", tmp_path / "g", wait=0, open_url=lambda url, timeout: Answer(b"bo", {"Content-Length": "4"}))
    with pytest.raises(FetchError):
        fetch("u", tmp_path / "g", max_bytes=1, open_url=lambda url, timeout: Answer(b"body", {}))
    assert not (tmp_path / "g").exists() and not (tmp_path / "g.part").exists()
    assert [declared_length(h) for h in ({"Content-Length": "5"}, {"content-length": "x"}, {}, {"Content-Length": "5", "Content-Encoding": "gzip"})] == [5, None, None, None]


def test_archives(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("d/x.txt", "x")
        z.writestr("y.csv", "yy")
    (tmp_path / "b.zip").write_text("no archive")
    with zipfile.ZipFile(tmp_path / "c.zip", "w") as z:
        z.writestr("../x.txt", "x")
    files = spark.read.format("binaryFile").load(str(tmp_path))
    got = sorted((r.path.rsplit("/", 1)[1], r.name, r.size, r.error is not None) for r in archives.members(files, ["*.txt"]).collect())
    assert got == [("a.zip", "x.txt", 1, False), ("b.zip", None, None, True), ("c.zip", None, None, True)]
    assert archives.extract(tmp_path / "a.zip", tmp_path / "o", ["*"], flatten=True) == [tmp_path / "o/x.txt", tmp_path / "o/y.csv"] and not (tmp_path / "a.zip").exists()
    with pytest.raises(ValueError):
        archives.extract(tmp_path / "c.zip", tmp_path / "o2", ["*"])


def test_html(spark, rows):
    page = "<nav><a href='/z.pdf'>z</a></nav><article><a class=x href='b.PDF'>b</a> <a href=\"/a.pdf\">a</a><a href='b.PDF'>b</a><a href='old.pdf'>o</a><a href='c.html'>c</a></article>"
    df = spark.createDataFrame([("https://h/d/i.html", page), ("https://h/n", "<a href='q.pdf'>q</a>"), ("e", None)], "url string, html string")
    assert rows(html.links(df, exclude=("OLD",))) == [("https://h/d/i.html", "https://h/a.pdf"), ("https://h/d/i.html", "https://h/d/b.PDF"), ("https://h/n", "https://h/q.pdf")]
    index = "<table><tr><td><a href='/1'>100</a></td><td>Introduction</td></tr><tr><td><a href='/4'>100-04</a></td><td>Medicare Claims Processing Manual</td></tr><tr><td><a href='/5'>100-04</a></td><td>Other</td></tr><tr><td><a href='/6'>200-01</a></td><td>No</td></tr></table>"
    got = rows(html.index_rows(spark.createDataFrame([("u", index)], "url string, html string")).select("key", "title", "href", "folder"))
    assert got == [("100", "Introduction", "/1", "pub_100_introduction"), ("100-04", "Medicare Claims Processing Manual", "/4", "pub_100_04_claims_processing")]


def test_slices(spark, rows):
    f = spark.createDataFrame([("a", 60), ("b", 25), ("c", None)], "k string, n int")
    assert rows(slices.page_slices(f, "k", "n")) == [("a", 1, 1, 25), ("a", 2, 26, 50), ("a", 3, 51, 60), ("b", 1, 1, 25), ("c", 1, 1, None)]
    assert slices.page_slices(f, "k", "n", 0).count() == 3
    e = spark.createDataFrame([("a", 2, 1, 26, 50, [1]), ("a", 1, 1, 1, 25, [25])], "k string, slice_no int, seq int, first_page int, last_page int, pages array<int>")
    assert rows(slices.stitch(e, "k").select("seq", "pages")) == [(1, [25]), (2, [26])]
    g = spark.createDataFrame([(1, "x", True), (2, "y", False), (3, "z", True)], "pos int, file string, ocr boolean")
    assert [r.files for r in slices.settings_groups(g, ["ocr"], "file").orderBy("first_pos").collect()] == [["x", "z"], ["y"]]


def test_config(tmp_path):
    (tmp_path / "c.toml").write_text("max_tokens = 100\n[tables.t]\noverlap = 10\n")
    c = load(tmp_path / "c.toml")
    assert EmbedSettings.of(c, c["tables"]["t"]) == EmbedSettings(64, 100, 10, False, {})
    for bad in ({"overlap": 100}, {"overwrite": "false"}, {"batch_size": True}):
        with pytest.raises(ConfigError):
            EmbedSettings.of(c, bad)
    with pytest.raises(ConfigError):
        load(tmp_path / "no.toml")
    with pytest.raises(ConfigError):
        typed({}, "x", int)
    (tmp_path / ".env").write_text("export A='1'\n# c\nB=2\n")
    assert load_env(tmp_path / ".env", {"A": "0", "C": "3"}) == {"A": "1", "B": "2", "C": "3"}
