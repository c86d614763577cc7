from pyspark.sql import functions as F

from foliant.operators import quality as q

S = "doc string, heading_text string, content_text string, page_start int, page_end int"


def test_text_health(spark):
    df = spark.createDataFrame([("a", None, "ok text here now", 1, 1), ("b", None, "bad \ufffd\x01\t\n x", 1, 1), ("c", None, "a b c dd", 1, 1), ("d", None, None, 1, 1), ("e", None, " ".join(["wo- rd"] * 11), 1, 1)], S)
    got = {r.doc: (r.bad_chars, r.single_ratio, r.broken, r.flagged) for r in q.text_health(df).collect()}
    assert got == {"a": (0, 0.0, 0, False), "b": (2, round(1 / 3, 4), 0, True), "c": (0, 0.75, 0, True), "d": (0, 0.0, 0, False), "e": (0, 0.0, 11, True)}


def test_without_tables(spark):
    df = spark.createDataFrame([("x\n| a |\n\n--- | :-\n  |b\ny",), (None,)], "t string")
    assert [r[0] for r in df.select(q.without_tables("t")).collect()] == ["x\n\ny", None]


def test_page_coverage(spark):
    df = spark.createDataFrame([("a", None, "x", 1, 3), ("a", None, "x", 2, 5), ("a", None, "x", 8, 8), ("a", None, "x", None, 10), ("b", None, "x", None, None), ("c", None, "x", 1, 1)], S)
    got = {r.doc: (r.total_pages, r.covered_pages, r.coverage) for r in q.page_coverage(df, "doc").collect()}
    assert got == {"a": (10, 6, 0.6), "b": (None, 0, None), "c": (1, 1, 1.0)}


def test_fragmentation(spark):
    rows = [(f"d{i}", None, "one two three four five six", p, p) for i in range(4) for p in range(1, 6)] + [("out", "h", None, 1 + k % 5, 1 + k % 5) for k in range(60)]
    got = q.fragmentation_flags(q.fragmentation(spark.createDataFrame(rows, S), "doc")).collect()
    assert [(r.doc, sorted(r.reasons)) for r in got] == [("out", ["many_sections", "short_sections"])]
    mixed = [r for r in rows if r[0] != "out"] + [("out", None, "one two three four five six", None, None)] * 60
    assert q.fragmentation_flags(q.fragmentation(spark.createDataFrame(mixed, S), "doc")).count() == 0


def test_fence_and_numbers(spark, rows):
    c = spark.createDataFrame([(1.0,), (0.9,), (None,)], "coverage double")
    assert q.coverage_fence(c).collect()[0].fence == 0.85 and q.coverage_fence(c.where("false")).collect()[0].fence == 0.0
    n = spark.createDataFrame([("a", h, "x", 1, 1) for h in ("1 x", "2.1 y", "5 z", "zzz", "99999999999999999999 q", None)] + [("b", h, "x", 1, 1) for h in ("10", "20", "40")], S)
    assert rows(q.number_gaps(n, "doc")) == [("a", 3), ("a", 4), ("b", 30)]


def test_coverage_gap(spark):
    a = spark.createDataFrame([("a", "One two 3.50"), ("b", None)], "k string, t string")
    b = spark.createDataFrame([("a", "two 3.5")], "k string, t string")
    assert [tuple(r) for r in q.coverage_gap(a, b, ["k"], "t", "t").collect()] == [("a", 3, 1, ["one"])]


def test_ranked(spark):
    one, two = spark.createDataFrame([("a",), ("b",)], "k string"), spark.createDataFrame([("b",), ("b",)], "k string")
    assert [tuple(r) for r in q.ranked_flags({"x": one, "y": two}, "k").collect()] == [("b", 2, "x,y"), ("a", 1, "x")]
    assert q.report(spark.createDataFrame([("a", "h", "x y", 1, 2)], S), "doc").select(F.get_json_object("record", "$.coverage")).collect()[0][0] == "1.0"
