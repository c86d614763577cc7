from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from foliant.functions import identity, text
from foliant.functions.stem import stem_word

ODD = "a\x0bb\x1cc\x85d\xa0e f  g\n h　"


def values(spark, rows, c):
    return [r[0] for r in spark.createDataFrame([(i, x) for i, x in enumerate(rows)], "i int, s string").orderBy("i").select(c).collect()]


def test_words_are_those_of_python(spark):
    rows = [ODD, "", None, "  ", "one", " two  words ", "x" * 10_000, "\x1f", "a b\xa0\x1ec"]
    assert values(spark, rows, text.word_count("s")) == [len((r or "").split()) for r in rows]
    assert values(spark, rows, text.words("s")) == [(r or "").split() for r in rows]
    assert values(spark, rows, text.py_strip("s")) == [None if r is None else r.strip() for r in rows]
    assert values(spark, rows, text.is_blank("s")) == [not (r or "").strip() for r in rows]


@settings(max_examples=20, deadline=None)
@given(st.lists(st.text(alphabet="ab \t\n\x0b\x1c\x85\xa0 　.", max_size=20), min_size=1, max_size=20))
def test_word_count_of_any_text(spark, rows):
    assert values(spark, rows, text.word_count("s")) == [len(r.split()) for r in rows]


def test_tokens(spark):
    assert [sorted(x) for x in values(spark, ["A 1.50 2.0 7 x_y Éa 1.50", None], text.tokens("s"))] == [sorted(["a", "1.5", "2", "7", "x_y", "éa"]), []]


def test_row_text(spark):
    df = spark.createDataFrame([("1", "Widget"), ("x", None), ("0", "")], "a string, b string")
    assert [r[0] for r in df.select(text.row_text([("Item #", "a"), ("Name", "b")])).collect()] == ["Item #: 1\nName: Widget", "Item #: x\nName: ", "Item #: 0\nName: "]


def test_hash(spark):
    import hashlib

    want = int.from_bytes(hashlib.sha256(b"a\nb").digest()[-8:], "big")
    assert values(spark, ["a\nb"], text.low64_sha256("s")) == [want]


def test_identity(spark):
    assert values(spark, ["Item #", "  A--B ", "", "é", "x" * 80], identity.column_name("s", "i")) == ["col_item", "col_a_b", "col_col_2", "col_col_3", "col_" + "x" * 59]
    assert values(spark, ["in/A b.v1.xlsx", ".env", "x", "c:\\d\\e.f"], identity.stem("s")) == ["A b.v1", ".env", "x", "e"]
    assert values(spark, ["a.b_1", "a.b\n", "A", "", None, "a..b"], identity.valid_path("s")) == [True, False, False, False, False, False]
    assert values(spark, ["Medicare Claims Processing Manual", "CMS Medicare Manual", "Manual", " Manual", None], identity.folder_name("s", F.lit("100-04"))) == ["pub_100_04_claims_processing", "pub_100_04_medicare", "pub_100_04_manual", None, None]
    assert values(spark, ["a/b", "/a", "C:x", "a/../b", "..\\x", "", None], identity.escapes("s")) == [False, True, True, True, True, True, True]
    df = spark.createDataFrame([("in/My Book.xlsx", "Sheet 1", None), ("b.xlsx", "s", "own.path"), ("b.xlsx", "s", "Bad Path")], "f string, s string, o string")
    assert [r[0] for r in df.select(identity.sheet_path("f", "s", "o", "pre.fix")).collect()] == ["pre.fix.my_book.sheet_1", "own.path", None]


def test_driver_names():
    assert identity.distinct_names(["a", "a", "a_2", "b"]) == ["a", "a_2", "a_2_2", "b"]
    assert all(len(n) <= 63 for n in identity.distinct_names(["x" * 63] * 3))
    assert [identity.column_index(c) for c in ("A", "z", "AA", "XFD")] == [1, 26, 27, 16384]
    assert identity.file_names(["h/a/x.pdf", "h/b/x.pdf", "h/b/x.pdf", "h/c"]) == ["x.pdf", "b_x.pdf", "b_x_2.pdf", "c"]


def test_stems():
    pairs = {"caresses": "caress", "ponies": "poni", "relational": "relat", "hopping": "hop", "falling": "fall", "happy": "happi", "adjustment": "adjust", "agreed": "agre", "sky": "sky", "controlling": "control", "x1": "x1"}
    assert {w: stem_word(w) for w in pairs} == pairs
