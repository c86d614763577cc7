import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from foliant.operators import chunks as m

COUNT = lambda t: len(t.split()) + 2


def plain(text, most, overlap):
    """One word after another, as a reader would do it."""
    ws = text.split()
    if COUNT(text) <= most:
        return [text]
    out, start = [], 0
    while start < len(ws):
        end = start + 1
        while end < len(ws) and COUNT(" ".join(ws[start : end + 1])) <= most:
            end += 1
        out.append(" ".join(ws[start:end]))
        if end == len(ws):
            return out
        k = end
        while k > start + 1 and COUNT(" ".join(ws[k - 1 : end])) <= overlap:
            k -= 1
        start = k
    return out


@settings(max_examples=300, deadline=None)
@given(st.integers(0, 120), st.integers(1, 30), st.integers(0, 29))
def test_greedy_equals_the_plain_way(n, most, overlap):
    if overlap < most:
        text = " ".join(f"w{i}" for i in range(n))
        assert [c for c, _ in m.greedy(text, COUNT, most, overlap)] == plain(text, most, overlap)


def test_closed_form_equals_greedy(spark):
    texts = [" ".join(f"w{i}" for i in range(n)) for n in (0, 1, 4, 8, 9, 25, 40, 200)] + [None, "\n\n", "a\nb", "a  b"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    for most, overlap in ((10, 2), (10, 3), (3, 2), (1, 0), (64, 10)):
        got = {}
        for r in m.additive(df, "text", most, overlap).collect():
            got.setdefault(r.id, {})[r.chunk_number] = (r.chunk_text, r.word_count)
        for i, t in enumerate(texts):
            want = m.greedy(t or "", COUNT, most, overlap)
            assert got.get(i, {}) == dict(enumerate(want, 1)), (i, most, overlap)


def test_counter_of_characters_and_by_counter(spark):
    assert m.greedy("\n" * 100, len, 10, 2) == []
    df = spark.createDataFrame([(1, "aa bb cc dd ee"), (2, None)], "id int, text string")
    got = sorted((r.id, r.chunk_number, r.chunk_text, r.word_count) for r in m.by_counter(df, ["id"], "text", lambda: len, 8, 2).collect())
    assert got == [(1, 1, "aa bb cc", 3), (1, 2, "cc dd ee", 3), (2, 1, "", 0)]


def test_header_budget(spark):
    df = spark.createDataFrame([("H one", " ".join(["w"] * 50)), ("H " * 30, "a b"), (None, None)], "heading string, body string")
    rows = m.with_header(df, "heading", "body", 30, 5).collect()
    assert all(r.chunk_text.startswith("heading: ") for r in rows)
    # the budget of a long header is one more than the overlap
    assert [r[0] for r in df.select(m.header_budget(30, 5, F.concat(F.lit("heading: "), F.coalesce("heading", F.lit(""))))).collect()] == [25, 6, 27]


@pytest.mark.parametrize("most, overlap", [(0, 0), (5, 5), (5, -1)])
def test_guards(most, overlap):
    with pytest.raises(ValueError):
        m.greedy("a", COUNT, most, overlap)
