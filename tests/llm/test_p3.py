import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from foliant.llm import p3_split as m

TEXT = st.lists(st.sampled_from(["a", "bb.", "c!", "d", "e", "f?", "g.h", "i"]), max_size=120).flatmap(lambda ws: st.lists(st.sampled_from([" ", "  ", "\n", " \n ", "　"]), min_size=len(ws), max_size=len(ws)).map(lambda gs: "".join(a + b for a, b in zip(ws, gs))))


def forced(text, limit):
    return any(len(x.split()) > limit for x in re.split(r"\n|(?<=[.!?])\s", text))


@settings(max_examples=300, deadline=None)
@given(TEXT, st.integers(3, 30), st.integers(0, 2))
def test_pieces_cover_the_text_with_the_overlap(text, limit, overlap):
    spans, ends = m.boundaries(text)
    n, cut = len(spans), m.cuts(len(spans), m.boundaries(text)[1], limit, overlap)
    assert n == len(text.split())
    if not n:
        return
    assert cut[0][0] == 0 and cut[-1][1] == n and all(0 < e - s <= limit for s, e, _ in cut)
    for (s, e, how), (s2, e2, _) in zip(cut, cut[1:]):
        assert s2 == e - overlap and e2 > e
        reach = [x for x in ends if s + overlap < x <= s + limit]
        assert (how == "natural" and e == reach[-1]) if reach else (how == "hard" and e == s + limit)
    assert (m.kind_of(n, ends, limit) == "forced") == forced(text, limit)


def test_oversized_and_pieces(spark, rows):
    long = " ".join(f"w{i}" + ("." if i % 50 == 0 else "") for i in range(1, 1001))
    hard = " ".join(f"w{i}" for i in range(500))
    content = spark.createDataFrame([(1, long, "x"), (2, hard, "x"), (3, "short text.", "x"), (4, None, "x"), (5, "", "x"), (6, " \n", "x"), (1, long, "x"), (7, "x" * 5000, "x")], "section_id bigint, content_text string, text string")
    chunks = spark.createDataFrame([(9, hard, "y")], "chunk_id bigint, chunk_text string, item_id string")
    items = m.items(content, chunks)
    assert rows(m.oversized(items)) == [("document_content", 1, "natural"), ("document_content", 2, "forced"), ("embedding_table", 9, "forced")]
    got = m.pieces(items).collect()
    own = sorted((r for r in got if (r.table_name, r.item_id) == ("document_content", 1)), key=lambda r: r.chunk_number)
    assert [r.chunk_number for r in own] == list(range(1, len(own) + 1))
    text = own[0].chunk_text.split()
    for r in own[1:]:
        assert r.word_count == len(r.chunk_text.split()) <= 400 and r.chunk_text.split()[:40] == text[-40:]
        text += r.chunk_text.split()[40:]
    assert text == long.split()
    assert {r.item_id: r.chunk_text for r in got if r.item_id in (3, 7)} == {3: "short text.", 7: "x" * 5000}
    assert not {4, 5, 6} & {r.item_id for r in got if r.table_name == "document_content"}


def test_parameters_and_empty_tables(spark):
    with pytest.raises(ValueError):
        m.cuts(10, [10], 5, 5)
    empty = m.items(spark.createDataFrame([], "section_id bigint, content_text string"), spark.createDataFrame([], "chunk_id bigint, chunk_text string"))
    assert m.oversized(empty).count() == m.pieces(empty).count() == 0
