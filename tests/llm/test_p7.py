import os

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from foliant.llm import p7_encode as m

pytestmark = pytest.mark.skipif(not os.path.exists(m.default_path()), reason="no vocabulary here")
TEXTS = ["", None, "Hello  world\n\n it's 12,345.67\t!", "<|endoftext|> x", "naïve café 漢字 🙂 é", "a" * 50_000, "\x00\x1c\x85 x", " ", "\xa0 　x"]


def whole(text):
    return m.encoder(m.default_path()).lib.encode(text, add_special_tokens=False).ids if text else []


def test_ids_equal_the_library(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id bigint, text string").selectExpr("*", "'x' as ids")
    assert {r.doc_id: r.ids for r in m.encode(df).collect()} == {i: whole(t) for i, t in enumerate(TEXTS)}


def test_round_trip_and_offsets(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id bigint, text string")
    assert all(r.same and r.aligned for r in m.round_trip(df).collect())
    assert m.encode(df.where("false")).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.one_of(st.text(max_size=60), st.text(alphabet="ab '\n\t.1s\x1c\x0b", max_size=60)))
def test_any_text(text):
    e = m.encoder(m.default_path())
    text = text.encode("utf-8", "replace").decode()
    ids = e.encode(text)
    assert ids == whole(text) and e.decode(ids) == text
    starts = e.offsets(text, ids)
    assert starts == sorted(starts) and (not ids or starts[0] == 0)


def test_a_vocabulary_with_another_split_goes_through_the_library_whole(spark):
    path = m.default_path("word_bpe_49k.json")
    if not os.path.exists(path):
        pytest.skip("no such vocabulary here")
    texts = ["DON'T do  that, MR. O'NEIL's 12345 claims", "Plain words only.", "don't", "naïve CAFÉ", "", None]
    lib = m.Encoder(path).lib
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    assert {r.doc_id: r.ids for r in m.encode(df, path).collect()} == {i: lib.encode(t, add_special_tokens=False).ids if t else [] for i, t in enumerate(texts)}
    assert m.splits_so(m.default_path()) and not m.splits_so(path)


def test_byte_table_is_a_bijection():
    t = m.byte_table()
    assert len(t) == 256 and set(t.values()) == set(range(256))
