import numpy as np
import pytest
from pyspark.sql import functions as F

from foliant.operators import embed as e
from foliant.operators import validate as v
from foliant.streaming.incremental import ingest


def test_filter_and_resume(spark, rows):
    s = spark.createDataFrame([("keep.pdf", 1, "a"), ("keepxpdf", 2, " "), ("other", 3, None), (None, 4, "b")], "f string, n int, t string")
    assert rows(s.where(e.source_filter(s, {"f": ["keep.%", "oth%"], "n": "_"})).select("n")) == [(1,), (3,)]
    with pytest.raises(ValueError, match="unknown"):
        e.source_filter(s, {"zz": "x"})
    done = spark.createDataFrame([("keep.pdf", 1), ("keep.pdf", 1)], "fname string, so int")
    assert rows(e.resume(s, done, {"f": "fname", "n": "so"}).select("n")) == [(2,), (3,), (4,)]
    assert rows(e.surviving(done, s.where("n > 1"), {"f": "fname", "n": "so"})) == [("keep.pdf", 1)] * 2
    assert rows(s.where(e.has_text(["t"])).select("n")) == [(1,), (4,)]


def test_encode_and_terms(spark):
    df = spark.createDataFrame([(1, "Claims of the claimed"), (2, None), (3, "")], "id int, chunk_text string")
    got = {r.id: r.embedding for r in e.encode(df, e.hashed_model(8)).collect()}
    assert abs(sum(x * x for x in got[1]) - 1) < 1e-5 and got[2] == got[3] == [0.0] * 8
    assert e.encode(df.where("false")).count() == 0
    assert [r[0] for r in df.orderBy("id").select(e.terms("chunk_text")).collect()] == [["claim"], [], []]


def test_top_k_equals_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(60, 4))
    x[7] = x[3]
    df = spark.createDataFrame([(i, [float(a) for a in r]) for i, r in enumerate(x)] + [(99, None), (98, [1.0])], "id int, v array<float>")
    u = x.astype(np.float32).astype(float)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    s = np.round(u @ u.T, 6)
    np.fill_diagonal(s, -9)
    for block in (65_536, 8):
        monkeypatch.setattr(e, "BLOCK", block)
        got = {(r.query_id, r["rank"]): r.id for r in e.top_k(df, df.where("id % 5 = 3"), "id", "v", 4, 3).collect()}
        assert got == {(q, k + 1): int(j) for q in range(3, 60, 5) for k, j in enumerate(np.lexsort((np.arange(60), -s[q]))[:3])}


def test_validators(spark, rows):
    doc = spark.createDataFrame([("a.b", "t", 2, 1), ("a.c", " ", 1, None), ("a.d", "t", 1, 3), ("a.d", "t", 1, 3)], "collection_path string, title string, n_parsed_sections int, source_binary_hash int")
    con = spark.createDataFrame([("a.b", 1, "h", "x y", 3, 2, 1), ("a.b", 3, None, "x", 1, 1, 1), ("zz", 1, None, " ", -1, 0, None)], "collection_path string, sort_order int, heading_text string, content_text string, word_count int, page_start int, page_end int")
    got = {(r["check"], r.key) for r in v.loaded_documents(doc, con, spark.createDataFrame([("a.x",)], "collection_path string")).collect()}
    assert got == {
        ("missing", "a.x"), ("title_blank", "a.c"), ("hash_missing", "a.c"), ("repeated", "a.d"), ("count", "a.c"), ("count", "a.d"), ("no_sections", "a.c"), ("no_sections", "a.d"), ("orphan", "zz/1"),
        ("order", "a.b"), ("word_count", "zz/1"), ("words_below_zero", "zz/1"), ("page_below_one", "zz/1"), ("nothing_in_it", "zz/1"), ("page_order", "a.b/1"),
    }
    assert [r["check"] for r in v.loaded_documents(doc.where("false"), con).collect()] == ["empty"]
    emb = spark.createDataFrame([("a.b", 1, 1, "x " * 20, 20, [1.0, 2.0]), ("a.b", 1, 2, "y", 1, None), ("q", 1, 1, "y", 1, [1.0])], "fname string, so int, chunk_number int, chunk_text string, word_count int, embedding array<float>")
    got = {(r["check"], r.key) for r in v.embeddings(con, emb, {"collection_path": "fname", "sort_order": "so"}, 2, 21, 10).collect()}
    assert got == {("unembedded", "a.b/3"), ("unembedded", "zz/1"), ("vector_missing", "a.b/1/2"), ("vector_size", "q/1/1"), ("orphan", "q/1/1"), ("over_model", "a.b/1/1"), ("over_budget", "a.b/1/1")}
    told = emb.where("fname = 'a.b' and chunk_number = 2").withColumn("chunk_terms", F.array(F.lit("y"), F.lit("z")))
    assert ("terms", "a.b/1/2") in {(r["check"], r.key) for r in v.embeddings(con, told, {"collection_path": "fname", "sort_order": "so"}, 2, 21, 10).collect()}
    assert [r["check"] for r in v.structured(con.where("false"), doc).collect()] == ["empty"]


def test_incremental_runs_add_only_what_is_new(spark, tmp_path):
    src, out, ck = (str(tmp_path / x) for x in ("src", "out", "ck"))
    schema = "k string, text string"

    def run():
        ingest(spark, src, schema, out, ck, {"k": "k"}, lambda d: d.withColumn("n", F.length("text"))).awaitTermination()
        return sorted(r.k for r in spark.read.parquet(out).collect())

    spark.createDataFrame([("a", "x"), ("b", "y"), ("a", "x")], schema).coalesce(1).write.parquet(src)
    assert run() == ["a", "b"] and run() == ["a", "b"]
    spark.createDataFrame([("b", "y"), ("c", "z")], schema).coalesce(1).write.mode("append").parquet(src)
    assert run() == ["a", "b", "c"]
