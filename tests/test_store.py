import json

import pytest
from pyspark.sql import functions as F

from foliant.operators import store


def test_load_is_idempotent(spark, tmp_path, rows):
    p = str(tmp_path / "t")
    a = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1)], "k string, v int")
    assert store.load(a, p, ["k"]) == 3 and store.load(a, p, ["k"]) == 0
    more = spark.createDataFrame([("a", 9), ("c", 1)], "k string, v int")
    assert store.load(more, p, ["k"]) == 1
    assert store.load(more, p, ["k"], overwrite=True) == 2
    assert rows(spark.read.parquet(p)) == [("a", 9), ("b", 1), ("c", 1)]
    assert store.delete(spark, p, F.col("k") == "a") == 1 and store.delete(spark, p, F.col("k") == "zz") == 0
    assert rows(spark.read.parquet(p)) == [("b", 1), ("c", 1)]


def test_buckets_rewrite_only_what_is_replaced(spark, tmp_path, rows):
    p = str(tmp_path / "t")
    a = spark.createDataFrame([(f"k{i}", i) for i in range(40)], "k string, v int")
    assert store.load(a, p, ["k"], buckets=8) == 40 and store.load(a, p, ["k"]) == 0
    files = lambda: {f.relative_to(p): f.stat().st_mtime_ns for f in (tmp_path / "t").rglob("*.parquet")}
    before = files()
    assert store.load(spark.createDataFrame([("new", 1)], "k string, v int"), p, ["k"], overwrite=True) == 1
    assert before.items() < files().items()  # nothing is rewritten for a new identity
    before = files()
    assert store.load(spark.createDataFrame([("k3", 99), ("k3", 98)], "k string, v int"), p, ["k"], overwrite=True) == 2
    kept = {f for f, at in before.items() if files().get(f) == at}
    assert 0 < len({f.parts[0] for f in kept}) == len({f.parts[0] for f in before}) - 1
    want = sorted([(f"k{i}", i) for i in range(40) if i != 3] + [("k3", 98), ("k3", 99), ("new", 1)])
    assert rows(store.read(spark, p)) == want
    assert store.delete(spark, p, F.col("k") == "k3") == 2 and rows(store.read(spark, p)) == [r for r in want if r[0] != "k3"]
    assert store.load(spark.createDataFrame([("k3", 1)], "k string, v int"), p, ["k"]) == 1


def test_a_failing_move_loses_nothing(spark, tmp_path, rows, monkeypatch):
    p = str(tmp_path / "t")
    store.load(spark.createDataFrame([("a", 1)], "k string, v int"), p, ["k"])
    move, asked = store._move, []

    def second_fails(fs, a, b):
        asked.append(a)
        if len(asked) == 2:
            raise store.StoreError("no")
        move(fs, a, b)

    monkeypatch.setattr(store, "_move", second_fails)
    with pytest.raises(store.StoreError):
        store.load(spark.createDataFrame([("a", 2)], "k string, v int"), p, ["k"], overwrite=True)
    assert rows(spark.read.parquet(p)) == [("a", 1)] and [x.name for x in tmp_path.iterdir()] == ["t"]
    monkeypatch.setattr(store, "_move", move)
    (tmp_path / "t").rename(tmp_path / "t.old-1")  # a swap cut short between its two moves
    assert rows(store.read(spark, p)) == [("a", 1)] and store.read(spark, str(tmp_path / "none")) is None


def test_families_are_loaded_twice_and_deleted(spark, tmp_path, rows):
    parents = spark.createDataFrame([("a", "A"), ("b", "B")], "collection_path string, title string")
    children = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1)], "collection_path string, sort_order int")
    f = str(tmp_path)
    assert store.load_family(parents, {"child": children}, f, "parent", buckets=4) == {"child": 3, "parent": 2}
    assert store.load_family(parents, {"child": children}, f, "parent") == {"child": 0, "parent": 0}
    assert store.load_family(parents.where("title = 'A'"), {"child": children.where("sort_order = 1")}, f, "parent", overwrite=True) == {"child": 1, "parent": 1}
    assert rows(store.read(spark, f + "/child")) == [("a", 1), ("b", 1)]
    assert store.delete_family(spark, f, "parent", ["child"], F.col("title") == "B") == {"parent": 1, "child": 1}
    assert rows(store.read(spark, f + "/child")) == [("a", 1)] and rows(store.read(spark, f + "/parent")) == [("a", "A")]


def test_cascade(spark, rows):
    child, parent = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "f string, v int"), spark.createDataFrame([("a",)], "k string")
    assert rows(store.cascade(child, parent, {"f": "k"})) == [("a", 1)]


def test_structured_append(spark, tmp_path):
    p = str(tmp_path / "s")
    f = lambda cols, path, n=2: spark.createDataFrame([(path, i, *(["v"] * len(cols))) for i in range(1, n + 1)], ["collection_path", "sort_order", *cols])
    assert store.append_structured(f(["a", "b"], "x"), p) == 2
    assert store.append_structured(f(["a", "b", "c"], "y"), p) == 2 and spark.read.parquet(p).columns[2:] == ["a", "b", "c"]
    assert store.append_structured(f(["a"], "z"), p) == 2 and store.append_structured(f(["a"], "z"), p) == 0
    with pytest.raises(ValueError, match="differ"):
        store.append_structured(f(["q"], "w"), p)
    with pytest.raises(ValueError, match="repeated"):
        store.append_structured(f(["a"], "v").unionByName(f(["a"], "v")), p)
    assert store.append_structured(f(["a", "b", "c", "d", "e", "f"], "u", 1), p) == 1  # exactly at the threshold
    assert store.append_structured(f(["a"], "z", 3), p, overwrite=True) == 3
    got = spark.read.parquet(p)
    assert got.where("collection_path = 'z'").count() == 3 and got.count() == 8
    assert store.append_structured(f(["a"], "t").where("false"), p) == 0


def test_files_and_comments(tmp_path):
    store.write_json(tmp_path / "d/x.json", {"a": "é"})
    assert json.loads((tmp_path / "d/x.json").read_text("utf-8")) == {"a": "é"} and [p.name for p in (tmp_path / "d").iterdir()] == ["x.json"]
    assert store.comment(None, "s", "it's", {"t": "x", "u": None}) == ["COMMENT ON NAMESPACE s IS 'it\\'s'", "COMMENT ON TABLE s.t IS 'x'"]
