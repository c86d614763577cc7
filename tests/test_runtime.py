import os

from foliant import runtime


def test_materialize_and_cleanup(spark, rows):
    df = runtime.materialize(spark.range(5).toDF("x"), "t")
    assert rows(df) == [(i,) for i in range(5)]
    folder = runtime._written[-1].removeprefix("file:").replace("///", "/").replace("//", "/")
    assert os.path.isdir(folder)
    runtime.cleanup(spark)
    assert not os.path.isdir(folder) and runtime._written == []


def test_tables_stay_as_they_are_unless_spread(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(runtime, "TASK_BYTES", 64)
    spark.range(1000).coalesce(1).write.parquet(str(tmp_path / "a.parquet"))
    part = next((tmp_path / "a.parquet").glob("part-*"))
    part.rename(tmp_path / "t.parquet")
    assert runtime.table(spark, str(tmp_path), "t").rdd.getNumPartitions() == 1
    spark.conf.set(runtime.SPREAD, "4")
    try:
        df = runtime.table(spark, str(tmp_path), "t")
        assert df.rdd.getNumPartitions() == 4 and df.count() == 1000
        monkeypatch.setattr(runtime, "TASK_BYTES", 1 << 20)
        assert runtime.table(spark, str(tmp_path), "t").rdd.getNumPartitions() == 1
    finally:
        spark.conf.unset(runtime.SPREAD)


def test_a_cluster_needs_a_shared_folder():
    import pytest

    class Conf:
        get = staticmethod(lambda *_: None)

    class Context:
        master = "spark://host:7077"
        getConf = staticmethod(Conf)
        getCheckpointDir = staticmethod(lambda: None)

    class Session:
        sparkContext, conf = Context, Conf

    with pytest.raises(RuntimeError, match="checkpoint"):
        runtime.shared_dir(Session)


def test_table_reads_what_the_store_writes(spark, tmp_path, rows):
    from foliant.operators import store

    store.load(spark.createDataFrame([("a", 1)], "k string, v int"), str(tmp_path / "t"), ["k"], buckets=4)
    assert rows(runtime.table(spark, str(tmp_path), "t")) == [("a", 1)]
