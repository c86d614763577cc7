"""Session, table access and lineage cuts shared by all operators."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def session(cores: str | int = "*", partitions: int | None = None) -> SparkSession:
    """A local session with the settings the plans are written for."""
    b = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("foliant")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("FOLIANT_DRIVER_MEMORY", "12g"))
    )
    if partitions:
        b = b.config("spark.sql.shuffle.partitions", str(partitions))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


#: Bytes of a file that make a task worth while.
TASK_BYTES = 256 * 1024
#: Session setting: into how many partitions tables that one task would read are spread (a single row group can't be split); unset, none are.
SPREAD = "spark.foliant.spread"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of a folder, ``<name>.parquet`` or ``<name>``; without buckets' own column."""
    path = f"{sf_dir}/{name}.parquet"
    fs, at = file_system(spark, path)
    if not fs.exists(at):
        path = f"{sf_dir}/{name}"
    df = spark.read.parquet(path).drop("_bucket")
    tasks = int(spark.conf.get(SPREAD, "0"))
    return spread(df, path, tasks) if tasks > 1 else df


def file_system(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def spread(df: DataFrame, path: str, tasks: int) -> DataFrame:
    """A table of a single file, spread over so many tasks; one too small to matter, or of several files, stays as it is."""
    fs, at = file_system(df.sparkSession, path)
    want = min(tasks, fs.getContentSummary(at).getLength() // TASK_BYTES)
    return df.repartition(int(want)) if want > 1 and fs.getFileStatus(at).isFile() else df


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: the cluster's ``spark.checkpoint.dir``.

    Only in a local session without that setting (tests) a temporary folder is made and set; on a cluster its absence is an error.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    if not sc.getCheckpointDir():
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        sc.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="foliant-"))
    return sc.getCheckpointDir().rstrip("/")


_written: list[str] = []


def cleanup(spark: SparkSession) -> None:
    """Remove the intermediate tables that this process has written, once their results are no longer needed."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    while _written:
        at = path(_written.pop())
        at.getFileSystem(conf).delete(at, True)


#: Bytes of a row group of intermediate tables.
ROW_GROUP = 32 * 1024 * 1024


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder in the shared one, removed by :func:`cleanup`."""
    path = f"{shared_dir(spark)}/foliant-{name}-{uuid.uuid4().hex}"
    _written.append(path)
    return path


def materialize(df: DataFrame, name: str = "part", partitions: int | None = None) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it again.

    It cuts the lineage so that a lost executor costs only the tasks after it, and gives Catalyst the
    real size of an intermediate result: a join with it is broadcast only below the session's own
    threshold and is a sort-merge join beyond it.
    """
    spark = df.sparkSession
    path = scratch(spark, name)
    # small row groups: a task that writes holds one of them
    (df.coalesce(partitions) if partitions else df).write.option("compression", "zstd").option("parquet.block.size", ROW_GROUP).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
