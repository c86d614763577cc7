"""Idempotent writes of tables kept as Parquet.

New identities are appended, whatever the size of the table. Replacing stored ones rewrites a table as a whole, or, if it was written with
``buckets``, only the buckets of the replaced identities: such a table is partitioned by a hash of its keys in a column that :func:`read` leaves out.
"""

from __future__ import annotations

import json
import os
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foliant.operators.sheets import overlap


#: Partition column of tables in buckets.
BUCKET = "_bucket"


class StoreError(OSError):
    """A folder could not be moved; what was stored is still there."""


def _fs(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def _raw(spark: SparkSession, path: str) -> DataFrame | None:
    fs, at = _fs(spark, path)
    if not fs.exists(at):
        # a swap that was cut short leaves the old table beside its place
        left = sorted((s.getModificationTime(), s.getPath().toString()) for s in fs.globStatus(at.suffix(".old-*")) or [])
        if not left:
            return None
        _move(fs, _fs(spark, left[-1][1])[1], at)
    return spark.read.option("mergeSchema", True).parquet(path)


def read(spark: SparkSession, path: str, like: DataFrame | None = None) -> DataFrame | None:
    """The table at a path, or None where there is none yet."""
    df = _raw(spark, path)
    return df if df is None else df.drop(BUCKET)


def _move(fs, a, b) -> None:
    if not fs.rename(a, b):
        raise StoreError(f"{a} could not be moved to {b}")


def replace(df: DataFrame, path: str) -> None:
    """Write beside the table, then swap the folders. The old one goes last: if a move fails it is moved back and the new one removed.

    Between the two moves there is no table at the path for a moment; :func:`read` then finds the old one.
    """
    spark = df.sparkSession
    name = uuid.uuid4().hex
    _writer(df).parquet(f"{path}.new-{name}")
    fs, at = _fs(spark, path)
    new, old = (_fs(spark, f"{path}.{x}-{name}")[1] for x in ("new", "old"))
    there = fs.exists(at)
    try:
        if there:
            _move(fs, at, old)
        try:
            _move(fs, new, at)
        except Exception:
            if there:
                _move(fs, old, at)
            raise
    except Exception:
        fs.delete(new, True)
        raise
    if there:
        fs.delete(old, True)


def _bucketed(df: DataFrame, keys: list[str], buckets: int | None) -> DataFrame:
    return df.withColumn(BUCKET, F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")) if buckets else df


def _writer(df: DataFrame):
    """A bucket is written by one task, so that a load adds one file to it; a bucket that is too large for that has too few beside it."""
    return df.repartition(BUCKET).write.partitionBy(BUCKET) if BUCKET in df.columns else df.write


def _append(df: DataFrame, path: str) -> None:
    _writer(df).mode("append").parquet(path)


def _buckets_of(stored: DataFrame, path: str) -> int | None:
    """How many buckets a stored table has; its folder says so."""
    if BUCKET not in stored.columns:
        return None
    fs, at = _fs(stored.sparkSession, f"{path}/_buckets-*")
    named = [x.getPath().getName() for x in fs.globStatus(at) or []]
    return int(named[0].split("-")[1])


def load(new: DataFrame, path: str, keys: list[str], overwrite: bool = False, buckets: int | None = None) -> int:
    """Append rows whose identity is not stored yet, or replace the stored rows of the same identities; returns rows written.

    ``keys`` name what is loaded as a whole (a document, a sheet). Skipping finds missing identities, never changed ones. ``buckets``
    counts when the table is made. Rows of the table are rewritten only where an identity is replaced.
    """
    spark = new.sparkSession
    stored = _raw(spark, path)
    if stored is None:
        _append(_bucketed(new, keys, buckets), path)
        if buckets:
            fs, at = _fs(spark, f"{path}/_buckets-{buckets}")
            fs.create(at).close()
        return spark.read.parquet(path).count()
    buckets = _buckets_of(stored, path)
    have = stored.select(*keys).distinct()
    if not overwrite:
        new = new.join(have, keys, "left_anti")
    new = _bucketed(new, keys, buckets)
    n = new.count()
    if not overwrite or new.join(have, keys, "left_semi").isEmpty():
        if n:
            _append(new, path)
        return n
    gone = new.select(*keys).distinct()
    if not buckets:
        replace(stored.join(gone, keys, "left_anti").unionByName(new, allowMissingColumns=True), path)
        return n
    touched = [r[0] for r in new.select(BUCKET).distinct().collect()]  # at most the number of buckets
    rest = stored.where(F.col(BUCKET).isin(touched)).join(gone, keys, "left_anti")
    _writer(rest.unionByName(new, allowMissingColumns=True)).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)
    return n


def load_family(parents: DataFrame, children: dict[str, DataFrame], folder: str, parent: str, key: str = "collection_path", overwrite: bool = False, buckets: int | None = None) -> dict[str, int]:
    """A parent table and its children: children are written first and the parent, which marks them as there, last.

    Children that an earlier, broken run left without their parent are replaced.
    """
    spark = parents.sparkSession
    stored = read(spark, f"{folder}/{parent}")
    fresh = parents if overwrite or stored is None else parents.join(stored.select(key), key, "left_anti")
    fresh = fresh.cache()
    out = {name: load(rows.join(fresh.select(key), key, "left_semi"), f"{folder}/{name}", [key], True, buckets) for name, rows in children.items()}
    out[parent] = load(fresh, f"{folder}/{parent}", [key], True, buckets)
    fresh.unpersist()
    return out


def delete(spark: SparkSession, path: str, gone: Column) -> int:
    """Rewrite a table without the rows of a condition; returns how many went."""
    stored = _raw(spark, path)
    if stored is None:
        return 0
    hit = F.coalesce(gone, F.lit(False))
    n = stored.where(hit).count()
    if n:
        buckets = _buckets_of(stored, path)
        replace(stored.where(~hit), path)
        if buckets:
            fs, at = _fs(spark, f"{path}/_buckets-{buckets}")
            fs.create(at).close()
    return n


def delete_family(spark: SparkSession, folder: str, parent: str, children: list[str], gone: Column, key: str = "collection_path") -> dict[str, int]:
    """Parents of a condition with their children: the parent goes first, so that what is there is whole, then children without a parent."""
    out = {parent: delete(spark, f"{folder}/{parent}", gone)}
    left = read(spark, f"{folder}/{parent}")
    for name in children:
        stored = _raw(spark, f"{folder}/{name}")
        if stored is None or left is None or not out[parent]:
            out[name] = 0
            continue
        before, buckets = stored.count(), _buckets_of(stored, f"{folder}/{name}")
        kept = cascade(stored, left, {key: key})
        out[name] = before - kept.count()
        if out[name]:
            replace(kept, f"{folder}/{name}")
            if buckets:
                fs, at = _fs(spark, f"{folder}/{name}/_buckets-{buckets}")
                fs.create(at).close()
    return out


def cascade(children: DataFrame, parents: DataFrame, keys: dict[str, str]) -> DataFrame:
    """Children whose parent is still there; keys map child columns to parent columns."""
    have = parents.select(*[F.col(b).alias(a) for a, b in keys.items()]).distinct()
    return children.join(have, list(keys), "left_semi")


def append_structured(new: DataFrame, path: str, threshold: float = 0.5, identity: tuple[str, ...] = ("collection_path", "sort_order"), overwrite: bool = False) -> int:
    """Append to a structured table whose columns only grow: new ones are added, missing ones null. Too little overlap is an error, as is a repeated key; no rows are 0."""
    spark = new.sparkSession
    stored = read(spark, path)
    if not new.groupBy(*identity).count().where("count > 1").isEmpty():
        raise ValueError("repeated keys")
    own = [c for c in new.columns if c not in identity]
    if stored is None:
        n = new.count()
        if n:
            new.write.parquet(path)
        return n
    before = [c for c in stored.columns if c not in identity]
    r_in, r_ex, ok = overlap(own, before, threshold)
    if not ok:
        raise ValueError(f"columns differ too much: {r_in:.2f} of the new and {r_ex:.2f} of the stored are common")
    have = stored.select("collection_path").distinct()
    if not overwrite:
        new = new.join(have, "collection_path", "left_anti")
    n = new.count()
    columns = [*identity, *before, *(c for c in own if c not in before)]
    if overwrite and n and not new.join(have, "collection_path", "left_semi").isEmpty():
        rest = stored.join(new.select("collection_path").distinct(), "collection_path", "left_anti")
        replace(rest.unionByName(new, allowMissingColumns=True).select(*columns), path)
    elif n and set(own) <= set(before):
        # no new column: files are added, and what they lack reads as null
        new.select(*identity, *(c for c in before if c in own), *(F.lit(None).cast(stored.schema[c].dataType).alias(c) for c in before if c not in own)).select(*identity, *before).write.mode("append").parquet(path)
    elif n:
        # a reader that doesn't merge schemas must see a new column too
        replace(stored.unionByName(new, allowMissingColumns=True).select(*columns), path)
    return n


def comment(spark: SparkSession, schema: str, schema_comment: str | None, tables: dict[str, str | None]) -> list[str]:
    """Statements that set comments, the schema's first; None leaves what is there."""
    quote = lambda s: "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"
    out = [f"COMMENT ON NAMESPACE {schema} IS {quote(schema_comment)}"] if schema_comment is not None else []
    return out + [f"COMMENT ON TABLE {schema}.{t} IS {quote(c)}" for t, c in tables.items() if c is not None]


def apply_comments(spark: SparkSession, schema: str, schema_comment: str | None, tables: dict[str, str | None]) -> int:
    """Run the statements of :func:`comment`; returns their number."""
    statements = comment(spark, schema, schema_comment, tables)
    for s in statements:
        spark.sql(s)
    return len(statements)


def write_text(path: str | Path, text: str) -> None:
    """Write a small driver-side file atomically: a temporary one beside it, then a rename."""
    path = Path(path)
    path.parent.mkdir(parents=True, exist_ok=True)
    fd, tmp = tempfile.mkstemp(dir=path.parent, prefix=path.name, suffix=".tmp")
    try:
        with os.fdopen(fd, "w", encoding="utf-8") as f:
            f.write(text)
        os.replace(tmp, path)
    except BaseException:
        Path(tmp).unlink(missing_ok=True)
        raise


def write_json(path: str | Path, value: object) -> None:
    write_text(path, json.dumps(value, indent=2, ensure_ascii=False, default=str))
