"""Incremental ingestion: whatever is new in a folder goes through a plan once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from foliant.operators.embed import resume
from foliant.operators.store import read


def ingest(spark: SparkSession, source: str, schema, target: str, checkpoint: str, keys: dict[str, str], transform: Callable[[DataFrame], DataFrame], files_per_trigger: int = 100) -> StreamingQuery:
    """Start a run over the files that came since the last one (``availableNow``).

    Each micro-batch is anti-joined with the target by key before it is transformed and appended, so that a repeated file or a
    repeated batch adds nothing. The checkpoint belongs in a folder that all executors share.
    """

    def batch(rows: DataFrame, _: int) -> None:
        own = rows.dropDuplicates(list(keys))
        stored = read(rows.sparkSession, target)
        fresh = own if stored is None else resume(own, stored, keys)
        transform(fresh).write.mode("append").parquet(target)

    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(source)
    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
