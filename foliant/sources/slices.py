"""Page ranges of long files, parsed one by one and put together again."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def page_slices(files: DataFrame, key: str, pages: str, size: int = 25) -> DataFrame:
    """``key, slice_no, first_page, last_page``: one slice where the number of pages is unknown, within the size, or the size isn't positive."""
    n = F.col(pages)
    cut = F.when((F.lit(size) > 0) & (n > size), F.transform(F.sequence(F.lit(1), n, F.lit(max(size, 1))), lambda s: F.struct(s.alias("a"), F.least(s + F.lit(size - 1), n).alias("b")))).otherwise(F.array(F.struct(F.lit(1).alias("a"), n.alias("b"))))
    return files.select(key, F.posexplode(cut).alias("pos", "s")).select(key, (F.col("pos") + 1).alias("slice_no"), F.col("s.a").alias("first_page"), F.col("s.b").alias("last_page"))


def stitch(elements: DataFrame, key: str) -> DataFrame:
    """Elements of slices in one order: ``seq`` counts over slice and place in it; page numbers go on from the slice's first page."""
    from pyspark.sql import Window

    order = F.row_number().over(Window.partitionBy(key).orderBy("slice_no", "seq"))
    shifted = F.transform("pages", lambda p: p + F.col("first_page") - 1)
    return elements.withColumn("pages", shifted).withColumn("seq", order).drop("slice_no", "first_page", "last_page")


def settings_groups(files: DataFrame, settings: list[str], key: str) -> DataFrame:
    """Files by their parse settings, groups and files in the order given (``pos``)."""
    return files.groupBy(*settings).agg(F.min("pos").alias("first_pos"), F.array_sort(F.collect_list(F.struct("pos", key))).alias("f")).select(*settings, "first_pos", F.transform("f", lambda x: x[key]).alias("files"))
