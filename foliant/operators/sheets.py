"""Worksheet cells to rows, sheets and structured tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from foliant.functions.identity import LONGEST_NAME, column_name
from foliant.functions.text import low64_sha256, word_count

OVERLAP = 0.5


def fill_merged(cells: DataFrame, ranges: DataFrame) -> DataFrame:
    """Every cell of a merged range gets the value of its first cell; a range whose first cell is empty changes nothing.

    A range is taken apart into its cells, whose number the file bounds, and joined by equality.
    """
    keys = ["file", "sheet"]
    covered = ranges.withColumn("r", F.explode(F.sequence("min_row", "max_row"))).withColumn("c", F.explode(F.sequence("min_col", "max_col")))
    anchors = cells.select(*keys, F.col("r").alias("min_row"), F.col("c").alias("min_col"), F.col("value").alias("anchor")).where("anchor is not null")
    filled = covered.join(anchors, [*keys, "min_row", "min_col"]).select(*keys, "r", "c", "anchor").dropDuplicates([*keys, "r", "c"])
    return cells.join(filled, [*keys, "r", "c"], "full").select(*keys, "r", "c", F.coalesce("anchor", "value").alias("value"))


def bounds(cells: DataFrame, header_row: int = 1, start_col: int = 1, end_col: int | None = None, data_start: int | None = None, data_end: int | None = None) -> DataFrame:
    """``file, sheet, first_col, last_col, first_row, last_row``: up to the column before the first blank header, and the
    last row with content in that span."""
    keys, first = ["file", "sheet"], data_start or header_row + 1
    full = cells.where((F.col("c") >= start_col) & F.col("value").isNotNull())
    heads = full.where(F.col("r") == header_row).select(*keys, "c")
    run = heads.withColumn("gap", F.col("c") - F.row_number().over(Window.partitionBy(*keys).orderBy("c"))).where(F.col("gap") == start_col - 1)
    span = run.groupBy(*keys).agg((F.lit(end_col) if end_col else F.max("c")).alias("last_col"))
    last = full.join(span, keys).where((F.col("r") >= first) & (F.col("c") <= F.col("last_col"))).groupBy(*keys).agg(F.max("r").alias("found"))
    return span.join(last, keys, "left").select(*keys, F.lit(start_col).alias("first_col"), "last_col", F.lit(first).alias("first_row"), (F.lit(data_end) if data_end else F.col("found")).cast("int").alias("last_row"))


def headers(cells: DataFrame, span: DataFrame, header_row: int = 1) -> DataFrame:
    """``file, sheet, c, header, column``."""
    keys = ["file", "sheet"]
    rows = cells.where((F.col("r") == header_row)).join(span, keys).where("c between first_col and last_col")
    return rows.select(*keys, "c", F.col("value").alias("header"), column_name("value", F.col("c") - F.col("first_col")).alias("column"))


def header_problems(heads: DataFrame) -> DataFrame:
    """Blank headers, equal headers and headers equal as column names: ``file, sheet, problem, header``."""
    keys = ["file", "sheet"]
    blank = heads.where("coalesce(trim(header), '') = ''").select(*keys, F.lit("blank").alias("problem"), F.lit("").alias("header"))
    same = heads.groupBy(*keys, "header").count().where("count > 1 and trim(header) <> ''").select(*keys, F.lit("duplicate").alias("problem"), "header")
    alike = heads.groupBy(*keys, "column").agg(F.count_distinct("header").alias("n"), F.min("header").alias("header")).where("n > 1").select(*keys, F.lit("duplicate_name").alias("problem"), "header")
    return blank.unionByName(same).unionByName(alike)


def data_rows(cells: DataFrame, span: DataFrame, heads: DataFrame) -> DataFrame:
    """Rows with content, numbered from 1: ``file, sheet, row_number, cells`` (header, column, value, in column order)."""
    keys = ["file", "sheet"]
    inside = cells.join(span, keys).where("r between first_row and last_row and c between first_col and last_col and value is not null").select(*keys, "r", "c", "value")
    order = F.row_number().over(Window.partitionBy(*keys).orderBy("r"))
    kept = inside.select(*keys, "r").distinct().withColumn("row_number", order)
    full = kept.join(heads, keys).join(inside, [*keys, "r", "c"], "left")
    return full.groupBy(*keys, "row_number").agg(F.array_sort(F.collect_list(F.struct("c", "header", "column", "value"))).alias("cells"))


def text_rows(rows: DataFrame, path: str = "collection_path") -> DataFrame:
    """``collection_path, sort_order, row_text, word_count`` of :func:`data_rows` with a path column."""
    text = F.array_join(F.transform("cells", lambda x: F.concat(x["header"], F.lit(": "), F.coalesce(x["value"], F.lit("")))), "\n")
    return rows.select(F.col(path).alias("collection_path"), F.col("row_number").alias("sort_order"), text.alias("row_text")).withColumn("word_count", word_count("row_text"))


def catalog(content: DataFrame) -> DataFrame:
    """One row per sheet: ``collection_path, n_rows, words, source_binary_hash`` (of the row texts in order).

    The hash reads a sheet's rows in order, so one task holds a sheet; the file format bounds it at 1,048,576 rows.
    """
    texts = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("sort_order", "row_text"))), lambda x: F.coalesce(x["row_text"], F.lit(""))), "\n")
    return content.groupBy("collection_path").agg(F.count("*").cast("int").alias("n_rows"), F.sum("word_count").alias("words"), low64_sha256(texts).alias("source_binary_hash"))


def long_form(content: DataFrame, sheets: DataFrame) -> DataFrame:
    """Rows of sheets with a structured target as ``structured_table, collection_path, sort_order, column, value``; blank values are null.

    Headers that give one column name keep apart: later ones get ``_2``, ``_3`` and so on.
    """
    target = sheets.where("structured_table is not null").select("collection_path", "structured_table").distinct()
    value = lambda x: F.trim(F.regexp_replace(x, r"^[^:]*:", ""))
    pairs = F.transform(F.split("row_text", "\n"), lambda x, i: F.when(F.contains(x, F.lit(":")), F.struct(column_name(F.regexp_extract(x, "^([^:]*):", 1), i).alias("name"), F.when(value(x) != "", value(x)).alias("value"))))
    nth = lambda p, i: F.size(F.filter(F.slice(F.col("_p"), 1, i), lambda q: q["name"] == p["name"]))
    tail = lambda n: F.concat(F.lit("_"), (n + 1).cast("string"))
    apart = F.transform("_p", lambda p, i: F.struct(F.when(nth(p, i) == 0, p["name"]).otherwise(F.concat(F.regexp_replace(F.substring(p["name"], F.lit(1), F.lit(LONGEST_NAME) - F.length(tail(nth(p, i)))), "_+$", ""), tail(nth(p, i)))).alias("column"), p["value"].alias("value")))
    rows = content.join(target, "collection_path").withColumn("_p", F.filter(pairs, lambda x: x.isNotNull()))
    return rows.select("structured_table", "collection_path", "sort_order", F.explode(apart).alias("x")).select("structured_table", "collection_path", "sort_order", "x.column", "x.value")


def wide(long: DataFrame, columns: list[str], keys: list[str] = ["collection_path", "sort_order"]) -> DataFrame:  # noqa: B006
    """A structured table with the given columns; a column that a sheet lacks is null."""
    return long.groupBy(*keys).agg(*[F.max(F.when(F.col("column") == c, F.col("value"))).alias(c) for c in columns])


def wide_all(long: DataFrame) -> DataFrame:
    """All structured tables under one another with the union of their columns; a column that a sheet lacks is null.

    The distinct column names, a list that the sheets' headers bound, are collected to name the columns.
    """
    columns = sorted(r[0] for r in long.select("column").distinct().collect())
    values = [F.max(F.when(F.col("column") == c, F.col("value"))).alias(c) for c in columns]
    keys = ["structured_table", "collection_path", "sort_order"]
    return long.groupBy(*keys).agg(*values) if values else long.select(*keys).distinct()


def overlap(incoming: list[str], existing: list[str], threshold: float = OVERLAP) -> tuple[float, float, bool]:
    """Shares of the common columns in either list, and whether to accept: not if both are below the threshold."""
    both = len(set(incoming) & set(existing))
    r_in, r_ex = both / len(set(incoming)) if incoming else 0.0, both / len(set(existing)) if existing else 0.0
    return r_in, r_ex, not (r_in < threshold and r_ex < threshold)


def drift(long: DataFrame) -> DataFrame:
    """For each sheet of a structured table, against the columns of the sheets before it in path order:
    ``n_incoming, n_existing, n_common, r_in, r_ex, accepted``; the first sheet of a table is always accepted.

    Works on the distinct columns of sheets: one row for each, however long the sheets are.
    """
    own = long.select("structured_table", "collection_path", "column").distinct()
    first = own.groupBy("structured_table", "column").agg(F.min("collection_path").alias("first_path"))
    common = own.join(first, ["structured_table", "column"]).groupBy("structured_table", "collection_path").agg(F.count("*").alias("n_incoming"), F.count_if(F.col("first_path") < F.col("collection_path")).alias("n_common"), F.count_if(F.col("first_path") == F.col("collection_path")).alias("n_new"))
    before = F.coalesce(F.sum("n_new").over(Window.partitionBy("structured_table").orderBy("collection_path").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    shown = common.withColumn("n_existing", before)
    r_in, r_ex = F.col("n_common") / F.col("n_incoming"), F.when(F.col("n_existing") > 0, F.col("n_common") / F.col("n_existing")).otherwise(0.0)
    return shown.select("structured_table", "collection_path", "n_incoming", "n_existing", "n_common", r_in.alias("r_in"), r_ex.alias("r_ex"), ((F.col("n_existing") == 0) | ~((r_in < OVERLAP) & (r_ex < OVERLAP))).alias("accepted"))


def append(parts: list[DataFrame]) -> DataFrame:
    """Frames under one another with the union of their columns."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
