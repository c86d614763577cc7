"""Validation: every check is a query for the rows that break it, with the same columns.

``check, key, detail``: failures of several checks are one frame, and no rows mean that all hold.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliant.functions.text import word_count
from foliant.schemas import CHECKS, KEYS


def failures(df: DataFrame, check: str, key: list[str], detail: Column | None = None) -> DataFrame:
    return df.select(F.lit(check).alias("check"), F.concat_ws("/", *[F.col(k).cast("string") for k in key]).alias("key"), (detail if detail is not None else F.lit("")).cast("string").alias("detail"))


def both(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)


def constraint_failures(df: DataFrame, table: str) -> DataFrame:
    """Rows that break a constraint of their table, one row a check; all checks in a single pass."""
    broken = F.array_compact(F.array(*[F.when(F.expr(cond), F.lit(name)) for name, cond in CHECKS[table].items()]))
    return df.withColumn("_check", F.explode(broken)).select(
        F.col("_check").alias("check"), F.concat_ws("/", *[F.col(k).cast("string") for k in KEYS[table]]).alias("key"), F.lit(table).alias("detail")
    )


def constraint_counts(df: DataFrame, table: str) -> DataFrame:
    """``check, n`` of every check of a table, from one aggregate."""
    row = df.agg(*[F.count_if(F.expr(cond)).alias(name) for name, cond in CHECKS[table].items()])
    return row.select(F.explode(F.map_from_arrays(F.array(*[F.lit(n) for n in CHECKS[table]]), F.array(*[F.col(n) for n in CHECKS[table]]))).alias("check", "n"))


def repeated_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys of more than one row, with their number."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def orphans(children: DataFrame, parents: DataFrame, keys: dict[str, str]) -> DataFrame:
    """Children without a parent; keys map child columns to parent columns."""
    return children.join(parents.select(*[F.col(b).alias(a) for a, b in keys.items()]).distinct(), list(keys), "left_anti")


def childless(parents: DataFrame, children: DataFrame, keys: dict[str, str]) -> DataFrame:
    """Parents without a child; keys map parent columns to child columns."""
    return orphans(parents, children, keys)


def counts_differ(parents: DataFrame, children: DataFrame, key: str, stated: str) -> DataFrame:
    """Parents whose stated number of children isn't the real one: ``key, stated, found``."""
    n = children.groupBy(key).agg(F.count("*").alias("found"))
    return parents.select(key, F.col(stated).alias("stated")).join(n, key, "left").withColumn("found", F.coalesce("found", F.lit(0))).where("stated <> found")


def gaps(df: DataFrame, key: str, order: str) -> DataFrame:
    """Keys whose order numbers aren't exactly 1 to n: ``key, n, lowest, highest, distinct``."""
    return (
        df.groupBy(key)
        .agg(F.count("*").alias("n"), F.min(order).alias("lowest"), F.max(order).alias("highest"), F.count_distinct(order).alias("n_distinct"))
        .where("lowest <> 1 or highest <> n or n_distinct <> n")
    )


def missing(expected: DataFrame, loaded: DataFrame, key: str) -> DataFrame:
    """Expected keys that aren't loaded."""
    return expected.select(key).distinct().join(loaded.select(key).distinct(), key, "left_anti")


def wrong_words(df: DataFrame, columns: list[str], stored: str = "word_count") -> DataFrame:
    """Rows whose stored number of words isn't that of the columns together."""
    real = reduce(lambda a, b: a + b, [word_count(c) for c in columns])
    return df.withColumn("real_words", real).where(F.col(stored).isNotNull() & (F.col(stored) != F.col("real_words")))


def _rows_checked(df: DataFrame, table: str, columns: list[str], hash_column: str | None = None) -> DataFrame:
    """Everything that a row can break by itself, in one pass: constraints, a missing hash, a wrong number of words."""
    tests = [F.when(F.expr(cond), F.struct(F.lit(name).alias("check"), F.lit(table).alias("detail"))) for name, cond in CHECKS[table].items()]
    if hash_column:
        tests.append(F.when(F.col(hash_column).isNull(), F.struct(F.lit("hash_missing").alias("check"), F.lit("").alias("detail"))))
    if columns:
        df = df.withColumn("_real", reduce(lambda a, b: a + b, [word_count(c) for c in columns]))
        tests.append(F.when(F.col("word_count") != F.col("_real"), F.struct(F.lit("word_count").alias("check"), F.concat_ws(" / ", "word_count", "_real").alias("detail"))))
    return df.select(F.concat_ws("/", *[F.col(k).cast("string") for k in KEYS[table]]).alias("key"), F.explode(F.array_compact(F.array(*tests))).alias("f")).select("f.check", "key", "f.detail")


def _family(parents: DataFrame, children: DataFrame, stated: str, none: str, expected: DataFrame | None, repeated: bool) -> DataFrame:
    """Everything that parents and children break together: one aggregate of each side by path, joined once.

    A parent's rows are as many failures as there are rows; an orphan is one for each of its rows.
    """
    k = "collection_path"
    own = parents.where(F.col(k).isNotNull()).groupBy(k, F.col(stated).alias("stated")).agg(F.count("*").alias("times")).groupBy(k).agg(F.collect_list(F.struct("stated", "times")).alias("versions"), F.sum("times").alias("n_parents"))
    order = children.groupBy(k).agg(F.count("*").alias("n"), F.min("sort_order").alias("lowest"), F.max("sort_order").alias("highest"), F.count_distinct("sort_order").alias("n_distinct"))
    if expected is not None:
        own = own.join(expected.select(k).distinct().withColumn("_wanted", F.lit(True)), k, "full")
    joined = own.join(order, k, "full")
    found = F.coalesce("n", F.lit(0))
    one = lambda cond, name, detail=F.lit(""): F.when(cond, F.array(F.struct(F.lit(name).alias("check"), detail.cast("string").alias("detail"), F.lit(1).cast("bigint").alias("times"))))
    differ = F.transform(F.filter(F.coalesce("versions", F.array()), lambda v: v["stated"] != found), lambda v: F.struct(F.lit("count").alias("check"), F.concat_ws(" / ", v["stated"].cast("string"), found.cast("string")).alias("detail"), v["times"].alias("times")))
    childless_ = F.when(F.col("n_parents").isNotNull() & F.col("n").isNull(), F.array(F.struct(F.lit(none).alias("check"), F.lit("").alias("detail"), F.col("n_parents").alias("times"))))
    parts = [
        differ,
        childless_,
        one(F.col("n").isNotNull() & ((F.col("lowest") != 1) | (F.col("highest") != F.col("n")) | (F.col("n_distinct") != F.col("n"))), "order", F.concat_ws(" / ", "lowest", "highest", "n", "n_distinct")),
    ]
    if repeated:
        parts.append(one(F.col("n_parents") > 1, "repeated", F.col("n_parents")))
    if expected is not None:
        parts.append(one(F.col("_wanted") & F.col("n_parents").isNull(), "missing"))
    none_ = F.expr("cast(array() as array<struct<check:string,detail:string,times:bigint>>)")
    flat = F.flatten(F.array(*[F.coalesce(p, none_) for p in parts]))
    shown = joined.select(F.coalesce(k, F.lit("")).alias("key"), F.explode(flat).alias("f"))
    return shown.select("f.check", "key", "f.detail", F.explode(F.sequence(F.lit(1), F.col("f.times"))).alias("_")).drop("_")


def _loaded(parents: DataFrame, children: DataFrame, parent: str, child: str, texts: list[str], stated: str, none: str, expected: DataFrame | None) -> DataFrame:
    if parents.isEmpty():
        return parents.sparkSession.createDataFrame([("empty", parent, "")], "check string, key string, detail string")
    orphan = failures(orphans(children, parents, {"collection_path": "collection_path"}), "orphan", KEYS[child])
    parts = [_rows_checked(parents, parent, [], "source_binary_hash"), _rows_checked(children, child, texts), _family(parents, children, stated, none, expected, parent == "document"), orphan]
    if parent != "document":
        parts.append(failures(repeated_keys(children, KEYS[child]), "repeated", KEYS[child], F.col("n")))
    return both(parts)


def loaded_documents(document: DataFrame, content: DataFrame, expected: DataFrame | None = None) -> DataFrame:
    """All checks of loaded documents; an empty table is the only failure then."""
    return _loaded(document, content, "document", "document_content", ["heading_text", "content_text"], "n_parsed_sections", "no_sections", expected)


def loaded_sheets(sheet: DataFrame, content: DataFrame, expected: DataFrame | None = None) -> DataFrame:
    """All checks of the text leg of workbooks."""
    return _loaded(sheet, content, "sheet", "sheet_content", ["row_text"], "n_rows", "no_rows", expected)


def structured(rows: DataFrame, sheet: DataFrame, expected: DataFrame | None = None) -> DataFrame:
    """Checks of a structured table: empty, keys missing, orphans, sources without rows."""
    keys = ["collection_path", "sort_order"]
    if rows.isEmpty():
        return rows.sparkSession.createDataFrame([("empty", "structured", "")], "check string, key string, detail string")
    parts = [failures(rows.where("collection_path is null or sort_order is null"), "key_missing", keys), failures(orphans(rows, sheet, {"collection_path": "collection_path"}), "orphan", keys)]
    if expected is not None:
        parts.append(failures(missing(expected, rows, "collection_path"), "missing", ["collection_path"]))
    return both(parts)


def embeddings(source: DataFrame, results: DataFrame, keys: dict[str, str], dim: int, longest: int, budget: int, special: int = 2, keys_of: list[str] | None = None) -> DataFrame:
    """Checks of an embedding table: empty, sources without results, vectors, orphans and token gates (one word over the budget is only a warning)."""
    own = keys_of or KEYS["embedding_table"]
    if results.isEmpty():
        return results.sparkSession.createDataFrame([("empty", "embedding_table", "")], "check string, key string, detail string")
    tokens = word_count("chunk_text") + special
    back = {b: a for a, b in keys.items()}
    terms_differ = []
    if "chunk_terms" in results.columns:  # the search terms are those of the text
        from foliant.operators.embed import terms

        again = results.withColumn("_again", terms("chunk_text"))
        terms_differ = [failures(again.where(~F.coalesce(F.col("chunk_terms") == F.col("_again"), F.lit(False))), "terms", own)]
    return both(
        [
            *terms_differ,
            failures(childless(source, results, keys), "unembedded", list(keys)),
            failures(results.where(F.col("embedding").isNull()), "vector_missing", own),
            failures(results.where(F.size("embedding") != dim), "vector_size", own, F.size("embedding")),
            failures(orphans(results, source, back), "orphan", own),
            failures(results.where(tokens > longest), "over_model", own, tokens),
            failures(results.where((tokens > budget) & (F.col("word_count") > 1)), "over_budget", own, tokens),
            failures(results.where((tokens > budget) & (F.col("word_count") <= 1)), "warning_single_word", own, tokens),
        ]
    )
