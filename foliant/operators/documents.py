"""Which authored documents are taken, and documents in the formats they are exported to."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliant.functions.identity import header_columns, stem, valid_path


class DocumentError(ValueError):
    """The authored documents can't be loaded as given."""


def judged(entries: DataFrame, file: str = "file", path: str = "collection_path") -> DataFrame:
    """Adds ``stem`` and ``problem``: repeated stems over all entries, then invalid paths, then paths repeated among the valid ones.

    Repetitions are counted by grouping and joined back: two narrow shuffles, whatever the number of entries.
    """
    own = entries.withColumn("stem", stem(file))
    stems = own.groupBy("stem").agg(F.count("*").alias("_n"))
    paths = own.where(valid_path(path)).groupBy(path).agg(F.count("*").alias("_m"))
    problem = F.when(F.col("_n") > 1, "repeated_stem").when(~valid_path(path), "invalid_path").when(F.col("_m") > 1, "repeated_path")
    return own.join(stems, "stem", "left").join(paths, path, "left").withColumn("problem", problem).drop("_n", "_m")


def kept(entries: DataFrame, file: str = "file", path: str = "collection_path") -> DataFrame:
    """Entries with a valid path; repeated stems and paths, and nothing left, are errors."""
    own = judged(entries, file, path)
    bad = own.where("problem like 'repeated%'").select("problem", file).limit(5).collect()
    if bad:
        raise DocumentError("; ".join(f"{r[0]}: {r[1]}" for r in bad))
    out = own.where("problem is null").drop("problem")
    if out.isEmpty():
        raise DocumentError("no document has a valid path")
    return out


def selected(keys: DataFrame, wanted: list[str], column: str = "key", alias: dict[str, str] | None = None) -> DataFrame:
    """Rows of the wanted keys, given by name or alias; an empty list takes all."""
    return keys.where(F.col(column).isin([(alias or {}).get(k, k) for k in wanted])) if wanted else keys


def exported(sections: DataFrame, form: str, key: str = "doc_id") -> DataFrame:
    """One text for each document: ``markdown``, ``text``, ``html``, ``json`` or ``yaml``. Sections in order; a document is one file and bounded by it."""
    h, c = F.col("heading_text"), F.col("content_text")
    escape = lambda x: F.replace(F.replace(F.replace(x, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    quote = lambda x: F.coalesce(F.get(F.regexp_extract_all(F.to_json(F.array(x)), F.lit(r"(?s)\A\[(.*)\]\z"), F.lit(1)), F.lit(0)), F.lit("null"))
    part = {
        "markdown": F.concat_ws("\n\n", F.concat(F.lit("## "), h), c),
        "text": F.concat_ws("\n\n", h, c),
        "html": F.concat_ws("\n", F.concat(F.lit("<h2>"), escape(h), F.lit("</h2>")), F.concat(F.lit("<p>"), F.replace(escape(c), F.lit("\n\n"), F.lit("</p>\n<p>")), F.lit("</p>"))),
        "json": F.to_json(F.struct("sort_order", "heading_text", "content_text"), {"ignoreNullFields": "false"}),
        "yaml": F.concat(F.lit("- heading: "), quote(h), F.lit("\n  content: "), quote(c)),
    }
    if form not in part:
        raise ValueError(f"unknown format {form!r}; there are {sorted(part)}")
    glue = {"json": ",", "yaml": "\n", "html": "\n"}.get(form, "\n\n")
    texts = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("sort_order", part[form].alias("t")))), lambda x: x["t"]), glue)
    whole = F.concat(F.lit("["), texts, F.lit("]")) if form == "json" else texts
    return sections.groupBy(key).agg(whole.alias("text"))


def missing_tables(spark: SparkSession, names: list[str]) -> list[str]:
    """Names that the catalog doesn't know."""
    return [n for n in names if not spark.catalog.tableExists(n)]


#: Table property that holds the keys.
KEYS = "foliant.keys"


def columns_of(spark: SparkSession, name: str) -> list[tuple[str, str]]:
    """Names and types of a table's columns, in order."""
    return [(c.name, c.dataType) for c in spark.catalog.listColumns(name)]


def keys_of(spark: SparkSession, name: str) -> list[str]:
    """The keys a table was created with; none if it has none."""
    rows = spark.sql(f"SHOW TBLPROPERTIES {name}").where(F.col("key") == KEYS).collect()
    return rows[0]["value"].split(",") if rows else []


def create_structured(spark: SparkSession, name: str, headers: list[str]) -> list[str]:
    """Create a structured table for a list of headers, a text column each; returns the columns. An existing one is never changed."""
    names = header_columns(headers)
    create(spark, name, ", ".join(["collection_path string", "sort_order int", *(f"`{n}` string" for n in names)]), ["collection_path", "sort_order"])
    return names


def create(spark: SparkSession, name: str, schema: str, keys: list[str] | None = None) -> None:
    """Create a table unless it is there; an existing one is never changed. Keys are kept as a table property."""
    props = f" TBLPROPERTIES ('{KEYS}' = '{','.join(keys)}')" if keys else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({schema}) USING parquet{props}")


def titled(parsed: DataFrame, entries: DataFrame, key: str = "doc_id") -> DataFrame:
    """Parsed documents with the title and path authored for their stem; a document that isn't authored is left out."""
    own = entries.select(F.col("stem").alias(key), "collection_path", "title").dropDuplicates([key])
    return parsed.join(own, key)


def default_title(file: str = "file", sheet: str = "sheet", title: str = "title"):
    """The authored title, or the file's stem and the sheet."""
    return F.coalesce(F.col(title), F.concat(stem(file), F.lit(" — "), F.col(sheet)))
