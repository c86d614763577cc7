"""Links and titles from HTML pages, by built-in expressions over whole pages."""

from __future__ import annotations

from urllib.parse import urljoin

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliant.functions.identity import folder_name


def scope(html: str | Column, tag: str = "article") -> Column:
    """What is inside the first element of a name, or the whole page without one."""
    h = F.col(html) if isinstance(html, str) else html
    inner = F.regexp_extract(h, rf"(?is)<{tag}\b[^>]*>(.*?)</{tag}\s*>", 1)
    return F.when(h.rlike(rf"(?is)<{tag}\b[^>]*>.*?</{tag}\s*>"), inner).otherwise(h)


def links(pages: DataFrame, suffix: str = ".pdf", exclude: tuple[str, ...] = (), tag: str = "article") -> DataFrame:
    """``url, link``: absolute addresses in the scope that end in the suffix, whatever the case, and hold no excluded part; sorted, each once."""
    hrefs = F.regexp_extract_all(scope("html", tag), F.lit(r"(?is)<a\b[^>]*?\bhref\s*=\s*[\"']([^\"']+)[\"']"), F.lit(1))
    keep = lambda x: F.lower(x).endswith(suffix.lower()) & ~_any(x, exclude)

    @F.pandas_udf("array<string>")
    def absolute(base, found):
        return found.combine(base, lambda ls, b: sorted({urljoin(b or "", x) for x in ls}) if ls is not None else [])

    return pages.select("url", absolute(F.col("url"), F.filter(hrefs, keep)).alias("links")).select("url", F.explode("links").alias("link"))


def _any(x: Column, parts: tuple[str, ...]) -> Column:
    out = F.lit(False)
    for p in parts:
        out = out | F.contains(F.lower(x), F.lit(p.lower()))
    return out


def index_rows(pages: DataFrame, key: str = r"\A100(-\d{2})?\z") -> DataFrame:
    """Keys and titles of the first table of an index page: ``url, key, title, href, folder``; the first row of a key wins.

    The key is a link text that matches; the title is the text of the row's last cell. Keys without a title are in :func:`untitled`.
    """
    table = F.regexp_extract("html", r"(?is)<table\b[^>]*>(.*?)</table\s*>", 1)
    rows = pages.select("url", F.posexplode(F.regexp_extract_all(table, F.lit(r"(?is)<tr\b[^>]*>(.*?)</tr\s*>"), F.lit(1))).alias("pos", "row"))
    plain = lambda c: F.trim(F.regexp_replace(F.regexp_replace(c, r"(?s)<[^>]*>", " "), r"\s+", " "))
    found = rows.select(
        "url",
        "pos",
        plain(F.regexp_extract("row", r"(?is)<a\b[^>]*>(.*?)</a\s*>", 1)).alias("key"),
        F.regexp_extract("row", r"(?is)<a\b[^>]*?\bhref\s*=\s*[\"']([^\"']+)[\"']", 1).alias("href"),
        plain(F.element_at(F.regexp_extract_all("row", F.lit(r"(?is)<td\b[^>]*>(.*?)</td\s*>"), F.lit(1)), -1)).alias("title"),
    ).where(F.col("key").rlike(key))
    first = found.withColumn("n", F.row_number().over(Window.partitionBy("url", "key").orderBy("pos"))).where("n = 1").drop("n", "pos")
    return first.withColumn("folder", folder_name("title", "key"))


def untitled(rows: DataFrame) -> DataFrame:
    return rows.where("coalesce(title, '') = '' or title = key").select("url", "key")
