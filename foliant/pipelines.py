"""The pipelines from authored settings to stored tables: documents, workbooks, embeddings, downloads and their validation.

Each takes a checked config (see :mod:`foliant.sources.config`), works on whole sets of files with the operators of this package, and loads
idempotently. What fails is named and stops only itself.
"""

from __future__ import annotations

import importlib
import logging
import time
from collections import defaultdict
from collections.abc import Callable
from functools import reduce
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliant.functions.identity import column_index, distinct_names, sheet_path, stem
from foliant.functions.text import row_text
from foliant.operators import acquire, chunks, documents, embed, sections, sheets, store, validate
from foliant.runtime import table
from foliant.sources import archives, config, parsed, xlsx

log = logging.getLogger("foliant")
#: Buckets of the tables that a pipeline makes.
BUCKETS = 64


def hook(name: str) -> Callable:
    """A callable given as ``module:name``."""
    module, _, attribute = name.partition(":")
    try:
        return getattr(importlib.import_module(module), attribute)
    except (ImportError, AttributeError, ValueError) as e:
        raise config.ConfigError(f"no such hook {name!r}: {e}") from e


def _local(c: str) -> F.Column:
    """A file's path without its scheme, as settings have it."""
    return F.regexp_replace(c, r"^file:/+", "/")


def _binary(spark: SparkSession, paths: list[str]) -> DataFrame:
    return spark.read.format("binaryFile").load(paths).select(_local("path").alias("path"), "content")


def _there(spark: SparkSession, path: str) -> bool:
    fs, at = store._fs(spark, path)
    return fs.exists(at)


# documents


def ingest_files(spark: SparkSession, settings: dict, root: str, folder: str, overwrite: bool = False) -> dict[str, int]:
    """Parse, take apart and load the documents of a config; returns rows written and ``failed``.

    ``parser`` names a hook (bytes to hash and elements); stored trees are read without one. ``cleaned`` is a folder for the cleaned records. ``prune``
    removes loaded documents that the config no longer has. Documents without a valid path are left out, repeated stems or paths are an error.
    """
    listed = config.check_files(settings)
    rows = [(str(config.anchored(d["file"], root)), d.get("collection_path"), d.get("title")) for d in listed]
    entries = documents.judged(spark.createDataFrame(rows, "file string, collection_path string, title string"))
    for r in entries.where("problem = 'invalid_path'").collect():
        log.warning("%s: no valid collection path", r.file)
    entries = documents.kept(entries.drop("stem", "problem")).withColumn("title", F.coalesce("title", stem("file"))).cache()
    wanted = [r.file for r in entries.select("file").collect()]  # as many as the config has
    missing = [p for p in wanted if not _there(spark, p)]
    for p in missing:
        log.error("%s: no file", p)
    found = [p for p in wanted if p not in set(missing)]
    if not found:
        return {"document": 0, "document_content": 0, "failed": len(missing)}
    tree = parsed.parse(_binary(spark, found), hook(settings["parser"]) if "parser" in settings else parsed.parse_json).cache()
    elements = parsed.elements(tree)
    failures = parsed.parse_failures(tree).unionByName(sections.section_failures(elements)).collect()
    for r in failures:
        log.error("%s: %s: %s", r.doc_id, r.stage, r.reason)
    own = documents.titled(sections.sections(elements), entries).cache()
    hashes = tree.where("error is null").groupBy("doc_id").agg(F.first("binary_hash").alias("binary_hash"))
    if "cleaned" in settings:
        sections.cleaned(own.drop("collection_path", "title"), hashes).write.mode("overwrite").parquet(str(config.anchored(settings["cleaned"], root)))
    parents = own.groupBy("doc_id", "collection_path", "title").agg(F.count("*").cast("int").alias("n_parsed_sections")).join(hashes, "doc_id")
    parents = parents.select("collection_path", "title", "n_parsed_sections", F.col("binary_hash").alias("source_binary_hash"), F.current_timestamp().alias("ingested_at"))
    content = own.select("collection_path", "sort_order", "heading_text", "content_text", F.col("word_count").cast("int").alias("word_count"), "page_start", "page_end")
    if settings.get("prune") and (stored := store.read(spark, f"{folder}/document")) is not None:
        keep = [r[0] for r in entries.select("collection_path").collect()]
        gone = store.delete_family(spark, folder, "document", ["document_content"], ~F.col("collection_path").isin(keep)) if not stored.where(~F.col("collection_path").isin(keep)).isEmpty() else {}
        log.info("pruned: %s", gone)
    out = store.load_family(parents, {"document_content": content}, folder, "document", overwrite=overwrite, buckets=BUCKETS)
    return out | {"failed": len(missing) + len({r.doc_id for r in failures})}


# workbooks


def _sheet_rows(cells: DataFrame, asked: list[tuple[str, str]], s: tuple) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows, headers and header problems of sheets with the same settings."""
    header_row, start, end, first, last = s
    own = cells.join(F.broadcast(cells.sparkSession.createDataFrame(asked, "file string, sheet string")), ["file", "sheet"], "left_semi") if asked else cells
    span = sheets.bounds(own, header_row, start, end, first, last)
    heads = sheets.headers(own, span, header_row)
    bad = sheets.header_problems(heads)
    good = heads.join(bad.select("file", "sheet").distinct(), ["file", "sheet"], "left_anti")
    return sheets.data_rows(own, span, good), good, bad


def ingest_sheets(spark: SparkSession, files: str | None, folder: str, prefix: str | None = None, overwrite: bool = False, settings: dict | None = None, root: str = ".", buckets: int | None = BUCKETS) -> dict[str, int]:
    """Read workbooks to cells, then rows, and load sheets with their contents; bad headers are errors of their sheet and stop only it.

    ``files`` takes every sheet of the files it matches; ``settings`` names sheets with their title, path, header row, columns, rows and structured table.
    A sheet with a structured table is appended to it as well, columns only grow.
    """
    listed = config.check_sheets(settings) if settings else []
    place = {(f, s["sheet"]): (str(config.anchored(f, root)), s) for f, s in listed}
    if settings:
        for f, sheet, reason in xlsx.input_failures(listed, root):
            log.error("%s / %s: %s", f, sheet, reason)
            place.pop((f, sheet), None)
        if not place:
            return {"sheet": 0, "sheet_content": 0}
    raw = _binary(spark, sorted({p for p, _ in place.values()}) if settings else [files])
    cells = sheets.fill_merged(xlsx.read_cells(raw), xlsx.read_cells(raw, "merged")).cache()
    groups: dict[tuple, list[tuple[str, str]]] = defaultdict(list)
    for path, s in place.values():
        letters = lambda k: column_index(s[k]) if k in s else None  # noqa: E731, B023
        groups[s.get("header_row", 1), letters("start_col") or 1, letters("end_col"), s.get("data_start_row"), s.get("data_end_row")].append((path, s["sheet"]))
    parts = [_sheet_rows(cells, asked, s) for s, asked in groups.items()] if settings else [_sheet_rows(cells, [], (1, 1, None, None, None))]
    rows, heads, bad = (reduce(lambda a, b: a.unionByName(b), x) for x in zip(*parts))
    for r in bad.collect():
        log.error("%s / %s: %s %s", r.file, r.sheet, r.problem, r.header)
    authored = spark.createDataFrame([(p, s["sheet"], s.get("collection_path"), s.get("title"), s.get("structured_table")) for p, s in place.values()], "file string, sheet string, _path string, _title string, structured_table string")
    rows = rows.join(F.broadcast(authored), ["file", "sheet"], "left").withColumn("collection_path", sheet_path("file", "sheet", "_path", prefix)).where("collection_path is not null")
    rows = rows.withColumn("title", documents.default_title("file", "sheet", "_title")).cache()
    texts = sheets.text_rows(rows).cache()
    names = rows.select("collection_path", "title", "structured_table").distinct()
    parents = sheets.catalog(texts).join(names, "collection_path").select("collection_path", "title", "n_rows", "source_binary_hash", "structured_table", F.current_timestamp().alias("ingested_at"))
    structured = {}
    for path, s in place.values():
        if "structured_table" in s:
            try:
                structured[s["structured_table"]] = structured.get(s["structured_table"], 0) + _structured(rows, heads, path, s, folder, overwrite)
            except ValueError as e:
                log.error("%s / %s: %s", path, s["sheet"], e)
    return store.load_family(parents, {"sheet_content": texts}, folder, "sheet", overwrite=overwrite, buckets=buckets) | structured


def _structured(rows: DataFrame, heads: DataFrame, path: str, s: dict, folder: str, overwrite: bool) -> int:
    """Append one sheet to its structured table, a column for each header; the names are collected, a list that the sheet's headers bound."""
    at = (F.col("file") == path) & (F.col("sheet") == s["sheet"])
    names = distinct_names([r[0] for r in heads.where(at).orderBy("c").select("column").collect()])
    own = rows.where(at).select("collection_path", F.col("row_number").alias("sort_order"), *[F.element_at("cells", i)["value"].alias(n) for i, n in enumerate(names, 1)])
    return store.append_structured(own, f"{folder}/{s['structured_table']}", overwrite=overwrite)


# embeddings


def embed_tables(spark: SparkSession, settings: dict, root: str) -> int:
    """Chunk and embed what has no embedding yet, for each table of a config; returns how many tables failed. One bad table does not stop the others.

    ``header_columns`` stand in front of each chunk and take from its budget; ``model`` names a hook that makes a model for a task, ``counter`` one
    that makes a token counter.
    """
    failed = 0
    for name, t in settings.get("tables", {}).items():
        try:
            own = config.EmbedSettings.of(settings, t)
            keys, columns, header = t["keys"], t["embed_columns"], t.get("header_columns", [])
            source = spark.read.parquet(str(config.anchored(t["source"], root))).drop(store.BUCKET)
            if unknown := sorted({*keys, *columns, *header} - set(source.columns)):
                raise config.ConfigError(f"unknown columns {unknown}")
            target = str(config.anchored(t["target"], root))
            rows = source.where(embed.source_filter(source, own.source_filter)) if own.source_filter else source
            same = {k: k for k in keys}
            stored = store.read(spark, target)
            if own.overwrite and stored is not None:
                store.replace(embed.surviving(stored, rows, same), target)
                stored = store.read(spark, target)
            rows = rows if stored is None else embed.resume(rows, stored, same)
            body = [c for c in columns if c not in header]
            # keys, header and embedded columns, each once
            text = rows.where(embed.has_text(columns)).select(*dict.fromkeys([*keys, *header, *columns])).withColumn("_text", row_text([(c, c) for c in body]))
            counter = t.get("counter", settings.get("counter"))
            if header:
                cut = chunks.with_prefix(text, row_text([(c, c) for c in header]), "_text", own.max_tokens, own.overlap)
            elif counter:
                cut = chunks.by_counter(text, keys, "_text", hook(counter), own.max_tokens, own.overlap)
            else:
                cut = chunks.additive(text, "_text", own.max_tokens, own.overlap)
            model = t.get("model", settings.get("model"))
            done = embed.encode(cut.select(*keys, "chunk_number", "chunk_text", "word_count"), hook(model) if model else None, own.batch_size)
            done.withColumn("chunk_terms", embed.terms("chunk_text")).write.mode("append").parquet(target)
            log.info("%s: %d chunks", name, spark.read.parquet(target).count())
        except (config.ConfigError, KeyError, ValueError) as x:
            failed += 1
            log.error("%s: %s", name, x)
    return failed


# downloads


def acquire_targets(spark: SparkSession, settings: dict, root: str, dry_run: bool = False, overwrite: bool = False, tasks: int = 8) -> list[dict]:
    """Discover, fetch and record the targets of a config; returns the manifest entries.

    Discovery: ``targets`` as they are, ``discovery`` of kind explicit or templated, or a ``discover`` hook (session and settings to rows). ``extract``
    takes kept members out of archives; ``delay`` seconds pass before each fetch of a task. Fetches run in ``tasks`` tasks over a shared folder.
    """
    d = config.check_acquisition(settings) if "discovery" in settings else {"kind": "explicit", "targets": settings.get("targets", [])}
    if "discover" in settings:
        found = acquire.explicit_targets(spark, list(hook(settings["discover"])(spark, settings)))
    elif d["kind"] == "explicit":
        found = acquire.explicit_targets(spark, d["targets"])
    else:
        values = spark.createDataFrame([(str(v),) for v in d["values"]], f"`{d['variable']}` string")
        found = acquire.templated_targets(values, d["variable"], d["url"], d["destination"], d.get("group"))
    acquire.checked(found, settings.get("min_targets", 0))
    manifest = str(config.anchored(settings.get("manifest", "manifest.json"), root))
    prior = None
    if _there(spark, manifest) and not overwrite:
        try:
            prior = acquire.read_manifest(spark, manifest)
        except ValueError as x:
            log.warning("the manifest is ignored: %s", x)
    from foliant.sources.fetch import fetch

    limits = {k: settings[k] for k in ("max_bytes",) if k in settings} | ({"tries": settings["retries"] + 1} if "retries" in settings else {})
    delay, take = float(settings.get("delay", 0)), settings.get("extract")

    def get(url: str, dest: Path) -> None:
        time.sleep(delay)
        fetch(url, dest, **limits)

    def unpack(_: dict, path: Path) -> list[Path]:
        return archives.extract(path, path.parent, take["keep"], take.get("flatten", False), take.get("delete", True)) if path.suffix == ".zip" else [path]

    entries = acquire.run_in_tasks(found, root, get, prior, unpack if take else None, overwrite, dry_run, tasks)
    if not dry_run:
        acquire.write_manifest(manifest, entries)
    return entries


# validation


def validate_tables(spark: SparkSession, folder: str) -> DataFrame:
    """Every check of the tables that lie in a folder: documents, sheets and the structured tables that sheets name."""
    has = lambda n: _there(spark, f"{folder}/{n}") or _there(spark, f"{folder}/{n}.parquet")
    parts = []
    if has("document") or has("document_content"):
        parts.append(validate.loaded_documents(table(spark, folder, "document"), table(spark, folder, "document_content")))
    if has("sheet") or has("sheet_content"):
        sheet = table(spark, folder, "sheet")
        parts.append(validate.loaded_sheets(sheet, table(spark, folder, "sheet_content")))
        for (name,) in sheet.where("structured_table is not null").select("structured_table").distinct().orderBy("structured_table").collect():
            if has(name):
                own = sheet.where(F.col("structured_table") == name)
                parts.append(validate.structured(table(spark, folder, name), sheet, own).withColumn("detail", F.concat_ws(" ", F.lit(name), "detail")))
            else:
                parts.append(spark.createDataFrame([("missing", name, "structured table")], "check string, key string, detail string"))
    if not parts:
        raise ValueError(f"no tables in {folder}")
    return validate.both(parts)


def validate_embeddings(spark: SparkSession, settings: dict, root: str) -> DataFrame:
    """Checks of the embedding tables of a config against their sources."""
    parts = []
    for name, t in settings.get("tables", {}).items():
        own = config.EmbedSettings.of(settings, t)
        source = spark.read.parquet(str(config.anchored(t["source"], root))).drop(store.BUCKET)
        source = source.where(embed.has_text(t["embed_columns"]))
        if own.source_filter:
            source = source.where(embed.source_filter(source, own.source_filter))
        results = store.read(spark, str(config.anchored(t["target"], root)))
        if results is None:
            parts.append(spark.createDataFrame([("missing", name, "embedding table")], "check string, key string, detail string"))
            continue
        longest = t.get("model_tokens", settings.get("model_tokens", 512))
        parts.append(validate.embeddings(source, results, {k: k for k in t["keys"]}, t.get("dimensions", settings.get("dimensions", 64)), longest, own.max_tokens, keys_of=[*t["keys"], "chunk_number"]))
    if not parts:
        raise ValueError("the config has no tables")
    return validate.both(parts)


def validate_cleaned(spark: SparkSession, folder: str) -> DataFrame:
    """Cleaned records, one JSON file each, that break their contract."""
    records = parsed.cleaned_records(_binary(spark, [f"{folder}/*.json"]))
    return parsed.cleaned_failures(records).select(F.lit("cleaned").alias("check"), F.col("doc_id").alias("key"), F.col("reason").alias("detail"))


def validate_downloads(spark: SparkSession, manifest: str, root: str) -> DataFrame:
    """Artifacts of a manifest that are missing, of another size or of another kind than their extension says; archives are read to their directory."""
    entries = acquire.read_manifest(spark, manifest)
    files = acquire.stored_files(spark, root)
    bad = acquire.manifest_failures(entries, files, acquire.MAGIC)
    return bad.select(F.col("problem").alias("check"), F.concat_ws(" ", "url", "path").alias("key"), F.lit("").alias("detail"))


def validate_inputs(spark: SparkSession, settings: dict, root: str) -> DataFrame:
    """Authored sheets that can't be read."""
    rows = [("input", f"{f} / {s}", reason) for f, s, reason in xlsx.input_failures(config.check_sheets(settings), root)]
    return spark.createDataFrame(rows, "check string, key string, detail string")

