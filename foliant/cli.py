"""Command line: ingest documents and workbooks, embed, acquire files, validate all of them, and report on quality.

Exit code 0: done (findings of the report change nothing); 1: failures or a wrong setting; 2: wrong usage.
"""

from __future__ import annotations

import argparse
import json
import logging
import os
import sys
import time
from pathlib import Path

from foliant.sources.config import ConfigError, load, load_env

log = logging.getLogger("foliant")


class _Json(logging.Formatter):
    converter = time.gmtime

    def format(self, r: logging.LogRecord) -> str:
        return json.dumps({"time": self.formatTime(r, "%Y-%m-%dT%H:%M:%SZ"), "level": r.levelname, "logger": r.name, "message": r.getMessage()}, ensure_ascii=False)


def set_up_logging(folder: Path | None) -> None:
    """Plain lines on the console; JSON lines in a rotating file where a folder is given."""
    from logging.handlers import RotatingFileHandler

    log.setLevel(logging.INFO)
    log.addHandler(logging.StreamHandler())
    if folder:
        folder.mkdir(parents=True, exist_ok=True)
        h = RotatingFileHandler(folder / "foliant.jsonl", maxBytes=10_000_000, backupCount=5, encoding="utf-8")
        h.setFormatter(_Json())
        log.addHandler(h)


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="foliant", description=__doc__)
    p.add_argument("--root", default=".", help="relative paths start here")
    p.add_argument("--log-dir")
    p.add_argument("--env-file", help="assignments that go before the environment")
    sub = p.add_subparsers(dest="command", required=True)
    s = sub.add_parser("validate", help="check stored tables, embeddings, cleaned records, downloads or authored sheets")
    s.add_argument("--tables", help="folder of the tables")
    s.add_argument("--embeddings", help="config of embeddings")
    s.add_argument("--cleaned", help="folder of cleaned records")
    s.add_argument("--manifest", help="manifest of downloads")
    s.add_argument("--inputs", help="config of workbooks")
    s = sub.add_parser("report", help="write a quality report")
    s.add_argument("--tables", required=True, help="folder of the tables")
    s.add_argument("--out", required=True)
    s = sub.add_parser("files", help="parse, take apart and load documents")
    s.add_argument("--config", required=True)
    s.add_argument("--tables", required=True)
    s.add_argument("--overwrite", action="store_true")
    s = sub.add_parser("sheets", help="ingest workbooks")
    s.add_argument("--files", help="pattern of workbooks, every sheet of them")
    s.add_argument("--config", help="sheets with their settings")
    s.add_argument("--tables", required=True)
    s.add_argument("--prefix")
    s.add_argument("--overwrite", action="store_true")
    s = sub.add_parser("embed", help="chunk and embed what has no embedding yet")
    s.add_argument("--config", required=True)
    s = sub.add_parser("acquire", help="fetch the targets of a config")
    s.add_argument("--config", required=True)
    s.add_argument("--dry-run", action="store_true")
    s.add_argument("--overwrite", action="store_true")
    s.add_argument("--tasks", type=int, default=8, help="fetches at a time")
    return p


def validate(spark, o: argparse.Namespace) -> int:
    from foliant import pipelines as p
    from foliant.operators.validate import both

    asked = {
        "tables": lambda x: p.validate_tables(spark, x),
        "embeddings": lambda x: p.validate_embeddings(spark, load(x), o.root),
        "cleaned": lambda x: p.validate_cleaned(spark, x),
        "manifest": lambda x: p.validate_downloads(spark, x, o.root),
        "inputs": lambda x: p.validate_inputs(spark, load(x), o.root),
    }
    parts = [f(getattr(o, name)) for name, f in asked.items() if getattr(o, name)]
    if not parts:
        raise ConfigError("nothing to validate")
    counts = both(parts).groupBy("check").count().orderBy("check").collect()
    for r in counts:
        log.error("%s: %d", r["check"], r["count"])
    return int(any(not r["check"].startswith("warning") for r in counts))


def report(spark, folder: str, out: str) -> int:
    from foliant.operators import quality
    from foliant.runtime import table

    quality.report(table(spark, folder, "document_content"), "collection_path").write.mode("overwrite").json(out)
    return 0


def ingest_sheets(spark, files: str, folder: str, prefix: str | None = None, overwrite: bool = False) -> dict[str, int]:
    """Every sheet of the workbooks that a pattern matches."""
    from foliant import pipelines

    return pipelines.ingest_sheets(spark, files, folder, prefix, overwrite, buckets=None)


def main(args: list[str] | None = None) -> int:
    o = parser().parse_args(args)
    set_up_logging(Path(o.log_dir) if o.log_dir else None)
    spark = None
    try:
        if o.env_file:
            os.environ.update(load_env(o.env_file, {}))
        config = load(o.config) if getattr(o, "config", None) else {}
        from foliant import pipelines as p
        from foliant.runtime import session

        spark = session()
        if o.command == "validate":
            return validate(spark, o)
        if o.command == "report":
            return report(spark, o.tables, o.out)
        if o.command == "files":
            done = p.ingest_files(spark, config, o.root, o.tables, o.overwrite)
            log.info("%s", done)
            return int(done["failed"] > 0)
        if o.command == "sheets":
            if bool(o.files) == bool(config):
                raise ConfigError("either --files or --config")
            log.info("%s", p.ingest_sheets(spark, o.files, o.tables, o.prefix, o.overwrite, config or None, o.root))
            return 0
        if o.command == "embed":
            return int(p.embed_tables(spark, config, o.root) > 0)
        entries = p.acquire_targets(spark, config, o.root, o.dry_run, o.overwrite, o.tasks)
        for x in entries:
            log.info("%s: %s%s", x["url"], x["status"], f" ({x['error']})" if x["error"] else "")
        return int(any(x["status"] == "failed" for x in entries))
    except (ConfigError, ValueError) as e:
        log.error("%s", e)
        return 1
    finally:
        if spark is not None:
            from foliant.runtime import cleanup

            cleanup(spark)


if __name__ == "__main__":
    sys.exit(main())
