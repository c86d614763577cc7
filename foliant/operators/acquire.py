"""Acquisition: targets, what can be skipped, manifests and their validation."""

from __future__ import annotations

import json
import time
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foliant.functions.identity import escapes
from foliant.operators.store import write_json
from foliant.schemas import MANIFEST, TARGETS

STATUSES = ("fetched", "skipped", "failed")
#: Hex of the bytes that files of a kind begin with.
MAGIC = {"pdf": "25504446", "zip": "504B03", "docx": "504B03", "xlsx": "504B03"}


class TargetError(ValueError):
    """The targets can't be acquired as given."""


def explicit_targets(spark: SparkSession, rows: list[dict]) -> DataFrame:
    """Authored targets; url and destination are required."""
    for r in rows:
        if not r.get("url") or not r.get("destination"):
            raise TargetError(f"a target needs url and destination: {r}")
    return spark.createDataFrame([(r["url"], r["destination"], r.get("group"), r.get("expected_size")) for r in rows], TARGETS)


def templated_targets(values: DataFrame, variable: str, url: str, destination: str, group: str | None = None) -> DataFrame:
    """One target for each value of a column; ``{variable}`` is the only placeholder."""
    import re

    for t in (url, destination, group or ""):
        other = set(re.findall(r"\{([^{}]*)\}", t)) - {variable}
        if other:
            raise TargetError(f"unknown placeholders {sorted(other)}")
    put = lambda t: F.replace(F.lit(t), F.lit("{" + variable + "}"), F.col(variable).cast("string"))
    return values.select(put(url).alias("url"), put(destination).alias("destination"), (put(group) if group else F.lit(None).cast("string")).alias("group"), F.lit(None).cast("bigint").alias("expected_size"))


def target_problems(targets: DataFrame) -> DataFrame:
    """``problem, destination``: destinations that leave the folder, and such that several URLs share."""
    out = targets.where(escapes("destination")).select(F.lit("escapes").alias("problem"), "destination")
    same = targets.groupBy("destination").agg(F.count_distinct("url").alias("n")).where("n > 1").select(F.lit("shared").alias("problem"), "destination")
    return out.unionByName(same)


def checked(targets: DataFrame, at_least: int = 0) -> DataFrame:
    """The targets, or an error: problems first, then too few of them. Runs before anything is fetched."""
    bad = target_problems(targets).limit(5).collect()
    if bad:
        raise TargetError("; ".join(f"{r.problem}: {r.destination}" for r in bad))
    n = targets.count()
    if n < at_least:
        raise TargetError(f"{n} targets, at least {at_least} expected")
    return targets


def last_entries(entries: DataFrame) -> DataFrame:
    """One entry for each URL, the last one of the manifest; ``pos`` is the place in it."""
    return entries.groupBy("url").agg(F.max_by(F.struct("status", "artifacts"), "pos").alias("e")).select("url", "e.status", "e.artifacts")


def decisions(targets: DataFrame, entries: DataFrame, files: DataFrame) -> DataFrame:
    """``url, destination, skip``: skip what was fetched or skipped before and whose artifacts, one at least, are all there at their size.

    ``files`` lists ``path, size`` of what is there. Artifacts are taken apart, joined and counted, so a target may have any number.
    """
    prior = last_entries(entries)
    parts = prior.select("url", F.explode("artifacts").alias("a")).select("url", F.col("a.path").alias("path"), F.col("a.size").alias("want"))
    there = parts.join(files, "path", "left").groupBy("url").agg(F.bool_and(F.coalesce(F.col("size") == F.col("want"), F.lit(False))).alias("intact"))
    good = prior.where(F.col("status").isin("fetched", "skipped")).join(there.where("intact"), "url", "left_semi").select("url", F.lit(True).alias("skip"))
    return targets.join(good, "url", "left").select("url", "destination", F.coalesce("skip", F.lit(False)).alias("skip"))


def manifest_failures(entries: DataFrame, files: DataFrame, content: dict[str, str] | None = None) -> DataFrame:
    """``url, path, problem``, the first that holds: failed, no_artifacts, missing, empty, size, content.

    ``files`` has ``path, size`` and, where contents are to be checked, ``head`` with the first bytes; ``content`` maps an extension to the hex of the bytes expected.
    """
    flat = entries.select("url", "status", F.explode_outer("artifacts").alias("a")).select("url", "status", F.col("a.path").alias("path"), F.col("a.size").alias("want"))
    seen = flat.join(files, "path", "left")
    wrong: Column = F.lit(False)
    if content and "head" in files.columns:
        for ext, magic in content.items():
            wrong = wrong | (F.lower("path").endswith(f".{ext}") & ~F.hex("head").startswith(magic))
    if content and "readable" in files.columns:
        wrong = wrong | ~F.coalesce("readable", F.lit(True))
    problem = (
        F.when(F.col("status") == "failed", "failed").when(F.col("path").isNull(), "no_artifacts").when(F.col("size").isNull(), "missing").when(F.col("size") == 0, "empty").when(F.col("size") != F.col("want"), "size").when(wrong, "content")
    )
    return seen.withColumn("problem", problem).where("problem is not null").select("url", "path", "problem")


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Entries of a manifest file with their place: ``pos, url, destination, group, status, error, artifacts``. Malformed files and entries are errors."""
    raw = json.loads("".join(r.value for r in spark.read.text(path, wholetext=True).collect()))
    if not isinstance(raw, dict) or not isinstance(raw.get("entries"), list):
        raise ValueError("a manifest is an object with a list of entries")
    for i, e in enumerate(raw["entries"]):
        bad = not isinstance(e, dict) or not isinstance(e.get("url"), str) or not isinstance(e.get("destination"), str) or e.get("status") not in STATUSES or not isinstance(e.get("artifacts", []), list)
        if bad or any(not isinstance(a, dict) or not isinstance(a.get("path"), str) or type(a.get("size")) is not int for a in e.get("artifacts", [])):
            raise ValueError(f"entry {i} is malformed")
    frame = spark.read.schema(MANIFEST).option("multiLine", True).option("mode", "FAILFAST").json(path)
    return frame.select(F.posexplode("entries").alias("pos", "e")).select("pos", "e.*")


def write_manifest(path: str, entries: list[dict], now: str | None = None) -> None:
    write_json(path, {"generated_at": now or time.strftime("%Y-%m-%dT%H:%M:%SZ", time.gmtime()), "entries": entries})


def run(targets: list[dict], root: str, fetch: Callable[[str, Path], None], prior: dict[str, dict] | None = None, after: Callable[[dict, Path], list[Path]] | None = None, overwrite: bool = False, dry_run: bool = False) -> list[dict]:
    """Acquire targets one by one on the driver; a failure stops only its own. Returns the manifest entries of all of them."""
    entries = []
    for t in targets:
        entry = {"url": t["url"], "destination": t["destination"], "group": t.get("group"), "status": "failed", "artifacts": [], "error": None}
        old = (prior or {}).get(t["url"])
        made: list[Path] = []
        if old and not overwrite and old["status"] in ("fetched", "skipped") and old["artifacts"] and all(Path(root, a["path"]).is_file() and Path(root, a["path"]).stat().st_size == a["size"] for a in old["artifacts"]):
            entries.append(entry | {"status": "skipped", "artifacts": old["artifacts"]})
            continue
        if dry_run:
            entries.append(entry | {"status": "skipped"})
            continue
        try:
            dest = Path(root, t["destination"])
            dest.parent.mkdir(parents=True, exist_ok=True)
            made = [dest]
            fetch(t["url"], dest)
            if t.get("expected_size") is not None and dest.stat().st_size != t["expected_size"]:
                raise ValueError(f"size {dest.stat().st_size}, expected {t['expected_size']}")
            if after:
                made = after(t, dest)
                if not made:
                    raise ValueError("nothing came out of the file")
            entries.append(entry | {"status": "fetched", "artifacts": [{"path": str(p.relative_to(root)), "size": p.stat().st_size} for p in made]})
        except Exception as e:  # noqa: BLE001 - any failure is the target's own
            for p in made:
                p.unlink(missing_ok=True)
            entries.append(entry | {"error": f"{type(e).__name__}: {e}"})
    return entries


def run_in_tasks(targets: DataFrame, root: str, fetch: Callable[[str, Path], None], prior: DataFrame | None = None, after: Callable[[dict, Path], list[Path]] | None = None, overwrite: bool = False, dry_run: bool = False, tasks: int = 8) -> list[dict]:
    """Like :func:`run`, with the targets spread over tasks that write to a shared folder; entries come back in the order of the targets' destinations.

    A retried task finds what it fetched before and fetches it again: a download ends in a rename, so nothing half-written stays.
    """
    import pyarrow as pa

    own = targets.select("url", F.to_json(F.struct("url", "destination", "group", "expected_size")).alias("target"))
    if prior is None:
        both = own.withColumn("old", F.lit(None).cast("string"))
    else:
        last = last_entries(prior)
        both = own.join(last.select("url", F.to_json(F.struct("url", "status", "artifacts")).alias("old")), "url", "left")

    def work(batches):
        for b in batches:
            out = []
            for text, old in zip(b.column("target").to_pylist(), b.column("old").to_pylist()):
                t = json.loads(text)
                known = {t["url"]: json.loads(old)} if old else {}
                out += run([t], root, fetch, {u: {"artifacts": [], **e} for u, e in known.items()}, after, overwrite, dry_run)
            yield pa.record_batch([pa.array([json.dumps(e) for e in out], pa.string())], names=["entry"])

    rows = both.repartition(tasks, "url").select("target", "old").mapInArrow(work, "entry string").collect()
    return sorted((json.loads(r.entry) for r in rows), key=lambda e: e["destination"])


def stored_files(spark: SparkSession, root: str) -> DataFrame:
    """``path`` below the root, ``size, head`` (first bytes) and ``readable``: whether a zip file's directory of members can be read (null for other files)."""
    import io
    import zipfile

    import pyarrow as pa

    def look(batches):
        for b in batches:
            rows = []
            for path, size, raw in zip(*(b.column(c).to_pylist() for c in ("path", "length", "content"))):
                ok = None
                if path.lower().endswith((".zip", ".docx", ".xlsx")):
                    try:
                        with zipfile.ZipFile(io.BytesIO(raw)) as z:
                            ok = len(z.infolist()) > 0
                    except (zipfile.BadZipFile, OSError, ValueError):
                        ok = False
                rows.append((path, size, raw[:8], ok))
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 4, (pa.string(), pa.int64(), pa.binary(), pa.bool_()))], names=["path", "size", "head", "readable"])

    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    base = str(Path(root).resolve())
    return files.select(F.regexp_replace("path", r"^file:/+", "/").alias("path"), "length", "content").mapInArrow(look, "path string, size bigint, head binary, readable boolean").withColumn("path", F.replace("path", F.lit(base + "/"), F.lit("")))


def counters(entries: list[dict]) -> dict[str, int]:
    """Number of entries of each status."""
    return {s: sum(e["status"] == s for e in entries) for s in STATUSES}
