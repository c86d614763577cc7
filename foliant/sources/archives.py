"""Members of zip archives."""

from __future__ import annotations

import fnmatch
import io
import shutil
import zipfile
from pathlib import Path, PurePosixPath

from pyspark.sql import DataFrame

MEMBERS = "path string, member string, name string, size bigint, content binary, error string"


def wanted(name: str, keep: list[str]) -> bool:
    """Whether a pattern fits the whole name or its last part."""
    return any(fnmatch.fnmatchcase(name, p) or fnmatch.fnmatchcase(PurePosixPath(name).name, p) for p in keep)


def safe(name: str) -> bool:
    parts = name.replace("\\", "/")
    return not parts.startswith("/") and ":" not in parts.split("/")[0] and ".." not in parts.split("/")


def members(files: DataFrame, keep: list[str]) -> DataFrame:
    """Kept members of each archive in ``binaryFile`` rows (:data:`MEMBERS`); an archive that can't be read, has an unsafe member or none to keep is one row with an error."""
    import pyarrow as pa

    def run(batches):
        for b in batches:
            rows = []
            for path, raw in zip(b.column("path").to_pylist(), b.column("content").to_pylist()):
                try:
                    with zipfile.ZipFile(io.BytesIO(raw)) as z:
                        names = sorted(n for n in z.namelist() if not n.endswith("/") and wanted(n, keep))
                        if not names:
                            raise ValueError("nothing to keep")
                        if not all(map(safe, names)):
                            raise ValueError("a member leaves the folder")
                        own = [(path, n, PurePosixPath(n).name, z.getinfo(n).file_size, z.read(n), None) for n in names]
                    rows += own
                except (zipfile.BadZipFile, ValueError, OSError) as e:
                    rows.append((path, None, None, None, None, str(e)))
            types = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.binary(), pa.string()]
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 6, types)], names=[f.split()[0] for f in MEMBERS.split(", ")])

    return files.select("path", "content").mapInArrow(run, MEMBERS)


def extract(archive: Path, folder: Path, keep: list[str], flatten: bool = False, delete: bool = True) -> list[Path]:
    """Extract on the driver; sorted paths of what was written. Two members of one name, when flattened, are an error; a failure leaves nothing behind."""
    out: list[Path] = []
    try:
        with zipfile.ZipFile(archive) as z:
            for n in sorted(n for n in z.namelist() if not n.endswith("/") and wanted(n, keep)):
                if not safe(n):
                    raise ValueError(f"a member leaves the folder: {n}")
                to = folder / (PurePosixPath(n).name if flatten else n)
                if to in out:
                    raise ValueError(f"two members are {to.name}")
                to.parent.mkdir(parents=True, exist_ok=True)
                out.append(to)
                with z.open(n) as src, to.open("wb") as dst:
                    shutil.copyfileobj(src, dst)
        if not out:
            raise ValueError("nothing to keep")
    except BaseException:
        for p in out:
            p.unlink(missing_ok=True)
        raise
    if delete:
        archive.unlink()
    return sorted(out)
