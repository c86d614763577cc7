"""Settings from TOML files and credentials from dotenv files, checked before any work."""

from __future__ import annotations

import re
import tomllib
from dataclasses import dataclass, field
from pathlib import Path


class ConfigError(ValueError):
    """A setting is missing, of the wrong type or unsafe."""


def load(path: str | Path) -> dict:
    try:
        return tomllib.loads(Path(path).read_text(encoding="utf-8"))
    except (OSError, tomllib.TOMLDecodeError) as e:
        raise ConfigError(f"{path}: {e}") from e


def load_env(path: str | Path, env: dict[str, str]) -> dict[str, str]:
    """Assignments of a dotenv file over the environment; a missing file is an error."""
    try:
        lines = Path(path).read_text(encoding="utf-8").splitlines()
    except OSError as e:
        raise ConfigError(str(e)) from e
    own = dict(re.match(r"\s*(?:export\s+)?([A-Za-z_]\w*)\s*=\s*(.*?)\s*$", x).groups() for x in lines if re.match(r"\s*(?:export\s+)?[A-Za-z_]\w*\s*=", x))
    return env | {k: v[1:-1] if len(v) > 1 and v[0] == v[-1] and v[0] in "\"'" else v for k, v in own.items()}


def typed(section: dict, name: str, kind: type, default=None):
    """A value of a type; booleans are no numbers and quoted booleans are errors."""
    if name not in section:
        if default is None:
            raise ConfigError(f"{name} is missing")
        return default
    v = section[name]
    if not isinstance(v, kind) or kind is not bool and isinstance(v, bool):
        raise ConfigError(f"{name} must be {kind.__name__}, not {v!r}")
    return v


@dataclass(frozen=True)
class EmbedSettings:
    """Settings of one embedding table; the table's own go before the common ones, then the defaults."""

    batch_size: int = 64
    max_tokens: int = 500
    overlap: int = 50
    overwrite: bool = False
    source_filter: dict = field(default_factory=dict)

    @classmethod
    def of(cls, config: dict, table: dict) -> "EmbedSettings":
        base = cls()
        pick = lambda n, k: typed(table, n, k, typed(config, n, k, getattr(base, n)))
        out = cls(pick("batch_size", int), pick("max_tokens", int), pick("overlap", int), table.get("overwrite", config.get("overwrite", False)), table.get("source_filter", {}))
        if not isinstance(out.overwrite, bool):
            raise ConfigError("overwrite must be bool")
        if out.max_tokens <= 0 or not 0 <= out.overlap < out.max_tokens or out.batch_size <= 0:
            raise ConfigError("batch_size and max_tokens must be positive, overlap below max_tokens")
        return out


def identifier(name: str) -> str:
    if not re.fullmatch(r"[a-z_][a-z0-9_]*", name) or len(name.encode()) > 63:
        raise ConfigError(f"unsafe identifier {name!r}")
    return name


def anchored(path: str, root: str | Path) -> Path:
    """A relative path below a root; a path with a drive or root stays as it is."""
    return Path(path) if re.match(r"^(?:[A-Za-z]:|/|\\)", path) else Path(root) / path


def check_files(config: dict) -> list[dict]:
    """The documents of a file ingestion: each needs a file; parse settings are booleans and names of back ends."""
    docs = config.get("documents")
    if not isinstance(docs, list) or not docs:
        raise ConfigError("documents must be a list with entries")
    seen: set[str] = set()
    for d in docs:
        name = typed(d, "file", str)
        if name in seen:
            raise ConfigError(f"{name} is there twice")
        seen.add(name)
        for key, kind in (("title", str), ("collection_path", str), ("do_ocr", bool)):
            if key in d:
                typed(d, key, kind)
    return docs


def check_sheets(config: dict) -> list[tuple[str, dict]]:
    """The sheets of a workbook ingestion: file and sheet; no identity twice; rows from 1; columns are letters; targets are identifiers."""
    out, seen = [], set()
    for f in typed(config, "files", list):
        name = typed(f, "file", str)
        for s in typed(f, "sheets", list):
            sheet = typed(s, "sheet", str)
            if (name, sheet) in seen:
                raise ConfigError(f"{name} / {sheet} is there twice")
            seen.add((name, sheet))
            for key in ("header_row", "data_start_row", "data_end_row"):
                if key in s and typed(s, key, int) < 1:
                    raise ConfigError(f"{key} must be at least 1")
            for key in ("start_col", "end_col"):
                if key in s and not re.fullmatch("[A-Za-z]+", typed(s, key, str)):
                    raise ConfigError(f"{key} must be column letters")
            if "structured_table" in s:
                identifier(typed(s, "structured_table", str))
            out.append((name, s))
    if not out:
        raise ConfigError("no sheets")
    return out


def check_acquisition(config: dict) -> dict:
    """Kind of discovery and limits of an acquisition."""
    d = typed(config, "discovery", dict)
    kind = typed(d, "kind", str)
    if kind not in ("explicit", "templated"):
        raise ConfigError(f"unknown discovery {kind!r}")
    for key in {"explicit": ["targets"], "templated": ["variable", "values", "url", "destination"]}[kind]:
        if key not in d:
            raise ConfigError(f"{key} is missing")
    for key in ("min_targets", "max_bytes", "retries"):
        if key in config and typed(config, key, int) < 0:
            raise ConfigError(f"{key} must not be negative")
    return d
