"""HTTP downloads with retries."""

from __future__ import annotations

import os
import time
import urllib.error
import urllib.request
from pathlib import Path

#: Answers after which a request is tried again.
RETRY = (429, 500, 502, 503, 504)


class FetchError(RuntimeError):
    """A download failed, whatever the cause."""


def declared_length(headers: dict[str, str]) -> int | None:
    """The stated size; none if it is missing, no number, or of an encoded body."""
    own = {k.lower(): v for k, v in headers.items()}
    text = (own.get("content-length") or "").strip()
    return int(text) if text.isdigit() and not own.get("content-encoding") else None


def fetch(url: str, dest: Path, timeout: float = 60.0, tries: int = 4, wait: float = 1.0, max_bytes: int | None = None, open_url=urllib.request.urlopen) -> int:
    """Download to ``<dest>.part`` and rename; returns the size. Retries failed connections and :data:`RETRY`; not found is final."""
    part = dest.with_name(dest.name + ".part")
    for left in range(tries - 1, -1, -1):
        try:
            size = 0
            with open_url(url, timeout=timeout) as r, part.open("wb") as f:
                want = declared_length(dict(r.headers.items()))
                while block := r.read(1 << 16):
                    size += len(block)
                    if max_bytes is not None and size > max_bytes:
                        raise FetchError(f"{url}: more than {max_bytes} bytes")
                    f.write(block)
            if want is not None and size != want:
                raise OSError(f"{size} bytes, {want} stated")
            os.replace(part, dest)
            return size
        except FetchError:
            part.unlink(missing_ok=True)
            raise
        except (OSError, ValueError) as e:
            part.unlink(missing_ok=True)
            if isinstance(e, ValueError) or not left or isinstance(e, urllib.error.HTTPError) and e.code not in RETRY:
                raise FetchError(f"{url}: {e}") from e
            time.sleep(wait * 2 ** (tries - 1 - left))
    raise FetchError(url)
