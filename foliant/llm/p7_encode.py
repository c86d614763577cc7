"""Encoding of the whole corpus with a public tokenizer.

The tokenizers library works on Arrow batches. Byte-level BPE never merges across the pieces of its pre-split, so a plain
ASCII text is split by the same pattern and each distinct piece is encoded once by the library and remembered
(a bounded memory); every other text goes through the library whole, and so does every text where the vocabulary file names another
pre-split or a normaliser. Offsets are in characters: byte offsets mapped
to the character that holds the byte. Decoding reverses the byte table and joins bytes before reading UTF-8, so that a
character split over several ids comes back.

Defined cases: null and empty texts give an empty list; strings of special tokens in a text are ordinary text; ``doc_id``
is unique by contract and every row comes out, so repeated rows give repeated results; extra columns are ignored. One map, no
shuffle.
"""

from __future__ import annotations

import json
import os
import re

import pyarrow as pa
from pyspark.sql import DataFrame

#: Bound of the remembered pieces of one worker, and the longest piece that is remembered.
REMEMBERED, LONGEST = 300_000, 48
#: The pre-split of byte-level vocabularies, for text of ASCII characters only.
ASCII_SPLIT = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\sA-Za-z0-9]+|\s+(?!\S)|\s+", re.ASCII)
_loaded: dict[str, "Encoder"] = {}


def default_path(name: str = "byte_bpe_50k.json") -> str:
    """Where the public vocabulary lies; the folder is a parameter (``FOLIANT_TOKENIZERS``)."""
    return os.path.join(os.environ.get("FOLIANT_TOKENIZERS", "/opt/tokenizers"), name)


def byte_table() -> dict[str, int]:
    """Character of the vocabulary to the byte it stands for: printable bytes are themselves, others follow from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


def splits_so(path: str) -> bool:
    """Whether the vocabulary file splits plain ASCII texts by :data:`ASCII_SPLIT` and changes nothing else before or between the pieces."""
    with open(path, encoding="utf-8") as f:
        d = json.load(f)
    pre, model = d.get("pre_tokenizer") or {}, d.get("model") or {}
    return (
        d.get("normalizer") is None
        and pre.get("type") == "ByteLevel"
        and pre.get("use_regex", True)
        and not pre.get("add_prefix_space", True)
        and model.get("type", "BPE") == "BPE"
        and not model.get("dropout")
        and all(t.get("special") for t in d.get("added_tokens") or [])
    )


class Encoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.lib = Tokenizer.from_file(path)
        self.lib.encode_special_tokens = True
        self.split = ASCII_SPLIT if splits_so(path) else None
        self.seen: dict[str, list[int]] = {}
        self.bytes: list[bytes] | None = None

    def _piece(self, piece: str) -> list[int]:
        ids = self.lib.encode(piece, add_special_tokens=False).ids
        if len(piece) <= LONGEST:
            if len(self.seen) >= REMEMBERED:
                self.seen.clear()
            self.seen[piece] = ids
        return ids

    def encode(self, text: str | None) -> list[int]:
        if not text:
            return []
        if self.split is None or not text.isascii():
            return self.lib.encode(text, add_special_tokens=False).ids
        out: list[int] = []
        get, add = self.seen.get, out.extend
        for piece in self.split.findall(text):
            add(get(piece) or self._piece(piece))
        return out

    def table(self) -> list[bytes]:
        """Bytes of each id."""
        if self.bytes is None:
            of, n = byte_table(), self.lib.get_vocab_size()
            self.bytes = []
            for i in range(n):
                token = self.lib.id_to_token(i) or ""
                self.bytes.append(bytes(of[c] for c in token) if all(c in of for c in token) else token.encode())
        return self.bytes

    def decode(self, ids: list[int]) -> str:
        table = self.table()
        return b"".join([table[i] for i in ids]).decode("utf-8", "replace")

    def offsets(self, text: str, ids: list[int]) -> list[int]:
        """Start of each id in characters: the character that holds its first byte."""
        table, raw, at, out = self.table(), text.encode("utf-8", "surrogatepass"), 0, []
        if len(raw) == len(text):
            for i in ids:
                out.append(at)
                at += len(table[i])
            return out
        char, owner = -1, []
        for b in raw:
            char += (b & 0xC0) != 0x80
            owner.append(char)
        for i in ids:
            out.append(owner[at])
            at += len(table[i])
        return out


def encoder(path: str) -> Encoder:
    if path not in _loaded:
        _loaded[path] = Encoder(path)
    return _loaded[path]


def _ids(path: str):
    def run(batches):
        e = encoder(path)
        for b in batches:
            ids = [e.encode(t) for t in b.column("text").to_pylist()]
            yield pa.record_batch([b.column("doc_id"), pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "ids"])

    return run


def _round_trip(path: str):
    def run(batches):
        e = encoder(path)
        for b in batches:
            n, same, aligned = [], [], []
            for t in b.column("text").to_pylist():
                ids = e.encode(t)
                n.append(len(ids))
                same.append(e.decode(ids) == (t or ""))
                starts = e.offsets(t or "", ids)
                aligned.append(len(starts) == len(ids) and starts == sorted(starts))
            yield pa.record_batch([b.column("doc_id"), pa.array(n, pa.int32()), pa.array(same), pa.array(aligned)], names=["doc_id", "n_ids", "same", "aligned"])

    return run


def encode(documents: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id, ids`` of every document, without special tokens."""
    return documents.select("doc_id", "text").mapInArrow(_ids(path or default_path()), "doc_id bigint, ids array<int>")


def round_trip(documents: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id, n_ids, same, aligned``: whether decoding gives the text again and offsets never go back."""
    return documents.select("doc_id", "text").mapInArrow(_round_trip(path or default_path()), "doc_id bigint, n_ids int, same boolean, aligned boolean")
