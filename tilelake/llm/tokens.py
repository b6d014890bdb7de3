"""Tokenising whole texts with the tokenizers library, each distinct pre-token once per worker.

The pre-tokens of a text in the Latin blocks are cut by the pattern that the vocabulary file names; the library's model
encodes each distinct one, and a bounded table keeps the ids as bytes. Texts with other characters, or with characters on
whose class two Unicode tables may differ, or with the string of a special token, go to the library whole. Both ways give
the ids of Tokenizer.encode(text, add_special_tokens=False); tests compare them.
"""

from __future__ import annotations

import json
import re
import unicodedata

import numpy as np

_LATIN = range(0x180)  # lower case of these stays within, but for one that is left out
CACHE_BYTES = 120 << 20  # of known pre-tokens in a worker's table, of which there are two: it changes speed and memory, not ids
_ENTRY = 220  # bytes of an entry besides its characters and ids


def _class(prefix: str) -> str:
    return "".join(re.escape(chr(c)) for c in _LATIN if unicodedata.category(chr(c)).startswith(prefix))


def _byte_table() -> dict[int, str]:
    """Byte -> the printable character that byte-level vocabularies write for it."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class FastEncoder:
    """bytes of little-endian uint32 ids for texts. path: a byte-level BPE vocabulary file, with or without word ends."""

    def __init__(self, path: str, cache_bytes: int = CACHE_BYTES):
        from tokenizers import Tokenizer

        self.full = Tokenizer.from_file(path)
        with open(path) as f:
            spec = json.load(f)
        self.lower = spec["normalizer"] is not None
        letters, numbers = _class("L"), _class("N")
        if self.lower:
            cut = rf"'s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[{numbers}]|[^\s{letters}{numbers}]+"
        else:
            cut = rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{letters}]+| ?[{numbers}]+| ?[^\s{letters}{numbers}]+|\s+(?!\S)|\s+"
        self.cut = re.compile(cut)
        special = "|".join(re.escape(t["content"]) for t in spec["added_tokens"])
        self.other = re.compile(r"[^\x00-\x1b\x20-\x84\x86-įı-ſ]" + (f"|{special}" if special else ""))
        self.model, self.table = self.full.model, _byte_table()
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.held, self.most = 0, cache_bytes

    def _piece(self, piece: str) -> bytes:
        shown = piece.encode().decode("latin-1").translate(self.table)
        return b"".join([t.id.to_bytes(4, "little") for t in self.model.tokenize(shown)])

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if self.other.search(text):
            return np.array(self.full.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        pieces = self.cut.findall(text.lower() if self.lower else text)
        try:
            return b"".join(map(self.known.__getitem__, pieces))
        except KeyError:
            return self._learn(pieces)

    def _learn(self, pieces: list[str]) -> bytes:
        """Ids of pieces some of which are not known. A full table becomes the older one, from which pieces in use come back."""
        if self.held > self.most:
            self.older, self.known, self.held = self.known, {}, 0
        known, older = self.known, self.older
        new = {p: older.get(p) or self._piece(p) for p in set(pieces).difference(known)}
        size = _ENTRY * len(new) + sum(map(len, new)) + sum(map(len, new.values()))
        if size > self.most:  # one text alone has more
            return b"".join([new[p] if p in new else known[p] for p in pieces])
        self.held += size
        known.update(new)
        return b"".join(map(known.__getitem__, pieces))


_ENCODERS: dict[tuple[str, int], FastEncoder] = {}


def encoder(vocabulary: str, cache_bytes: int = CACHE_BYTES) -> FastEncoder:
    """The worker's encoder for a file name of public_tokenizers, or for a path."""
    key = vocabulary, cache_bytes
    if key not in _ENCODERS:
        path = vocabulary
        if "/" not in vocabulary:
            import public_tokenizers

            path = public_tokenizers.path(vocabulary)
        _ENCODERS[key] = FastEncoder(path, cache_bytes)
    return _ENCODERS[key]
