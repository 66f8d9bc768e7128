"""Whole texts to the ids of a tokenizers file, word by word.

For tokenizers that drop white space and never join across it, a text's ids are those of its
blank-separated chunks. Chunks are remembered by a worker across tasks. A chunk seen first is cut at the
borders of its letter runs, unless an apostrophe, a mark to be composed or a special token may reach
across one; a run of
composed Latin letters goes to the merge model directly, everything else through the whole tokenizer.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from array import array
from codecs import charmap_decode

from riskrules.llm.common import Remembered

_RUNS = re.compile(r"[^\W\d_]+|[\W\d_]+")
_CLOSING = b".,;:!?)"  # marks that close a word, and are a piece of their own


def _byte_letters() -> dict[int, int]:
    """Byte-level alphabet: printable Latin-1 bytes stand for themselves, the others follow from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: b for b in plain} | {b: 256 + i for i, b in enumerate(rest)}


class Encoder:
    """``encode(text)`` gives the ids as little-endian bytes of type ``kind``."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.kind = "<u2" if self.size <= 1 << 16 else "<u4"
        self.code = "H" if self.kind == "<u2" else "I"
        self.chunks = Remembered(self.one)
        letters = _byte_letters()
        self.letters = "".join(chr(letters[b]) for b in range(256))
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        # Both hold for lower-casing byte-level tokenizers with letter runs as words; else all goes the long way.
        probe = "Zürich straße façade the"
        self.short = self.tokenizer.encode(probe, add_special_tokens=False).ids == [i for w in probe.lower().encode().split() for i in self._merged(w)]
        closed = [self.tokenizer.encode(f"word{a}{_CLOSING.decode()}", add_special_tokens=False).ids for a in ("", " ")]
        self.short = self.short and closed[0] == closed[1]

    def _merged(self, word: bytes) -> list[int]:
        return [t.id for t in self.model.tokenize(charmap_decode(word, "strict", self.letters)[0])]

    def _bytes(self, ids: list[int]) -> bytes:
        out = array(self.code, ids)
        if sys.byteorder == "big":
            out.byteswap()
        return out.tobytes()

    def _run(self, data: bytes) -> bytes | None:
        """Ids of a run of composed Latin letters; None for other chunks."""
        if not data.isalpha():  # ASCII letters
            text = data.decode(errors="replace")
            if not (text.isalpha() and max(text) < "ɐ" and unicodedata.is_normalized("NFC", text)):
                return None
            low = text.lower()
            if not low.isalpha():  # one capital becomes a letter and a mark
                return None
            data = low.encode()
        return self._bytes(self._merged(data.lower()))

    def one(self, data: bytes) -> bytes:
        """The ids of one blank-free chunk, worked out anew."""
        if self.short:
            word = data.rstrip(_CLOSING)
            found = self._run(word)
            if found is not None:
                return found if len(word) == len(data) else found + self.chunks[data[len(word) :]]
        text = data.decode(errors="replace")  # bytes that are not UTF-8 become the replacement mark
        # The lower case of a dotted capital I ends in a mark, which may join what follows.
        if self.short and not ("'" in text or "\u0130" in text or not unicodedata.is_normalized("NFC", text) or any(s in text for s in self.special)):
            runs = _RUNS.findall(text)
            if len(runs) > 1:
                return b"".join([self.chunks[r.encode()] for r in runs])
        return self._bytes(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def encode(self, text: bytes) -> bytes:
        # A special token's text must not arise by lower-casing.
        chunks = text.split() if not self.short or b"<" in text else text.lower().split()
        return b"".join(map(self.chunks.__getitem__, chunks))


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder per file and worker."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def forget() -> None:
    """Free a worker's encoders with the chunks they remember; the next use reads the file again."""
    _ENCODERS.clear()
