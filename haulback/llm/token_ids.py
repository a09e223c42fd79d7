"""Token ids of whole texts by a byte-level BPE of the ``tokenizers`` library.

A byte-level BPE first cuts a text by a fixed pattern and then merges inside each cut only. A single space or
newline between two other characters always starts a cut, so the ids of a text are those of its space-separated
pieces in turn. Pieces recur far more often than texts: their ids are kept in a dictionary of bounded size.
What isn't a plain word goes to the library's ``encode`` as it is.
"""

from __future__ import annotations

import functools
import re
import sys
from array import array

import public_tokenizers
from tokenizers import Tokenizer

DEFAULT_TOKENIZER = "byte_bpe_50k.json"

#: Pieces remembered by one Python worker; two generations of half of it.
KEPT_PIECES = 1_000_000

#: Punctuation that forms a cut of its own after a word; without the apostrophe, which starts contractions.
_TAIL = ".,;:!?|&#*$%()[]{}<>-_/\\\"+=~^@`"

if sys.byteorder != "little" or array("I").itemsize != 4:
    raise ImportError("ids are kept as little-endian 32-bit integers")

_SINGLE_SPACE = re.compile(r"(?<=\S) (?=\S)")


def tokenizer_path(name: str = DEFAULT_TOKENIZER) -> str:
    """Where a public vocabulary lies; a path is returned as it is."""
    return name if "/" in name else public_tokenizers.path(name)


def _byte_letters() -> list[str]:
    """The printable character which stands for each byte in a byte-level vocabulary."""
    shown = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = [b for b in range(256) if b not in shown]
    return [chr(256 + rest.index(b)) if b in rest else chr(b) for b in range(256)]


class _NeedsCare(Exception):
    """A piece that touches other white space: the text must be cut more carefully."""


class _Pieces(dict):
    """Ids, as little-endian unsigned 32-bit bytes, of pieces that follow ``lead``."""

    def __init__(self, encoder: TextEncoder, lead: str):
        self.encoder, self.lead, self.older = encoder, lead, {}
        self.letter = encoder.letters[ord(lead)] if lead else ""
        self.tails: dict[str, bytes] = {}

    def __missing__(self, piece: str) -> bytes:
        found = self.older.get(piece)
        if found is None and self.lead and piece[:1] == "\n":
            found = self.encoder.newline + self.encoder.bare[piece[1:]]  # a newline takes the lead's place
        if found is None:
            core = piece.rstrip(_TAIL)
            if core.isalpha() and (core.isascii() or max(core) <= "ɏ"):
                if len(core) < len(piece):
                    found = self[core] + self._tail(piece[len(core):])
                else:
                    encoder = self.encoder
                    letters = core if core.isascii() else core.encode().decode("latin-1").translate(encoder.letters)
                    found = array("I", [t.id for t in encoder.tokenize(self.letter + letters)]).tobytes()
            else:
                if not piece or piece[0].isspace() or piece[-1].isspace():
                    raise _NeedsCare
                if "\n" in piece:
                    return self._lines(piece)
                found = self.encoder.library(self.lead + piece)
        if len(self) >= KEPT_PIECES // 2:
            self.older = dict(self)
            self.clear()
        self[piece] = found
        return found

    def _tail(self, tail: str) -> bytes:
        if len(self.tails) > 10_000:
            self.tails.clear()
        if tail not in self.tails:
            self.tails[tail] = self.encoder.library(tail)
        return self.tails[tail]

    def _lines(self, piece: str) -> bytes:
        lines = piece.split("\n")
        if any(not x or x[0].isspace() or x[-1].isspace() for x in lines):
            return self.encoder.library(self.lead + piece)
        bare = self.encoder.bare
        return self.encoder.newline.join([self[lines[0]], *[bare[x] for x in lines[1:]]])


class TextEncoder:
    """``tokenizers`` ids of texts, equal to ``encode(text, add_special_tokens=False)``."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenize = self.tokenizer.model.tokenize
        self.letters = dict(enumerate(_byte_letters()))
        self._special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.spaced, self.bare = _Pieces(self, " "), _Pieces(self, "")
        self.newline = self.library("\n")

    def library(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def __call__(self, text: str | None) -> bytes:
        """Ids of a whole text as little-endian unsigned 32-bit bytes; none for null or empty."""
        if not text:
            return b""
        if any(s in text for s in self._special):
            return self.library(text)
        try:
            return self._joined(text.replace("\n", " \n").split(" "))
        except _NeedsCare:
            pass
        pieces = _SINGLE_SPACE.split(text)
        out = []
        for k, piece in enumerate(pieces):
            try:
                out.append((self.spaced if k else self.bare)[piece])
            except _NeedsCare:
                out.append(self.library((" " if k else "") + piece))
        return b"".join(out)

    def _joined(self, pieces: list[str]) -> bytes:
        first = self.bare[pieces[0]]
        return first + b"".join(map(self.spaced.__getitem__, pieces[1:]))


@functools.lru_cache(maxsize=2)
def text_encoder(path: str) -> TextEncoder:
    """One encoder for each Python worker."""
    return TextEncoder(path)
