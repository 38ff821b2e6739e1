"""Byte-level BPE vocabularies read from a public tokenizer file, and texts cut into pieces that encode on their own."""

from __future__ import annotations

import json
import re
from collections.abc import Callable

import regex

# Fixed values of the byte-level scheme: bytes that stand for themselves, and the split pattern.
_PLAIN = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

# Characters on which libraries could differ in what is a letter, a number or white space.
_UNSETTLED = re.compile(r"[\x1c-\x1f\x85\xa0\u0250-\U0010ffff]")


def byte_symbols() -> dict[str, int]:
    """The printable characters that stand for bytes in the vocabulary file."""
    out = {chr(b): b for b in _PLAIN}
    spare = 0x100
    for b in range(0x100):
        if chr(b) not in out or out[chr(b)] != b:
            out[chr(spare)] = b
            spare += 1
    return out


class Vocabulary:
    """Tokens by their bytes, and the special tokens that are cut out of texts first."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.path = path
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        names = sorted(self.special, key=len, reverse=True)
        self._cutter = re.compile("(" + "|".join(map(re.escape, names)) + ")") if names else None
        symbols = byte_symbols()
        self.ids = {bytes(symbols[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in self.special}
        self.merges = [tuple(bytes(symbols[c] for c in side) for side in (m.split(" ") if isinstance(m, str) else m)) for m in spec["model"]["merges"]]

    def cut(self, text: str) -> list[str]:
        """The text cut at special tokens: plain parts at even places, special tokens between them."""
        return self._cutter.split(text) if self._cutter and any(s in text for s in self.special) else [text]


class PieceEncoder:
    """Results of an encoder for the pieces of a text, keeping those of pieces seen before.

    A blank between two other characters that are no white space always starts a new word of the split pattern, and a line break
    between such characters is a word of its own, so texts can be cut there. Texts with runs of white space are encoded whole.
    ``encode(pieces)`` gets the pieces that have not been met for a while: the store holds two generations of at most ``room`` pieces.
    """

    def __init__(self, encode: Callable[[list[str]], list], room: int = 250_000):
        self.encode, self.room, self.young, self.old = encode, room, {"": False, "\n": False}, {}

    def warm(self, texts: list[str]) -> None:
        """Learn the new pieces of many texts at once."""
        new = {p for text in texts if text for p in text.replace("\n", " \n").split(" ")[1:] if p not in self.young}
        if new:
            self._learn(new)

    def parts(self, text: str) -> list:
        """Results of the pieces in order."""
        if not text:
            return []
        if text[0].isspace() or text[-1].isspace():
            return self.encode([text])
        first, *rest = text.replace("\n", " \n").split(" ")
        out = list(map(self.young.get, rest))
        if None in out:
            late = self._learn({p for p, got in zip(rest, out, strict=True) if got is None})
            out = [late[p] if got is None else got for p, got in zip(rest, out, strict=True)]
        # False marks a piece with white space at a border.
        return self.encode([text]) if False in out else [*self.encode([first]), *out]

    def _learn(self, pieces: set[str]) -> dict[str, object]:
        got = {p: self.old[p] for p in pieces if p in self.old}
        new = [p for p in pieces if p not in got]
        good = [p for p in new if not (p.lstrip("\n")[:1].isspace() or p[-1].isspace())]
        got.update(dict.fromkeys(new, False))
        got.update(zip(good, self.encode([p if p[0] == "\n" else " " + p for p in good]), strict=True))
        if len(self.young) + len(got) > self.room:
            self.old, self.young = self.young, {"": False, "\n": False}
        self.young.update(got)
        return got


_WORDS = regex.compile(PATTERN)


def words(text: str) -> list[str]:
    """Words of the split pattern."""
    return _WORDS.findall(text)


def settled(text: str) -> bool:
    """True if all libraries split the text alike."""
    return not _UNSETTLED.search(text)
