"""A byte-level BPE vocabulary and the cutting of a text into pieces that merges never cross."""

from __future__ import annotations

import json
import re
from dataclasses import dataclass, field
from functools import cache

import regex

# The cutting pattern that byte-level vocabularies of this kind are made for.
WHITE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
CONTRACTIONS = ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d")
PIECE = regex.compile(
    "|".join(CONTRACTIONS)
    + rf"| ?\p{{L}}+| ?\p{{N}}+| ?[^{WHITE}\p{{L}}\p{{N}}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+"
)
# Coarser: a word with what touches it, or white space. Every cut of this one is a cut of PIECE.
CHUNK = re.compile(rf" ?[^{WHITE}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]")


def byte_alphabet() -> dict[str, int]:
    """The character that stands for each byte in the vocabulary file, and the byte.

    Printable characters of Latin-1 stand for themselves; the other bytes take
    the characters from 256 on, in order.
    """
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


@dataclass
class Vocabulary:
    """ids by bytes, bytes by id, merged pairs in the order of their ranks, special strings."""

    ids: dict[bytes, int]
    pieces: list[bytes]
    merges: list[tuple[int, int, int]]
    special: dict[str, int]
    cutter: re.Pattern | None = field(default=None)

    def chunks(self, text: str) -> list[str]:
        """The text's chunks in order; a special string is one of them."""
        if self.cutter is None or not self.cutter.search(text):
            return CHUNK.findall(text)
        out: list[str] = []
        for part in self.cutter.split(text):
            out.extend([part] if part in self.special else CHUNK.findall(part))
        return out


@cache
def load(path: str) -> Vocabulary:
    """Read a tokenizers file; the vocabulary is kept for the worker's later tasks."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    alphabet = byte_alphabet()
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    ids = {bytes(alphabet[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in special}
    pieces = [b""] * (max([*ids.values(), *special.values()]) + 1)
    for t, i in ids.items():
        pieces[i] = t
    for t, i in special.items():
        pieces[i] = t.encode()
    merges = []
    for pair in spec["model"]["merges"]:
        left, right = pair if isinstance(pair, list) else pair.split(" ")
        a, b = (bytes(alphabet[c] for c in x) for x in (left, right))
        merges.append((ids[a], ids[b], ids[a + b]))
    longest_first = sorted(special, key=len, reverse=True)
    cutter = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")") if special else None
    return Vocabulary(ids, pieces, merges, special, cutter)
