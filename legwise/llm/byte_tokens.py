"""Byte-level BPE counts and ids of whole texts, used by packing and token
counts. A vocabulary file of the ``tokenizers`` library is a parameter; its
ids equal merge ranks, so the same vocabulary runs as ranks."""

from __future__ import annotations

import array
import json
import re
from functools import lru_cache

import regex
import tiktoken
from tokenizers import Tokenizer

from legwise.llm.common import release

#: The published pre-token pattern of this tokenizer family.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

# The same pattern for texts of plain ASCII and Latin letters, with the classes
# spelt out, which the standard module scans faster.
_LETTER, _DIGIT = "A-Za-zªµºÀ-ÖØ-öø-ɏ", "0-9²³¹¼-¾"
_LATIN = re.compile(rf"'(?:[stmd]|re|ve|ll)| ?[{_LETTER}]+| ?[{_DIGIT}]+"
                    rf"| ?[^\s{_LETTER}{_DIGIT}]+|\s+(?!\S)|\s+")
_ANY = regex.compile(PATTERN)
_IS_LATIN = re.compile("[\t-\r -~ -ɏ]*").fullmatch

#: Most different pre-tokens whose ids a worker remembers.
REMEMBERED = 100_000


def any_pre_tokens(text: str, at: int = 0):
    """Matches of the pre-token pattern from ``at`` on; the pattern looks behind
    no match, so a scan may start at any boundary."""
    return _ANY.finditer(text, at)


def byte_alphabet() -> dict[str, int]:
    """Printable stand-in of every byte: printable Latin-1 stands for itself,
    the others follow from U+0100 in order."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Encoder(dict):
    """Pre-token -> its ids as packed unsigned 32-bit integers."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self._to_byte = to_byte = byte_alphabet()
        self._words = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
        ranks = {bytes(to_byte[c] for c in token): i for token, i in spec["model"]["vocab"].items()}
        self._encode = tiktoken.Encoding("vocabulary", pat_str=PATTERN, mergeable_ranks=ranks,
                                         special_tokens={})._core_bpe.encode_single_piece
        self.special = {t["content"]: array.array("I", [t["id"]]).tobytes()
                        for t in spec["added_tokens"]}
        names = "|".join(re.escape(s) for s in sorted(self.special, key=len, reverse=True))
        self._special = re.compile(f"({names})") if names else None
        del spec, ranks
        release()  # what reading the file has taken

    def __missing__(self, piece: str) -> bytes:
        ids = self._packed(piece.encode())
        if len(self) < REMEMBERED and len(piece) < 64:
            self[piece] = ids
        return ids

    def _packed(self, raw: bytes) -> bytes:
        return array.array("I", self._encode(raw)).tobytes()

    def ids(self, text: str) -> bytes:
        """Packed ids of a whole text; special tokens in it get their own id."""
        if self._special is not None and "<|" in text:
            return b"".join(self.special.get(part) or self._plain(part)
                            for part in self._special.split(text))
        return self._plain(text)

    def _plain(self, text: str) -> bytes:
        if _IS_LATIN(text):
            return b"".join(map(self.__getitem__, _LATIN.findall(text)))
        to_byte = self._to_byte
        return b"".join([self._packed(bytes([to_byte[c] for c in word]))
                         for word, _ in self._words(text)])


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)
