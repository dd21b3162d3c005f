"""Operator 3: BPE encoding by backtracking, decoding by an offset table.

Encoding. Words are taken as the vocabulary's normaliser and splitter define
them. Within a word the exact merge result is the one segmentation in which
every neighbouring pair of tokens is compatible, i.e. merging their joined
spelling gives back just these two. An Aho-Corasick automaton over the reversed
token spellings lists, for every start position, the tokens beginning there,
longest first. The encoder walks left to right, takes the longest token that is
compatible with its left neighbour, and steps back when none fits; a position
that has failed once is never entered again, so the work is linear.

Decoding. All token spellings lie in one byte buffer; an offset table gives the
slice of each id, and a batch of ids is one gather.

Defined results: null and empty texts give no ids and decode to the empty text;
special tokens written in a text get their own id; repeated rows, null ids and
other columns pass through unchanged.
"""

from __future__ import annotations

import json
import re
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from legwise.llm.byte_tokens import byte_alphabet

#: Most different words whose ids a worker remembers.
REMEMBERED = 400_000
#: Bytes of decoded text made at a time.
DECODE_SLICE = 1 << 22

# The vocabulary's own splitting, spelt out for texts of plain ASCII and Latin
# letters; other texts go through the library's normaliser and splitter.
_LETTER, _DIGIT = "A-Za-zªµºÀ-ÖØ-öø-įı-ʯ", "0-9²³¹¼-¾"
_LATIN = re.compile(rf"'(?:[stmd]|re|ve|ll)|[{_LETTER}]+|[{_DIGIT}]|[^\s{_LETTER}{_DIGIT}]+")
_IS_LATIN = re.compile("[\t-\r -~ -įı-ɏ]*").fullmatch
#: Ends a spelling that closes a word; not part of the byte alphabet.
_END = "\x00"


class WordBpe(dict):
    """Word -> packed ids, filled by backtracking."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, self._suffix = spec["model"], spec["model"]["end_of_word_suffix"]
        self._byte_char = {b: c for c, b in byte_alphabet().items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self._special = re.compile("(%s)" % "|".join(map(re.escape, self.special))) if self.special else None
        library = Tokenizer.from_file(path)
        self._normal, self._words = library.normalizer.normalize_str, library.pre_tokenizer.pre_tokenize_str

        # Tokens get numbers in merge order: units first, then merges by rank.
        vocab, merges = model["vocab"], [tuple(m) if isinstance(m, list) else tuple(m.split(" "))
                                         for m in model["merges"]]
        made = ["".join((a.removesuffix(self._suffix) if b else a, b)) for a, b in merges]
        merged = set(made)
        units = [t for t in vocab if t not in merged]
        self._spelling = [self._mark(t) for t in units + made]
        number = {s: i for i, s in enumerate(self._spelling)}
        self._id = np.array([vocab[t] for t in units + made], np.uint32)
        self._length = [len(s) for s in self._spelling]
        self._parts = [(i, i) for i in range(len(units))]
        self._merge: dict[tuple[int, int], int] = {}
        for i, (a, b) in enumerate(merges):
            pair = (number[self._mark(a)], number[self._mark(b)])
            self._parts.append(pair)
            self._merge[pair] = len(units) + i
        self._compatible: dict[tuple[int, int], bool] = {}

        self._automaton = ahocorasick.Automaton()
        for i, s in enumerate(self._spelling):
            self._automaton.add_word(s[::-1], i)
        self._automaton.make_automaton()

        texts = dict.fromkeys(range(max([*vocab.values(), *self.special.values()]) + 1), "")
        texts |= {i: t for t, i in vocab.items()} | {i: t for t, i in self.special.items()}
        raw = [f"{texts[i]} ".encode() for i in sorted(texts)]
        self.table = np.frombuffer(b"".join(raw), np.uint8)
        self.offsets = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)

    def _mark(self, token: str) -> str:
        return token.removesuffix(self._suffix) + _END if token.endswith(self._suffix) else token

    def _fit(self, left: int, right: int) -> bool:
        """Whether the merges of the joined spelling keep the cut between them.

        Undo the later of the two last merges step by step: a merge across the
        cut breaks the pair if it comes before the merge that was undone.
        """
        key = (left, right)
        known = self._compatible.get(key)
        if known is not None:
            return known
        parts, merge, before, good = self._parts, self._merge, len(self._parts), True
        while True:
            across = merge.get((left, right))
            if across is not None and across < before:
                good = False
                break
            a, b = parts[left], parts[right]
            left_is_unit, right_is_unit = a[0] == left, b[0] == right
            if left_is_unit and right_is_unit:
                break
            if right_is_unit or (not left_is_unit and left > right):
                before, left = left, a[1]
            else:
                before, right = right + 1, b[0]
        if len(self._compatible) < 4 * REMEMBERED:
            self._compatible[key] = good
        return good

    def segment(self, spelled: str) -> list[int]:
        """Token numbers of one spelled word."""
        n = len(spelled)
        starts: list[list[int]] = [[] for _ in range(n)]  # the automaton reports longer tokens first
        for end, token in self._automaton.iter(spelled[::-1]):
            starts[n - 1 - end].append(token)
        path: list[tuple[int, int]] = []  # (token, place among the options)
        open_at = [True] * (n + 1)
        at, option = 0, 0
        while at < n:
            options = starts[at]
            while option < len(options):
                token = options[option]
                if open_at[at + self._length[token]] and (not path or self._fit(path[-1][0], token)):
                    break
                option += 1
            if option < len(options):
                path.append((token, option))
                at, option = at + self._length[token], 0
            else:
                open_at[at] = False
                token, option = path.pop()
                at, option = at - self._length[token], option + 1
        return [token for token, _ in path]

    def __missing__(self, word: str) -> bytes:
        chars = self._byte_char
        ids = self._spelled("".join([chars[b] for b in word.encode()]))
        if len(self) < REMEMBERED and len(word) < 64:
            self[word] = ids
        return ids

    def _spelled(self, spelled: str) -> bytes:
        return self._id[self.segment(spelled + _END)].tobytes()

    def ids(self, text: str) -> bytes:
        if self._special is not None and "<|" in text:
            return b"".join(self.special[p].to_bytes(4, "little") if p in self.special else self._plain(p)
                            for p in self._special.split(text))
        return self._plain(text)

    def _plain(self, text: str) -> bytes:
        if _IS_LATIN(text):
            return b"".join(map(self.__getitem__, _LATIN.findall(text.lower())))
        return b"".join([self._spelled(w) for w, _ in self._words(self._normal(text))])

    def decode(self, ids: np.ndarray, at: np.ndarray) -> pa.Array:
        """Texts of the id lists ids[at[i]:at[i + 1]]: token spellings joined by
        one space."""
        length = self.offsets[ids + 1] - self.offsets[ids]
        ends = np.concatenate([[0], np.cumsum(length)])
        out = np.empty(int(ends[-1]), np.uint8)
        lo = 0
        while lo < len(ids):
            hi = max(lo + 1, int(np.searchsorted(ends, ends[lo] + DECODE_SLICE, side="right")) - 1)
            shift = np.repeat(self.offsets[ids[lo:hi]] - (ends[lo:hi] - ends[lo]), length[lo:hi])
            out[ends[lo]:ends[hi]] = self.table[shift + np.arange(len(shift))]
            lo = hi
        cuts = ends[at]
        data = pa.LargeStringArray.from_buffers(len(at) - 1, pa.py_buffer(cuts.astype(np.int64)), pa.py_buffer(out))
        return pc.replace_substring_regex(data, " $", "")  # the joint after the last token


@lru_cache(maxsize=2)
def word_bpe(path: str) -> WordBpe:
    return WordBpe(path)


def encode(df: DataFrame, vocabulary: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """``df`` with a column of token ids."""
    @F.arrow_udf("array<int>")
    def run(texts: pa.Array) -> pa.Array:
        bpe = word_bpe(vocabulary)
        packed = [bpe.ids(t.as_py() or "") for t in texts]
        at = np.concatenate([[0], np.cumsum([len(p) // 4 for p in packed], dtype=np.int64)])
        return pa.ListArray.from_arrays(pa.array(at, pa.int32()),
                                        pa.array(np.frombuffer(b"".join(packed), np.int32)))
    return df.withColumn(ids_col, run(F.col(text_col).cast("string")))


def decode(df: DataFrame, vocabulary: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """``df`` with the text that a column of ids decodes to."""
    @F.arrow_udf("string")
    def run(ids: pa.Array) -> pa.Array:
        at = np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(ids), 0).to_numpy(False))])
        flat = ids.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        return word_bpe(vocabulary).decode(flat, at.astype(np.int64)).cast(pa.string())
    return df.withColumn(out_col, run(F.col(ids_col)))
