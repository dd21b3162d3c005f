"""Operator 5: token counts that follow edits.

Each document has a segment tree over its pre-tokens: a leaf covers up to LEAF
consecutive pre-tokens with their characters and tokens, inner nodes hold sums.
A heap layout in two arrays (characters, tokens) stores it in one row.

An edit replaces ``removed`` characters at ``start`` by ``inserted``. Descending
by characters finds the leaf that holds the last character the pre-tokeniser
could still have judged differently (it looks LOOKAHEAD characters ahead), and
pre-tokens are encoded again from there until a boundary coincides with a leaf
boundary behind the edit: from a boundary on, the pre-tokens depend only on the
text behind it. Only that region is encoded; sums change on the paths of the
touched leaves, or are added up again when the number of leaves changes.

A document's edits are applied in the order of ``seq``; starts and lengths are
clipped to the text as it stands then. :func:`apply_edits` gathers the edits of
one document into one row, beside its text.

Defined results: a null text counts as empty and has 0 tokens; documents without
edits keep their tree; edits of unknown documents are ignored; null numbers
count as 0 and a null insertion as empty; special tokens written in a text are
ordinary text. ``doc_id`` must be a key where edits are given; count() takes
repeated rows and null ids as they come.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from legwise.llm.byte_tokens import Encoder, any_pre_tokens, encoder

LEAF = 64
#: Characters behind a pre-token that can change where it ends: the longest
#: contraction, or white space before a word.
LOOKAHEAD = 3

TREE = "chars array<int>, tokens array<int>"


def _heap(leaves: list[int]) -> list[int]:
    """Sums in heap order: node k has the children 2k + 1 and 2k + 2."""
    size = 1
    while size < len(leaves):
        size *= 2
    heap = [0] * (size - 1) + leaves + [0] * (size - len(leaves))
    for k in range(size - 2, -1, -1):
        heap[k] = heap[2 * k + 1] + heap[2 * k + 2]
    return heap


class Tree:
    def __init__(self, chars: list[int], tokens: list[int]):
        self.chars, self.tokens = chars, tokens
        self.base = len(chars) // 2  # place of the first leaf

    @classmethod
    def of_leaves(cls, leaves: list[tuple[int, int]]) -> Tree:
        return cls(_heap([c for c, _ in leaves] or [0]), _heap([t for _, t in leaves] or [0]))

    def leaves(self) -> list[tuple[int, int]]:
        out = list(zip(self.chars[self.base:], self.tokens[self.base:]))
        while out and out[-1] == (0, 0):
            out.pop()
        return out

    def find(self, at: int) -> tuple[int, int]:
        """The leaf that holds character ``at`` and where it begins."""
        k, begin = 0, 0
        while k < self.base:
            k = 2 * k + 1
            if at >= begin + self.chars[k] and self.chars[k + 1]:
                begin, k = begin + self.chars[k], k + 1
        return k - self.base, begin

    def splice(self, first: int, last: int, new: list[tuple[int, int]]) -> Tree:
        """Replaces the leaves first..last - 1."""
        if len(new) != last - first:
            old = self.leaves()
            return Tree.of_leaves(old[:first] + new + old[last:])
        for k, (c, t) in enumerate(new, self.base + first):
            dc, dt = c - self.chars[k], t - self.tokens[k]
            while True:
                self.chars[k] += dc
                self.tokens[k] += dt
                if not k:
                    break
                k = (k - 1) // 2
        return self


def _segments(encode: Encoder, text: str, begin: int, stop=None):
    """Leaves of the pre-tokens from ``begin`` on; ``stop`` tells at a boundary
    whether what follows is known. Returns the leaves and the last boundary."""
    leaves, chars, tokens, n, at = [], 0, 0, 0, begin
    for match in any_pre_tokens(text, begin):
        if stop is not None and stop(at):
            break
        chars += match.end() - at
        tokens += len(encode[match.group()]) // 4
        at, n = match.end(), n + 1
        if n == LEAF:
            leaves.append((chars, tokens))
            chars = tokens = n = 0
    if n:
        leaves.append((chars, tokens))
    return leaves, at


def build(encode: Encoder, text: str) -> Tree:
    return Tree.of_leaves(_segments(encode, text, 0)[0])


def edit(encode: Encoder, tree: Tree, text: str, start: int, removed: int, inserted: str) -> tuple[Tree, str, int]:
    """The tree and text after one edit, and how many characters were encoded."""
    start = min(max(start, 0), len(text))
    end = min(start + max(removed, 0), len(text))
    changed = text[:start] + inserted + text[end:]
    moved = len(changed) - len(text)
    first, begin = tree.find(max(0, start - LOOKAHEAD - 1))
    n_leaves = len(tree.leaves())
    last, bound = first, begin  # the old leaf boundary not yet passed by the scan

    def known(at: int) -> bool:
        nonlocal last, bound
        while last < n_leaves and (bound + moved < at or bound < end):
            bound += tree.chars[tree.base + last]
            last += 1
        return bound >= end and bound + moved == at and at >= start + len(inserted)

    new, at = _segments(encode, changed, begin, known)
    if not known(at):  # the scan ran to the end of the text
        last = n_leaves
    return tree.splice(first, min(last, n_leaves), new), changed, at - begin


def count(df: DataFrame, vocabulary: str, text_col: str = "text") -> DataFrame:
    """``df`` with its trees (struct ``tree``) and ``n_tokens``."""
    @F.arrow_udf(f"struct<{TREE.replace(' ', ':', 1).replace(', tokens ', ',tokens:')}>")
    def trees(texts: pa.Array) -> pa.Array:
        encode = encoder(vocabulary)
        made = [build(encode, t.as_py() or "") for t in texts]
        return pa.StructArray.from_arrays([pa.array([t.chars for t in made], pa.list_(pa.int32())),
                                           pa.array([t.tokens for t in made], pa.list_(pa.int32()))],
                                          names=["chars", "tokens"])
    return (df.withColumn("tree", trees(F.col(text_col).cast("string")))
            .withColumn("n_tokens", F.col("tree.tokens")[0].cast("long")))


def _edited(vocabulary: str):
    def run(batches):
        encode = encoder(vocabulary)
        for batch in batches:
            chars, tokens, texts, again = [], [], [], []
            for row in batch.select(["text", "tree", "edits"]).to_pylist():
                tree, text, done = Tree(row["tree"]["chars"], row["tree"]["tokens"]), row["text"] or "", 0
                for e in row["edits"] or []:
                    tree, text, n = edit(encode, tree, text, e["start"] or 0, e["removed"] or 0, e["inserted"] or "")
                    done += n
                chars.append(tree.chars)
                tokens.append(tree.tokens)
                texts.append(text)
                again.append(done)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_before"), pa.array([t[0] for t in tokens], pa.int64()),
                 pa.array(again, pa.int64()), pa.array(texts, pa.string()),
                 pa.array(chars, pa.list_(pa.int32())), pa.array(tokens, pa.list_(pa.int32()))],
                names=["doc_id", "n_before", "n_tokens", "n_encoded_chars", "text", "chars", "tokens"])
    return run


def recount(counted: DataFrame, vocabulary: str) -> DataFrame:
    """counted: doc_id, text, tree, n_tokens and ``edits``, an array of (start,
    removed, inserted) in order, or null. Returns doc_id, n_before, n_tokens,
    n_encoded_chars, the edited text and its tree (chars, tokens)."""
    id_type = counted.schema["doc_id"].dataType.simpleString()
    return (counted.select("doc_id", "text", "tree", F.col("n_tokens").alias("n_before"), "edits")
            .mapInArrow(_edited(vocabulary), f"doc_id {id_type}, n_before long, n_tokens long, n_encoded_chars long, "
                                             f"text string, {TREE}"))


def apply_edits(counted: DataFrame, edits: DataFrame, vocabulary: str) -> DataFrame:
    """Applies a table of edits (doc_id, seq, start, removed, inserted)."""
    listed = (edits.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct(
        "seq", "start", "removed", "inserted"))).alias("edits"))
        .withColumn("edits", F.transform("edits", lambda e: F.struct(e["start"], e["removed"], e["inserted"]))))
    return recount(counted.join(listed, "doc_id", "left"), vocabulary)
