"""Operator 8: license scan by an exact set-similarity join.

Templates are whole license notices, as sets of runs of three words; the base
phrases are sets of words. Texts are cut into overlapping blocks, long enough that
any run as long as the longest template lies in one block. A block meets a template
when it holds at least the template's threshold of the template's set.

The elements of the templates are ordered by their frequency over all texts (a
grouped count of these elements only). A block can meet a template only if it holds
one of the template's first |t| - need + 1 elements in that order (prefix filter),
has ``need`` elements (length filter), and holds enough prefix elements that those
after the prefix can make up the rest (positional filter). What passes is verified
exactly. Every text and every block is looked at; the templates are a short fixed
table, so they travel with the task and nothing is shuffled but element counts.

Base phrases are templates with threshold 1; their places (consecutive words)
are read from the blocks that meet them. For notices, ``notices`` tells the words
of the block from the first to the last that belong to the notice, and the share of
the notice that they hold; blocks that overlap may report one notice twice.

Defined results: a null or empty text has no words, no places (null first and
last word), empty labels and score 0; repeated rows and null ids are rows of
their own; an empty table gives an empty result; other columns are not read; words
and runs are compared by 64-bit hashes.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from legwise.llm.common import lower, mix, powers, slices, text_bytes, word_hashes

SLICE = 1 << 20
#: Words of an element of a notice.
RUN = 3


@dataclass(frozen=True)
class Template:
    label: str
    words: str
    threshold: float
    base: bool = False


# The base phrases, then the published notices of common licenses.
TEMPLATES = (
    Template("cc-by", "cc by", 1.0, base=True),
    Template("gpl", "general public license", 1.0, base=True),
    Template("reserved", "all rights reserved", 1.0, base=True),
    Template("apache-2.0", "licensed under the apache license version 2 0 the license you may not use this file "
             "except in compliance with the license you may obtain a copy of the license at http www apache org "
             "licenses license 2 0 unless required by applicable law or agreed to in writing software distributed "
             "under the license is distributed on an as is basis without warranties or conditions of any kind either "
             "express or implied see the license for the specific language governing permissions and limitations "
             "under the license", 0.75),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted "
             "provided that the following conditions are met redistributions of source code must retain the above "
             "copyright notice this list of conditions and the following disclaimer redistributions in binary form "
             "must reproduce the above copyright notice this list of conditions and the following disclaimer in the "
             "documentation and or other materials provided with the distribution", 0.75),
    Template("cc-by-4.0", "this work is licensed under the creative commons attribution 4 0 international license "
             "to view a copy of this license visit http creativecommons org licenses by 4 0", 0.75),
    Template("gpl", "this program is free software you can redistribute it and or modify it under the terms of the "
             "gnu general public license as published by the free software foundation either version 3 of the "
             "license or at your option any later version this program is distributed in the hope that it will be "
             "useful but without any warranty without even the implied warranty of merchantability or fitness for a "
             "particular purpose see the gnu general public license for more details", 0.75),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without "
             "fee is hereby granted provided that the above copyright notice and this permission notice appear in "
             "all copies", 0.75),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software "
             "and associated documentation files the software to deal in the software without restriction including "
             "without limitation the rights to use copy modify merge publish distribute sublicense and or sell "
             "copies of the software and to permit persons to whom the software is furnished to do so subject to "
             "the following conditions the above copyright notice and this permission notice shall be included in "
             "all copies or substantial portions of the software", 0.75),
    Template("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy "
             "of the mpl was not distributed with this file you can obtain one at http mozilla org mpl 2 0", 0.75),
    Template("unlicense", "this is free and unencumbered software released into the public domain anyone is free to "
             "copy modify publish use compile sell or distribute this software either in source code form or as a "
             "compiled binary for any purpose commercial or non commercial and by any means", 0.75),
)


def _words(data: np.ndarray, at: np.ndarray):
    low = lower(data)
    word = (low >= 128) | ((low >= 97) & (low <= 122)) | ((low >= 48) & (low <= 57))
    return word_hashes(low, ~word, at)


def _known(hashes: np.ndarray, vocabulary: np.ndarray) -> np.ndarray:
    """Place of each word in the sorted vocabulary, or -1."""
    place = np.minimum(np.searchsorted(vocabulary, hashes), len(vocabulary) - 1)
    return np.where(vocabulary[place] == hashes, place, -1)


def _runs(doc: np.ndarray, words: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(text number, hash) of the runs of ``width`` words; the i-th run of a text
    begins with its i-th word."""
    if width == 1 or len(words) < width:
        return (doc, words) if width == 1 else (doc[:0], words[:0])
    factor, n = powers(0xBF58476D1CE4E5B9, width + 1)[1:], len(words) - width + 1
    total = mix(sum(words[j:n + j] * factor[j] for j in range(width)))
    inside = doc[width - 1:] == doc[:n]
    return doc[:n][inside], total[inside]


def _hashes(words: str, width: int) -> np.ndarray:
    data = np.frombuffer(words.encode(), np.uint8)
    return _runs(*_words(data, np.array([0, len(data)])), width)[1]


def _width(t: Template) -> int:
    return 1 if t.base else RUN


def _count(vocabulary: np.ndarray, width: int, other: np.ndarray, other_width: int):
    """Counts of the elements of both kinds: the words' numbers, then the runs'."""
    def run(batches):
        total = np.zeros(len(vocabulary) + len(other), np.int64)
        for batch in batches:
            data, at = text_bytes(batch.column("text"))
            for lo, hi in slices(at, SLICE):
                doc, words = _words(data[at[lo]:at[hi]], at[lo:hi + 1] - at[lo])
                for first, own, w in ((0, vocabulary, width), (len(vocabulary), other, other_width)):
                    known = _known(_runs(doc, words, w)[1], own)
                    total[first:first + len(own)] += np.bincount(known[known >= 0], minlength=len(own))
        yield pa.RecordBatch.from_pydict({"word": pa.array(np.arange(len(total))), "n": pa.array(total)})
    return run


class _Index:
    """Templates of one kind as element numbers, with their prefixes in frequency
    order."""

    def __init__(self, templates, vocabulary: np.ndarray, frequency: np.ndarray, width: int):
        self.vocabulary, self.templates, self.width = vocabulary, templates, width
        self.sequence = [_known(_hashes(t.words, width), vocabulary) for t in templates]
        self.sets, self.prefix, self.need = [], [], []
        for t, words in zip(templates, self.sequence):
            own = np.unique(words)
            own = own[np.lexsort((own, frequency[own]))]  # rarest first
            need = max(1, math.ceil(t.threshold * len(own) - 1e-9))
            self.sets.append(own)
            self.need.append(need)
            self.prefix.append(own[:len(own) - need + 1])
        self.stride = max(map(len, self.sequence), default=1)

    def meet(self, k: int, known, block, in_block):
        """Blocks that meet template k and the share of its words they hold.
        Words lie in block ``block`` and, but for a text's first stride, in the
        one before."""
        own, prefix, need = self.sets[k], self.prefix[k], self.need[k]

        def holdings(wanted, only=None):
            at = np.flatnonzero(np.isin(known, wanted))
            pair = np.concatenate([block[0][at], block[1][at]]), np.concatenate([known[at], known[at]])
            keep = pair[0] >= 0
            if only is not None:
                keep &= np.isin(pair[0], only)
            cell = np.unique(pair[0][keep] * len(self.vocabulary) + pair[1][keep])
            return np.unique(cell // len(self.vocabulary), return_counts=True)

        found, held = holdings(prefix)
        found = found[(in_block[found] >= need) & (held + len(own) - len(prefix) >= need)]
        if not len(found):
            return found, np.zeros(0)
        found, held = holdings(own, found)
        return found[held >= need], held[held >= need] / len(own)

    def places(self, k: int, known, doc, block, met) -> np.ndarray:
        """Word numbers where template k stands as consecutive words."""
        sequence = self.sequence[k]
        at = np.flatnonzero(known == sequence[0])
        at = at[at + len(sequence) <= len(known)]
        for j, word in enumerate(sequence[1:], 1):
            at = at[(known[at + j] == word) & (doc[at + j] == doc[at])]
        return at[np.isin(block[0][at], met)]


    def blocks(self, doc: np.ndarray, rows: int):
        """Of elements: their number in the text, the one or two blocks they lie
        in, the blocks' texts, first elements and sizes."""
        n = np.bincount(doc, minlength=rows)
        place = np.arange(len(doc)) - (np.cumsum(n) - n)[doc]
        count = -(-n // self.stride)
        start = np.cumsum(count) - count
        own = start[doc] + place // self.stride
        owner = np.repeat(np.arange(rows), count)
        begins = (np.arange(len(owner)) - start[owner]) * self.stride
        return place, (own, np.where(place >= self.stride, own - 1, -1)), owner, begins, np.minimum(n[owner] - begins, 2 * self.stride)


def _scan(indexes):
    def run(batches):
        for batch in batches:
            data, at = text_bytes(batch.column("text"))
            for lo, hi in slices(at, SLICE):
                yield _rows(*indexes, batch.column("doc_id").slice(lo, hi - lo),
                            data[at[lo]:at[hi]], at[lo:hi + 1] - at[lo])
    return run


def _rows(phrases: _Index, notices: _Index, ids: pa.Array, data, at) -> pa.RecordBatch:
    rows = len(at) - 1
    doc, words = _words(data, at)
    n_base, score = np.zeros(rows, np.int64), np.zeros(rows)
    low, high = np.full(rows, np.iinfo(np.int64).max), np.full(rows, -1)
    base: list[set] = [set() for _ in range(rows)]
    found: list[list] = [[] for _ in range(rows)]

    known = _known(words, phrases.vocabulary)
    place, block, owner, _, in_block = phrases.blocks(doc, rows)
    for k, t in enumerate(phrases.templates):
        places = phrases.places(k, known, doc, block, phrases.meet(k, known, block, in_block)[0])
        hit = doc[places]
        n_base += np.bincount(hit, minlength=rows)
        np.minimum.at(low, hit, place[places])
        np.maximum.at(high, hit, place[places])
        score[hit] = 1.0
        for d in np.unique(hit):
            base[d].add(t.label)

    run_doc, runs = _runs(doc, words, notices.width)
    known = _known(runs, notices.vocabulary)
    place, block, owner, begins, in_block = notices.blocks(run_doc, rows)
    for k, t in enumerate(notices.templates):
        met, share = notices.meet(k, known, block, in_block)
        np.maximum.at(score, owner[met], share)
        mine = np.flatnonzero(np.isin(known, notices.sets[k])) if len(met) else []
        for b, part in zip(met.tolist(), share.tolist()):
            own = place[mine][(block[0][mine] == b) | (block[1][mine] == b)]
            found[owner[b]].append({"label": t.label, "first_word": int(own.min()),
                                    "last_word": int(own.max()) + notices.width - 1, "share": part})
    none = high < 0
    labels = [sorted(b | {x["label"] for x in f}) for b, f in zip(base, found)]
    return pa.RecordBatch.from_arrays(
        [ids, pa.array(np.bincount(doc, minlength=rows), pa.int64()), pa.array(n_base),
         pa.array(low, pa.int64(), mask=none), pa.array(high, pa.int64(), mask=none),
         pa.array([",".join(sorted(x)) for x in base], pa.string()), pa.array([",".join(x) for x in labels], pa.string()),
         pa.array(score), pa.array(found, pa.list_(NOTICE))],
        names=["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "notices"])


NOTICE = pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("share", pa.float64())])


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates=TEMPLATES) -> DataFrame:
    """One row per input row: doc_id, n_words, n_base, first_word, last_word,
    base_labels, labels, score (the largest share of a template met), notices
    (array of label, first_word, last_word, share)."""
    rows = df.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    kinds = [[t for t in templates if t.base], [t for t in templates if not t.base]]
    vocabularies = [np.unique(np.concatenate([np.zeros(1, np.uint64), *[_hashes(t.words, _width(t)) for t in kind]]))
                    for kind in kinds]
    counted = (rows.select("text").mapInArrow(_count(vocabularies[0], 1, vocabularies[1], RUN), "word long, n long")
               .groupBy("word").agg(F.sum("n").alias("n")).collect())  # one row per template element
    frequency = np.zeros(sum(map(len, vocabularies)), np.int64)
    for r in counted:
        frequency[r["word"]] = r["n"]
    split = len(vocabularies[0])
    indexes = (_Index(kinds[0], vocabularies[0], frequency[:split], 1),
               _Index(kinds[1], vocabularies[1], frequency[split:], RUN))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(_scan(indexes),
                           f"doc_id {id_type}, n_words long, n_base long, first_word long, last_word long, "
                           "base_labels string, labels string, score double, "
                           "notices array<struct<label: string, first_word: bigint, last_word: bigint, share: double>>")
