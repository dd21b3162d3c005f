"""Operator 11: quality by nearest-neighbour voting in a latent semantic space.

Terms. A text counts terms of three families over its whole length: its words
(runs of letters and digits, in lower case, hashed), the shapes of what stands
between blanks (letters, digits, upper case and every mark, runs of one kind
written once, hashed), and whether a word repeats the one before it, the one two
before it, or neither. Within a family the value of a term is the root of its
share.

Space. Document frequencies and the products of all pairs of terms are summed
over all documents, in one pass; the driver gets these TERMS * TERMS sums,
weighs them by inverse document frequency and takes the first ``DIMENSIONS``
eigenvectors: latent semantic analysis of the whole corpus.

Vote. At most ``EXEMPLARS`` labelled documents, half of them of each label where
there are more, chosen by a hash of their id, are put into that space and
broadcast (at most EXEMPLARS * (DIMENSIONS + 2) numbers). For every document its
cosines with all of them are exact products, block by block; the ``NEIGHBOURS``
nearest vote with weight (cosine ** SHARPNESS), scaled so that the labels weigh
what they do among all labelled documents. The score is the share of label 1,
smoothed by one vote at the rate of label 1.

Only rows of the fold that is not held out are labelled: crc32 of the id as text
modulo FOLDS is not 0. Labels, language, source and id are no terms.

Defined results: null and empty texts have no terms and score the rate of label
1; a null id is not held out and has no label; several labels of an id are
averaged, null labels ignored; repeated rows are scored alike; without labels
every score is 0.5; an empty table gives an empty result; other columns are not
read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from legwise.llm.common import cut, lower, shuffle_width, slices, text_bytes, word_hashes

WORDS, SHAPES, FLOW = 320, 189, 3
TERMS = WORDS + SHAPES + FLOW
#: What words weigh beside shapes and repeats.
WORD_WEIGHT = 0.5
DIMENSIONS = 48
#: Bound of the labelled sample.
EXEMPLARS = 8192
NEIGHBOURS = 15
SHARPNESS = 8
THRESHOLD = 0.3
FOLDS = 5
#: Text bytes, and documents against all exemplars, worked on at a time.
SLICE, BLOCK = 1 << 19, 256
#: Rows of the matrix of products in one piece on its way to be summed.
STRIP = 32


def _shares(doc: np.ndarray, term: np.ndarray, size: int, rows: int) -> np.ndarray:
    """(rows, size) roots of the shares of terms."""
    counts = np.bincount(doc * size + term, minlength=rows * size).reshape(rows, size).astype(float)
    return np.sqrt(counts / np.maximum(counts.sum(axis=1, keepdims=True), 1))


def _bucket(h: np.ndarray, size: int) -> np.ndarray:
    return ((h >> np.uint64(33)) % np.uint64(size)).astype(np.int64)


def terms(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """(texts, TERMS) values of the texts data[at[i]:at[i + 1]]."""
    rows = len(at) - 1
    low = lower(data)
    digit, capital = (data >= 48) & (data <= 57), (data >= 65) & (data <= 90)
    letter = (low >= 97) & (low <= 122) | (low >= 128)
    doc, word = word_hashes(low, ~(letter | digit), at)
    flow = np.zeros(len(word), np.int64)
    for back in (2, 1):
        flow[back:][(word[back:] == word[:-back]) & (doc[back:] == doc[:-back])] = back
    kind = np.where(letter, 97, np.where(digit, 48, low)).astype(np.uint8)
    kind[capital] = 65
    blank = (kind == 32) | ((kind >= 9) & (kind <= 13) & (kind != 10))
    kind[blank] = 32
    new = np.ones(len(kind), bool)
    new[1:] = kind[1:] != kind[:-1]
    new[at[:-1][at[:-1] < len(kind)]] = True
    begins = np.concatenate([[0], np.cumsum(new)])[at]
    place, shape = word_hashes(kind[new], blank[new], begins)
    return np.concatenate([WORD_WEIGHT * _shares(doc, _bucket(word, WORDS), WORDS, rows),
                           _shares(place, _bucket(shape, SHAPES), SHAPES, rows),
                           _shares(doc, flow, FLOW, rows)], axis=1)


def _values(column: pa.Array):
    """(first row, values) of the texts of a column, slice by slice."""
    data, at = text_bytes(column)
    for lo, hi in slices(at, SLICE):
        yield lo, terms(data[at[lo]:at[hi]], at[lo:hi + 1] - at[lo])


def _sums(batches):
    """Of a partition: number of texts, document frequencies, term products."""
    n, frequency, products = 0, np.zeros(TERMS), np.zeros((TERMS, TERMS))
    for batch in batches:
        for _, x in _values(batch.column("text")):
            n += len(x)
            frequency += (x > 0).sum(axis=0)
            products += x.T @ x
    if n:
        yield _strips(n, frequency, products)


def _strips(n: int, frequency: np.ndarray, products: np.ndarray) -> pa.RecordBatch:
    """The sums in strips of the upper triangle; strip -1 holds counts."""
    strips = [(-1, np.append(frequency, n))]
    strips += [(k, products[k:k + STRIP, k:].ravel()) for k in range(0, TERMS, STRIP)]
    return pa.RecordBatch.from_pydict({"strip": pa.array([k for k, _ in strips], pa.int32()),
                                       "v": pa.array([v.astype(np.float32).tobytes() for _, v in strips], pa.binary())})


def _add_up(batches):
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for k, raw in zip(batch.column("strip").to_pylist(), batch.column("v")):
            v = np.frombuffer(raw.as_py(), np.float32)
            total[k] = total[k] + v if k in total else v.astype(float)
    yield pa.RecordBatch.from_pydict({"strip": pa.array(list(total), pa.int32()),
                                      "v": pa.array([v.astype(np.float64).tobytes() for v in total.values()], pa.binary())})


@dataclass(frozen=True)
class Space:
    """Terms to latent dimensions."""
    turn: np.ndarray  # (TERMS, dimensions)

    def place(self, x: np.ndarray) -> np.ndarray:
        """Unit vectors; a text without terms is the zero vector."""
        y = x @ self.turn
        return (y / np.maximum(np.linalg.norm(y, axis=1, keepdims=True), 1e-12)).astype(np.float32)


def fit_space(texts: DataFrame, dimensions: int = DIMENSIONS) -> Space:
    """Latent space of all documents. Strips meet in TERMS / STRIP + 1 groups,
    which are summed as a stream."""
    spark = texts.sparkSession
    sums = (texts.mapInArrow(_sums, "strip int, v binary").repartition(min(shuffle_width(spark), TERMS // STRIP), "strip")
            .mapInArrow(_add_up, "strip int, v binary").collect())  # TERMS * TERMS numbers
    if not sums:
        return Space(np.zeros((TERMS, 1)))
    found = {r["strip"]: np.frombuffer(r["v"]) for r in sums}
    frequency, n = found[-1][:-1], found[-1][-1]
    products = np.zeros((TERMS, TERMS))
    for k in range(0, TERMS, STRIP):
        products[k:k + STRIP, k:] = found[k].reshape(-1, TERMS - k)
    products = np.triu(products) + np.triu(products, 1).T
    weight = np.log((1 + n) / (1 + frequency)) + 0.1  # terms of every text keep some weight
    values, vectors = np.linalg.eigh(weight[:, None] * products * weight[None])
    return Space(weight[:, None] * vectors[:, ::-1][:, :dimensions])


def _placed(space: Space):
    def run(batches):
        for batch in batches:
            for lo, x in _values(batch.column("text")):
                part = batch.slice(lo, len(x))
                yield pa.RecordBatch.from_pydict({"y": part.column("y"),
                                                  "v": pa.array([v.tobytes() for v in space.place(x)], pa.binary())})
    return run


@dataclass(frozen=True)
class Voters:
    vectors: np.ndarray  # (exemplars, dimensions)
    label: np.ndarray  # share of label 1
    weight: np.ndarray
    rate: float

    def score(self, y: np.ndarray) -> np.ndarray:
        """Shares of label 1 among the nearest exemplars of unit vectors."""
        if not len(self.label):
            return np.full(len(y), self.rate)
        near = min(NEIGHBOURS, len(self.label))
        out = np.empty(len(y))
        for lo in range(0, len(y), BLOCK):
            cosine = y[lo:lo + BLOCK] @ self.vectors.T
            top = np.argpartition(-cosine, near - 1, axis=1)[:, :near]
            vote = np.maximum(np.take_along_axis(cosine, top, axis=1).astype(float), 0) ** SHARPNESS * self.weight[top]
            out[lo:lo + BLOCK] = ((vote * self.label[top]).sum(axis=1) + self.rate) / (vote.sum(axis=1) + 1)
        return np.clip(out, 0.0, 1.0)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def fit_voters(docs: DataFrame, labels: DataFrame, space: Space, label_col: str, exemplars: int = EXEMPLARS) -> Voters:
    """``docs``: doc_id, text. A bounded, deterministic sample of the labelled
    rows of the training folds."""
    known = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(f"`{label_col}`").cast("double").alias("y"))
             .where("doc_id IS NOT NULL AND y IS NOT NULL").where(~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.avg("y").alias("y")).withColumn("one", F.col("y") >= 0.5))
    known = known.join(docs.select("doc_id").distinct(), "doc_id", "left_semi")
    size = {r["one"]: r["n"] for r in known.groupBy("one").agg(F.count(F.lit(1)).alias("n")).collect()}
    total = sum(size.values())
    if not total:
        return Voters(np.zeros((0, space.turn.shape[1])), np.zeros(0), np.zeros(0), 0.5)
    some = min(size.get(False, 0), size.get(True, 0), exemplars // 2)  # the rarer label's part
    take = {one: n if n <= some else min(n, exemplars - min(size.get(not one, 0), exemplars // 2))
            for one, n in size.items()}
    picked = [known.where(F.col("one") == one).orderBy(F.xxhash64("doc_id"), "doc_id").limit(k)
              for one, k in take.items()]
    sample = picked[0] if len(picked) == 1 else picked[0].unionByName(picked[1])
    texts = docs.join(F.broadcast(sample.select("doc_id", "y")), "doc_id")  # at most `exemplars` rows
    rows = cut(texts.select("text", "y").mapInArrow(_placed(space), "y double, v binary"), "quality-voters")
    rows = rows.orderBy("v", "y").limit(4 * exemplars).toPandas()
    label = rows["y"].to_numpy(float)
    vectors = np.frombuffer(b"".join(rows["v"]), np.float32).reshape(len(rows), -1)
    scale = np.where(label >= 0.5, size.get(True, 0) / max(1, take.get(True, 0)),
                     size.get(False, 0) / max(1, take.get(False, 0)))
    return Voters(vectors, label, scale / scale.mean(), float((label * scale).sum() / scale.sum()))


def _scored(space: Space, voters: Voters):
    def run(batches):
        for batch in batches:
            for lo, x in _values(batch.column("text")):
                part = batch.slice(lo, len(x))
                score = voters.score(space.place(x))
                score[~x.any(axis=1)] = voters.rate
                yield pa.RecordBatch.from_pydict({"doc_id": part.column("doc_id"), "score": pa.array(score)})
    return run


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             label_col: str = "quality", threshold: float = THRESHOLD, exemplars: int = EXEMPLARS) -> DataFrame:
    """One row per input row: doc_id, held_out, score, predicted."""
    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                        F.col(f"`{text_col}`").cast("string").alias("text"))
    space = fit_space(texts.select("text"))
    voters = fit_voters(texts, labels, space, label_col, exemplars)
    scored = texts.mapInArrow(_scored(space, voters), "doc_id long, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))
