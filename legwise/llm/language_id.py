"""Operator 2: language identification by Bayesian evidence fusion.

For every language l the fused log posterior of a document is the sum of

* its text likelihood: all letter trigrams of the whole text under smoothed
  trigram models fitted on the labelled rows, tempered so that a long text
  weighs no more than ``EVIDENCE`` independent trigrams;
* the declared language (a column, or the lang attribute of the markup): how
  often text of language l is declared so, counted over all rows;
* the host prior: shares of the languages on the host, smoothed towards its
  domain, the domain towards its address suffix, the suffix towards all rows.
  A document's own contribution is taken out of its host's counts.

The counts are grouped aggregations with a map-side part, so a hot host is a
few rows per task. A uniform trigram model stands for "no known language"; a
document is rejected when that model or no language wins, i.e. when the
posterior of the best language is below ``min_confidence``.

Every label is a language. Only the trigram counts, BUCKETS numbers a language,
and the tables of declared languages and all rows (a number for each pair of
languages at most) reach the driver; more labels than MAX_LANGUAGES are an
error, none is left out. The prior table grows with the number of hosts; it is joined, and
Spark broadcasts it only where its measured size allows.

Defined results: a null, empty or letterless text has language ``und``,
confidence 0 and is rejected; null hosts, suffixes and declarations count as an
empty one; unknown declarations carry no evidence; repeated rows are judged
one by one, ties go to the language first in the alphabet; with no labelled
row every document is ``und``; other columns come along as a struct, so their
names cannot clash.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from legwise.llm.common import cut, release, slices, text_bytes

BUCKETS = 1 << 14
#: Labels from which fitting fails; a language takes 128 KB of each Python process.
MAX_LANGUAGES = 2048
#: Trigrams a text may count for at most.
EVIDENCE = 100
#: Weight, in documents, of the parent level in a prior.
WEIGHT = 5.0
#: Prior of "no known language" beside each document's languages.
UNKNOWN = 1e-3
SLICE = 1 << 19
#: Numbers in a work array of counts or scores.
CELLS = 1 << 21
UND = "und"


def trigrams(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text number, bucket) of all trigrams around a letter; ASCII without
    letters counts as one blank, bytes beyond ASCII as letters."""
    if len(data) < 1:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    upper = (data >= 65) & (data <= 90)
    low = data + np.where(upper, 32, 0).astype(np.uint8)
    letter = (low >= 128) | ((low >= 97) & (low <= 122))
    code = np.where(letter, low, 32).astype(np.uint32)
    before, after = np.full(len(code), 32, np.uint32), np.full(len(code), 32, np.uint32)
    before[1:], after[:-1] = code[:-1], code[1:]
    begins = at[:-1][at[:-1] < len(code)]
    before[begins] = 32
    after[begins[begins > 0] - 1] = 32
    gram = ((before << 16) | (code << 8) | after) * np.uint32(2654435761)
    where = np.flatnonzero(letter)
    return np.searchsorted(at, where, side="right") - 1, (gram[where] >> 18).astype(np.int64)


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    log_p: np.ndarray  # (languages, BUCKETS)


def _count(languages: tuple[str, ...]):
    number = {name: i for i, name in enumerate(languages)}

    def run(batches):
        total = np.zeros(len(languages) * BUCKETS, np.int64)
        for batch in batches:
            data, at = text_bytes(batch.column("text"))
            own = np.array([number[x] for x in batch.column("label").to_pylist()], np.int64)
            for lo, hi in slices(at, SLICE):
                doc, gram = trigrams(data[at[lo]:at[hi]], at[lo:hi + 1] - at[lo])
                cell = own[lo:hi][doc] * BUCKETS + gram
                if len(total) <= CELLS:
                    total += np.bincount(cell, minlength=len(total))
                else:
                    np.add.at(total, cell, 1)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"cell": pa.array(some), "n": pa.array(total[some])})
        release()
    return run


def fit(df: DataFrame, text_col: str = "text", label_col: str = "lang",
        max_languages: int = MAX_LANGUAGES) -> Model:
    """Trigram models of all labels, counted over all labelled rows. More than
    ``max_languages`` labels are an error."""
    rows = df.select(F.col(text_col).cast("string").alias("text"), F.col(label_col).cast("string").alias("label"))
    labelled = rows.where("label IS NOT NULL AND label <> ''")
    languages = tuple(sorted(r["label"] for r in labelled.select("label").distinct().limit(max_languages + 1).collect()))
    if len(languages) > max_languages:
        raise ValueError(f"more than {max_languages} labels in {label_col}: raise max_languages or merge labels")
    counts = np.zeros(len(languages) * BUCKETS)
    if languages:
        cells = (labelled.mapInArrow(_count(languages), "cell long, n long")
                 .groupBy("cell").agg(F.sum("n").alias("n")).toPandas())
        counts[cells["cell"].to_numpy(np.int64)] = cells["n"].to_numpy(float)
    counts = counts.reshape(len(languages), BUCKETS)
    counts += 0.02
    counts /= counts.sum(axis=1, keepdims=True)
    return Model(languages, np.log(counts, out=counts))


def _score(model: Model):
    """Of texts: ``ll``, tempered log-likelihoods, the unknown language's last;
    and ``p``, the shares of the known languages by them. Null for a text
    without letters."""
    unknown, width = np.full(BUCKETS, -np.log(BUCKETS)), len(model.languages) + 1
    step = max(1, CELLS // width)

    def run(text: pa.Array) -> pa.Array:
        done = []
        for first in range(0, len(text), step):
            data, at = text_bytes(text.slice(first, step))
            rows = len(at) - 1
            out, count = np.zeros((rows, width)), np.zeros(rows, np.int64)
            for lo, hi in slices(at, SLICE):
                doc, gram = trigrams(data[at[lo]:at[hi]], at[lo:hi + 1] - at[lo])
                count[lo:hi] = np.bincount(doc, minlength=hi - lo)
                for k, row in enumerate((*model.log_p, unknown)):
                    out[lo:hi, k] = np.bincount(doc, row[gram], hi - lo)
            out *= (np.minimum(1.0, EVIDENCE / np.maximum(count, 1)))[:, None]
            done.append(pa.StructArray.from_arrays([_lists(out, count == 0), _lists(_normalised(out[:, :-1]), count == 0)],
                                                   names=["ll", "p"]))
        release()
        return pa.concat_arrays(done) if done else pa.array([], SCORES)
    return F.arrow_udf(run, "struct<ll array<double>, p array<double>>")


SCORES = pa.struct([("ll", pa.list_(pa.float64())), ("p", pa.list_(pa.float64()))])


def _normalised(values: np.ndarray) -> np.ndarray:
    """exp of rows of logs, each summing to one."""
    raised = np.exp(values - values.max(axis=1, keepdims=True))
    return raised / raised.sum(axis=1, keepdims=True)


def _lists(values: np.ndarray, null: np.ndarray) -> pa.ListArray:
    ends = np.arange(0, values.size + 1, values.shape[1], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values.ravel()), mask=pa.array(null))


def _matrix(lists: pa.Array, fill: np.ndarray) -> np.ndarray:
    """The rows of an array of lists; ``fill`` stands for nulls."""
    out = np.tile(fill, (len(lists), 1))
    out[lists.is_valid().to_numpy(zero_copy_only=False)] = lists.drop_null().flatten().to_numpy().reshape(-1, len(fill))
    return out


def _fuse(languages: tuple[str, ...], root: np.ndarray, unknown: float, min_confidence: float):
    names = np.array(languages, object)

    def run(ll: pa.Array, p: pa.Array, n_host: pa.Array, c_host: pa.Array, parent: pa.Array,
            of_word: pa.Array) -> pa.Array:
        zeros = np.zeros(len(names))
        logs = _matrix(ll, np.zeros(len(names) + 1))
        known, at_host = ll.is_valid().to_numpy(zero_copy_only=False), c_host.is_valid().to_numpy(zero_copy_only=False)
        n = np.maximum(np.nan_to_num(n_host.to_numpy(zero_copy_only=False)) - 1, 0)[:, None]
        c = np.maximum(_matrix(c_host, zeros) - _matrix(p, zeros), 0)
        prior = np.where(at_host[:, None], (c + WEIGHT * _matrix(parent, root)) / (n + WEIGHT), root)
        logs[:, :-1] += np.log(prior * (1 - UNKNOWN)) + _matrix(of_word, zeros)
        logs[:, -1] += unknown
        post = _normalised(logs)[:, :-1]
        first = post.argmax(axis=1)
        best = np.where(known, post[np.arange(len(post)), first], 0.0)
        sure = known & (best >= min_confidence)
        return pa.StructArray.from_arrays(
            [pa.array(np.where(sure, names[first], UND), pa.string()), pa.array(best), pa.array(sure)],
            names=["language", "confidence", "accepted"])
    return run


def _sums(name: str, k: int) -> Column:
    return F.array(*[F.sum(F.col(name)[i]) for i in range(k)])


def _smooth(counts: Column, n: Column, parent: Column) -> Column:
    return F.zip_with(counts, parent, lambda c, p: (F.greatest(c, F.lit(0.0)) + WEIGHT * p)
                      / (F.greatest(n, F.lit(0.0)) + WEIGHT))


def identify(df: DataFrame, model: Model, text_col: str = "text", host: Column | None = None,
             suffix: Column | None = None, declared: Column | None = None,
             min_confidence: float = 0.5) -> DataFrame:
    """One row per input row: row (all its columns), language, confidence,
    accepted. Host, suffix and declared are columns over ``df``."""
    spark, k = df.sparkSession, len(model.languages)
    nothing = F.lit("")
    host, suffix, declared = [F.coalesce(nothing if c is None else c.cast("string"), nothing)
                              for c in (host, suffix, declared)]
    facts = [host.alias("host"), suffix.alias("suffix"), F.substring_index(host, ".", -2).alias("domain"),
             F.lower(F.substring_index(declared, "-", 1)).alias("declared")]
    text = F.col(f"`{text_col}`").cast("string")
    if not k:
        return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"),
                         F.lit(UND).alias("language"), F.lit(0.0).alias("confidence"), F.lit(False).alias("accepted"))

    score = _score(model)  # only the text goes to Python
    seen = df.select(*facts, score(text).alias("s")).select("*", "s.ll", "s.p").drop("s").where("ll IS NOT NULL")
    place = ["suffix", "domain", "host"]
    cells = cut(seen.withColumn("declared", F.when(F.col("declared").isin(list(model.languages)), F.col("declared")))
                .groupBy(*place, "declared").agg(F.count(F.lit(1)).cast("double").alias("n"),
                                                 _sums("p", k).alias("c")), "language-counts")

    def level(*keys: str) -> DataFrame:
        name = keys[-1] if keys else "all"
        return cells.groupBy(*keys).agg(F.sum("n").alias(f"n_{name}"), _sums("c", k).alias(f"c_{name}"))

    everything = level().first()["c_all"] or [1.0] * k
    of_all = (np.array(everything, float) + 1.0) / (sum(everything) + k)
    root = F.array(*[F.lit(float(x)) for x in of_all])
    said = {r["declared"]: r["c_declared"] for r in level("declared").where("declared IS NOT NULL").collect()}
    of_language = [sum(c[i] for c in said.values()) for i in range(k)]
    # log P(declared | language); an unknown declaration is no evidence. A table, as it has a number for each pair.
    evidence = [(d, [float(np.log((c[i] + 1.0) / (of_language[i] + len(said) + 1))) for i in range(k)])
                for d, c in sorted(said.items())]
    priors = (level(*place).join(level("suffix", "domain"), ["suffix", "domain"]).join(level("suffix"), ["suffix"])
              .withColumn("parent", _smooth(F.col("c_domain"), F.col("n_domain"),
                                            _smooth(F.col("c_suffix"), F.col("n_suffix"), root)))
              .select(*place, "n_host", "c_host", "parent"))

    row = F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row")
    scored = (df.select(row, *facts, score(text).alias("s")).select("*", "s.ll", "s.p").drop("s")
              .join(priors, place, "left"))
    if evidence:
        words = spark.createDataFrame(evidence, "declared string, of_word array<double>")
        scored = scored.join(F.broadcast(words), "declared", "left")
    else:
        scored = scored.withColumn("of_word", F.lit(None).cast("array<double>"))
    unknown = float(np.log(UNKNOWN / max(1, len(said))))
    fuse = F.arrow_udf(_fuse(model.languages, of_all, unknown, min_confidence),
                       "struct<language string, confidence double, accepted boolean>")
    done = scored.select("row", fuse("ll", "p", "n_host", "c_host", "parent", "of_word").alias("x"))
    return done.select("row", "x.language", "x.confidence", "x.accepted")


def page_evidence(url_col: str = "url", html_col: str = "html") -> dict[str, Column]:
    """Host, address suffix and declared markup language of a web page."""
    host = F.lower(F.regexp_extract(F.col(url_col), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/:?#]*)", 1))
    return {"host": host, "suffix": F.substring_index(host, ".", -1),
            "declared": F.regexp_extract(F.col(html_col), r"(?i)<html[^>]*\slang\s*=\s*[\"']?([A-Za-z-]+)", 1)}


def identify_documents(docs: DataFrame) -> DataFrame:
    """The parameters for ``documents``: ``source`` is the host, ``lang`` the declared language."""
    return identify(docs, fit(docs), host=F.col("source"), declared=F.col("lang"))
