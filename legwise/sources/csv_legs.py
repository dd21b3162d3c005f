"""A5 + C1 + C3: landing CSV files of any layout into one staged table that loses
nothing.

Every file has its own header. The heads of the files (a bounded number of bytes
each) give the headers; files with one header form a group, and a group is one
scan with that header as its schema; the groups are united by column name. A
record may span lines and hold quotes, so a file is parsed by one task, as a
stream.

Every record becomes one staged row. Short records are filled with nulls. A
record with more fields than its header, or with a quote left open, carries a
``problem`` and its whole text. Files that cannot be used (no header, a required
column missing, unreadable) come back as quarantine rows with their reason; they
never stop the others.

Limits: the head of a file holds its header within ``HEAD_BYTES``.
"""

from __future__ import annotations

import csv
import io
import logging
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from legwise.schemas import COORD_COLUMNS, RAW_INPUT_COLUMNS
from legwise.session import scratch_path

log = logging.getLogger(__name__)

#: Bytes of a file that are read to find its header.
HEAD_BYTES = 1 << 16
#: Heads read at a time.
HEAD_THREADS = 16
RECORD = "_staged_record"
PROBLEM = "_staged_problem"
PATH = "_staged_path"
SPREAD = "_staged_spread"
EXTRA_FIELDS = "more fields than the header"
OPEN_QUOTE = "quote left open"
CSV_OPTIONS = {"multiLine": "true", "quote": '"', "escape": '"', "mode": "PERMISSIVE"}

QUARANTINE = T.StructType([T.StructField(n, T.StringType()) for n in ("path", "source_file", "kind", "reason", "record")])


@dataclass(frozen=True)
class Header:
    """Column names of a file, made unique as data frames need them."""
    names: tuple[str, ...]

    @classmethod
    def of(cls, fields: list[str]) -> "Header":
        seen, names = set(), []
        for i, raw in enumerate(fields):
            name = base = raw.strip() or f"Unnamed: {i}"
            k = 0
            while name.lower() in seen:
                k += 1
                name = f"{base}.{k}"
            seen.add(name.lower())
            names.append(name)
        return cls(tuple(names))

    def missing(self, required: tuple[str, ...]) -> list[str]:
        return [c for c in required if c not in self.names]


def read_head(spark: SparkSession, path: str, size: int = HEAD_BYTES) -> Header | None:
    """The header of one file, or None when it has no record."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    where = jvm.org.apache.hadoop.fs.Path(path)
    stream = where.getFileSystem(conf).open(where)
    try:
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(where)
        data = (codec.createInputStream(stream) if codec else stream).readNBytes(size)
    finally:
        stream.close()
    text = bytes(data).decode("utf-8-sig", errors="replace")
    for fields in csv.reader(io.StringIO(text, newline="")):
        if fields:
            return Header.of(fields)
    return None


def read_heads(spark: SparkSession, paths: list[str]) -> tuple[dict[str, Header], dict[str, str]]:
    """(headers by path, reasons of the files that have none)."""
    def one(path: str):
        try:
            return path, read_head(spark, path), None
        except Exception as e:  # noqa: BLE001 - an unreadable file is quarantined with its reason
            return path, None, f"unreadable: {str(e).splitlines()[0][:300]}"

    heads, broken = {}, {}
    with ThreadPoolExecutor(HEAD_THREADS) as pool:
        for path, header, reason in pool.map(one, paths):
            if header is None:
                broken[path] = reason or "no header"
            else:
                heads[path] = header
    return heads, broken


def scan_group(spark: SparkSession, paths: list[str], header: Header) -> DataFrame:
    """All records of files with one header: its columns as text, and the
    record's text, problem and path."""
    fields = [T.StructField(c, T.StringType()) for c in header.names]
    df = (spark.read.options(**CSV_OPTIONS).option("header", "true").option("columnPruning", "false")
          .option("columnNameOfCorruptRecord", RECORD)
          .schema(T.StructType([*fields, T.StructField(RECORD, T.StringType())])).csv(paths))
    # Records whose number of fields is not the header's come with their text; one field more than
    # the header has shows the long ones.
    wider = ", ".join(f"f{i} string" for i in range(len(fields) + 1))
    over = F.from_csv(F.col(RECORD), F.lit(wider), CSV_OPTIONS)[f"f{len(fields)}"]
    text = F.coalesce(F.col(RECORD), F.lit(""))
    quotes = F.length(text) - F.length(F.replace(text, F.lit('"'), F.lit("")))
    last = F.col(f"`{header.names[-1]}`")
    problem = F.when(quotes % 2 == 1, F.lit(OPEN_QUOTE)).when(over.isNotNull(), F.lit(EXTRA_FIELDS))
    # A quote left open in the last field takes in the rest of the file, but not a field too many or too
    # few; `open_files` tells such files from those whose last fields hold line breaks.
    spread = F.col(RECORD).isNull() & last.contains("\n")
    record = F.when(spread, F.concat_ws(",", *[F.col(f"`{c}`") for c in header.names])).otherwise(F.col(RECORD))
    return df.select(*[F.col(f"`{c}`") for c in header.names], record.alias(RECORD), problem.alias(PROBLEM),
                     F.coalesce(spread, F.lit(False)).alias(SPREAD),
                     F.col("_metadata.file_path").alias(PATH), F.col("_metadata.file_name").alias("_staged_name"))


def open_files(spark: SparkSession, rows: DataFrame) -> list[str]:
    """Paths of the files with an odd number of quotes, of those that have a
    record whose last field spans lines."""
    asked = [r[0] for r in rows.where(SPREAD).select(PATH).distinct().collect()]
    if not asked:
        return []
    text = spark.read.text(asked).select(F.col("_metadata.file_path").alias("path"), "value")
    quotes = F.sum(F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit(""))))
    return [r["path"] for r in text.groupBy("path").agg(quotes.alias("q")).where("q % 2 = 1").collect()]


def read_groups(spark: SparkSession, heads: dict[str, Header]) -> DataFrame:
    """One scan for each distinct header, united by name. Known input columns
    that no header has are null."""
    groups: dict[Header, list[str]] = {}
    for path, header in heads.items():
        groups.setdefault(header, []).append(path)
    scans = [scan_group(spark, paths, header) for header, paths in sorted(groups.items(), key=lambda g: g[0].names)]
    df = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), scans)
    absent = {c: F.lit(None).cast("string") for c in RAW_INPUT_COLUMNS if c not in df.columns}
    df = df.withColumns({**absent, "source_file": F.col("_staged_name")})
    return df.drop("_staged_name")


def _quarantined(spark: SparkSession, reasons: dict[str, str]) -> DataFrame:
    rows = [(p, p.rsplit("/", 1)[-1], "file", reason, None) for p, reason in sorted(reasons.items())]
    return spark.createDataFrame(rows, QUARANTINE)


@dataclass
class Staged:
    """``rows``: every record of the usable files, written; ``quarantine``: files
    and records that do not load; ``broken``: reasons by path of the unusable
    files; ``good``: rows to load."""
    rows: DataFrame | None
    good: DataFrame | None
    quarantine: DataFrame
    broken: dict[str, str]
    paths: list[str]


def _write(spark: SparkSession, heads: dict[str, Header], broken: dict[str, str]) -> list[str]:
    """Stage the files; when the scan fails, halve them until the file that
    cannot be read stands alone."""
    if not heads:
        return []
    path = scratch_path(spark, "staged-legs")
    try:
        read_groups(spark, heads).write.parquet(path)
        return [path]
    except (PySparkException, Py4JError) as e:
        if len(heads) == 1:
            broken[next(iter(heads))] = f"unreadable: {str(e).splitlines()[0][:300]}"
            return []
        log.warning("staging %d files failed, trying halves: %s", len(heads), str(e).splitlines()[0])
    names = sorted(heads)
    halves = names[:len(names) // 2], names[len(names) // 2:]
    return [p for half in halves for p in _write(spark, {n: heads[n] for n in half}, broken)]


def stage(spark: SparkSession, paths: list[str], required: tuple[str, ...] = COORD_COLUMNS,
          whole_files: bool = True) -> Staged:
    """Parse the files once. With ``whole_files`` a file with a bad record does
    not load at all (it is tried again with the next run, once mended); else its
    good records load and the bad ones are kept in quarantine."""
    heads, broken = read_heads(spark, paths)
    for p in [p for p, h in heads.items() if h.missing(required)]:
        broken[p] = f"missing column(s) {heads.pop(p).missing(required)}"
    written = _write(spark, heads, broken)
    if not written:
        return Staged(None, None, _quarantined(spark, broken), broken, [])
    parts = [spark.read.parquet(p) for p in written]
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    unclosed = open_files(spark, rows)
    if unclosed:
        rows = rows.withColumn(PROBLEM, F.when(F.col(SPREAD) & F.col(PATH).isin(unclosed), F.lit(OPEN_QUOTE))
                               .otherwise(F.col(PROBLEM)))
    bad = rows.where(F.col(PROBLEM).isNotNull())
    records = bad.select(F.col(PATH).alias("path"), "source_file", F.lit("record").alias("kind"),
                         F.col(PROBLEM).alias("reason"), F.col(RECORD).alias("record"))
    good = rows.where(F.col(PROBLEM).isNull())
    if whole_files:
        good = good.join(bad.select(PATH).distinct(), PATH, "left_anti")
    good = good.drop(RECORD, PROBLEM, SPREAD)
    quarantine = records.unionByName(_quarantined(spark, broken)) if broken else records
    return Staged(rows, good, quarantine, broken, written)
