"""Landing files: discovery, file metadata and CSV scan (SURVEY §2.1 A1-A5,
§2.3 C1-C3, §2.4 F2-F3, §2.5 J3, §2.9 U2-U3).

Discovery lists the landing folder with the ``binaryFile`` source, selecting
only path/size/time (the file content is never read), so listing is an
ordinary distributed scan. Names are filtered with column expressions; the
already-loaded set is an anti join (AQE turns it into a broadcast join when
the loaded-name list is small, measured at run time).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DATE_IN_NAME = r"(\d{4})-\d{2}-\d{2}"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def base_name(path) -> Column:
    """Last part of a path or URL."""
    return F.element_at(F.split(_c(path), "/"), -1)


def name_matches(name, substring: str, suffix: str) -> Column:
    """Ends with the suffix and contains the substring."""
    n = _c(name)
    return n.endswith(suffix) & n.contains(substring)


def year_allowed(name, only_years) -> Column:
    """The first ``YYYY-MM-DD`` in the name decides; names without a
    date always pass."""
    if not only_years:
        return F.lit(True)
    year = F.regexp_extract(_c(name), DATE_IN_NAME, 1)
    return (year == "") | year.cast("int").isin(*[int(y) for y in only_years])


def file_date_from_name(name, substring: str, suffix: str) -> Column:
    """Remove ``substring + '_'`` and the suffix, parse; null on failure."""
    s = F.replace(F.replace(_c(name), F.lit(substring + "_"), F.lit("")), F.lit(suffix), F.lit(""))
    return F.try_to_timestamp(F.when(~s.rlike(r"^\s*T?\d{1,2}:"), s)).cast("timestamp_ntz")  # a time alone is no date


def list_files(spark: SparkSession, landing_path: str) -> DataFrame:
    """All files under the landing path: ``path, name, length, modificationTime``."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(landing_path)
            .select("path", base_name("path").alias("name"), "length", "modificationTime"))


def matching_files(listing: DataFrame, substring: str, suffix: str, only_years=None,
                   name_col: str = "name") -> DataFrame:
    """A1 + A2 + U3: matching files, distinct. A listing with paths keeps files
    of one name in several folders apart; one of names alone is distinct by name.
    Who shows the list sorts it."""
    key = "path" if "path" in listing.columns else name_col
    return (listing.filter(name_matches(name_col, substring, suffix) & year_allowed(name_col, only_years))
            .dropDuplicates([key]))


def below_folder(path, folder: str) -> Column:
    """A file's path below the landing folder, whatever scheme or spelling the
    listing puts in front of it."""
    tail = folder.rstrip("/").split("://", 1)[-1].removeprefix("file:").rsplit("*", 1)[-1].rstrip("/") + "/"
    p = F.replace(_c(path), F.lit("file:///"), F.lit("/"))
    return F.when(F.instr(p, tail) > 0, F.substring_index(p, tail, -1)).otherwise(p)


def new_files(candidates: DataFrame, loaded: DataFrame, name_col: str = "name") -> DataFrame:
    """Candidates whose name is not loaded yet."""
    return candidates.join(loaded.select(F.col("source_file").alias(name_col)), name_col, "left_anti")


def read_leg_csv(spark: SparkSession, paths: list[str], header: tuple[str, ...] | None = None) -> DataFrame:
    """A5 + C1: CSV with header, every column as text (nothing is inferred), and
    the file name as ``source_file``.

    ``header`` is the column order of the files (default: the first file's
    header). Every file's header is checked against it (``enforceSchema`` off),
    so a file with other columns or another order stops the read instead of
    shifting values between columns. Malformed rows become nulls (PERMISSIVE).
    """
    if header is None:
        header = tuple(spark.read.option("header", "true").csv(paths[:1]).columns)
    schema = T.StructType([T.StructField(c, T.StringType()) for c in header])
    df = (spark.read.option("header", "true").option("mode", "PERMISSIVE")
          .option("enforceSchema", "false")
          .schema(schema).csv(paths))
    return df.select("*", F.col("_metadata.file_name").alias("source_file"))


def file_metrics(df: DataFrame, name_col: str = "source_file") -> DataFrame:
    """rows per file (a file with no valid row is simply absent)."""
    return df.groupBy(name_col).agg(F.count(F.lit(1)).cast("int").alias("n_rows"))
