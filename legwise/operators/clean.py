"""Clean step: coerce raw text, hash each row, keep rows with a trip date
(SURVEY §2.3 C4-C7, §2.4 F5, §2.10 X24, §2.11 H1, §2.12 D1-D3).

Built-in expressions only; the whole step is one narrow projection (no shuffle,
no Python worker). ``route_clean`` gives every raw row one route and says why, so
that no row leaves the step unaccounted for; ``clean_transform`` is its rows with
a trip date.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from legwise.functions import hashing as H
from legwise.functions import timefns as T
from legwise.functions.text import py_number_text
from legwise.schemas import CLEAN

# --- fixed values that must equal the reference's ---------------------------
NUMERIC_COLUMNS = ("start_longitude", "start_latitude", "end_longitude", "end_latitude",
                   "manhattan_distance_mi", "euclidean_distance_mi")
ID_COLUMNS = ("user_trip_id", "Origin_BG", "Dest_BG", "source_file")
# The raw extract (A6): 18 columns, ``file_date`` read as ``file_date_raw``.
EXTRACT_COLUMNS = ("user_trip_id", "start_time", "end_time", "start_longitude", "start_latitude",
                   "end_longitude", "end_latitude", "service_name", "route_short_name", "mode",
                   "start_stop_name", "end_stop_name", "source_file", "file_date_raw",
                   "manhattan_distance_mi", "euclidean_distance_mi", "Origin_BG", "Dest_BG")
# Longest text (UTF-16 units) that the clean table takes.
MAX_LENGTHS = {"user_trip_id": 100, "service_name": 200, "route_short_name": 50, "mode": 50,
               "start_stop_name": 200, "end_stop_name": 200, "source_file": 300, "file_date_raw": 50,
               "Origin_BG": 12, "Dest_BG": 12}
REQUIRED = ("user_trip_id",)
# -----------------------------------------------------------------------------
CLEAN_ROUTE, UNDATED, REJECTED = "clean", "undated", "rejected"
NUMBER = r"(?i)^\s*[+-]?(\d+\.?\d*(e[+-]?\d+)?|\.\d+(e[+-]?\d+)?|inf|infinity|nan)\s*$"


def to_number(x) -> Column:
    """C4: lenient numeric coercion. Plain and exponent notation, inf and nan are
    numbers; type suffixes and hexadecimal text, which Spark's cast would take,
    are not."""
    c = (F.col(x) if isinstance(x, str) else x).cast("string")
    return F.when(c.rlike(NUMBER), F.btrim(c).try_cast("double"))


def finite_or_null(x) -> Column:
    """NaN and +-Infinity become null."""
    c = F.col(x) if isinstance(x, str) else x
    return F.when(F.isnan(c) | (F.abs(c) == float("inf")), F.lit(None).cast("double")).otherwise(c)


def utf16_length(x) -> Column:
    """Length in UTF-16 units, in which the clean table limits its text."""
    c = F.col(x) if isinstance(x, str) else x
    return F.octet_length(F.encode(c, "UTF-16LE")) / 2


def reject_reason() -> Column:
    """Why the clean table would not take a row; null when it does. Trailing
    blanks beyond a limit do no harm and do not count."""
    reasons = [F.when(F.col(c).isNull(), F.lit(f"null {c}")) for c in REQUIRED]
    reasons += [F.when((F.length(c) > n // 2) & (utf16_length(F.rtrim(c)) > n), F.lit(f"{c} longer than {n}"))
                for c, n in MAX_LENGTHS.items()]
    return F.coalesce(*reasons)


def route_clean(raw: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Every raw row in the shape of ``LegTrips_Clean``, with its ``route``
    (clean, undated or rejected) and ``reject_reason``. A row without a trip date
    is undated, whatever else it lacks.

    The row hash covers the raw time text and the *coerced* coordinates (as
    Python prints them); distances are not hashed. ``keep`` carries extra raw
    columns through.
    """
    nums = {c: to_number(c) for c in NUMERIC_COLUMNS}
    hashed = {c: F.col(c).cast("string") for c in ("user_trip_id", "start_time", "end_time",
                                                   "source_file", "file_date_raw", "Origin_BG", "Dest_BG")}
    # one converter applied to the four coordinates (a small lambda, not four
    # copies of a large expression in the generated code)
    texts = F.transform(F.array(*[nums[c] for c in NUMERIC_COLUMNS[:4]]), py_number_text)
    hashed.update({c: F.element_at(texts, i + 1) for i, c in enumerate(NUMERIC_COLUMNS[:4])})
    out = raw.select(
        *keep, H.row_hash(hashed).alias("row_hash"),
        F.col("user_trip_id").cast("string").alias("user_trip_id"),
        T.file_trip_date(F.col("file_date_raw").cast("string")).alias("trip_date"),
        T.floor_ms(T.parse_utc(F.col("start_time").cast("string"))).alias("start_time_utc"),
        T.floor_ms(T.parse_utc(F.col("end_time").cast("string"))).alias("end_time_utc"),
        *[finite_or_null(nums[c]).alias(c) for c in NUMERIC_COLUMNS[:4]],
        "service_name", "route_short_name", "mode", "start_stop_name", "end_stop_name",
        F.col("source_file").cast("string").alias("source_file"),
        F.col("file_date_raw").cast("string").alias("file_date_raw"),
        *[finite_or_null(nums[c]).alias(c) for c in NUMERIC_COLUMNS[4:]],
        F.col("Origin_BG").cast("string").alias("Origin_BG"),
        F.col("Dest_BG").cast("string").alias("Dest_BG"))
    undated = F.col("trip_date").isNull()
    return (out.withColumn("reject_reason", F.when(undated, F.lit("no trip date")).otherwise(reject_reason()))
            .withColumn("route", F.when(undated, F.lit(UNDATED)).when(F.col("reject_reason").isNotNull(), F.lit(REJECTED))
                        .otherwise(F.lit(CLEAN_ROUTE)))
            .select(*keep, *[f.name for f in CLEAN.fields], "route", "reject_reason"))


def clean_transform(raw: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Raw extract -> rows in the shape of ``LegTrips_Clean`` (20 columns,
    declared types). Rows whose file date does not parse are dropped."""
    return route_clean(raw, keep).where(F.col("trip_date").isNotNull()).drop("route", "reject_reason")
