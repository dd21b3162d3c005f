"""Post-refresh checks and run counters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def date_range_count(df: DataFrame, date_col: str = "trip_date") -> DataFrame:
    """``MIN, MAX`` of the date and the row count (one row)."""
    return df.agg(F.min(date_col).alias("min_date"), F.max(date_col).alias("max_date"),
                  F.count(F.lit(1)).cast("int").alias("n_rows"))


def row_count(df: DataFrame) -> DataFrame:
    """Row count (one row)."""
    return df.agg(F.count(F.lit(1)).cast("int").alias("n_rows"))


def latest_rows(df: DataFrame, n: int = 10, date_col: str = "trip_date", tie_break: str = "oid") -> DataFrame:
    """``TOP n ORDER BY date DESC``; ties broken by ``oid`` so the answer
    repeats. Planned as ``TakeOrderedAndProject`` (a per-task top-n, then a
    merge of n rows per task)."""
    return df.orderBy(F.col(date_col).desc_nulls_last(), F.col(tie_break).asc()).limit(n)


def file_date_watermark(raw: DataFrame, col: str = "file_date_raw") -> DataFrame:
    """Latest parseable file date; bad values are ignored."""
    return raw.agg(F.max(F.try_to_timestamp(F.col(col).cast("string"))).cast("timestamp_ntz").alias("watermark"))


def run_counters(**counts: int) -> dict[str, int]:
    """The counters a run reports (values come from Observations)."""
    return {k: int(v) for k, v in counts.items()}
