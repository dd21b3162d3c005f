"""Global ``ROW_NUMBER() OVER (ORDER BY ...)`` without a single partition
(SURVEY §2.7 W4-W6, §7.4).

A window with no ``PARTITION BY`` moves every row to one task. Here:

1. ``orderBy`` range-partitions and sorts the rows (Spark samples the sort
   key, so partitions are balanced even when one day or key dominates);
2. each row is tagged with its partition id and its index inside the
   partition (``monotonically_increasing_id`` keeps the index in the low 33
   bits), and the tagged rows are written once as a Parquet table in the
   shared checkpoint folder (``spark.checkpoint.dir``) so a recomputation
   cannot reshuffle them, and so the sort runs exactly once;
3. the row count of each partition (one row per partition) gives a running
   offset, broadcast back: ``oid = offset(partition) + index + 1``.

The only data reaching one task is the per-partition count table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from legwise.session import scratch_path

_INDEX_MASK = (1 << 33) - 1


def _sort_cols(order: list) -> list[Column]:
    return [F.col(c).asc_nulls_first() if isinstance(c, str) else c for c in order]


def global_row_number(df: DataFrame, order: list, out_col: str = "oid",
                      materialize: bool = True) -> DataFrame:
    """``df`` plus ``out_col`` = 1..n in ``order`` (ascending, nulls first for
    plain names). The order must be total for the numbering to repeat; add a
    tie-break column when it is not."""
    spark = df.sparkSession
    tagged = (df.orderBy(*_sort_cols(order))
              .withColumn("_pid", F.spark_partition_id())
              .withColumn("_mid", F.monotonically_increasing_id()))
    if materialize:
        path = scratch_path(spark, "numbered")
        tagged.write.mode("overwrite").parquet(path)
        tagged = spark.read.parquet(path)
    counts = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"))
    # one row per partition: a proven bound for the broadcast
    return (tagged.join(F.broadcast(offsets), "_pid")
            .withColumn(out_col, (F.col("_off") + F.col("_mid").bitwiseAND(F.lit(_INDEX_MASK)) + 1)
                        .cast("int"))
            .drop("_pid", "_mid", "_off"))
