"""Insert-only merge on the row hash.

Keys are ``(trip_date, row_hash)``: the hash covers the file date the trip
date is parsed from, so the pair is no finer than the hash itself, but it
lets the anti join against the stored table (partitioned by ``trip_date``)
prune to the batch's days — dynamic partition pruning reads only the
partitions whose dates occur in the batch. Dedupe and anti join share the
key, so the batch is shuffled once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEYS = ("trip_date", "row_hash")


def dedupe_batch(batch: DataFrame, keys=KEYS) -> DataFrame:
    """D-3: one row per key. Copies agree on every hashed field; among copies
    that differ elsewhere (distances are not hashed) the smallest row is kept,
    so the result repeats. ``min(struct)`` is combined map-side, so a key with
    many copies is pre-aggregated before the shuffle."""
    rest = [c for c in batch.columns if c not in keys]
    if not rest:
        return batch.dropDuplicates(list(keys))
    return (batch.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_r"))
            .select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest])
            .select(*batch.columns))


def new_rows(batch: DataFrame, existing: DataFrame | None, keys=KEYS, min_date=None) -> DataFrame:
    """Rows of the batch whose key is not stored yet, one for each key.
    Known rows go first, so only new ones are reduced to one a key.

    The stored side is cut to the batch's days first: a left-anti join gets
    no dynamic partition pruning, so without this every run would shuffle the
    keys of the whole stored table. ``min_date`` (known from the extract
    watermark) gives a static partition filter; otherwise the batch's
    min/max ``trip_date`` are scalar subqueries, which Spark evaluates before
    listing the stored table's partitions.
    """
    if existing is None:
        return dedupe_batch(batch, keys)
    stored = existing.select(*keys)
    if min_date is not None:
        stored = stored.filter(F.col("trip_date") >= F.lit(str(min_date)).cast("date"))
    else:
        bounds = batch.agg(F.struct(F.min("trip_date").alias("lo"), F.max("trip_date").alias("hi"))).scalar()
        stored = stored.filter((F.col("trip_date") >= bounds.getField("lo"))
                               & (F.col("trip_date") <= bounds.getField("hi")))
    return dedupe_batch(batch.join(stored, list(keys), "left_anti").select(*batch.columns), keys)
