"""Ordered sequence within groups: ``row_number``, ``lag`` and ``lead`` over
one window spec (SURVEY §2.7 W1-W3), safe for hot groups.

A plain ``Window.partitionBy(keys)`` sends each group to one task. That is
the right plan for normal groups (one Exchange + Sort + Window), but a single
group holding a large share of the rows would then be sorted by one task. So:

1. hot groups are found from a sample of the rows (no group is ever collected;
   only the bounded list of hot keys reaches the driver);
2. rows of normal groups take the plain window;
3. rows of hot groups get a chunk id before any shuffle: a sample of the hot
   rows' order columns gives sorted chunk boundaries (about one per
   ``rows_per_task`` rows), and a binary search over them numbers each row's
   contiguous chunk. One hash exchange on ``(keys, chunk)`` then feeds the
   window, and a small per-chunk summary (count, first and last row) fixes
   ``row_number`` offsets and the ``lag``/``lead`` values that cross a chunk
   edge.

Samples are chosen by a hash of keys and order columns, never at random, so a
recomputed task chooses the same rows and repeat runs cut the same chunks. The
boundaries are written once and read by every use. The hot path needs an order
without ties (a tie-break column); chunks of equal rows could not be told apart.

Both paths give exactly the same result; the choice only moves work.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from legwise.session import written

DEFAULT_ROWS_PER_TASK = 4_000_000
_SAMPLE_HITS = 64  # expected sampled rows of a group at the hot threshold
_HASH_RANGE = 1 << 20


def _order_cols(order: list[str]) -> list[Column]:
    return [F.col(c).asc_nulls_first() for c in order]


def _plain(df: DataFrame, keys, order, lags, leads, seq_col) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*_order_cols(order))
    cols = [F.row_number().over(w).alias(seq_col)]
    cols += [F.lag(src).over(w).alias(out) for out, src in lags.items()]
    cols += [F.lead(src).over(w).alias(out) for out, src in leads.items()]
    return df.select("*", *cols)


def _chosen(columns: list[str], fraction: Column | float, salt: int) -> Column:
    """Whether a row belongs to a sample of about ``fraction``: a hash of its
    columns decides."""
    place = F.pmod(F.xxhash64(F.lit(salt), *[F.col(c) for c in columns]), F.lit(_HASH_RANGE))
    return place < F.ceil((F.lit(fraction) if isinstance(fraction, float) else fraction) * _HASH_RANGE)


def detect_hot_keys(df: DataFrame, keys: list[str], rows_per_task: int = DEFAULT_ROWS_PER_TASK,
                    order: list[str] | None = None) -> DataFrame | None:
    """Keys whose estimated row count reaches ``rows_per_task / 2``, with that
    estimate as ``_est_rows``; ``None`` when there are none.

    A sample of the rows, chosen by a hash of keys and ``order`` (default: all
    columns), is counted per key (a partial aggregate); only these columns are
    read. At most ``2 * rows / rows_per_task`` keys can qualify, so the list is
    bounded and safe to broadcast.
    """
    fraction = min(1.0, _SAMPLE_HITS / float(rows_per_task))
    min_hits = max(1, int(math.ceil(rows_per_task / 2.0 * fraction)))
    used = [*keys, *(order or [c for c in df.columns if c not in keys])]
    sampled = df.where(_chosen(used, fraction, 7)) if fraction < 1 else df
    counts = sampled.groupBy(*keys).agg(F.count(F.lit(1)).alias("_hits")).where(F.col("_hits") >= min_hits)
    hot = counts.select(*keys, (F.col("_hits") / fraction).alias("_est_rows")).collect()
    if not hot:
        return None
    return df.sparkSession.createDataFrame([tuple(r) for r in hot], df.select(*keys).schema.add("_est_rows", "double"))


_BOUND_SAMPLES = 16  # sampled rows per chunk used to place its boundary
_SEARCH_STEPS = 24   # binary-search depth: up to 16M chunks per key


def _null_safe_on(left: DataFrame, right: DataFrame, keys, prefix: str):
    cond = None
    for k in keys:
        c = left[k].eqNullSafe(right[f"{prefix}{k}"])
        cond = c if cond is None else cond & c
    return cond


def _chunk_bounds(df: DataFrame, hot_keys: DataFrame, keys, order, rows_per_task: int) -> DataFrame:
    """Per hot key: sorted array of order-struct boundaries, one per chunk of
    about ``rows_per_task`` rows. Built from a per-key sample of about
    ``_BOUND_SAMPLES`` rows per chunk, so its size is bounded by
    ``hot rows / rows_per_task`` boundaries."""
    hk = hot_keys.select(*[F.col(k).alias(f"_b_{k}") for k in keys],
                         F.greatest(F.lit(1.0), F.ceil(F.col("_est_rows") / rows_per_task)).alias("_chunks"),
                         F.col("_est_rows"))
    hk = hk.withColumn("_frac", F.least(F.lit(1.0), F.col("_chunks") * _BOUND_SAMPLES / F.col("_est_rows")))
    ordv = F.struct(*[F.col(c) for c in order]).alias("_o")
    sample = (df.join(F.broadcast(hk), _null_safe_on(df, hk, keys, "_b_"), "inner")
              .filter(_chosen([*keys, *order], F.col("_frac"), 11))
              .select(*keys, "_chunks", ordv))
    w = Window.partitionBy(*keys).orderBy("_o")
    sample = sample.select("*", F.row_number().over(w).alias("_rn"),
                           F.count(F.lit(1)).over(Window.partitionBy(*keys)).alias("_n"))
    step = F.greatest(F.lit(1), F.floor(F.col("_n") / F.col("_chunks")))
    cuts = sample.filter((F.col("_rn") % step == 0) & (F.col("_rn") < F.col("_n")))
    return cuts.groupBy(*keys).agg(F.sort_array(F.collect_list("_o")).alias("_bounds"))


def _chunk_of(ordv: Column, bounds: Column) -> Column:
    """Number of boundaries <= the row's order struct (binary search over the
    sorted array): the row's chunk, monotone in the order."""
    n = F.coalesce(F.size(bounds), F.lit(0))

    def step(lo, i):
        cand = lo + F.call_function("shiftleft", F.lit(1), F.lit(_SEARCH_STEPS - 1) - i)
        return F.when((cand <= n) & (F.element_at(bounds, cand.cast("int")) <= ordv), cand).otherwise(lo)
    return F.when(bounds.isNull(), F.lit(0)).otherwise(
        F.aggregate(F.sequence(F.lit(0), F.lit(_SEARCH_STEPS - 1)), F.lit(0), step))


def _chunked(df: DataFrame, hot_keys: DataFrame, keys, order, lags, leads, seq_col,
             rows_per_task: int) -> DataFrame:
    """Window over hot groups split into contiguous chunks (one shuffle)."""
    ck = "_chunk"
    # Written once: a recomputed task must not cut the chunks elsewhere.
    bounds, _ = written(_chunk_bounds(df, hot_keys, keys, order, rows_per_task), "chunk-bounds")
    bounds = bounds.select(*[F.col(k).alias(f"_c_{k}") for k in keys], "_bounds")
    tagged = (df.join(F.broadcast(bounds), _null_safe_on(df, bounds, keys, "_c_"), "left")
              .withColumn(ck, _chunk_of(F.struct(*[F.col(c) for c in order]), F.col("_bounds")))
              .drop("_bounds", *[f"_c_{k}" for k in keys]))
    w = Window.partitionBy(*keys, ck).orderBy(*_order_cols(order))
    local = tagged.select(
        "*", F.row_number().over(w).alias("_rn"),
        *[F.lag(src).over(w).alias(f"_lag_{out}") for out, src in lags.items()],
        *[F.lead(src).over(w).alias(f"_lead_{out}") for out, src in leads.items()])

    # One row per (group, chunk): size, first row (feeds leads) and last row
    # (feeds lags). Grouped like the window, so no new Exchange.
    first_struct = F.struct(*[F.col(src).alias(out) for out, src in leads.items()]) if leads else F.lit(None)
    last_struct = F.struct(*[F.col(src).alias(out) for out, src in lags.items()]) if lags else F.lit(None)
    summary = local.groupBy(*keys, ck).agg(F.count(F.lit(1)).alias("_cnt"),
                                          F.min_by(first_struct, F.col("_rn")).alias("_first"),
                                          F.max_by(last_struct, F.col("_rn")).alias("_last"))
    sw = Window.partitionBy(*keys).orderBy(ck)
    summary = summary.select(
        *keys, ck, "_cnt",
        F.coalesce(F.sum("_cnt").over(sw.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_offset"),
        F.lag("_last").over(sw).alias("_prev_last"),
        F.lead("_first").over(sw).alias("_next_first"))
    # The summary has one row per (hot key, chunk): a proven bound.
    # Null-safe on the keys: a null key can be the hot one.
    summary = summary.select(*[F.col(k).alias(f"_s_{k}") for k in keys],
                             *[c for c in summary.columns if c not in keys])
    cond = (local[ck] == summary[ck]) & _null_safe_on(local, summary, keys, "_s_")
    joined = local.join(F.broadcast(summary), cond, "inner").drop(summary[ck])
    out = [(F.col("_rn") + F.col("_offset")).cast("int").alias(seq_col)]
    out += [F.when(F.col("_rn") == 1, F.col(f"_prev_last.{o}")).otherwise(F.col(f"_lag_{o}")).alias(o)
            for o in lags]
    out += [F.when(F.col("_rn") == F.col("_cnt"), F.col(f"_next_first.{o}")).otherwise(F.col(f"_lead_{o}")).alias(o)
            for o in leads]
    return joined.select(*df.columns, *out)


def sequence_within(df: DataFrame, keys: list[str], order: list[str],
                    lags: dict[str, str] | None = None, leads: dict[str, str] | None = None,
                    seq_col: str = "seq", hot_keys: DataFrame | str | None = "auto",
                    rows_per_task: int = DEFAULT_ROWS_PER_TASK) -> DataFrame:
    """Add ``seq_col`` (row_number), ``lags`` and ``leads`` (``{out: source}``)
    over ``PARTITION BY keys ORDER BY order`` (ascending, nulls first).

    ``hot_keys``: ``"auto"`` samples for hot groups, ``None`` always takes the
    plain window, or a DataFrame of keys (+ optional ``_est_rows``) to split.
    Hot groups need an ``order`` that has no ties within a group.
    """
    lags, leads = dict(lags or {}), dict(leads or {})
    if isinstance(hot_keys, str):
        if hot_keys != "auto":
            raise ValueError(f"hot_keys must be 'auto', None or a DataFrame, not {hot_keys!r}")
        hot_keys = detect_hot_keys(df, keys, rows_per_task, order)
    if hot_keys is None:
        return _plain(df, keys, order, lags, leads, seq_col)

    if "_est_rows" not in hot_keys.columns:
        hot_keys = hot_keys.withColumn("_est_rows", F.lit(float(rows_per_task)))
    hot_keys = hot_keys.select(*keys, F.col("_est_rows").cast("double"))
    # Null-safe key match: a null key can be the hot one.
    hot = F.broadcast(hot_keys.select(*[F.col(k).alias(f"_hk_{k}") for k in keys]).distinct())
    cond = _null_safe_on(df, hot, keys, "_hk_")
    normal_rows = df.join(hot, cond, "left_anti")
    hot_rows = df.join(hot, cond, "left_semi")
    plain = _plain(normal_rows, keys, order, lags, leads, seq_col)
    chunked = _chunked(hot_rows, hot_keys, keys, order, lags, leads, seq_col, rows_per_task)
    return plain.unionByName(chunked)
