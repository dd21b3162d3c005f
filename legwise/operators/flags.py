"""The flag stage of the refresh: filter the window, label each leg, order
the legs of each trip and flag transfers (SURVEY §2.4 F6-F8, §2.7 W1-W3,
§2.10 X1-X6).

The filters run *before* the window functions: a leg removed for a bad
block group makes its neighbours adjacent, exactly as in the reference.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from legwise.functions import labels as L
from legwise.functions import timefns as T
from legwise.operators.sequence import DEFAULT_ROWS_PER_TASK, sequence_within

TRIP_KEYS = ("user_trip_id", "trip_date")
TRIP_ORDER = ("start_time_utc", "end_time_utc")

# The 17 columns of the clean table read by the refresh, in order.
BASE_SOURCE_COLUMNS = ("user_trip_id", "trip_date", "start_time_utc", "end_time_utc",
                       "start_longitude", "start_latitude", "end_longitude", "end_latitude",
                       "service_name", "route_short_name", "mode",
                       "start_stop_name", "end_stop_name", "Origin_BG", "Dest_BG",
                       "manhattan_distance_mi", "euclidean_distance_mi")
DERIVED_BASE_COLUMNS = ("service_group", "provider_name", "leg_minutes")
LAGS = {"prev_service_name": "service_name",
        "prev_route_short_name": "route_short_name",
        "prev_end_stop_name": "end_stop_name"}
LEADS = {"next_service_name": "service_name",
         "next_route_short_name": "route_short_name",
         "next_start_stop_name": "start_stop_name"}
FLAG_COLUMNS = ("to_route_short_name_label", "from_route_short_name_label",
                "is_transfer_leg", "transfer_type")


def base_filter(as_of, days_back: int = 31, region_prefix: str | None = None) -> Column:
    """F6-F8 as one predicate: window days, valid block groups, optional prefix
    on both ends (a literal prefix, not a LIKE pattern)."""
    cond = T.in_window("trip_date", as_of, days_back) & L.bg_is_valid("Origin_BG") & L.bg_is_valid("Dest_BG")
    if region_prefix is not None:
        cond = cond & F.col("Origin_BG").startswith(region_prefix) & F.col("Dest_BG").startswith(region_prefix)
    return cond


def base_legs(clean: DataFrame, as_of=None, days_back: int = 31,
              region_prefix: str | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """The ``base`` stage: 17 source columns + service group, provider, minutes.
    ``keep`` carries extra columns through (e.g. the tie-break column)."""
    extra = [c for c in keep if c not in BASE_SOURCE_COLUMNS]
    return (clean
            .filter(base_filter(as_of, days_back, region_prefix))
            .select(*extra, *BASE_SOURCE_COLUMNS,
                    L.service_group("service_name", "mode").alias("service_group"),
                    L.provider_name("service_name").alias("provider_name"),
                    T.leg_minutes("start_time_utc", "end_time_utc").alias("leg_minutes")))


def ordered_legs(base: DataFrame, tie_break: str | None = "row_hash",
                 hot_keys: DataFrame | str | None = "auto", rows_per_task: int = DEFAULT_ROWS_PER_TASK) -> DataFrame:
    """``leg_seq`` and the previous/next leg's service, route and stop,
    all over one window ``(user_trip_id, trip_date) ORDER BY start, end``.
    ``tie_break`` is appended to the order so results repeat; without one hot
    trips cannot be split and take the plain window."""
    order = list(TRIP_ORDER) + ([tie_break] if tie_break else [])
    if tie_break is None:
        if isinstance(hot_keys, DataFrame):
            raise ValueError("hot trips can only be split in an order without ties: name a tie_break column")
        hot_keys = None
    return sequence_within(base, list(TRIP_KEYS), order, lags=LAGS, leads=LEADS,
                           seq_col="leg_seq", hot_keys=hot_keys, rows_per_task=rows_per_task)


def add_flags(ordered: DataFrame) -> DataFrame:
    """X3-X6 on top of the ordered legs."""
    return ordered.select(
        "*",
        L.to_route_label("service_name", "route_short_name", "mode").alias("to_route_short_name_label"),
        L.from_route_label("prev_service_name", "prev_route_short_name").alias("from_route_short_name_label"),
        L.is_transfer_leg("prev_service_name", "service_name",
                          "prev_route_short_name", "route_short_name").alias("is_transfer_leg"),
        L.transfer_type("prev_service_name", "service_name",
                        "prev_route_short_name", "route_short_name").alias("transfer_type"))


def flags(clean: DataFrame, as_of=None, days_back: int = 31, region_prefix: str | None = None,
          tie_break: str | None = "row_hash", hot_keys: DataFrame | str | None = "auto",
          rows_per_task: int = DEFAULT_ROWS_PER_TASK) -> DataFrame:
    """The whole flag stage (``#flags`` of the reference) as one lazy plan.
    Trips above ``rows_per_task`` legs take the split window path."""
    keep = (tie_break,) if tie_break else ()
    base = base_legs(clean, as_of, days_back, region_prefix, keep=keep)
    return add_flags(ordered_legs(base, tie_break, hot_keys=hot_keys, rows_per_task=rows_per_task))
