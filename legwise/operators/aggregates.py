"""The seven daily aggregates of the refresh.

Every table counts distinct trips. Instead of ``countDistinct`` (which Spark
plans as an ``Expand`` that copies each row once per distinct set before the
first shuffle), each table is aggregated in two levels: per (group, trip)
— leg count, "has a transfer", and sum + count of every averaged column,
all combined map-side — then per group. Same two shuffles, a third of the
rows, no ``Expand``; the first shuffle is keyed by group *and* trip, so a hot
group is spread over many tasks and arrives pre-aggregated. Averages are
``sum / count`` over non-null values, as ``AVG`` is.

G6 groups by the G5 keys minus ``route_short_name``, which is the same
expression as ``to_route_short_name``; it is therefore a projection of G5
and is derived from it without another shuffle. ACCESS and EGRESS walk rows
come from one pass: each walk leg emits 0-2 roles, then one ``groupBy``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from legwise.functions import hashing as H
from legwise.functions import labels as L


def _avg(c: str) -> Column:
    return F.avg(F.col(c).cast("double"))


def by_trip(df: DataFrame, keys: list[str], avgs: dict[str, str], count_name: str, trips_name: str,
            transfer_trips_name: str | None = None, transfer_legs_name: str | None = None) -> DataFrame:
    """Two-level aggregate: ``count(*)``, ``count(DISTINCT user_trip_id)``,
    optionally ``count(DISTINCT CASE WHEN is_transfer_leg = 1 THEN user_trip_id END)``
    and ``sum(is_transfer_leg = 1)``, and ``avg`` of each ``avgs`` column."""
    lvl1 = [F.count(F.lit(1)).alias("_n")]
    if transfer_trips_name or transfer_legs_name:
        tr = (F.col("is_transfer_leg") == 1).cast("int")
        lvl1 += [F.max(tr).alias("_tr"), F.sum(tr).alias("_trl")]
    for out, src in avgs.items():
        v = F.col(src).cast("double")
        lvl1 += [F.sum(v).alias(f"_s_{out}"), F.count(v).alias(f"_c_{out}")]
    per_trip = df.groupBy(*keys, "user_trip_id").agg(*lvl1)
    lvl2 = [F.sum("_n").cast("int").alias(count_name)]
    if transfer_legs_name:
        lvl2.append(F.sum("_trl").cast("int").alias(transfer_legs_name))
    lvl2.append(F.count("user_trip_id").cast("int").alias(trips_name))
    if transfer_trips_name:
        lvl2.append(F.count(F.when(F.col("_tr") == 1, F.col("user_trip_id"))).cast("int")
                    .alias(transfer_trips_name))
    for out in avgs:
        c = F.sum(f"_c_{out}")
        lvl2.append(F.when(c > 0, F.sum(f"_s_{out}") / c).alias(out))
    return per_trip.groupBy(*keys).agg(*lvl2)


FLOW_AVGS = {"avg_manhattan_mi": "manhattan_distance_mi", "avg_euclidean_mi": "euclidean_distance_mi",
             "mean_start_lon": "start_longitude", "mean_start_lat": "start_latitude",
             "mean_end_lon": "end_longitude", "mean_end_lat": "end_latitude",
             "avg_leg_minutes": "leg_minutes"}
HOTSPOT_AVGS = {"mean_lon": "start_longitude", "mean_lat": "start_latitude", "avg_leg_minutes": "leg_minutes"}
WALK_AVGS = {"avg_walk_minutes": "leg_minutes", "avg_walk_euclidean_mi": "euclidean_distance_mi",
             "avg_walk_manhattan_mi": "manhattan_distance_mi", "mean_start_lon": "start_longitude",
             "mean_start_lat": "start_latitude", "mean_end_lon": "end_longitude", "mean_end_lat": "end_latitude"}


def _flows(df: DataFrame, keys: list[str]) -> DataFrame:
    return by_trip(df, keys, FLOW_AVGS, "leg_count", "trip_count", transfer_trips_name="transfer_trip_count")


def _hotspots(df: DataFrame, keys: list[str]) -> DataFrame:
    return by_trip(df, keys, HOTSPOT_AVGS, "transfer_events", "transfer_trips")


FLOW_DAILY_COLUMNS = ("trip_date", "Origin_BG", "Dest_BG", "service_group", "provider_name",
                      "leg_count", "trip_count", "transfer_trip_count",
                      "avg_manhattan_mi", "avg_euclidean_mi",
                      "mean_start_lon", "mean_start_lat", "mean_end_lon", "mean_end_lat",
                      "avg_leg_minutes")


def flow_daily(flags: DataFrame) -> DataFrame:
    """G1: flows per day, origin, destination, service group and provider."""
    return _flows(flags, ["trip_date", "Origin_BG", "Dest_BG", "service_group", "provider_name"]) \
        .select(*FLOW_DAILY_COLUMNS)


def flow_daily_route(flags: DataFrame) -> DataFrame:
    """G1 split by the "to route" label."""
    return (flags.drop("route_short_name")
            .withColumnRenamed("to_route_short_name_label", "route_short_name")
            .transform(lambda d: _flows(d, ["trip_date", "route_short_name", "Origin_BG", "Dest_BG",
                                            "service_group", "provider_name"]))
            .select("trip_date", "route_short_name", *FLOW_DAILY_COLUMNS[1:]))


def transfer_legs(flags: DataFrame) -> DataFrame:
    """F9 + J5: transfer legs with their hotspot key computed once."""
    return (flags.filter(F.col("is_transfer_leg") == 1)
            .withColumn("hotspot_key", L.hotspot_key("start_stop_name", "start_longitude", "start_latitude")))


def transfer_hotspots(flags: DataFrame) -> DataFrame:
    """Transfer hotspots per day, key, provider and raw stop name."""
    return _hotspots(transfer_legs(flags), ["trip_date", "hotspot_key", "provider_name", "start_stop_name"]) \
        .select("trip_date", "hotspot_key", "provider_name", "start_stop_name",
                "transfer_events", "transfer_trips", "mean_lon", "mean_lat", "avg_leg_minutes")


ROUTE_HOTSPOT_COLUMNS = ("trip_date", "route_short_name", "transfer_type", "hotspot_key", "hotspot_hash",
                         "provider_name", "start_stop_name", "from_route_short_name", "to_route_short_name",
                         "transfer_events", "transfer_trips", "mean_lon", "mean_lat", "avg_leg_minutes")


def transfer_hotspots_route(flags: DataFrame) -> DataFrame:
    """Hotspots by route, transfer type and route pair, with the key's
    SHA-256 (UTF-16LE bytes). The hash is a function of the key, so it is
    computed after the aggregate, once per output row."""
    legs = transfer_legs(flags).select(
        "trip_date", "hotspot_key", "provider_name", "start_stop_name", "user_trip_id",
        "start_longitude", "start_latitude", "leg_minutes",
        F.coalesce(F.col("transfer_type"), F.lit("OTHER")).alias("transfer_type"),
        F.coalesce(F.col("from_route_short_name_label"), F.lit(L.NA_LABEL)).alias("from_route_short_name"),
        F.coalesce(F.col("to_route_short_name_label"), F.lit(L.NA_LABEL)).alias("to_route_short_name"))
    agg = _hotspots(legs, ["trip_date", "transfer_type", "hotspot_key", "provider_name", "start_stop_name",
                           "from_route_short_name", "to_route_short_name"])
    return agg.select("trip_date", F.col("to_route_short_name").alias("route_short_name"), "transfer_type",
                      "hotspot_key", H.utf16_sha256("hotspot_key").alias("hotspot_hash"),
                      *ROUTE_HOTSPOT_COLUMNS[5:])


def transfer_hotspots_routepair(route_hotspots: DataFrame) -> DataFrame:
    """G6 from G5: the same groups without the duplicated route column."""
    return route_hotspots.drop("route_short_name")


def bg_summary(flags: DataFrame) -> DataFrame:
    """Per day and origin block group."""
    t = by_trip(flags, ["trip_date", "Origin_BG"], {"avg_leg_minutes": "leg_minutes"}, "legs", "trips",
                transfer_trips_name="trips_with_transfer", transfer_legs_name="transfer_legs")
    return t.select("trip_date", "Origin_BG", "legs", "transfer_legs", "trips", "trips_with_transfer",
                    F.when(F.col("trips") == 0, F.lit(0.0))
                     .otherwise(F.col("trips_with_transfer").cast("double") / F.col("trips"))
                     .alias("pct_trips_with_transfer"),
                    "avg_leg_minutes")


WALK_COLUMNS = ("trip_date", "walk_type", "related_service", "related_route", "stop_key", "stop_name",
                "provider_name", "walk_leg_count", "trip_count", "avg_walk_minutes",
                "avg_walk_euclidean_mi", "avg_walk_manhattan_mi",
                "mean_start_lon", "mean_start_lat", "mean_end_lon", "mean_end_lat")
_TRANSIT = (L.FIXED_ROUTE_SERVICE, L.DEMAND_RESPONSE_SERVICE)


def walk_roles(flags: DataFrame, types: tuple[str, ...] = ("ACCESS", "EGRESS")) -> DataFrame:
    """F10 + U1: one row per (walk leg, role). A walk leg followed by transit is
    ACCESS (neighbour = next leg), preceded by transit is EGRESS (neighbour =
    previous leg); a walk leg between two transit legs has both roles."""
    def role(kind: str, svc: str, route: str, stop: str) -> Column:
        return F.when(F.col(svc).isin(*_TRANSIT),
                      F.struct(F.lit(kind).alias("walk_type"), F.col(svc).alias("svc"),
                               F.col(route).alias("route"), F.col(stop).alias("stop")))
    arms = {"ACCESS": role("ACCESS", "next_service_name", "next_route_short_name", "next_start_stop_name"),
            "EGRESS": role("EGRESS", "prev_service_name", "prev_route_short_name", "prev_end_stop_name")}
    roles = F.filter(F.array(*[arms[t] for t in types]), lambda r: r.isNotNull())
    walk = flags.filter(F.lower(F.col("mode")) == "walk")
    return (walk.select("trip_date", "user_trip_id", "leg_minutes", "euclidean_distance_mi",
                        "manhattan_distance_mi", "start_longitude", "start_latitude",
                        "end_longitude", "end_latitude", F.explode(roles).alias("r"))
            .select("*", F.col("r.walk_type").alias("walk_type"),
                    L.related_service("r.svc").alias("related_service"),
                    L.related_route("r.svc", "r.route").alias("related_route"),
                    L.stop_key("r.stop").alias("stop_key"),
                    F.col("r.stop").alias("stop_name"))
            .drop("r"))


def walk_access_egress(flags: DataFrame, types: tuple[str, ...] = ("ACCESS", "EGRESS")) -> DataFrame:
    """G7a + G7b (U1) in one group-by."""
    return (by_trip(walk_roles(flags, types),
                    ["trip_date", "walk_type", "related_service", "related_route", "stop_key", "stop_name"],
                    WALK_AVGS, "walk_leg_count", "trip_count")
            .withColumn("provider_name", F.lit(L.UNKNOWN_PROVIDER))
            .select(*WALK_COLUMNS))


def all_aggregates(flags: DataFrame) -> dict[str, DataFrame]:
    """The seven target tables of the refresh, keyed by table name."""
    route_hotspots = transfer_hotspots_route(flags)
    return {
        "Flow_BG_BG_Daily": flow_daily(flags),
        "Transfer_Hotspots_Daily": transfer_hotspots(flags),
        "BG_Summary_Daily": bg_summary(flags),
        "Flow_BG_BG_Daily_Route": flow_daily_route(flags),
        "Transfer_Hotspots_Daily_Route": route_hotspots,
        "Transfer_Hotspots_Daily_RoutePair": transfer_hotspots_routepair(route_hotspots),
        "Walk_AccessEgress_Daily": walk_access_egress(flags),
    }
