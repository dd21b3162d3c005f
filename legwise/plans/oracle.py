"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

Written independently of the Spark operators: walk roles as a UNION ALL,
the route-pair table grouped directly, global numbering as a plain
``ROW_NUMBER() OVER (ORDER BY ...)``. Doubles are rounded to 6 places and
hashes are lower-case hex, as in ``catalog.presentable``.
"""

from __future__ import annotations

import datetime as dt
import math

from legwise.sources import fixtures as FX

_AS_OF = dt.date.fromisoformat(FX.AS_OF)
START = (_AS_OF - dt.timedelta(days=FX.DAYS_BACK)).isoformat()
END = _AS_OF.isoformat()
# --- fixed values, stated here again so that a fault in the engine's own shows ---
FIXED, DEMAND = "'AGENCY_FIXED_ROUTE'", "'AGENCY_DEMAND_RESPONSE'"
PROVIDERS = "'AGENCY_FIXED_ROUTE', 'AGENCY_DEMAND_RESPONSE', 'BIKESHARE', 'SCOOTER_VENDOR', 'RIDESHARE_VENDOR'"
MODE_ARMS = """WHEN lower(mode) = 'walk' THEN 'WALK'
         WHEN lower(mode) IN ('bike', 'bikeshare') THEN 'BIKE'
         WHEN lower(mode) = 'scooter' THEN 'SCOOTER'
         WHEN lower(mode) = 'rideshare' THEN 'RIDESHARE'
         WHEN lower(mode) = 'transit' THEN 'OTHER_TRANSIT'"""
# EPSG:32140: semi-major axis, inverse flattening, origin, standard parallels (degrees), false origin.
AXIS, INVERSE_FLATTENING = 6378137.0, 298.257222101
ORIGIN_LAT, ORIGIN_LON, PARALLEL_1, PARALLEL_2 = 27 + 50 / 60, -99.0, 30 + 17 / 60, 28 + 23 / 60
FALSE_EASTING, FALSE_NORTHING = 600000.0, 4000000.0
# ----------------------------------------------------------------------------------


def nb(x: str) -> str:
    """Blank test (NULLIF with trailing-blank padding)."""
    return f"CASE WHEN rtrim({x}) <> '' THEN {x} END"


def r6(x: str, alias: str | None = None) -> str:
    return f"ROUND({x}, 6) AS {alias}" if alias else f"ROUND({x}, 6)"


def coord_text(x: str) -> str:
    return f"COALESCE(printf('%.6g', round({x}, 4)), '')"


def hotspot_key(stop: str = "start_stop_name", lon: str = "start_longitude", lat: str = "start_latitude") -> str:
    return f"COALESCE({nb(stop)}, 'COORD_' || {coord_text(lon)} || '_' || {coord_text(lat)})"


def utf16_sha256(x: str) -> str:
    # ASCII keys: UTF-16LE bytes are each byte followed by 0x00
    return rf"sha256(unhex(regexp_replace(hex({x}), '(..)', '\100', 'g')))"


def num_text(x: str) -> str:
    return rf"regexp_replace(regexp_replace(printf('%.9f', {x}), '0+$', ''), '\.$', '')"


def legs_cte() -> str:
    return f"legs AS (\n{FX.legs_sql()}\n)"


def base_cte(prefix: str | None = None) -> str:
    region = ""
    if prefix is not None:
        region = f"\n    AND starts_with(Origin_BG, '{prefix}') AND starts_with(Dest_BG, '{prefix}')"
    return f"""base AS (
  SELECT event_id, user_trip_id, trip_date, start_time_utc, end_time_utc,
    start_longitude, start_latitude, end_longitude, end_latitude,
    service_name, route_short_name, mode, start_stop_name, end_stop_name,
    Origin_BG, Dest_BG, manhattan_distance_mi, euclidean_distance_mi,
    CASE WHEN service_name = {FIXED} THEN 'FIXED_ROUTE'
         WHEN service_name = {DEMAND} THEN 'DEMAND_RESPONSE'
         {MODE_ARMS}
         ELSE 'OTHER' END AS service_group,
    CASE WHEN service_name IN ({PROVIDERS})
         THEN service_name ELSE '(UNKNOWN)' END AS provider_name,
    CASE WHEN start_time_utc IS NOT NULL AND end_time_utc IS NOT NULL AND end_time_utc >= start_time_utc
         THEN CAST(date_diff('second', start_time_utc, end_time_utc) AS DOUBLE) / 60.0 END AS leg_minutes
  FROM legs
  WHERE trip_date >= DATE '{START}' AND trip_date < DATE '{END}'
    AND Origin_BG IS NOT NULL AND Dest_BG IS NOT NULL
    AND length(rtrim(Origin_BG)) = 12 AND length(rtrim(Dest_BG)) = 12{region}
)"""


ORDERED_CTE = """ordered AS (
  SELECT *,
    CAST(row_number() OVER w AS INTEGER) AS leg_seq,
    lag(service_name) OVER w AS prev_service_name,
    lag(route_short_name) OVER w AS prev_route_short_name,
    lag(end_stop_name) OVER w AS prev_end_stop_name,
    lead(service_name) OVER w AS next_service_name,
    lead(route_short_name) OVER w AS next_route_short_name,
    lead(start_stop_name) OVER w AS next_start_stop_name
  FROM base
  WINDOW w AS (PARTITION BY user_trip_id, trip_date
               ORDER BY start_time_utc ASC NULLS FIRST, end_time_utc ASC NULLS FIRST, event_id ASC NULLS FIRST)
)"""

_F2D = f"(prev_service_name = {FIXED} AND service_name = {DEMAND})"
_D2F = f"(prev_service_name = {DEMAND} AND service_name = {FIXED})"
_RC = (f"(prev_service_name = {FIXED} AND service_name = {FIXED} "
       f"AND coalesce(prev_route_short_name, '') <> coalesce(route_short_name, ''))")

FLAGS_CTE = f"""flags AS (
  SELECT *,
    CASE WHEN service_name = {DEMAND} THEN 'DEMAND_RESPONSE'
         WHEN service_name = {FIXED} THEN coalesce({nb('route_short_name')}, '(UNKNOWN_ROUTE)')
         WHEN lower(mode) = 'walk' THEN 'WALK'
         ELSE coalesce({nb('route_short_name')}, '(NA)') END AS to_route_short_name_label,
    CASE WHEN prev_service_name = {DEMAND} THEN 'DEMAND_RESPONSE'
         WHEN prev_service_name = {FIXED} THEN coalesce({nb('prev_route_short_name')}, '(UNKNOWN_ROUTE)')
         WHEN prev_service_name IS NULL THEN NULL
         ELSE coalesce({nb('prev_route_short_name')}, '(NA)') END AS from_route_short_name_label,
    CASE WHEN prev_service_name IS NULL THEN 0
         WHEN {_F2D} OR {_D2F} OR {_RC} THEN 1 ELSE 0 END AS is_transfer_leg,
    CASE WHEN prev_service_name IS NULL THEN NULL
         WHEN {_F2D} THEN 'FIXED_TO_DEMAND'
         WHEN {_D2F} THEN 'DEMAND_TO_FIXED'
         WHEN {_RC} THEN 'ROUTE_CHANGE'
         ELSE 'OTHER' END AS transfer_type
  FROM ordered
)"""


def with_flags(select: str, prefix: str | None = None, extra_ctes: tuple[str, ...] = ()) -> str:
    ctes = [legs_cte(), base_cte(prefix), ORDERED_CTE, FLAGS_CTE, *extra_ctes]
    return "WITH " + ",\n".join(ctes) + "\n" + select


def _flow_measures() -> str:
    return f"""CAST(count(*) AS INTEGER) AS leg_count,
    CAST(count(DISTINCT user_trip_id) AS INTEGER) AS trip_count,
    CAST(count(DISTINCT CASE WHEN is_transfer_leg = 1 THEN user_trip_id END) AS INTEGER) AS transfer_trip_count,
    avg(manhattan_distance_mi) AS avg_manhattan_mi, avg(euclidean_distance_mi) AS avg_euclidean_mi,
    avg(start_longitude) AS mean_start_lon, avg(start_latitude) AS mean_start_lat,
    avg(end_longitude) AS mean_end_lon, avg(end_latitude) AS mean_end_lat,
    avg(leg_minutes) AS avg_leg_minutes"""


def _hotspot_measures() -> str:
    return """CAST(count(*) AS INTEGER) AS transfer_events,
    CAST(count(DISTINCT user_trip_id) AS INTEGER) AS transfer_trips,
    avg(start_longitude) AS mean_lon, avg(start_latitude) AS mean_lat, avg(leg_minutes) AS avg_leg_minutes"""


FLOW_ROUTE_CTE = f"""fdr AS (
  SELECT trip_date, to_route_short_name_label AS route_short_name, Origin_BG, Dest_BG, service_group,
    provider_name, {_flow_measures()}
  FROM flags GROUP BY trip_date, to_route_short_name_label, Origin_BG, Dest_BG, service_group, provider_name
)"""

TRANSFER_LEGS_CTE = f"""tl AS (
  SELECT *, {hotspot_key()} AS hotspot_key,
    coalesce(transfer_type, 'OTHER') AS tt,
    coalesce(from_route_short_name_label, '(NA)') AS from_route_short_name,
    coalesce(to_route_short_name_label, '(NA)') AS to_route_short_name
  FROM flags WHERE is_transfer_leg = 1
)"""

ROUTE_HOTSPOT_CTE = f"""thr AS (
  SELECT trip_date, to_route_short_name AS route_short_name, tt AS transfer_type, hotspot_key,
    {utf16_sha256('hotspot_key')} AS hotspot_hash, provider_name, start_stop_name,
    from_route_short_name, to_route_short_name, {_hotspot_measures()}
  FROM tl
  GROUP BY trip_date, tt, hotspot_key, provider_name, start_stop_name, from_route_short_name, to_route_short_name
)"""


def _walk_arm(kind: str, svc: str, route: str, stop: str) -> str:
    return f"""SELECT trip_date, '{kind}' AS walk_type,
    CASE WHEN {svc} = {FIXED} THEN 'FIXED_ROUTE' WHEN {svc} = {DEMAND} THEN 'DEMAND_RESPONSE'
         ELSE 'OTHER' END AS related_service,
    CASE WHEN {svc} = {DEMAND} THEN 'DEMAND_RESPONSE'
         WHEN {svc} = {FIXED} THEN coalesce({nb(route)}, '(UNKNOWN_ROUTE)') ELSE '(NA)' END AS related_route,
    coalesce({nb(stop)}, '(NO_STOP)') AS stop_key, {stop} AS stop_name, '(UNKNOWN)' AS provider_name,
    CAST(count(*) AS INTEGER) AS walk_leg_count, CAST(count(DISTINCT user_trip_id) AS INTEGER) AS trip_count,
    avg(leg_minutes) AS avg_walk_minutes, avg(euclidean_distance_mi) AS avg_walk_euclidean_mi,
    avg(manhattan_distance_mi) AS avg_walk_manhattan_mi,
    avg(start_longitude) AS mean_start_lon, avg(start_latitude) AS mean_start_lat,
    avg(end_longitude) AS mean_end_lon, avg(end_latitude) AS mean_end_lat
  FROM flags
  WHERE lower(mode) = 'walk' AND {svc} IN ({FIXED}, {DEMAND})
  GROUP BY ALL"""


ACCESS_SQL = _walk_arm("ACCESS", "next_service_name", "next_route_short_name", "next_start_stop_name")
EGRESS_SQL = _walk_arm("EGRESS", "prev_service_name", "prev_route_short_name", "prev_end_stop_name")
WALK_CTE = f"walk AS (\n{ACCESS_SQL}\nUNION ALL\n{EGRESS_SQL}\n)"

WALK_COLS = ("trip_date, walk_type, related_service, related_route, stop_key, stop_name, provider_name, "
             "walk_leg_count, trip_count")
WALK_AVGS = ("avg_walk_minutes", "avg_walk_euclidean_mi", "avg_walk_manhattan_mi",
             "mean_start_lon", "mean_start_lat", "mean_end_lon", "mean_end_lat")
FLOW_AVGS = ("avg_manhattan_mi", "avg_euclidean_mi", "mean_start_lon", "mean_start_lat",
             "mean_end_lon", "mean_end_lat", "avg_leg_minutes")
HOT_AVGS = ("mean_lon", "mean_lat", "avg_leg_minutes")


def _r6s(cols) -> str:
    return ", ".join(r6(c, c) for c in cols)


PUBLISH_FLOWS_CTE = f"""pf AS (
  SELECT CAST(row_number() OVER (ORDER BY trip_date NULLS FIRST, route_short_name NULLS FIRST,
      service_group NULLS FIRST, provider_name NULLS FIRST, Origin_BG NULLS FIRST, Dest_BG NULLS FIRST) AS INTEGER) AS oid,
    trip_date, route_short_name, Origin_BG, Dest_BG, service_group, provider_name,
    leg_count, trip_count, transfer_trip_count, avg_manhattan_mi, avg_euclidean_mi, avg_leg_minutes,
    mean_start_lon, mean_start_lat, mean_end_lon, mean_end_lat
  FROM fdr
  WHERE trip_date >= DATE '{START}' AND trip_date < DATE '{END}'
    AND mean_start_lon IS NOT NULL AND mean_start_lat IS NOT NULL
    AND mean_end_lon IS NOT NULL AND mean_end_lat IS NOT NULL
)"""

PUBLISH_HOTSPOTS_CTE = f"""ph AS (
  SELECT CAST(row_number() OVER (ORDER BY trip_date NULLS FIRST, transfer_type NULLS FIRST,
      provider_name NULLS FIRST, hotspot_key NULLS FIRST, from_route_short_name NULLS FIRST,
      to_route_short_name NULLS FIRST, start_stop_name NULLS FIRST) AS INTEGER) AS oid,
    trip_date, route_short_name, from_route_short_name, to_route_short_name, transfer_type, hotspot_key,
    hotspot_hash, provider_name, start_stop_name, transfer_events, transfer_trips, avg_leg_minutes,
    mean_lon, mean_lat
  FROM thr
  WHERE trip_date >= DATE '{START}' AND trip_date < DATE '{END}' AND mean_lon IS NOT NULL AND mean_lat IS NOT NULL
)"""

PUBLISH_WALK_CTE = f"""pw AS (
  SELECT CAST(row_number() OVER (ORDER BY trip_date NULLS FIRST, walk_type NULLS FIRST,
      related_service NULLS FIRST, related_route NULLS FIRST, stop_key NULLS FIRST,
      stop_name NULLS FIRST) AS INTEGER) AS oid, *
  FROM walk
  WHERE trip_date >= DATE '{START}' AND trip_date < DATE '{END}' AND walk_type = 'EGRESS'
    AND mean_start_lon IS NOT NULL AND mean_start_lat IS NOT NULL
    AND mean_end_lon IS NOT NULL AND mean_end_lat IS NOT NULL
)"""

_FLAG_SEL = ("to_route_short_name_label, from_route_short_name_label, is_transfer_leg, transfer_type")


def refresh_oracles() -> dict[str, str]:
    q: dict[str, str] = {}
    q["leg_base"] = ("WITH " + legs_cte() + ",\n" + base_cte() + "\nSELECT event_id, user_trip_id, trip_date, "
                     "start_time_utc, end_time_utc, " + _r6s(("start_longitude", "start_latitude",
                                                              "end_longitude", "end_latitude")) +
                     ", service_name, route_short_name, mode, start_stop_name, end_stop_name, Origin_BG, Dest_BG, "
                     + _r6s(("manhattan_distance_mi", "euclidean_distance_mi")) +
                     ", service_group, provider_name, " + r6("leg_minutes", "leg_minutes") + " FROM base")
    q["leg_sequence"] = with_flags(
        "SELECT event_id, user_trip_id, trip_date, leg_seq, prev_service_name, prev_route_short_name, "
        "prev_end_stop_name, next_service_name, next_route_short_name, next_start_stop_name FROM flags")
    q["transfer_flags"] = with_flags(
        f"SELECT event_id, user_trip_id, trip_date, leg_seq, {_FLAG_SEL} FROM flags")
    q["region_filtered_flags"] = with_flags(
        f"SELECT event_id, user_trip_id, trip_date, Origin_BG, Dest_BG, leg_seq, {_FLAG_SEL} FROM flags",
        prefix=FX.REGION_PREFIX)
    q["flow_daily"] = with_flags(
        f"SELECT trip_date, Origin_BG, Dest_BG, service_group, provider_name, leg_count, trip_count, "
        f"transfer_trip_count, {_r6s(FLOW_AVGS)} FROM (SELECT trip_date, Origin_BG, Dest_BG, service_group, "
        f"provider_name, {_flow_measures()} FROM flags GROUP BY ALL)")
    q["flow_daily_route"] = with_flags(
        f"SELECT trip_date, route_short_name, Origin_BG, Dest_BG, service_group, provider_name, leg_count, "
        f"trip_count, transfer_trip_count, {_r6s(FLOW_AVGS)} FROM fdr", extra_ctes=(FLOW_ROUTE_CTE,))
    q["transfer_hotspots"] = with_flags(
        f"SELECT trip_date, hotspot_key, provider_name, start_stop_name, transfer_events, transfer_trips, "
        f"{_r6s(HOT_AVGS)} FROM (SELECT trip_date, hotspot_key, provider_name, start_stop_name, "
        f"{_hotspot_measures()} FROM tl GROUP BY trip_date, hotspot_key, provider_name, start_stop_name)",
        extra_ctes=(TRANSFER_LEGS_CTE,))
    hot_cols = ("trip_date, transfer_type, hotspot_key, hotspot_hash, provider_name, start_stop_name, "
                "from_route_short_name, to_route_short_name, transfer_events, transfer_trips")
    q["transfer_hotspots_route"] = with_flags(
        f"SELECT route_short_name, {hot_cols}, {_r6s(HOT_AVGS)} FROM thr",
        extra_ctes=(TRANSFER_LEGS_CTE, ROUTE_HOTSPOT_CTE))
    q["transfer_hotspots_routepair"] = with_flags(
        f"SELECT {hot_cols}, {_r6s(HOT_AVGS)} FROM (SELECT trip_date, tt AS transfer_type, hotspot_key, "
        f"{utf16_sha256('hotspot_key')} AS hotspot_hash, provider_name, start_stop_name, from_route_short_name, "
        f"to_route_short_name, {_hotspot_measures()} FROM tl GROUP BY trip_date, tt, hotspot_key, provider_name, "
        f"start_stop_name, from_route_short_name, to_route_short_name)", extra_ctes=(TRANSFER_LEGS_CTE,))
    q["bg_summary"] = with_flags(
        """SELECT trip_date, Origin_BG, legs, transfer_legs, trips, trips_with_transfer,
          ROUND(CASE WHEN trips = 0 THEN 0.0 ELSE CAST(trips_with_transfer AS DOUBLE) / trips END, 6)
            AS pct_trips_with_transfer,
          ROUND(avg_leg_minutes, 6) AS avg_leg_minutes
        FROM (SELECT trip_date, Origin_BG, CAST(count(*) AS INTEGER) AS legs,
                CAST(sum(CASE WHEN is_transfer_leg = 1 THEN 1 ELSE 0 END) AS INTEGER) AS transfer_legs,
                CAST(count(DISTINCT user_trip_id) AS INTEGER) AS trips,
                CAST(count(DISTINCT CASE WHEN is_transfer_leg = 1 THEN user_trip_id END) AS INTEGER)
                  AS trips_with_transfer,
                avg(leg_minutes) AS avg_leg_minutes
              FROM flags GROUP BY trip_date, Origin_BG)""")
    walk_sel = f"SELECT {WALK_COLS}, {_r6s(WALK_AVGS)} FROM walk"
    q["walk_access"] = with_flags(walk_sel, extra_ctes=(f"walk AS (\n{ACCESS_SQL}\n)",))
    q["walk_egress"] = with_flags(walk_sel, extra_ctes=(f"walk AS (\n{EGRESS_SQL}\n)",))
    q["walk_access_egress"] = with_flags(walk_sel, extra_ctes=(WALK_CTE,))
    q["publish_flows"] = with_flags(
        "SELECT oid, trip_date, route_short_name, Origin_BG, Dest_BG, service_group, provider_name, leg_count, "
        f"trip_count, transfer_trip_count, {_r6s(FLOW_AVGS)} FROM pf",
        extra_ctes=(FLOW_ROUTE_CTE, PUBLISH_FLOWS_CTE))
    q["publish_hotspots"] = with_flags(
        "SELECT oid, trip_date, route_short_name, from_route_short_name, to_route_short_name, transfer_type, "
        "hotspot_key, hotspot_hash, provider_name, start_stop_name, transfer_events, transfer_trips, "
        f"{_r6s(HOT_AVGS)} FROM ph", extra_ctes=(TRANSFER_LEGS_CTE, ROUTE_HOTSPOT_CTE, PUBLISH_HOTSPOTS_CTE))
    q["publish_walk_egress"] = with_flags(
        f"SELECT oid, {WALK_COLS}, {_r6s(WALK_AVGS)} FROM pw", extra_ctes=(WALK_CTE, PUBLISH_WALK_CTE))
    line = (f"'LINESTRING (' || {num_text('mean_start_lon')} || ' ' || {num_text('mean_start_lat')} || ', ' || "
            f"{num_text('mean_end_lon')} || ' ' || {num_text('mean_end_lat')} || ')'")
    q["flow_lines"] = with_flags(f"SELECT oid, trip_date, {line} AS wkt, 4326 AS srid FROM pf",
                                 extra_ctes=(FLOW_ROUTE_CTE, PUBLISH_FLOWS_CTE))
    point = f"'POINT (' || {num_text('mean_lon')} || ' ' || {num_text('mean_lat')} || ')'"
    q["hotspot_points"] = with_flags(
        f"SELECT oid, trip_date, {point} AS wkt, 4326 AS srid FROM ph",
        extra_ctes=(TRANSFER_LEGS_CTE, ROUTE_HOTSPOT_CTE, PUBLISH_HOTSPOTS_CTE))
    q["walk_egress_lines"] = with_flags(f"SELECT oid, trip_date, {line} AS wkt, 4326 AS srid FROM pw",
                                        extra_ctes=(WALK_CTE, PUBLISH_WALK_CTE))
    q["hotspot_hash_backfill"] = with_flags(
        "SELECT trip_date, tt AS transfer_type, hotspot_key, " + utf16_sha256("hotspot_key") + " AS hotspot_hash, "
        "provider_name, start_stop_name, from_route_short_name, to_route_short_name, "
        "CAST(count(*) AS INTEGER) AS transfer_events FROM tl GROUP BY trip_date, tt, hotspot_key, provider_name, "
        "start_stop_name, from_route_short_name, to_route_short_name", extra_ctes=(TRANSFER_LEGS_CTE,))
    q["validate_flows"] = with_flags(
        "SELECT min(trip_date) AS min_date, max(trip_date) AS max_date, CAST(count(*) AS INTEGER) AS n_rows FROM pf",
        extra_ctes=(FLOW_ROUTE_CTE, PUBLISH_FLOWS_CTE))
    q["validate_hotspots"] = with_flags(
        "SELECT CAST(count(*) AS INTEGER) AS n_rows FROM ph",
        extra_ctes=(TRANSFER_LEGS_CTE, ROUTE_HOTSPOT_CTE, PUBLISH_HOTSPOTS_CTE))
    q["validate_walk_top10"] = with_flags(
        f"SELECT oid, {WALK_COLS}, {_r6s(WALK_AVGS)} FROM pw ORDER BY trip_date DESC, oid LIMIT 10",
        extra_ctes=(WALK_CTE, PUBLISH_WALK_CTE))
    return q


ORACLE_SQL: dict[str, str] = {}
ORACLE_SQL.update(refresh_oracles())


# --- clean, incremental, files, links, geo ------------------------------------

FILE_SUBSTRING = "tapped_trip_view_legs"
HASH_TEXT = ("CAST(user_trip_id AS VARCHAR)", "start_time", "end_time",
             "CAST(TRY_CAST(start_longitude AS DOUBLE) AS VARCHAR)",
             "CAST(TRY_CAST(start_latitude AS DOUBLE) AS VARCHAR)",
             "CAST(TRY_CAST(end_longitude AS DOUBLE) AS VARCHAR)",
             "CAST(TRY_CAST(end_latitude AS DOUBLE) AS VARCHAR)",
             "service_name", "route_short_name", "mode", "start_stop_name", "end_stop_name",
             "source_file", "file_date_raw", "Origin_BG", "Dest_BG")


def _fin(x: str) -> str:
    return f"CASE WHEN isfinite(TRY_CAST({x} AS DOUBLE)) THEN TRY_CAST({x} AS DOUBLE) END"


def clean_select(src: str) -> str:
    parts = ", ".join(f"coalesce({p}, '')" for p in HASH_TEXT)
    return f"""SELECT event_id, sha256(concat_ws('|', {parts})) AS row_hash,
    CAST(user_trip_id AS VARCHAR) AS user_trip_id,
    CAST(TRY_CAST(file_date_raw AS TIMESTAMP) AS DATE) AS trip_date,
    date_trunc('millisecond', TRY_CAST(start_time AS TIMESTAMP)) AS start_time_utc,
    date_trunc('millisecond', TRY_CAST(end_time AS TIMESTAMP)) AS end_time_utc,
    {_fin('start_longitude')} AS start_longitude, {_fin('start_latitude')} AS start_latitude,
    {_fin('end_longitude')} AS end_longitude, {_fin('end_latitude')} AS end_latitude,
    service_name, route_short_name, mode, start_stop_name, end_stop_name, source_file, file_date_raw,
    {_fin('manhattan_distance_mi')} AS manhattan_distance_mi,
    {_fin('euclidean_distance_mi')} AS euclidean_distance_mi,
    Origin_BG, Dest_BG
  FROM {src}
  WHERE TRY_CAST(file_date_raw AS TIMESTAMP) IS NOT NULL"""


def _file_date(name: str) -> str:
    return f"TRY_CAST(replace(replace({name}, '{FILE_SUBSTRING}_', ''), '.csv', '') AS TIMESTAMP)"


def with_raw(select: str, extra_ctes: tuple[str, ...] = ()) -> str:
    ctes = [legs_cte(), f"raw AS (\n{FX.raw_sql()}\n)",
            f"rawf AS (SELECT *, {_file_date('source_file')} AS file_date FROM raw)", *extra_ctes]
    return "WITH " + ",\n".join(ctes) + "\n" + select


def _lambert_sql(lon: str, lat: str) -> tuple[str, str]:
    """Lambert conformal conic with two standard parallels, from its textbook
    formulas."""
    f = 1 / INVERSE_FLATTENING
    e = math.sqrt(2 * f - f * f)

    def m(phi: float) -> float:
        return math.cos(phi) / math.sqrt(1 - (e * math.sin(phi)) ** 2)

    def small_t(phi: float) -> float:
        return math.tan(math.pi / 4 - phi / 2) / ((1 - e * math.sin(phi)) / (1 + e * math.sin(phi))) ** (e / 2)
    p0, p1, p2 = (math.radians(x) for x in (ORIGIN_LAT, PARALLEL_1, PARALLEL_2))
    n = (math.log(m(p1)) - math.log(m(p2))) / (math.log(small_t(p1)) - math.log(small_t(p2)))
    af = AXIS * m(p1) / (n * small_t(p1) ** n)
    rf = af * small_t(p0) ** n

    def d(v: float) -> str:
        return f"CAST('{v!r}' AS DOUBLE)"
    phi = f"radians({lat})"
    es = f"({d(e)} * sin({phi}))"
    t = f"(tan({d(math.pi / 4)} - {phi} / 2) / pow((1.0 - {es}) / (1.0 + {es}), {d(e / 2)}))"
    r = f"({d(af)} * pow({t}, {d(n)}))"
    theta = f"({d(n)} * radians({lon} - {d(ORIGIN_LON)}))"
    return (f"({d(FALSE_EASTING)} + {r} * sin({theta}))", f"({d(FALSE_NORTHING + rf)} - {r} * cos({theta}))")


def clean_oracles() -> dict[str, str]:
    q: dict[str, str] = {}
    q["clean_legs"] = with_raw(
        "SELECT event_id, user_trip_id, trip_date, start_time_utc, end_time_utc, "
        + _r6s(("start_longitude", "start_latitude", "end_longitude", "end_latitude")) +
        ", service_name, route_short_name, mode, start_stop_name, end_stop_name, source_file, file_date_raw, "
        + _r6s(("manhattan_distance_mi", "euclidean_distance_mi")) + ", Origin_BG, Dest_BG FROM clean",
        extra_ctes=(f"clean AS (\n{clean_select('raw')}\n)",))
    q["row_hash"] = with_raw("SELECT event_id, trip_date, row_hash FROM clean",
                             extra_ctes=(f"clean AS (\n{clean_select('raw')}\n)",))
    dedupe = "QUALIFY row_number() OVER (PARTITION BY trip_date, row_hash ORDER BY event_id) = 1"
    q["incremental_upsert"] = with_raw(
        """SELECT event_id, trip_date, row_hash, source_file FROM c1
        UNION ALL
        SELECT event_id, trip_date, row_hash, source_file FROM c2
        WHERE NOT EXISTS (SELECT 1 FROM c1 WHERE c1.trip_date = c2.trip_date AND c1.row_hash = c2.row_hash)""",
        extra_ctes=(f"b1 AS (SELECT * FROM rawf WHERE file_date <= TIMESTAMP '2024-01-20')",
                    f"b2 AS (SELECT * FROM rawf WHERE file_date >= TIMESTAMP '2024-01-16')",
                    f"c1 AS (\n{clean_select('b1')}\n{dedupe}\n)",
                    f"c2 AS (\n{clean_select('b2')}\n{dedupe}\n)"))
    q["incremental_since"] = with_raw(
        """SELECT source_file, max(file_date) AS file_date, CAST(count(*) AS INTEGER) AS n_rows
        FROM rawf, (SELECT max(TRY_CAST(file_date_raw AS TIMESTAMP)) AS wm FROM raw) w
        WHERE file_date >= w.wm - INTERVAL 5 DAY GROUP BY source_file""")
    year = r"regexp_extract(source_file, '(\d{4})-\d{2}-\d{2}', 1)"
    q["new_files"] = with_raw(
        f"""SELECT name, {_file_date('name')} AS file_date FROM (
          SELECT DISTINCT source_file AS name FROM raw
          WHERE ends_with(source_file, '.csv') AND contains(source_file, '{FILE_SUBSTRING}')
            AND ({year} = '' OR TRY_CAST({year} AS INTEGER) IN (2024))) cand
        WHERE NOT EXISTS (SELECT 1 FROM rawf WHERE rawf.file_date <= TIMESTAMP '2024-01-20'
                          AND rawf.source_file = cand.name)""")
    q["file_metadata"] = with_raw(
        f"SELECT source_file, {_file_date('source_file')} AS file_date, CAST(count(*) AS INTEGER) AS n_rows "
        "FROM raw GROUP BY source_file")
    sh = r"'^([a-zA-Z][a-zA-Z0-9+.-]*):(//[^/?#]*)?'"
    no_frag = r"regexp_replace(base, '#.*$', '')"
    no_query = rf"regexp_replace({no_frag}, '\?.*$', '')"
    q["page_links"] = rf"""WITH h AS (
          SELECT url AS base, unnest(regexp_extract_all(html, '<a\s[^>]*href="([^"]*)"', 1)) AS href FROM pages),
        r AS (SELECT CASE
            WHEN regexp_matches(href, '^[a-zA-Z][a-zA-Z0-9+.-]*:') THEN href
            WHEN starts_with(href, '//') THEN regexp_extract(base, {sh}, 1) || ':' || href
            WHEN starts_with(href, '/') THEN regexp_extract(base, {sh}, 1) || ':' || regexp_extract(base, {sh}, 2) || href
            WHEN starts_with(href, '?') THEN {no_query} || href
            WHEN starts_with(href, '#') THEN {no_frag} || href
            WHEN href = '' THEN base
            ELSE regexp_replace({no_query}, '[^/]*$', '') || regexp_replace(href, '^\./', '') END AS url FROM h)
        SELECT DISTINCT url FROM r ORDER BY url"""
    x0, y0 = _lambert_sql("start_longitude", "start_latitude")
    x1, y1 = _lambert_sql("end_longitude", "end_latitude")
    q["leg_distances"] = ("WITH " + legs_cte() + f""",
        p AS (SELECT event_id, {x0} AS x0, {y0} AS y0, {x1} AS x1, {y1} AS y1 FROM legs
              WHERE start_longitude IS NOT NULL AND start_latitude IS NOT NULL
                AND end_longitude IS NOT NULL AND end_latitude IS NOT NULL)
        SELECT event_id, round(x0, 3) AS start_x, round(y0, 3) AS start_y, round(x1, 3) AS end_x,
          round(y1, 3) AS end_y,
          round((abs(x1 - x0) + abs(y1 - y0)) / 1609.344, 6) AS manhattan_distance_mi,
          round(sqrt((x1 - x0) * (x1 - x0) + (y1 - y0) * (y1 - y0)) / 1609.344, 6) AS euclidean_distance_mi
        FROM p""")
    step = FX.GRID_STEP
    q["block_group_join"] = f"""WITH pts AS ({FX.grid_points_sql()}),
        cells AS ({FX.grid_cells_sql()})
        SELECT event_id,
          (SELECT min(bg_id) FROM cells c WHERE pts.lon > c.x0 AND pts.lon < c.x0 + {step}
             AND pts.lat > c.y0 AND pts.lat < c.y0 + {step}) AS Origin_BG,
          (SELECT min(bg_id) FROM cells c WHERE pts.end_lon > c.x0 AND pts.end_lon < c.x0 + {step}
             AND pts.end_lat > c.y0 AND pts.end_lat < c.y0 + {step}) AS Dest_BG
        FROM pts"""
    return q


ORACLE_SQL.update(clean_oracles())


# --- written and dirty input ---------------------------------------------------

# The longest text of each column of the clean table.
LONGEST = (("user_trip_id", 100), ("service_name", 200), ("route_short_name", 50), ("mode", 50),
           ("start_stop_name", 200), ("end_stop_name", 200), ("source_file", 300), ("file_date_raw", 50),
           ("Origin_BG", 12), ("Dest_BG", 12))
WRITTEN = (("Flow_BG_BG_Daily", "flow_daily", "leg_count"),
           ("Transfer_Hotspots_Daily", "transfer_hotspots", "transfer_events"),
           ("BG_Summary_Daily", "bg_summary", "legs"),
           ("Flow_BG_BG_Daily_Route", "flow_daily_route", "leg_count"),
           ("Transfer_Hotspots_Daily_Route", "transfer_hotspots_route", "transfer_events"),
           ("Transfer_Hotspots_Daily_RoutePair", "transfer_hotspots_routepair", "transfer_events"),
           ("Walk_AccessEgress_Daily", "walk_access_egress", "walk_leg_count"),
           ("ArcGIS_Flow_BG_BG_Daily_Route_Rolling31", "publish_flows", "oid"),
           ("ArcGIS_Transfer_Hotspots_Daily_Route_Rolling31", "publish_hotspots", "oid"),
           ("ArcGIS_Walk_Egress_Daily_Rolling31", "publish_walk_egress", "oid"))


def dirty_oracles() -> dict[str, str]:
    q: dict[str, str] = {}
    hot = with_flags("SELECT event_id, user_trip_id, trip_date, leg_seq, prev_service_name, prev_route_short_name, "
                     "prev_end_stop_name, next_service_name, next_route_short_name, next_start_stop_name FROM flags")
    q["leg_sequence_hot"] = hot.replace(legs_cte(), f"plain_legs AS (\n{FX.legs_sql()}\n), legs AS (\n{FX.hot_legs_sql()}\n)")
    arms = " ".join(f"WHEN length(rtrim({c})) > {n} THEN '{c} longer than {n}'" for c, n in LONGEST)
    q["reject_split"] = f"""WITH {legs_cte()}, plain_raw AS (\n{FX.raw_sql()}\n), raw AS (\n{FX.reject_raw_sql()}\n),
        d AS (SELECT *, CAST(TRY_CAST(file_date_raw AS TIMESTAMP) AS DATE) AS trip_date FROM raw),
        r AS (SELECT event_id, trip_date, CASE WHEN trip_date IS NULL THEN 'no trip date'
            WHEN user_trip_id IS NULL THEN 'null user_trip_id' {arms} END AS reject_reason FROM d)
        SELECT event_id, CASE WHEN trip_date IS NULL THEN 'undated' WHEN reject_reason IS NOT NULL THEN 'rejected'
          ELSE 'clean' END AS route, reject_reason, trip_date FROM r"""
    fields = FX.CSV_FIELDS[1:]
    loaded = ", ".join(f"CASE WHEN kind = 'short' THEN NULL ELSE nullif({c}, '') END AS {c}" if c in ("mode", "end_stop_name")
                       else f"nullif({c}, '') AS {c}" for c in fields)
    nothing = ", ".join(f"NULL AS {c}" for c in fields)
    q["csv_legs"] = f"""WITH {legs_cte()}, raw AS (\n{FX.raw_sql()}\n), f AS (\n{FX.csv_rows_sql()}\n)
        SELECT event_id, {loaded}, 'loaded' AS outcome FROM f WHERE kind <> 'extra'
        UNION ALL SELECT event_id, {nothing}, 'more fields than the header' FROM f WHERE kind = 'extra'
        UNION ALL SELECT NULL, {nothing},
          'missing column(s) [''start_longitude'', ''start_latitude'', ''end_longitude'', ''end_latitude'']'"""
    # Even-odd crossings of a ray to the right, over all polygons whose box holds the point; a point on
    # an edge is outside.
    q["block_group_shapes"] = f"""WITH polys AS ({FX.shapes_sql()}), pts AS ({FX.shape_points_sql()}),
        r AS (SELECT bg_id, unnest(rings) AS ring FROM polys),
        e AS (SELECT bg_id, unnest(list_zip(ring[1:len(ring) - 1], ring[2:])) AS s FROM r),
        edges AS (SELECT bg_id, s[1].x AS x1, s[1].y AS y1, s[2].x AS x2, s[2].y AS y2 FROM e),
        box AS (SELECT bg_id, min(least(x1, x2)) AS x0, max(greatest(x1, x2)) AS x9, min(least(y1, y2)) AS y0,
                  max(greatest(y1, y2)) AS y9 FROM edges GROUP BY bg_id),
        near AS (SELECT event_id, lon, lat, bg_id FROM pts JOIN box ON lon > x0 AND lon < x9 AND lat > y0 AND lat < y9),
        hit AS (SELECT event_id, bg_id FROM near JOIN edges USING (bg_id) GROUP BY event_id, bg_id
          HAVING sum(CASE WHEN (y1 > lat) <> (y2 > lat) AND lon < (x2 - x1) * (lat - y1) / (y2 - y1) + x1 THEN 1 ELSE 0 END) % 2 = 1
            AND NOT bool_or((x2 - x1) * (lat - y1) - (y2 - y1) * (lon - x1) = 0 AND lon BETWEEN least(x1, x2) AND greatest(x1, x2)
                            AND lat BETWEEN least(y1, y2) AND greatest(y1, y2)))
        SELECT event_id, min(bg_id) AS bg_id, CAST(count(bg_id) AS INTEGER) AS n_containing
        FROM pts LEFT JOIN hit USING (event_id) GROUP BY event_id"""
    q["refresh_written"] = "\nUNION ALL\n".join(
        f"SELECT '{name}' AS table_name, count(*) AS n_rows, CAST(sum({measure}) AS BIGINT) AS total FROM ({ORACLE_SQL[key]})"
        for name, key, measure in WRITTEN)
    return q


ORACLE_SQL.update(dirty_oracles())
