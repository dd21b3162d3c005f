"""Publish tables and map features (SURVEY §2.3 C9, §2.4 F11-F12, §2.7 W4-W6,
§2.13 V1-V4).

The three publish tables are the aggregate rows of the window with complete
mean coordinates, numbered by a global ``oid``. Features are WKT or GeoJSON
text built with string functions (no locale, no float formatting surprises).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from legwise.functions import timefns as T
from legwise.functions.geodesic import points_between
from legwise.operators.numbering import global_row_number

FLOW_ORDER = ["trip_date", "route_short_name", "service_group", "provider_name", "Origin_BG", "Dest_BG"]
# The reference order is not unique; the stop name is the tie-break.
HOTSPOT_ORDER = ["trip_date", "transfer_type", "provider_name", "hotspot_key",
                 "from_route_short_name", "to_route_short_name", "start_stop_name"]
WALK_ORDER = ["trip_date", "walk_type", "related_service", "related_route", "stop_key", "stop_name"]

PUBLISH_FLOW_COLUMNS = ("oid", "trip_date", "route_short_name", "Origin_BG", "Dest_BG", "service_group",
                        "provider_name", "leg_count", "trip_count", "transfer_trip_count",
                        "avg_manhattan_mi", "avg_euclidean_mi", "avg_leg_minutes",
                        "mean_start_lon", "mean_start_lat", "mean_end_lon", "mean_end_lat")
PUBLISH_HOTSPOT_COLUMNS = ("oid", "trip_date", "route_short_name", "from_route_short_name",
                           "to_route_short_name", "transfer_type", "hotspot_key", "hotspot_hash",
                           "provider_name", "start_stop_name", "transfer_events", "transfer_trips",
                           "avg_leg_minutes", "mean_lon", "mean_lat")
PUBLISH_WALK_COLUMNS = ("oid", "trip_date", "walk_type", "related_service", "related_route", "stop_key",
                        "stop_name", "provider_name", "walk_leg_count", "trip_count",
                        "avg_walk_minutes", "avg_walk_euclidean_mi", "avg_walk_manhattan_mi",
                        "mean_start_lon", "mean_start_lat", "mean_end_lon", "mean_end_lat")
_FLOAT_COLUMNS = {"avg_manhattan_mi", "avg_euclidean_mi", "avg_leg_minutes", "mean_start_lon",
                  "mean_start_lat", "mean_end_lon", "mean_end_lat", "mean_lon", "mean_lat",
                  "avg_walk_minutes", "avg_walk_euclidean_mi", "avg_walk_manhattan_mi"}
SRID_WGS84 = 4326


def _project(df: DataFrame, columns) -> DataFrame:
    """Publish projection, floats cast to double."""
    return df.select(*[F.col(c).cast("double").alias(c) if c in _FLOAT_COLUMNS else F.col(c)
                       for c in columns])


def _not_null(*cols: str) -> Column:
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull()
    return cond


def flow_rows(flow_route: DataFrame, as_of=None, days_back: int = 31) -> DataFrame:
    """Rows of the flows table, before they are numbered."""
    return flow_route.filter(T.in_window("trip_date", as_of, days_back)
                             & _not_null("mean_start_lon", "mean_start_lat", "mean_end_lon", "mean_end_lat"))


def hotspot_rows(route_hotspots: DataFrame, as_of=None, days_back: int = 31) -> DataFrame:
    """Rows of the hotspots table, before they are numbered."""
    return route_hotspots.filter(T.in_window("trip_date", as_of, days_back) & _not_null("mean_lon", "mean_lat"))


def publish_flows(flow_route: DataFrame, as_of=None, days_back: int = 31,
                  materialize: bool = True) -> DataFrame:
    """ArcGIS flows table from ``Flow_BG_BG_Daily_Route``."""
    rows = flow_rows(flow_route, as_of, days_back)
    return _project(global_row_number(rows, FLOW_ORDER, materialize=materialize), PUBLISH_FLOW_COLUMNS)


def publish_hotspots(route_hotspots: DataFrame, as_of=None, days_back: int = 31,
                     materialize: bool = True) -> DataFrame:
    """ArcGIS hotspots table from ``Transfer_Hotspots_Daily_Route``."""
    rows = hotspot_rows(route_hotspots, as_of, days_back)
    return _project(global_row_number(rows, HOTSPOT_ORDER, materialize=materialize), PUBLISH_HOTSPOT_COLUMNS)


def publish_walk_egress(walk: DataFrame, as_of=None, days_back: int = 31,
                        materialize: bool = True) -> DataFrame:
    """ArcGIS walk egress table from ``Walk_AccessEgress_Daily`` (EGRESS only)."""
    rows = walk.filter(T.in_window("trip_date", as_of, days_back) & (F.col("walk_type") == "EGRESS")
                       & _not_null("mean_start_lon", "mean_start_lat", "mean_end_lon", "mean_end_lat"))
    return _project(global_row_number(rows, WALK_ORDER, materialize=materialize), PUBLISH_WALK_COLUMNS)


# --- features -----------------------------------------------------------------

def _num(c) -> Column:
    """Plain decimal text of a double (no exponent), trailing zeros removed."""
    col = F.col(c) if isinstance(c, str) else c
    text = F.format_number(col, 9)  # has thousands separators; remove them
    text = F.regexp_replace(text, ",", "")
    return F.regexp_replace(F.regexp_replace(text, r"0+$", ""), r"\.$", "")


def line_points(x0, y0, x1, y1, densify: int = 0) -> Column:
    """The places of a line: both ends, and with ``densify=n`` n - 1 more in
    equal steps along the geodesic of the WGS84 ellipsoid."""
    cx0, cy0, cx1, cy1 = [F.col(c) if isinstance(c, str) else c for c in (x0, y0, x1, y1)]
    if densify and densify > 1:
        return points_between(cx0, cy0, cx1, cy1, densify)
    return F.array(F.struct(cx0.alias("lon"), cy0.alias("lat")), F.struct(cx1.alias("lon"), cy1.alias("lat")))


def line_wkt(x0, y0, x1, y1, densify: int = 0) -> Column:
    """V1/V3: ``LINESTRING (x0 y0, ..., x1 y1)``."""
    text = F.transform(line_points(x0, y0, x1, y1, densify), lambda p: F.concat(_num(p["lon"]), F.lit(" "), _num(p["lat"])))
    return F.concat(F.lit("LINESTRING ("), F.array_join(text, ", "), F.lit(")"))


def point_wkt(x, y) -> Column:
    """V2: ``POINT (x y)``."""
    cx, cy = [F.col(c) if isinstance(c, str) else c for c in (x, y)]
    return F.concat(F.lit("POINT ("), _num(cx), F.lit(" "), _num(cy), F.lit(")"))


def line_geojson(x0, y0, x1, y1, densify: int = 0) -> Column:
    text = F.transform(line_points(x0, y0, x1, y1, densify),
                       lambda p: F.concat(F.lit("["), _num(p["lon"]), F.lit(","), _num(p["lat"]), F.lit("]")))
    return F.concat(F.lit('{"type":"LineString","coordinates":['), F.array_join(text, ","), F.lit("]}"))


def point_geojson(x, y) -> Column:
    cx, cy = [F.col(c) if isinstance(c, str) else c for c in (x, y)]
    return F.concat(F.lit('{"type":"Point","coordinates":['), _num(cx), F.lit(","), _num(cy), F.lit("]}"))


def flow_lines(publish_flow: DataFrame, densify: int = 0) -> DataFrame:
    """V1 + V4: O-D flow lines, all attributes kept."""
    return publish_flow.select(
        "*", line_wkt("mean_start_lon", "mean_start_lat", "mean_end_lon", "mean_end_lat", densify).alias("wkt"),
        F.lit(SRID_WGS84).alias("srid"))


def hotspot_points(publish_hotspot: DataFrame) -> DataFrame:
    """V2 + V4: hotspot points."""
    return publish_hotspot.select("*", point_wkt("mean_lon", "mean_lat").alias("wkt"),
                                  F.lit(SRID_WGS84).alias("srid"))


def walk_egress_lines(publish_walk: DataFrame, densify: int = 0) -> DataFrame:
    """V3 + V4: walk egress lines."""
    return publish_walk.select(
        "*", line_wkt("mean_start_lon", "mean_start_lat", "mean_end_lon", "mean_end_lat", densify).alias("wkt"),
        F.lit(SRID_WGS84).alias("srid"))
