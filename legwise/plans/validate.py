"""Checks after a refresh (G8, G9, S2) over the written publish tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from legwise.operators import validate as V
from legwise.plans.refresh import read_refreshed


def validate_refresh(spark: SparkSession, output_path: str, top_n: int = 10) -> dict[str, DataFrame]:
    flows, hotspots, walk = (read_refreshed(spark, output_path, t) for t in (
        "ArcGIS_Flow_BG_BG_Daily_Route_Rolling31", "ArcGIS_Transfer_Hotspots_Daily_Route_Rolling31",
        "ArcGIS_Walk_Egress_Daily_Rolling31"))
    return {"flows_date_range": V.date_range_count(flows),
            "hotspots_count": V.row_count(hotspots),
            "walk_egress_latest": V.latest_rows(walk, top_n)}
