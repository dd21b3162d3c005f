"""Sources, table maintenance, features and configuration."""

import json
import os

import pytest
from pyspark.sql import functions as F

from legwise.config import ConfigError, IngestConfig, PipelineConfig
from legwise.operators import publish as P
from legwise.schemas import (backfill_hotspot_hash, check_not_null, create_table_if_absent, read_table,
                             split_not_null)
from legwise.sources import files as SF
from legwise.sources.links import extract_links, resolve_url
from legwise.sources.polygons import read_geojson


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def test_csv_header_order_is_respected(spark, tmp):
    cols = ["end_latitude", "user_trip_id", "start_longitude", "start_latitude", "end_longitude", "mode", "extra"]
    write(f"{tmp}/a/x.csv", ",".join(cols) + "\n29.5,u1,-98.5,29.4,-98.6,walk,e1\n")
    df = SF.read_leg_csv(spark, [f"{tmp}/a/x.csv"])
    r = df.first()
    assert (r["user_trip_id"], r["end_latitude"], r["extra"], r["source_file"]) == ("u1", "29.5", "e1", "x.csv")


def test_csv_header_mismatch_stops_the_read(spark, tmp):
    write(f"{tmp}/b/1.csv", "user_trip_id,start_longitude\nu1,1\n")
    write(f"{tmp}/b/2.csv", "start_longitude,user_trip_id\n2,u2\n")
    with pytest.raises(Exception):
        SF.read_leg_csv(spark, [f"{tmp}/b/1.csv", f"{tmp}/b/2.csv"]).collect()


def test_name_filters(spark):
    names = ["tapped_trip_view_legs_2024-01-05.csv", "tapped_trip_view_legs_2023-12-31.csv",
             "tapped_trip_view_legs_latest.csv", "other_2024-01-05.csv", "tapped_trip_view_legs_2024-01-05.txt"]
    df = spark.createDataFrame([(n,) for n in names], "name string")
    got = [r["name"] for r in SF.matching_files(df, "tapped_trip_view_legs", ".csv", [2024]).collect()]
    assert got == ["tapped_trip_view_legs_2024-01-05.csv", "tapped_trip_view_legs_latest.csv"]
    d = df.select(SF.file_date_from_name("name", "tapped_trip_view_legs", ".csv").alias("d")).collect()
    assert str(d[0]["d"]) == "2024-01-05 00:00:00" and d[2]["d"] is None


def test_url_resolution(spark):
    base = "https://h.example.org/a/b/page.html?x=1#top"
    cases = {"/root.csv": "https://h.example.org/root.csv", "//cdn.example.org/f.csv": "https://cdn.example.org/f.csv",
             "rel.csv": "https://h.example.org/a/b/rel.csv", "./rel.csv": "https://h.example.org/a/b/rel.csv",
             "?y=2": "https://h.example.org/a/b/page.html?y=2", "#frag": "https://h.example.org/a/b/page.html?x=1#frag",
             "http://o.example.com/z": "http://o.example.com/z"}
    df = spark.createDataFrame([(base, h) for h in cases], "b string, h string")
    got = {r["h"]: r["u"] for r in df.select("h", resolve_url("b", "h").alias("u")).collect()}
    assert got == cases


def test_extract_links_filters_and_sorts(spark):
    html = ('<a href="/f/tapped_trip_view_legs_2024-01-02.csv">x</a> <a class="c" href="/f/other.csv">y</a>'
            '<a href="/f/tapped_trip_view_legs_2024-01-01.csv">z</a><a href="/f/tapped_trip_view_legs_2024-01-01.csv">')
    pages = spark.createDataFrame([(1, "https://p.example.org/list", html)], "page_id long, url string, html string")
    got = [r["url"] for r in extract_links(pages, substring="tapped_trip_view_legs", suffix=".csv").collect()]
    assert got == ["https://p.example.org/f/tapped_trip_view_legs_2024-01-01.csv",
                   "https://p.example.org/f/tapped_trip_view_legs_2024-01-02.csv"]


def test_geojson_polygons(spark, tmp):
    fc = {"type": "FeatureCollection", "features": [
        {"type": "Feature", "properties": {"GEOID": "480290000001"},
         "geometry": {"type": "Polygon", "coordinates": [[[0, 0], [1, 0], [1, 1], [0, 0]]]}},
        {"type": "Feature", "properties": {"GEOID": "480290000002"},
         "geometry": {"type": "MultiPolygon", "coordinates": [[[[2, 0], [3, 0], [3, 1], [2, 0]]],
                                                              [[[4, 0], [5, 0], [5, 1], [4, 0]]]]}}]}
    write(f"{tmp}/bg.geojson", json.dumps(fc))
    rows = {r["bg_id"]: r["rings"] for r in read_geojson(spark, f"{tmp}/bg.geojson").collect()}
    assert len(rows["480290000001"]) == 1 and len(rows["480290000002"]) == 2
    assert rows["480290000002"][1][0]["x"] == 4.0


def test_create_table_and_not_null_check(spark, tmp):
    create_table_if_absent(spark, "BG_Summary_Daily", path=f"{tmp}/bgs", name="bgs_test")
    create_table_if_absent(spark, "BG_Summary_Daily", path=f"{tmp}/bgs", name="bgs_test")  # idempotent
    assert "pct_trips_with_transfer" in spark.table("bgs_test").columns
    spark.sql("DROP TABLE bgs_test")
    df = spark.createDataFrame([("k1", None), ("k2", b"x")], "hotspot_key string, hotspot_hash binary")
    assert check_not_null(df, "hotspot_hash") is False  # warns, does not raise
    filled = backfill_hotspot_hash(df)
    assert check_not_null(filled, "hotspot_hash") is True
    assert filled.filter("hotspot_key = 'k2'").first()["hotspot_hash"] == b"x"  # only nulls are filled


def test_reject_split(spark):
    df = spark.createDataFrame([("a", 1), (None, 2)], "user_trip_id string, v int")
    good, bad = split_not_null(df, ("user_trip_id",))
    assert good.count() == 1 and bad.first()["reject_reason"] == "null user_trip_id"


def test_read_table_of_missing_path_is_empty(spark, tmp):
    assert read_table(spark, f"{tmp}/none", "LegTrips_Clean").count() == 0


def test_densified_line(spark):
    df = spark.createDataFrame([(-98.5, 29.4, -97.5, 30.4)], "a double, b double, c double, d double")
    wkt = df.select(P.line_wkt("a", "b", "c", "d", densify=4)).first()[0]
    pts = wkt[len("LINESTRING ("):-1].split(", ")
    assert len(pts) == 5 and pts[0] == "-98.5 29.4" and pts[-1] == "-97.5 30.4"
    plain = df.select(P.line_wkt("a", "b", "c", "d")).first()[0]
    assert plain == "LINESTRING (-98.5 29.4, -97.5 30.4)"


def test_config_errors():
    with pytest.raises(ConfigError):
        IngestConfig.from_env({})
    cfg = PipelineConfig.from_env({"LANDING_PATH": "/l", "RAW_PATH": "/r", "CLEAN_PATH": "/c",
                                   "STATE_PATH": "/s", "OUTPUT_PATH": "/o", "FEATURES_PATH": "/f",
                                   "ONLY_YEARS": "2024,2025", "RUN_MODULE3_IF_NO_NEW": "yes"})
    assert cfg.ingest.only_years == (2024, 2025) and cfg.run_publish_if_no_new and cfg.publish_enabled
    assert cfg.transform.days_back == 31 and cfg.transform.rolling_days == 34


def test_every_table_can_be_declared(spark, tmp):
    from legwise.schemas import PARTITION_COLUMNS, TABLES
    for i, table in enumerate(TABLES):
        name = f"decl_{i}"
        create_table_if_absent(spark, table, path=f"{tmp}/t{i}", name=name)
        cols = spark.table(name).columns
        assert set(cols) == {f.name for f in TABLES[table].fields}
        parts = PARTITION_COLUMNS.get(table, ())
        assert tuple(cols[len(cols) - len(parts):]) == parts  # partition columns come last
        spark.sql(f"DROP TABLE {name}")
