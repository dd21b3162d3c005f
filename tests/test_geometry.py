"""Geodesics against published distances, polygon covers, GeoJSON, links."""

import json
import math

import pytest
from pyspark.sql import functions as F

from legwise.functions import geodesic as G
from legwise.operators import publish as P
from legwise.operators import spatial as SP
from legwise.sources.links import extract_links, resolve_url
from legwise.sources.polygons import ReferenceSystemError, read_geojson


def degrees(d, m, s):
    return math.copysign(abs(d) + m / 60 + s / 3600, d)


#: Published: a national geodetic survey's check line, and degrees of the meridian and the equator.
FLINDERS, BUNINYON = (degrees(144, 25, 29.5244), degrees(-37, 57, 3.7203)), (degrees(143, 55, 35.3839), degrees(-37, 39, 10.1561))
LINES = [(*FLINDERS, *BUNINYON, 54972.271, degrees(306, 52, 5.37)), (0.0, 0.0, 1.0, 0.0, 111319.491, 90.0),
         (0.0, 0.0, 0.0, 1.0, 110574.389, 0.0), (0.0, 0.0, 0.0, 90.0, 10001965.729, 0.0), (5.0, 5.0, 5.0, 5.0, 0.0, None)]


def test_geodesic_lengths_and_bearings(spark):
    df = spark.createDataFrame(LINES, "a double, b double, c double, d double, metres double, bearing double")
    there = df.withColumn("g", G.inverse("a", "b", "c", "d"))
    for r in there.withColumn("e", G.direct("a", "b", F.col("g.azimuth"), F.col("g.metres"))).collect():
        assert abs(r.g.metres - r.metres) < 1e-3
        assert r.bearing is None or abs(math.degrees(r.g.azimuth) % 360 - r.bearing) < 1e-5
        assert abs(r.e.lat - r.d) < 1e-9 and (r.d == 90 or abs(r.e.lon - r.c) < 1e-9)


def test_lines_follow_the_geodesic(spark):
    df = spark.createDataFrame([(179.5, 10.0, -179.5, 10.5), (-98.5, 29.4, -97.74, 30.27), (1.0, None, 2.0, 3.0)],
                               "a double, b double, c double, d double")
    rows = df.withColumn("p", G.points_between("a", "b", "c", "d", 4)).withColumn("m", G.inverse("a", "b", "c", "d")["metres"]) \
        .withColumn("steps", F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: G.inverse(
            F.get("p", i)["lon"], F.get("p", i)["lat"], F.get("p", i + 1)["lon"], F.get("p", i + 1)["lat"])["metres"])).collect()
    for r in rows[:2]:
        assert (r.p[0].lon, r.p[0].lat, r.p[-1].lon, r.p[-1].lat) == (r.a, r.b, r.c, r.d)
        assert all(abs(s - r.m / 4) < 1e-3 for s in r.steps)
        assert all(-180 <= x.lon <= 180 for x in r.p)
    text = df.limit(1).select(P.line_wkt("a", "b", "c", "d", 4), P.line_geojson("a", "b", "c", "d", 4),
                              P.line_wkt("a", "b", "c", "d")).first()
    assert text[0].count(",") == 4 and len(json.loads(text[1])["coordinates"]) == 5
    assert text[2] == "LINESTRING (179.5 10, -179.5 10.5)"


def test_a_stray_vertex_does_not_explode_the_cover(spark):
    good = [(-98.50, 29.40), (-98.46, 29.40), (-98.46, 29.44), (-98.50, 29.44), (-98.50, 29.40)]
    bad = [*good[:3], (0.0, 0.0), *good[3:]]
    df = spark.createDataFrame([("a", [{"x": x, "y": y} for x, y in good]), ("b", [{"x": x, "y": y} for x, y in bad])],
                               "bg_id string, ring array<struct<x double, y double>>")
    cells = SP.polygon_cells(df, 0.01)
    assert cells.count() < 60_000  # its box has 28 million cells
    pts = spark.createDataFrame([(1, -98.48, 29.41), (2, -98.45, 29.41), (3, -98.50, 29.42), (4, None, 29.4)],
                                "i int, x double, y double")
    got = {r.i: (r.bg, r.n) for r in SP.assign_polygon(pts, cells, "x", "y", "bg", 0.01, count_out="n").collect()}
    assert got[1][0] == "a" and got[2][0] is None and got[3] == (None, 0) and got[4] == (None, 0)


def feature(i, extra=""):
    ring = [[i, 0], [i + 1, 0], [i + 1, 1], [i, 1], [i, 0]]
    return ('{"type": "Feature", "properties": {"GEOID": "g%d", "id2": "h%d", "name": "a } , { \\"x\\" %s"}, "geometry": '
            '{"type": "Polygon", "coordinates": [%s]}}' % (i, i, extra, json.dumps(ring)))


@pytest.mark.parametrize("joint", [",\n", ",", " ,\n  "])
def test_geojson_is_read_in_parts(spark, tmp, joint):
    path = f"{tmp}/bg.geojson"
    with open(path, "w") as f:
        f.write('{"type": "FeatureCollection", "crs": {"type": "name", "properties": {"name": "urn:ogc:def:crs:EPSG::4269"}},'
                '\n"features": [\n' + joint.join(feature(i, "x" * 2000) for i in range(300)) + "\n]}\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    try:
        df = read_geojson(spark, path)
        assert df.rdd.getNumPartitions() > 4
        assert sorted(r.bg_id for r in df.collect()) == sorted(f"g{i}" for i in range(300))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert read_geojson(spark, path, "id2").where("bg_id = 'h7'").first().rings[0][1].asDict() == {"x": 8.0, "y": 0.0}
    assert read_geojson(spark, path, "nothing").count() == 0


def test_geojson_in_another_system_is_refused(spark, tmp):
    path = f"{tmp}/bg.geojson"
    with open(path, "w") as f:
        f.write('{"type": "FeatureCollection", "crs": {"type": "name", "properties": {"name": "urn:ogc:def:crs:EPSG::32140"}},'
                '"features": [' + feature(1) + "]}")
    with pytest.raises(ReferenceSystemError, match="32140"):
        read_geojson(spark, path)
    with open(path, "w") as f:
        f.write('{"type": "FeatureCollection", "features": [{"geometry": null, "type": "Feature", "properties": {}}]}')
    with pytest.raises(ValueError, match="first member"):
        read_geojson(spark, path).count()


def test_links_of_any_spelling(spark):
    html = """<A HREF='one.csv'>1</A> <a class="x>y" href="/d/../two.csv?a=1&amp;b=2">2</a> <a title=t href=three.csv>3</a>
        <!-- <a href="no.csv"> --> <script>var s = '<a href="never.csv">';</script> <abbr href="not.csv"> <a
        href = "../four.csv#x">4</a> <a href="">5</a><a href="one.csv">again</a>"""
    pages = spark.createDataFrame([("https://h.org/a/b/page.html", html), ("https://h.org", None)], "url string, html string")
    assert [r.url for r in extract_links(pages).collect()] == [
        "https://h.org/a/b/one.csv", "https://h.org/a/b/page.html", "https://h.org/a/b/three.csv", "https://h.org/a/four.csv#x",
        "https://h.org/two.csv?a=1&b=2"]


def test_dots_in_addresses(spark):
    from urllib.parse import urljoin
    base = "https://h.org/a/b/c.html?q#f"
    hrefs = ["../z.csv", "../../../z.csv", "./z.csv", "..", ".", "d/./e/../f", "/x/../y/", "/x/./y?p=../q", "d//e", "?n=1", "g;x=1/../y"]
    df = spark.createDataFrame([(base, h) for h in hrefs] + [("https://h.org", "z.csv")], "b string, h string")
    for r in df.select("b", "h", resolve_url("b", "h").alias("u")).collect():
        assert r.u == urljoin(r.b, r.h), r.h
