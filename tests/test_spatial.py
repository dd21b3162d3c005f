"""Point-in-polygon join on hand-made polygons (FIXTURES §4)."""

import pytest

from legwise.functions.geo import projection
from legwise.operators.spatial import assign_polygon, polygon_cells


def ring(*pts):
    pts = list(pts) + [pts[0]]
    return [{"x": float(x), "y": float(y)} for x, y in pts]


POLYS = [
    ("A_L", [ring((0, 0), (2, 0), (2, 1), (1, 1), (1, 2), (0, 2))]),            # concave L
    ("B_hole", [ring((3, 0), (6, 0), (6, 3), (3, 3)), ring((4, 1), (5, 1), (5, 2), (4, 2))]),
    ("C_tri", [ring((7, 0), (9, 0), (8, 2))]),
    ("D_sq", [ring((10, 0), (12, 0), (12, 2), (10, 2))]),
    ("E_sq", [ring((11, 1), (13, 1), (13, 3), (11, 3))]),                      # overlaps D
]
POINTS = {
    "in_L": (0.5, 1.5, "A_L"), "notch_of_L": (1.5, 1.5, None), "in_ring": (3.5, 0.5, "B_hole"),
    "in_hole": (4.5, 1.5, None), "on_hole_edge": (4.0, 1.5, None), "in_tri": (8.0, 0.5, "C_tri"),
    "overlap": (11.5, 1.5, "D_sq"), "only_E": (12.5, 2.5, "E_sq"), "on_edge": (2.0, 0.5, None),
    "on_vertex": (0.0, 0.0, None), "outside": (20.0, 20.0, None), "slanted_edge_out": (9.0, 1.5, None),
    "null": (None, None, None),
}


@pytest.fixture(scope="module")
def polys(spark):
    return spark.createDataFrame(POLYS, "bg_id string, rings array<array<struct<x:double,y:double>>>")


@pytest.mark.parametrize("cell", [0.5, 1.0, 3.0])
@pytest.mark.parametrize("broadcast", [True, False])
def test_assign(spark, polys, cell, broadcast):
    pts = spark.createDataFrame([(k, x, y) for k, (x, y, _) in POINTS.items()], "name string, x double, y double")
    out = assign_polygon(pts, polygon_cells(polys, cell), "x", "y", "bg", cell=cell, broadcast=broadcast)
    got = {r["name"]: r["bg"] for r in out.collect()}
    assert got == {k: v[2] for k, v in POINTS.items()}
    assert out.count() == len(POINTS)  # a left join that never duplicates


def test_projection_check_values():
    p = projection(32140)
    e, n = p.forward(29.4241, -98.4936)
    assert e == pytest.approx(649133.4849, abs=1e-3) and n == pytest.approx(4176405.3447, abs=1e-3)
    e, n = p.forward(29.5, -98.6)
    assert e == pytest.approx(638781.2947, abs=1e-3) and n == pytest.approx(4184777.1776, abs=1e-3)


def test_projection_worked_example():
    from legwise.functions.geo import LambertConic2SP, _dms
    us_ft = LambertConic2SP(a=20925832.16, inv_f=294.97870, lat0=_dms(27, 50), lon0=-99.0,
                            lat1=_dms(28, 23), lat2=_dms(30, 17), false_easting=2000000.0, false_northing=0.0)
    e, n = us_ft.forward(28.5, -96.0)
    assert e == pytest.approx(2963503.91, abs=0.05) and n == pytest.approx(254759.80, abs=0.05)


def test_projection_columns_match_python(spark):
    from legwise.functions.geo import project
    df = spark.createDataFrame([(-98.4936, 29.4241), (-98.6, 29.5)], "lon double, lat double")
    x, y = project("lon", "lat")
    got = df.select(x, y).collect()
    p = projection(32140)
    for (lon, lat), r in zip([(-98.4936, 29.4241), (-98.6, 29.5)], got):
        ex, ey = p.forward(lat, lon)
        assert r[0] == pytest.approx(ex, abs=1e-6) and r[1] == pytest.approx(ey, abs=1e-6)
