"""Crowded cells are split; shapes wholly around a part are counted, not listed."""

import random

from pyspark.sql import functions as F

from legwise.operators import spatial as SP


def ring(*pts):
    return [{"x": float(x), "y": float(y)} for x, y in [*pts, pts[0]]]


def test_split_cells_give_the_rows_of_plain_ones(spark, monkeypatch):
    monkeypatch.setattr(SP, "POINTS_KEPT", 2)
    r = random.Random(3)
    shapes = [(f"s{i:02}", [ring((-0.3 - i / 100, -0.4), (3.2, -0.3 - i / 90), (3.3 + i / 80, 3.1), (-0.2, 3.4))]) for i in range(30)]
    shapes += [("hole", [ring((0.2, 0.2), (2.7, 0.2), (2.7, 2.7), (0.2, 2.7)), ring((1.0, 1.0), (1.5, 1.0), (1.5, 2.0), (1.0, 2.0))]),
               ("open", [ring((0.5, 0.5), (2.5, 0.5), (2.5, 2.5))[:-1]]), ("twice", [ring((0, 0), (1, 0), (0, 1))]),
               ("twice", [ring((0, 0), (2, 0), (0, 2))]), ("gap", [[{"x": 0.0, "y": 0.0}, {"x": None, "y": 1.0}, {"x": 2.0, "y": 2.0}]]),
               (None, [ring((0, 0), (1, 0), (0, 1))])]
    polygons = spark.createDataFrame(shapes, "bg_id string, rings array<array<struct<x:double,y:double>>>")
    places = [(r.uniform(-0.5, 3.5), r.uniform(-0.5, 3.5)) for _ in range(1500)] + [(1.0, 1.5), (0.2, 0.2), (1.5, 1.5), (0.0, 0.0)]
    places += [(None, 1.0), (float("nan"), 0.5), (50.0, 50.0)]
    points = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(places)], "i int, x double, y double")
    plain, split = SP.polygon_cells(polygons, 1.0), SP.split_cells(polygons, points, "x", "y", 1.0)

    def rows(cells, broadcast):
        out = SP.assign_polygon(points, cells, "x", "y", "bg", 1.0, broadcast, count_out="n")
        return sorted((a.i, a.bg, a.n) for a in out.collect())
    assert rows(split, True) == rows(split, False) == rows(plain, True)
    levels = split.agg(F.max("level"), F.expr("percentile(size(cands), 0.5)")).first()
    assert levels[0] >= 2 and levels[1] <= 4  # a plain cell lists the 30 shapes around it
