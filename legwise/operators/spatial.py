"""Point-in-polygon left join.

Plan:

1. Polygon edges are bucketed by grid cell (``cell`` degrees). A horizontal
   ray from a point to +x can only cross edges that straddle the point's
   latitude, i.e. edges in the point's row band, and only edges that reach
   the point's cell or lie to its right. Edges entirely right of the cell
   that span the whole band are crossed by every ray from the cell: they are
   folded into a parity bit. Per (cell, polygon) the table keeps that bit and
   the few remaining edges; per cell, the candidates sorted by polygon id. A cell
   wholly inside a polygon keeps no edge and needs no exact test.
   The cover follows the outline: in each row band a polygon takes the cells
   between its edges there, an edge being clipped to the band (and widened by a
   cell, which settles rounding). So the cover grows with the polygon's area and
   outline, and one stray vertex adds a thin spike instead of a huge box.
2. Every point gets exactly one cell and is left-joined to that table on the
   cell key, so each point row stays one row and unmatched points keep a null
   id.
3. The exact test runs on the candidate array with built-in higher-order
   functions: even-odd crossing count (parity bit + remaining edges) — holes
   and multi-polygons included — and a point on an edge or vertex is *not*
   inside (``within``). The first (smallest-id) containing polygon wins,
   which settles overlapping polygons deterministically (D-7).

Where both points and polygons are many, ``split_cells`` cuts a crowded cell into 4,
16, ... parts, so that a part holds few points. A polygon that lies wholly around a
part is not listed there but counted, with the smallest id: once for the largest
square of parts it covers. So a point meets only polygons whose outline passes near it.

Per point the work is proportional to the edges near its cell row, not to
the polygon size. The cell table is broadcast only when its measured edge
count is under a bound; otherwise both sides are shuffled on the cell key and
AQE's skew handling splits hot cells (dense downtown points).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from legwise.session import written

DEFAULT_CELL = 0.01
DEFAULT_BROADCAST_EDGES = 2_000_000
#: Points and shapes that a split cell should still hold, the deepest split (4 ** 8 parts), and grid places worked on at a time.
POINTS_KEPT, SHAPES_KEPT, DEEPEST, PLACES = 16, 4, 8, 1 << 19


def _rings(polygons: DataFrame) -> DataFrame:
    """Normalise to ``bg_id, rings array<array<struct<x,y>>>``."""
    if "rings" in polygons.columns:
        return polygons.select("bg_id", "rings")
    return polygons.select("bg_id", F.array(F.col("ring")).alias("rings"))


def _cell(v: Column, cell: float) -> Column:
    return F.floor(v / F.lit(float(cell)))


def _ring_edges(p: DataFrame) -> DataFrame:
    """``bg_id, x1, y1, x2, y2`` of every ring edge."""
    ring = p.select("bg_id", "whole", F.explode("rings").alias("r")).where(F.size("r") > 1)
    return ring.select("bg_id", "whole", F.explode(F.transform(
        F.sequence(F.lit(1), F.size("r") - 1),
        lambda i: F.struct(F.element_at("r", i)["x"].alias("x1"), F.element_at("r", i)["y"].alias("y1"),
                           F.element_at("r", i + 1)["x"].alias("x2"), F.element_at("r", i + 1)["y"].alias("y2"))))
                       .alias("e")).select("bg_id", "whole", "e.*")


def _banded_edges(edges: DataFrame, cell: float) -> DataFrame:
    """Edges in the row bands (``cy``) they touch, with the cells (``bx0`` to
    ``bx1``) their part in the band may reach."""
    e = edges.select("*", _cell(F.least("y1", "y2"), cell).alias("ey0"), _cell(F.greatest("y1", "y2"), cell).alias("ey1"))
    e = e.withColumn("cy", F.explode(F.sequence("ey0", "ey1")))
    lo = F.greatest(F.col("cy") * cell, F.least("y1", "y2"))
    hi = F.least((F.col("cy") + 1) * cell, F.greatest("y1", "y2"))

    def at(y: Column) -> Column:
        return F.when(F.col("y1") == F.col("y2"), F.col("x1")).otherwise(
            F.col("x1") + (F.col("x2") - F.col("x1")) * (y - F.col("y1")) / (F.col("y2") - F.col("y1")))
    ends = F.when(F.col("y1") == F.col("y2"), F.array("x1", "x2")).otherwise(F.array(at(lo), at(hi)))
    low, high = F.least("x1", "x2"), F.greatest("x1", "x2")
    return e.select("*", _cell(F.least(high, F.greatest(low, F.array_min(ends))), cell).alias("c0"),
                    _cell(F.least(high, F.greatest(low, F.array_max(ends))), cell).alias("c1")) \
        .withColumn("bx0", F.greatest(F.col("c0") - 1, _cell(low, cell))) \
        .withColumn("bx1", F.least(F.col("c1") + 1, _cell(high, cell))).drop("c0", "c1")


def _cell_entries(polygons: DataFrame, cell: float) -> DataFrame:
    """One row per cell, polygon and box: ``cx, cy, bg_id, base, edges, minx, miny, maxx, maxy, whole``;
    ``whole``: all its rings here are closed and have all their coordinates."""
    p = _rings(polygons)
    pts = F.flatten(F.col("rings"))
    boxes = p.select("bg_id",
                     F.array_min(F.transform(pts, lambda q: q["x"])).alias("minx"),
                     F.array_max(F.transform(pts, lambda q: q["x"])).alias("maxx"),
                     F.array_min(F.transform(pts, lambda q: q["y"])).alias("miny"),
                     F.array_max(F.transform(pts, lambda q: q["y"])).alias("maxy"))
    closed = F.forall("rings", lambda r: (F.size(r) < 2) | (F.element_at(r, 1) == F.element_at(r, -1)))
    given = F.forall(pts, lambda q: q["x"].isNotNull() & q["y"].isNotNull() & ~F.isnan(q["x"]) & ~F.isnan(q["y"]))
    banded = _banded_edges(_ring_edges(p.withColumn("whole", F.coalesce(closed & given, F.lit(False)))),
                           cell)
    cells = (banded.groupBy("bg_id", "cy").agg(F.min("bx0").alias("from_x"), F.max("bx1").alias("to_x"))
             .withColumn("cx", F.explode(F.sequence("from_x", "to_x"))).drop("from_x", "to_x"))
    # per (cell, polygon): edges that reach the cell or lie right of it, in its band
    pairs = cells.join(banded, ["bg_id", "cy"]).filter(F.col("bx1") >= F.col("cx"))
    always = (F.col("bx0") > F.col("cx")) & (F.col("ey0") < F.col("cy")) & (F.col("ey1") > F.col("cy"))
    return (pairs.groupBy("cx", "cy", "bg_id")
            .agg((F.sum(always.cast("int")) % 2).cast("int").alias("base"),
                 F.filter(F.collect_list(F.when(~always, F.struct("x1", "y1", "x2", "y2"))),
                          lambda e: e.isNotNull()).alias("edges"), F.bool_and("whole").alias("whole"))
            .where("base = 1 OR size(edges) > 0").join(boxes, "bg_id"))


CANDIDATE = ("bg_id", "minx", "miny", "maxx", "maxy", "base", "edges")


def polygon_cells(polygons: DataFrame, cell: float = DEFAULT_CELL) -> DataFrame:
    """``cx, cy, cands array<struct<bg_id, minx, miny, maxx, maxy, base, edges>>``;
    ``base`` is the parity of the always-crossed edges, ``edges`` the rest
    (``x1, y1, x2, y2``) that a ray from this cell may cross or touch."""
    return _cell_entries(polygons, cell).groupBy("cx", "cy").agg(
        F.array_sort(F.collect_list(F.struct(*CANDIDATE))).alias("cands"))


def _add(shape: tuple, *at: np.ndarray) -> np.ndarray:
    return np.bincount(np.ravel_multi_index(at, shape), minlength=int(np.prod(shape))).reshape(shape)


def _parts(rows: pa.RecordBatch, k: int, cell: float):
    """The parts (4 ** k for a cell) of the entries ``rows``: those an entry is listed in, and the squares it covers."""
    n, m, s = 1 << k, len(rows), cell / (1 << k)
    cx, cy, base, whole = (rows[c].to_numpy(zero_copy_only=False) for c in ("cx", "cy", "base", "whole"))
    edges = rows["edges"]
    own = np.repeat(np.arange(m), edges.value_lengths().to_numpy())
    flat = edges.flatten()
    ends = np.array([flat.field(c).to_numpy(zero_copy_only=False) for c in range(4)]).reshape(4, -1)[:, whole[own]]
    own = own[whole[own]]
    x1, y1, x2, y2 = ends

    def at_cell(v):
        return np.floor(v / s).astype(np.int64)
    ey0, ey1 = at_cell(np.minimum(y1, y2)), at_cell(np.maximum(y1, y2))
    r0, r1 = np.maximum(ey0, cy[own] * n), np.minimum(ey1, cy[own] * n + n - 1)
    reps = np.maximum(r1 - r0 + 1, 0)
    i = np.repeat(np.arange(len(own)), reps)
    band = np.arange(len(i)) - np.repeat(np.cumsum(reps) - reps, reps) + r0[i]
    own, x1, y1, x2, y2, ey0, ey1 = (v[i] for v in (own, x1, y1, x2, y2, ey0, ey1))
    low, high, level = np.minimum(x1, x2), np.maximum(x1, x2), y1 == y2
    slope = (x2 - x1) / np.where(level, 1, y2 - y1)
    ya, yb = np.maximum(band * s, np.minimum(y1, y2)), np.minimum((band + 1) * s, np.maximum(y1, y2))
    xa, xb = np.where(level, x1, x1 + slope * (ya - y1)), np.where(level, x2, x1 + slope * (yb - y1))
    # as in _banded_edges: widened by a part, which settles rounding
    bx0 = np.maximum(at_cell(np.clip(np.minimum(xa, xb), low, high)) - 1, at_cell(low)) - cx[own] * n
    bx1 = np.minimum(at_cell(np.clip(np.maximum(xa, xb), low, high)) + 1, at_cell(high)) - cx[own] * n
    a, b, y = np.clip(bx0, 0, n), np.clip(bx1, -1, n - 1), band - cy[own] * n
    spans, reach = (ey0 < band) & (ey1 > band), a <= b
    grid = (m, n, n + 1)
    touched = np.cumsum(_add(grid, own[reach], y[reach], a[reach]) - _add(grid, own[reach], y[reach], b[reach] + 1), axis=2)[..., :n] > 0

    def right(of: np.ndarray) -> np.ndarray:
        """How many of these edges lie right of each part."""
        return np.cumsum(_add(grid, own[of], y[of], a[of])[..., ::-1], axis=2)[..., ::-1][..., 1:]
    middle = (band + 0.5) * s
    inside = (base[:, None, None] + right((y1 > middle) != (y2 > middle))) % 2 == 1
    place = np.arange(n)
    box = [np.nan_to_num(rows[c].to_numpy(zero_copy_only=False).astype(float), nan=0.0) for c in ("minx", "maxx", "miny", "maxy")]
    fits = ~np.logical_or.reduce([np.asarray(rows[c].is_null()) for c in ("minx", "maxx", "miny", "maxy")])
    px, py = cx[:, None] * n + place, cy[:, None] * n + place
    in_x = (px > at_cell(box[0])[:, None]) & (px < at_cell(box[1])[:, None])
    in_y = (py > at_cell(box[2])[:, None]) & (py < at_cell(box[3])[:, None])
    within = (in_y[:, :, None] & in_x[:, None, :]) & (fits & whole)[:, None, None]
    covered = ~touched & inside & within
    listed = (touched | (inside & ~within)) & whole[:, None, None]

    # edges of the listed parts: those that reach the part or lie right of it, but for the always-crossed ones
    width = b + 1
    j = np.repeat(np.arange(len(own)), width)
    col = np.arange(len(j)) - np.repeat(np.cumsum(width) - width, width)
    kept = listed[own[j], y[j], col] & ~(spans[j] & (col < a[j]))
    j, col = j[kept], col[kept]
    spot = (own[j] * n + y[j]) * n + col
    order = np.argsort(spot, kind="stable")
    where = np.flatnonzero(listed)
    bounds = np.searchsorted(spot[order], np.append(where, m * n * n))
    j = j[order]
    made = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.StructArray.from_arrays(
        [pa.array(v[j]) for v in (x1, y1, x2, y2)], ["x1", "y1", "x2", "y2"]))
    e, py_, px_ = np.unravel_index(where, (m, n, n))
    parity = (base[e] + right(spans)[e, py_, px_]) % 2
    yield _rows_of(rows, e, k, k, cx[e] * n + px_, cy[e] * n + py_, parity, made)

    odd = np.repeat(np.flatnonzero(~whole), n * n)  # rings that are not closed: listed everywhere as they are
    if len(odd):
        spot = np.tile(np.arange(n * n), len(odd) // (n * n))
        yield _rows_of(rows, odd, k, k, cx[odd] * n + spot % n, cy[odd] * n + spot // n, base[odd], edges.take(pa.array(odd)))

    for depth in range(k + 1):
        side, size = 1 << depth, n >> depth
        full = covered.reshape(m, side, size, side, size).all(axis=(2, 4))
        covered = covered & ~np.repeat(np.repeat(full, size, axis=1), size, axis=2)
        e, qy, qx = np.nonzero(full)
        if len(e):
            yield _rows_of(rows, e, k, depth, cx[e] * side + qx, cy[e] * side + qy, base[e], pa.nulls(len(e), edges.type))


def _rows_of(rows, e, level, depth, sx, sy, base, edges) -> pa.RecordBatch:
    took = rows.select(["bg_id", "minx", "miny", "maxx", "maxy"]).take(pa.array(e))
    edges = edges.cast(pa.list_(pa.struct([(c, pa.float64()) for c in ("x1", "y1", "x2", "y2")])))
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(e), level), pa.int32()), pa.array(np.full(len(e), depth), pa.int32()),
         pa.array(sx, pa.int64()), pa.array(sy, pa.int64()), *took.columns, pa.array(base, pa.int32()), edges],
        names=["level", "depth", "sx", "sy", *CANDIDATE])


def _split(cell: float):
    def run(batches):
        for batch in batches:
            levels = batch["level"].to_numpy()
            for k in np.unique(levels):
                some = np.flatnonzero(levels == k)
                step = max(1, PLACES >> (2 * int(k)))
                for lo in range(0, len(some), step):
                    yield from _parts(batch.take(pa.array(some[lo:lo + step])), int(k), cell)
    return run


def split_cells(polygons: DataFrame, points: DataFrame, lon: str, lat: str, cell: float = DEFAULT_CELL) -> DataFrame:
    """The cell table for these points: ``level, sx, sy`` (a part of the side ``cell / 2 ** level``), ``cands`` as in
    ``polygon_cells``, ``around`` (how many polygons cover the part, not in ``cands``) and ``first`` (the smallest id
    of those). Cells without points are left out."""
    polygons, _ = written(_rings(polygons), "polygon-rings")  # rings may be costly to make, and are used several times
    entries, _ = written(_cell_entries(polygons, cell), "polygon-entries")
    crowd = points.groupBy(_cell(F.col(lon), cell).alias("cx"), _cell(F.col(lat), cell).alias("cy")).agg(
        F.count(F.lit(1)).alias("points"))
    fine = F.least(F.floor(F.log2(F.greatest(F.col("points") / POINTS_KEPT, F.lit(1.0))) / 2),
                   F.ceil(F.log2(F.greatest(F.col("shapes") / SHAPES_KEPT, F.lit(1.0)))), F.lit(DEEPEST))
    levels = (entries.groupBy("cx", "cy").agg(F.count(F.lit(1)).alias("shapes")).join(crowd, ["cx", "cy"])
              .select("cx", "cy", fine.cast("int").alias("level")))
    schema = ("level int, depth int, sx long, sy long, bg_id string, minx double, miny double, maxx double, maxy double, "
              "base int, edges array<struct<x1: double, y1: double, x2: double, y2: double>>")
    parts, _ = written(entries.join(levels, ["cx", "cy"]).mapInArrow(_split(cell), schema), "polygon-parts")
    side = F.expr("shiftleft(1L, level - depth)")
    covers = (parts.where("edges IS NULL").groupBy("level", "depth", "sx", "sy")
              .agg(F.count(F.lit(1)).alias("around"), F.min("bg_id").alias("first"))
              .select("level", F.explode(F.sequence(F.col("sx") * side, F.col("sx") * side + side - 1)).alias("px"),
                      F.col("sy") * side, side, "around", "first").toDF("level", "sx", "y0", "side", "around", "first")
              .select("level", "sx", F.explode(F.expr("sequence(y0, y0 + side - 1)")).alias("sy"), "around", "first"))
    listed = parts.where("edges IS NOT NULL").select("level", "sx", "sy", F.struct(*CANDIDATE).alias("cand"))
    return (listed.unionByName(covers, allowMissingColumns=True).groupBy("level", "sx", "sy")
            .agg(F.array_sort(F.collect_list("cand")).alias("cands"), F.coalesce(F.sum("around"), F.lit(0)).alias("around"),
                 F.min("first").alias("first")))


def _crosses(px: Column, py: Column, e: Column) -> Column:
    x1, y1, x2, y2 = e["x1"], e["y1"], e["x2"], e["y2"]
    straddles = (y1 > py) != (y2 > py)
    return straddles & (px < (x2 - x1) * (py - y1) / (y2 - y1) + x1)


def _on_edge(px: Column, py: Column, e: Column) -> Column:
    x1, y1, x2, y2 = e["x1"], e["y1"], e["x2"], e["y2"]
    cross = (x2 - x1) * (py - y1) - (y2 - y1) * (px - x1)
    return ((cross == 0) & (px >= F.least(x1, x2)) & (px <= F.greatest(x1, x2))
            & (py >= F.least(y1, y2)) & (py <= F.greatest(y1, y2)))


def point_in_candidate(px: Column, py: Column, c: Column) -> Column:
    """Strictly inside under the even-odd rule; a point on a boundary is outside."""
    crossings = F.aggregate(c["edges"], c["base"],
                            lambda acc, e: acc + F.when(_crosses(px, py, e), 1).otherwise(0))
    return ((crossings % 2) == 1) & ~F.exists(c["edges"], lambda e: _on_edge(px, py, e))


def point_in_rings(px: Column, py: Column, rings: Column) -> Column:
    """The same test against whole rings (no cell table), for small inputs."""
    def edge(r, i):
        return F.struct(F.element_at(r, i)["x"].alias("x1"), F.element_at(r, i)["y"].alias("y1"),
                        F.element_at(r, i + 1)["x"].alias("x2"), F.element_at(r, i + 1)["y"].alias("y2"))
    all_edges = F.flatten(F.transform(rings, lambda r: F.transform(F.sequence(F.lit(1), F.size(r) - 1),
                                                                     lambda i: edge(r, i))))
    return point_in_candidate(px, py, F.struct(F.lit(0).alias("base"), all_edges.alias("edges")))


def containing(px: Column, py: Column, cands: Column) -> Column:
    """The candidates that strictly contain the point, smallest id first."""
    return F.filter(cands, lambda c: (px > c["minx"]) & (px < c["maxx"]) & (py > c["miny"]) & (py < c["maxy"])
                    & point_in_candidate(px, py, c))


def containing_id(px: Column, py: Column, cands: Column) -> Column:
    """Id of the first candidate (smallest id) that strictly contains the point."""
    return F.try_element_at(containing(px, py, cands), F.lit(1))["bg_id"]


def cell_table_edges(cells: DataFrame) -> int:
    """Total candidate edges in the cell table (one small aggregate)."""
    v = cells.select(F.aggregate(F.col("cands"), F.lit(0).cast("long"),
                                 lambda acc, c: acc + F.size(c["edges"]).cast("long") + 1).alias("v"), F.lit(1).alias("one")) \
        .agg(F.sum(F.col("v") + F.col("one"))).first()[0]
    return int(v or 0)


def assign_polygon(points: DataFrame, cells: DataFrame, lon: str, lat: str, out: str,
                   cell: float = DEFAULT_CELL, broadcast: bool | None = None, count_out: str | None = None) -> DataFrame:
    """Left join each point to the polygon containing it (``out`` = id or
    null; ``count_out``: how many polygons contain it, more than one where they
    overlap, D-7). ``broadcast``: None = decide by measured size, True/False =
    force."""
    p = points.withColumn("_cx", _cell(F.col(lon), cell)).withColumn("_cy", _cell(F.col(lat), cell))
    keys, px, py = ["_cx", "_cy"], F.col(lon), F.col(lat)
    if broadcast is None:
        broadcast = cell_table_edges(cells) <= DEFAULT_BROADCAST_EDGES
    if "around" in cells.columns:  # split cells: a point looks up its cell's level first
        levels = cells.select(F.expr("shiftright(sx, level)").alias("_cx"), F.expr("shiftright(sy, level)").alias("_cy"),
                              F.col("level").alias("_level")).distinct()
        side = F.lit(float(cell)) / F.pow(F.lit(2.0), F.col("_level"))
        p = (p.join(levels, keys, "left").withColumn("_level", F.coalesce("_level", F.lit(0)))
             .withColumn("_cx", F.floor(px / side)).withColumn("_cy", F.floor(py / side)))
        keys = ["_level", *keys]
        table = cells.select(F.col("level").alias("_level"), F.col("sx").alias("_cx"), F.col("sy").alias("_cy"),
                             F.col("cands").alias("_cands"), F.col("around").alias("_around"), F.col("first").alias("_first"))
    else:
        table = cells.select(F.col("cx").alias("_cx"), F.col("cy").alias("_cy"), F.col("cands").alias("_cands"),
                             F.lit(0).cast("long").alias("_around"), F.lit(None).cast("string").alias("_first"))
    joined = p.join(F.broadcast(table) if broadcast else table, keys, "left")
    given = px.isNotNull() & py.isNotNull()
    around = given & ~F.isnan(px.cast("double")) & ~F.isnan(py.cast("double"))  # no number lies in no polygon
    first = F.when(around, F.col("_first"))
    if count_out is None:
        found = joined.withColumn(out, F.least(F.when(given, containing_id(px, py, F.col("_cands"))), first))
    else:
        ids = F.transform(F.when(given, containing(px, py, F.col("_cands"))), lambda c: c["bg_id"])
        found = (joined.withColumn("_ids", F.coalesce(ids, F.array().cast("array<string>")))
                 .withColumn(out, F.least(F.try_element_at("_ids", F.lit(1)), first))
                 .withColumn(count_out, (F.size("_ids") + F.coalesce(F.when(around, F.col("_around")), F.lit(0))).cast("int"))
                 .drop("_ids"))
    return found.drop("_cx", "_cy", "_cands", "_around", "_first", "_level")


def assign_origin_destination(legs: DataFrame, polygons: DataFrame, cell: float = DEFAULT_CELL,
                              start=("start_longitude", "start_latitude"),
                              end=("end_longitude", "end_latitude"),
                              out=("Origin_BG", "Dest_BG"), broadcast: bool | None = None) -> DataFrame:
    """J1 + J2: origin and destination block groups; the cell table is written
    once and used for its size and for both ends."""
    cells, _ = written(polygon_cells(polygons, cell), "polygon-cells")
    if broadcast is None:
        broadcast = cell_table_edges(cells) <= DEFAULT_BROADCAST_EDGES
    legs = assign_polygon(legs, cells, start[0], start[1], out[0], cell, broadcast)
    return assign_polygon(legs, cells, end[0], end[1], out[1], cell, broadcast)
