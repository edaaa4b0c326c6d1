import math
from fractions import Fraction

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from wardgrid.operators.cover import BOX, ENDS, cover, cut_cells, points_in_cover

SQ = "POLYGON ((0 0, 4 0, 4 4, 0 4, 0 0), (1 1, 2 1, 2 2, 1 2, 1 1))"
MP = "MULTIPOLYGON (((5 0, 6 0, 6 1, 5 1, 5 0)), ((5 2, 7 2, 7 3, 6 3, 6 4, 5 4, 5 2)))"
# an upright border on the right side and nothing else has a height
OPEN = "POLYGON ((0.5 0, 1.5 0, 1.5 1.5, 0.5 1.5))"
BOW = "POLYGON ((10 10, 12 12, 12 10, 10 12, 10 10))"


def star(n, cx=-73.9, cy=40.7):
    """A ring of n vertices whose radius swings."""
    points = []
    for i in range(n):
        angle, radius = 2 * math.pi * i / n, 0.1 + 0.02 * math.sin(25 * 2 * math.pi * i / n)
        points.append((cx + radius * math.cos(angle), cy + radius * math.sin(angle)))
    return [*points, points[0]]


def text(ring):
    return "POLYGON ((" + ", ".join(f"{x!r} {y!r}" for x, y in ring) + "))"


def where(rings, x, y):
    """'in', 'on' or 'out', with rationals."""
    odd = False
    for ring in rings:
        for (ax, ay), (bx, by) in zip(ring, ring[1:]):
            if y < min(ay, by) or y > max(ay, by):
                continue
            px, py, qx, qy = (Fraction(float(v)) for v in (ax, ay, bx, by))
            side = (qx - px) * (Fraction(float(y)) - py) - (qy - py) * (Fraction(float(x)) - px)
            if side == 0 and min(ax, bx) <= x <= max(ax, bx) and min(ay, by) <= y <= max(ay, by):
                return "on"
            if (ay > y) != (by > y):
                odd ^= (side > 0) == (by > ay)
    return "in" if odd else "out"


def points(spark, pairs):
    return spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(pairs)], "i int, longitude double, latitude double")


def met(frame, keep="id"):
    return sorted((r["i"], r[keep]) for r in frame.collect())


RINGS = {
    "sq": [[(0, 0), (4, 0), (4, 4), (0, 4), (0, 0)], [(1, 1), (2, 1), (2, 2), (1, 2), (1, 1)]],
    "mp": [[(5, 0), (6, 0), (6, 1), (5, 1), (5, 0)], [(5, 2), (7, 2), (7, 3), (6, 3), (6, 4), (5, 4), (5, 2)]],
    "bow": [[(10, 10), (12, 12), (12, 10), (10, 12), (10, 10)]],
}


@pytest.mark.parametrize(("most", "limit"), [(1, 1 << 28), (3, 0), (100, 1 << 28)])
def test_rings_holes_and_borders(spark, most, limit):
    shapes = spark.createDataFrame([("sq", SQ), ("mp", MP), ("bow", BOW)], "id string, geometry_wkt string")
    spots = [(x / 4, y / 4) for x in range(-2, 52, 2) for y in range(-2, 52, 2)] + [(0.3, 0.7), (10.5, 10.5), (11.25, 10.8)]
    for boundary in (False, True):
        told = met(points_in_cover(points(spark, spots), shapes, ["id"], boundary=boundary, broadcast_bytes=limit, hot_cell_rows=3, most=most))
        wanted = {"in", "on"} if boundary else {"in"}
        assert told == sorted((i, name) for i, (x, y) in enumerate(spots) for name, rings in RINGS.items() if where(rings, x, y) in wanted)


def test_slanted_edges_agree_with_rationals(spark):
    rng = np.random.default_rng(5)
    ring = star(60)
    spots = []
    for (ax, ay), (bx, by) in zip(ring, ring[1:]):
        for part in rng.random(6):
            x, y = ax + part * (bx - ax), ay + part * (by - ay)
            spots += [(x, y), (np.nextafter(x, 9), y), (np.nextafter(x, -99), y), (x, np.nextafter(y, 99))]
    spots += ring
    shapes = spark.createDataFrame([("s", text(ring))], "id string, geometry_wkt string")
    for boundary in (False, True):
        told = met(points_in_cover(points(spark, spots), shapes, ["id"], boundary=boundary))
        wanted = {"in", "on"} if boundary else {"in"}
        assert told == [(i, "s") for i, (x, y) in enumerate(spots) if where([ring], x, y) in wanted]


def test_cells_grow_with_the_vertices(spark):
    sizes = {}
    for n in (1_000, 10_000):
        shape = spark.createDataFrame([("s", text(star(n)))], "id string, geometry_wkt string")
        cells = cover(shape, ["id"])
        seen = cells.agg(F.count("*").alias("n"), F.sum(F.size("_edges")).alias("edges"), F.max(F.size("_edges")).alias("most")).first()
        sizes[n] = seen["n"]
        assert seen["most"] <= 8 and seen["edges"] < 12 * n
    assert sizes[10_000] < 15 * sizes[1_000]


def test_most_points_need_no_edge(spark):
    rng = np.random.default_rng(7)
    ring = star(2_000)
    spots = list(zip(rng.uniform(-74.02, -73.78, 4_000), rng.uniform(40.58, 40.82, 4_000)))
    shape = spark.createDataFrame([("s", text(ring))], "id string, geometry_wkt string")
    told = met(points_in_cover(points(spark, spots), shape, ["id"]))
    assert told == [(i, "s") for i, (x, y) in enumerate(spots) if where([ring], x, y) == "in"]
    # area of the cells that lie inside as a whole, against the area of the ring
    whole = cover(shape, ["id"]).where("_edges is null").agg(F.sum(F.expr("pow(4D, -18 + 2 * _level)"))).first()[0]
    ring_area = abs(sum(ax * by - bx * ay for (ax, ay), (bx, by) in zip(ring, ring[1:]))) / 2
    assert 0.8 < whole / ring_area < 1  # 0.83; a larger share would take smaller cells along the boundary


def test_nothing_to_match(spark):
    none = spark.createDataFrame([("a", None), ("b", "POINT (1 2)"), ("c", "POLYGON EMPTY")], "id string, geometry_wkt string")
    spots = spark.createDataFrame([(0, 1.0, 1.0), (1, None, 1.0), (2, 500.0, 1.0), (3, float("nan"), 1.0)], "i int, longitude double, latitude double")
    empty = points_in_cover(spots, none, ["id"])
    assert empty.columns == ["i", "longitude", "latitude", "id"] and empty.count() == 0
    square = spark.createDataFrame([("sq", "POLYGON ((0 0, 4 0, 4 4, 0 4, 0 0))"), ("again", "POLYGON ((0 0, 4 0, 4 4, 0 4, 0 0))")], none.schema)
    assert met(points_in_cover(spots, square, ["id"])) == [(0, "again"), (0, "sq")]
    with pytest.raises(ValueError):
        points_in_cover(spots.withColumn("id", F.lit(1)), square, ["id"])


def test_bounds_of_polygons(spark):
    """A closed ring is bounded on all sides; without an edge the count to its west may be odd, and stays so."""
    bounds = {r["id"]: tuple(r[b] for b in BOX) for r in cover(spark.createDataFrame([("sq", SQ), ("open", OPEN)], "id string, geometry_wkt string"), ["id"]).collect()}
    assert bounds == {"sq": (0.0, 4.0, 0.0, 4.0), "open": (-math.inf, 1.5, 0.0, 1.5)}
    shapes = spark.createDataFrame([("open", OPEN)], "id string, geometry_wkt string")
    assert met(points_in_cover(points(spark, [(0.25, 0.75), (0.75, 0.75), (1.75, 0.75), (1.0, 1.75)]), shapes, ["id"])) == [(0, "open"), (1, "open")]


def test_one_batch_of_cells_for_many_polygons(spark):
    """Polygons of a few cells share a batch: as many batches as tasks, not as polygons."""
    small = spark.range(200).selectExpr("id", "concat('POLYGON ((', id, ' 0, ', id + 1, ' 0, ', id, ' 1, ', id, ' 0))') AS geometry_wkt")
    joins = []
    own = pd.DataFrame.join
    flat = cover(small, ["id"])
    assert flat.select("id").distinct().count() == 200
    frame = pd.DataFrame({"id": [7, 8], **{n: [[0.0, 1.0, 0.0], [1.0, 2.0, 1.0]] for n in ENDS}})
    try:
        pd.DataFrame.join = lambda *a, **k: joins.append(1) or own(*a, **k)
        cells = pd.concat(cut_cells([frame], ["id"], 8))
    finally:
        pd.DataFrame.join = own
    assert set(cells["id"]) == {7, 8} and len(joins) == 1
