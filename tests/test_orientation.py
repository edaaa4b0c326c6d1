"""Sides of edges against rational arithmetic."""

import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from wardgrid.functions import geometry
from wardgrid.functions.orientation import _close, exact_sum_sign, turn


def sign(x):
    return (x > 0) - (x < 0)


def rational(ax, ay, bx, by, px, py):
    ax, ay, bx, by, px, py = map(Fraction, (ax, ay, bx, by, px, py))
    return sign((bx - ax) * (py - ay) - (by - ay) * (px - ax))


def plain(ax, ay, bx, by, px, py):
    return sign((bx - ax) * (py - ay) - (by - ay) * (px - ax))


def near_edges(seed, n, scale):
    source = random.Random(seed)
    for _ in range(n):
        ax, ay, bx, by = (source.uniform(-1, 1) * scale - 73.9 * (k % 2) for k in range(4))
        t = source.choice([0.0, 0.5, 1.0, 2.0, source.random()])
        px, py = ax + t * (bx - ax), ay + t * (by - ay)
        for _ in range(source.randrange(3)):
            px = math.nextafter(px, source.choice([-math.inf, math.inf]))
        yield ax, ay, bx, by, px, py


@pytest.mark.parametrize("scale", [1e-6, 1.0, 1e12])
def test_sides_near_the_edge(spark, scale):
    rows = list(near_edges(int(math.log10(scale)), 1500, scale))
    rows += [(0.0, 0.0, 0.0, 0.0, 1.0, 1.0), (0.1, 0.1, 0.3, 0.3, 0.2, 0.2), (0.1, 0.1, 0.7, 0.7, 0.3, math.nextafter(0.3, 1))]
    frame = spark.createDataFrame(rows, "ax double, ay double, bx double, by double, px double, py double")
    got = [(r[:6], int(r["s"])) for r in frame.withColumn("s", F.signum(turn(*map(F.col, frame.columns)))).collect()]
    assert len(got) == len(rows) and all(s == rational(*corners) for corners, s in got)
    assert sum(plain(*r) != rational(*r) for r in rows) > 20  # rounding does go wrong here


def test_sums_that_cancel(spark):
    cases = [[], [0.0], [1e16, 1.0, -1e16], [1e16, -1.0, -1e16], [0.1, 0.2, -0.3], [1e100, 1e-100, -1e100, -1e-100], [3.0, -1.0, -2.0]]
    frame = spark.createDataFrame([(c,) for c in cases], "v array<double>")
    got = [int(r[0]) for r in frame.select(F.signum(exact_sum_sign(F.col("v")))).collect()]
    assert got == [sign(sum(map(Fraction, c))) for c in cases]


def test_missing_corner(spark):
    assert spark.range(1).select(turn(*[F.lit(v).cast("double") for v in (0, 0, 1, 1, None, 1)])).first()[0] is None


def test_slanted_borders_of_two_polygons(spark):
    """Points on and beside a border that two triangles share: in one, in the other, or on both borders."""
    a, b = (-73.987654, 40.701234), (-73.912345, 40.798765)
    left, right = (-74.05, 40.76), (-73.85, 40.74)
    source = random.Random(4)
    spots = [a, b]
    for _ in range(600):
        t = source.random()
        x, y = a[0] + t * (b[0] - a[0]), a[1] + t * (b[1] - a[1])
        for _ in range(source.randrange(3)):
            x = math.nextafter(x, source.choice([-math.inf, math.inf]))
        spots.append((x, y))
    spots += [((a[0] + b[0]) / 2, (a[1] + b[1]) / 2)]

    def text(*corners):
        return "POLYGON ((" + ", ".join(f"{x!r} {y!r}" for x, y in [*corners, corners[0]]) + "))"

    shapes = spark.createDataFrame([("l", text(a, b, left)), ("r", text(a, b, right))], "id string, wkt string")
    points = spark.createDataFrame([(k, x, y) for k, (x, y) in enumerate(spots)], "k int, x double, y double")
    edges = geometry.polygon_edges(geometry.parse_rings(F.col("wkt")))
    x, y, e = F.col("x"), F.col("y"), F.col("edges")
    rows = points.crossJoin(shapes.withColumn("edges", edges)).select(
        "k", "id", geometry.inside(e, x, y).alias("contains"), geometry.inside(e, x, y, boundary=True).alias("covers")).collect()
    found = {(r["k"], r["id"]): (r["contains"], r["covers"]) for r in rows}
    sides = {k: rational(*a, *b, *spot) for k, spot in enumerate(spots)}
    assert {1, -1, 0} == set(sides.values())
    for k, side in sides.items():
        on = side == 0
        assert found[k, "l"] == (side > 0, side > 0 or on), (k, side)
        assert found[k, "r"] == (side < 0, side < 0 or on), (k, side)


@pytest.mark.parametrize("unit", [1.0, 2.0**-40, 2.0**-460])
def test_sides_by_two_products(spark, unit):
    """Whole-numbered steps of over 2**45: the products differ by less than their rounding, or not at all. The exact
    sum is a mark here: it is taken only where products may be too small for a double."""
    source = random.Random(5)
    rows = []
    for _ in range(600):
        u, x, y = 2 * source.randrange(1 << 45) + 1, source.randrange(1 << 40), source.randrange(1 << 40)
        v = u + source.choice([-2, 0, 2])
        rows.append(tuple(c * unit for c in (x, y, x + u, y + v, x + (u - 1) // 2, y + (v - 1) // 2)))
    frame = spark.createDataFrame([tuple(map(float, r)) for r in rows], "ax double, ay double, bx double, by double, px double, py double")
    ax, ay, bx, by, px, py = map(F.col, frame.columns)
    steps = [(bx, ax), (py, ay), (by, ay), (px, ax)]
    held = F.struct(*[(a - b).alias(f"d{i}") for i, (a, b) in enumerate(steps)])
    quick = _close(F.col("d"), steps, F.lit(float("nan")))
    got = frame.withColumn("d", held).select(*frame.columns, turn(ax, ay, bx, by, px, py).alias("s"), quick.alias("q")).collect()
    assert all(sign(r["s"]) == rational(*r[:6]) for r in got)
    assert sum(plain(*r[:6]) != rational(*r[:6]) for r in got) > 20
    if unit > 2.0**-400:
        assert all(sign(r["q"]) == rational(*r[:6]) for r in got)
