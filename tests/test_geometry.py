import pytest
from pyspark.sql import functions as F

from wardgrid.functions import geometry, projection
from wardgrid.operators.spatial import centroid_crosswalk, points_in_polygons, points_per_polygon

SQ = "POLYGON ((0 0, 4 0, 4 4, 0 4, 0 0), (1 1, 2 1, 2 2, 1 2, 1 1))"
MP = "MULTIPOLYGON (((5 0, 6 0, 6 1, 5 1, 5 0)), ((5 2, 7 2, 7 3, 6 3, 6 4, 5 4, 5 2)))"


@pytest.fixture
def shapes(spark):
    return spark.createDataFrame([("sq", SQ), ("mp", MP)], "id string, geometry_wkt string")


def test_area_and_centroid(one):
    sq = one(geometry.centroid, SQ)
    assert (sq["area"], sq["cx"], sq["cy"]) == pytest.approx((15, 30.5 / 15, 30.5 / 15))
    mp = one(geometry.centroid, MP)
    assert (mp["area"], mp["cx"], mp["cy"]) == pytest.approx((4, 5.75, 2.25))


def test_orientation_does_not_matter(one):
    turned = "POLYGON ((0 0, 0 4, 4 4, 4 0, 0 0), (1 1, 2 1, 2 2, 1 2, 1 1))"
    assert one(geometry.area, turned) == pytest.approx(15)


def test_hole_touching_part_order(one):
    two = "MULTIPOLYGON (((0 0, 4 0, 4 4, 0 4, 0 0), (1 1, 2 1, 2 2, 1 2, 1 1)), ((10 0, 12 0, 12 2, 10 2, 10 0), (10.5 0.5, 11 0.5, 11 1, 10.5 1, 10.5 0.5)))"
    assert one(geometry.area, two) == pytest.approx(15 + 4 - 0.25)


def test_degenerate_and_foreign_text(one):
    flat = one(geometry.centroid, "POLYGON ((0 0, 1 1, 0 0))")
    assert flat["area"] == 0 and flat["cx"] is None
    assert one(geometry.parse_rings, "POINT (1 2)") is None
    assert one(geometry.parse_rings, "POLYGON EMPTY") == []


def test_far_from_zero_keeps_precision(one):
    small = "POLYGON ((-73.9 40.7, -73.899 40.7, -73.899 40.701, -73.9 40.701, -73.9 40.7))"
    assert one(geometry.area, small) == pytest.approx(1e-6, rel=1e-6)


@pytest.mark.parametrize("wkt", [SQ, MP])
def test_text_round_trip(one, wkt):
    plain = lambda t: t.replace(".0", "")
    assert plain(one(lambda t: geometry.wkt_from_rings(geometry.parse_rings(t)), wkt)) == wkt


SPOTS = [
    (3, 3, ["sq"]), (1.5, 1.5, []), (6.5, 3.5, []), (5.5, 3.5, ["mp"]), (6.5, 2.5, ["mp"]), (5.5, 0.5, ["mp"]),
    (5.5, 1.5, []), (0, 2, []), (4, 4, []), (1, 1.5, []), (2, 0, []), (0, 0, []), (6, 3, []), (7, 2, []),
    (100, 80, []), (3, 1, ["sq"]), (0.5, 2, ["sq"]),
]
ON_THE_LINE = {(0, 2), (4, 4), (1, 1.5), (2, 0), (0, 0), (6, 3), (7, 2)}


def test_containment_join(spark, shapes):
    named = shapes.withColumnRenamed("id", "shape")
    points = spark.createDataFrame([(float(x), float(y)) for x, y, _ in SPOTS], "lon double, lat double")
    met = points_in_polygons(points, named, ["shape"], "lon", "lat").collect()
    for x, y, wanted in SPOTS:
        assert sorted(r["shape"] for r in met if (r["lon"], r["lat"]) == (x, y)) == wanted, (x, y)


def test_containment_filter_and_its_boundary(spark, shapes):
    points = spark.createDataFrame([(float(x), float(y)) for x, y, _ in SPOTS], "lon double, lat double")
    edges = geometry.polygon_edges(geometry.parse_rings(F.col("geometry_wkt")))
    x, y = F.col("lon"), F.col("lat")
    tried = points.crossJoin(shapes).withColumn("edges", edges).select(
        "lon", "lat", "id", geometry.inside(F.col("edges"), x, y).alias("contains"),
        geometry.inside(F.col("edges"), x, y, boundary=True).alias("covers")).collect()
    for px, py, wanted in SPOTS:
        here = [r for r in tried if (r["lon"], r["lat"]) == (px, py)]
        assert sorted(r["id"] for r in here if r["contains"]) == wanted
        covers = [r["id"] for r in here if r["covers"]]
        assert len(covers) == 1 if (px, py) in ON_THE_LINE else covers == wanted


NOTCHED = [
    # floors, ceilings, spikes up and down, a hole whose tips lie at vertex heights
    ("stairs", [[(0, 0), (6, 0), (6, 1), (5, 1), (5, 2), (4, 2), (4, 3), (0, 3), (0, 2), (1, 2), (1, 1), (0, 1), (0, 0)]]),
    ("teeth", [[(0, 0), (1, 3), (2, 0), (3, 3), (4, 0), (5, 3), (6, 0), (6, 4), (0, 4), (0, 0)]]),
    ("crown", [[(0, 0), (6, 0), (6, 4), (5, 1), (4, 4), (3, 1), (2, 4), (1, 1), (0, 4), (0, 0)]]),
    ("ring", [[(0, 0), (6, 0), (6, 4), (0, 4), (0, 0)], [(1, 2), (3, 1), (5, 2), (3, 3), (1, 2)]]),
    ("pinch", [[(0, 0), (3, 2), (6, 0), (6, 4), (3, 3), (0, 4), (0, 0)], [(1, 2), (2, 2), (2, 2.5), (1, 2.5), (1, 2)]]),
    ("tip", [[(0, 0), (6, 0), (6, 4), (0, 4), (0, 0)], [(2, 0), (4, 2), (2, 2), (2, 0)]]),
]


def strictly_inside(rings, x, y):
    """Exact rational even-odd test that leaves the boundary out."""
    from fractions import Fraction

    odd = False
    x, y = Fraction(x), Fraction(y)
    for ring in rings:
        for (x1, y1), (x2, y2) in zip(ring, ring[1:]):
            x1, y1, x2, y2 = map(Fraction, (x1, y1, x2, y2))
            turn = (x2 - x1) * (y - y1) - (y2 - y1) * (x - x1)
            if turn == 0 and min(x1, x2) <= x <= max(x1, x2) and min(y1, y2) <= y <= max(y1, y2):
                return False
            if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
                odd = not odd
    return odd


@pytest.mark.parametrize("shift, scale", [(0.0, 1.0), (-73.0, 0.125), (0.5, 4.0)])
def test_every_vertex_height_and_border(spark, shift, scale):
    """Points on a half-step lattice hit floors, ceilings, tips and vertices exactly."""
    def moved(ring):
        return [(shift + scale * x, scale * y) for x, y in ring]

    texts = [(n, "POLYGON (" + ", ".join("(" + ", ".join(f"{x!r} {y!r}" for x, y in moved(r)) + ")" for r in rings) + ")")
             for n, rings in NOTCHED]
    polygons = spark.createDataFrame(texts, "shape string, geometry_wkt string")
    spots = [(shift + scale * i / 4, scale * j / 4) for i in range(-1, 26) for j in range(-1, 18)]
    points = spark.createDataFrame(spots, "lon double, lat double")
    met = points_in_polygons(points, polygons, ["shape"], "lon", "lat").collect()
    got = sorted((r["shape"], r["lon"], r["lat"]) for r in met)
    want = sorted((n, x, y) for n, rings in NOTCHED for x, y in spots if strictly_inside([moved(r) for r in rings], x, y))
    assert got == want


def lattice(spark, n):
    at = F.col("id")
    return spark.range(n).select(
        "id",
        (F.pmod(at * 7919, F.lit(9973)) / F.lit(9973.0).cast("double") * 8).alias("lon"),
        (F.pmod(at * 5381, F.lit(9967)) / F.lit(9967.0).cast("double") * 5).alias("lat"),
    )


def test_counts_equal_plain_comparisons(spark, shapes):
    points = lattice(spark, 600000)
    counts = points_per_polygon(points, shapes, ["id"], "lon", "lat")
    sq = "lon > 0 and lon < 4 and lat > 0 and lat < 4 and not (lon between 1 and 2 and lat between 1 and 2)"
    mp = """(lon > 5 and lon < 6 and lat > 0 and lat < 1)
            or (lon > 5 and lon < 7 and lat > 2 and lat < 4 and not (lon >= 6 and lat >= 3))"""
    # half-open, as a bare even-odd test counts: 225,027 and 59,988 points
    half_open = sq.replace("lon > 0", "lon >= 0").replace("lat > 0", "lat >= 0").replace(
        "lon between 1 and 2", "(lon >= 1 and lon < 2)").replace("lat between 1 and 2", "(lat >= 1 and lat < 2)")
    plain = points.selectExpr(f"count_if({sq})", f"count_if({mp})", f"count_if({half_open})").first()
    assert {r["id"]: r["n"] for r in counts.collect()} == {"sq": plain[0], "mp": plain[1]}
    assert plain[2] == 225027


def test_shuffled_and_salted_join_agree_with_broadcast(spark, shapes):
    points = lattice(spark, 30000).union(
        spark.range(20000).select("id", F.lit(3.0).alias("lon"), F.lit(3.0).alias("lat"))
    )
    small = {"broadcast_bytes": 0, "hot_cell_rows": 500}
    with pytest.raises(ValueError, match="both sides"):
        points_in_polygons(points, shapes, ["id"], "lon", "lat")
    named = shapes.withColumnRenamed("id", "shape")
    a = points_in_polygons(points, named, ["shape"], "lon", "lat")
    b = points_in_polygons(points, named, ["shape"], "lon", "lat", **small)
    assert a.count() == b.count() and a.exceptAll(b).count() == 0
    c = points_per_polygon(points, named, ["shape"], "lon", "lat")
    d = points_per_polygon(points, named, ["shape"], "lon", "lat", **small)
    assert sorted(c.collect()) == sorted(d.collect())


def test_sizes_from_street_corner_to_state(spark):
    def square(x, y, half):
        return (f"POLYGON (({x-half} {y-half}, {x+half} {y-half}, {x+half} {y+half}, {x-half} {y+half}, "
                f"{x-half} {y-half}))")

    sizes = [10.0 ** -e / 3 for e in range(-1, 7)]
    named = spark.createDataFrame([(f"{s:.0e}", square(1.03, 2.07, s)) for s in sizes], "id string, geometry_wkt string")
    pts = [(1.03 + f * s, 2.07 + g * s) for s in sizes for f in (-1.01, -0.7, 0.3, 0.99) for g in (-0.99, 0.2, 1.02)]
    got = points_in_polygons(spark.createDataFrame(pts, "lon double, lat double"), named, ["id"], "lon", "lat").count()
    want = sum(abs(x - 1.03) < s and abs(y - 2.07) < s for x, y in pts for s in sizes)
    assert got == want


def test_tiling_puts_each_point_in_at_most_one_polygon(spark):
    tiles = [
        (i * 10 + j, f"POLYGON (({i} {j}, {i+1} {j}, {i+1} {j+1}, {i} {j+1}, {i} {j}))") for i in range(8) for j in range(5)
    ]
    named = spark.createDataFrame(tiles, "tile int, geometry_wkt string")
    points = lattice(spark, 20000)
    met = points_in_polygons(points, named, ["tile"], "lon", "lat")
    assert met.groupBy("id").count().where("count > 1").count() == 0
    on_lines = points.where("lon = floor(lon) or lat = floor(lat)").count()
    assert met.count() + on_lines == 20000


def test_random_star_polygons_against_brute_force(spark):
    import math
    import random

    rng = random.Random(5)

    def star(cx, cy, n, size):
        turns = sorted(rng.random() * 2 * math.pi for _ in range(n))
        pts = [(cx + size * (0.3 + rng.random()) * math.cos(t), cy + size * (0.3 + rng.random()) * math.sin(t)) for t in turns]
        return pts + pts[:1]

    stars = [star(rng.uniform(-74, -73), rng.uniform(40, 41), rng.randint(3, 60), rng.choice([0.003, 0.05, 0.4])) for _ in range(40)]
    spots = [(rng.uniform(-74.2, -72.8), rng.uniform(39.8, 41.2)) for _ in range(1500)]

    def holds(ring, x, y):
        odd = False
        for (x1, y1), (x2, y2) in zip(ring, ring[1:]):
            if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
                odd = not odd
        return odd

    wkt = [(i, "POLYGON ((" + ", ".join(f"{x!r} {y!r}" for x, y in s) + "))") for i, s in enumerate(stars)]
    polygons = spark.createDataFrame(wkt, "star int, geometry_wkt string")
    points = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(spots)], "id int, lon double, lat double")
    got = {(r["id"], r["star"]) for r in points_in_polygons(points, polygons, ["star"], "lon", "lat").collect()}
    want = {(i, j) for i, (x, y) in enumerate(spots) for j, s in enumerate(stars) if holds(s, x, y)}
    assert got == want and len(want) > 500


def test_no_polygons_no_rows(spark, shapes):
    none = shapes.where("id = 'x'").withColumnRenamed("id", "shape")
    assert points_in_polygons(lattice(spark, 10), none, ["shape"], "lon", "lat").count() == 0
    assert points_per_polygon(lattice(spark, 10), none, ["shape"], "lon", "lat").count() == 0


def test_crosswalk(spark, shapes):
    inner = spark.createDataFrame(
        [("a", "POLYGON ((2.5 2.5, 3 2.5, 3 3, 2.5 3, 2.5 2.5))"), ("b", "POLYGON ((1.2 1.2, 1.8 1.2, 1.8 1.8, 1.2 1.8, 1.2 1.2))")],
        "tract string, geometry_wkt string",
    )
    assert [tuple(r) for r in centroid_crosswalk(inner, shapes, ["tract"], ["id"]).collect()] == [("sq", "a")]


def test_projection(spark):
    df = spark.createDataFrame([(-74.0, 40 + 10 / 60), (-74.0060, 40.7128), (-73.7, 40.9)], "lon double, lat double")
    feet = df.withColumn("p", projection.lonlat_to_state_plane(F.col("lon"), F.col("lat")))
    back = feet.withColumn("q", projection.state_plane_to_lonlat(F.col("p.x"), F.col("p.y"))).collect()
    assert (back[0]["p"]["x"], back[0]["p"]["y"]) == pytest.approx((984250.0, 0.0), abs=1e-3)
    assert (back[1]["p"]["x"], back[1]["p"]["y"]) == pytest.approx((982587, 198969), abs=1)
    for r in back:
        assert (r["q"]["x"], r["q"]["y"]) == pytest.approx((r["lon"], r["lat"]), abs=1e-11)


def test_reprojection_refuses_to_guess(one):
    with pytest.raises(ValueError, match="no coordinate system"):
        geometry.wkt_to_wgs84(F.col("v"), None)
    with pytest.raises(ValueError, match="EPSG:3857"):
        geometry.wkt_to_wgs84(F.col("v"), 3857)
    assert one(lambda t: geometry.wkt_to_wgs84(t, 4326), SQ) == SQ
    moved = one(lambda t: geometry.wkt_to_wgs84(t, 2263), "POLYGON ((984250 0, 985250 0, 985250 1000, 984250 0))")
    first = moved[len("POLYGON (("):].split(",")[0].split()
    assert (float(first[0]), float(first[1])) == pytest.approx((-74.0, 40 + 10 / 60))


def test_equal_points_of_a_crowded_cell_are_spread(spark):
    from wardgrid.operators.spatial import _salted

    points = spark.range(10000).selectExpr("1D lon", "2D lat", "IF(id < 9000, 5L, id) _cell")
    strips = spark.createDataFrame([(5, "a"), (9500, "b")], "_cell long, name string")
    spread, copies = _salted(points, strips, 1000)
    counts = [r["count"] for r in spread.where("_cell = 5").groupBy("_salt").count().collect()]
    assert len(counts) == 9 and max(counts) < 1300 and spread.count() == 10000
    assert copies.groupBy("name").count().orderBy("name").collect() == [("a", 9), ("b", 1)]
    assert spread.join(copies, ["_cell", "_salt"]).count() == 9001


def test_no_polygons_match_nothing(spark):
    from wardgrid.operators.spatial import points_in_polygons

    none = spark.createDataFrame([], "zone string, geometry_wkt string")
    found = points_in_polygons(spark.createDataFrame([(1.0, 2.0)], "longitude double, latitude double"), none, ["zone"])
    assert found.columns == ["longitude", "latitude", "zone"] and found.count() == 0
