"""Polygons as WKT text: parse, measure, build, reproject.

A parsed polygon is `array<struct<hole:boolean, pts:array<struct<x,y>>>>`, one
entry per ring. Under the even-odd rule the rings of a POLYGON or MULTIPOLYGON
can be pooled, so containment needs only the edges.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from wardgrid.functions.clean import record
from wardgrid.functions.orientation import turn
from wardgrid.functions.projection import state_plane_to_lonlat

PART_BREAK = r"\)\s*\)\s*,\s*\(\s*\("
RING_BODY = r"[-+.0-9][^()]*"
POLYGON_TEXT = r"(?i)^\s*(multi)?polygon\b"


def bound(value: Column, build: Callable[[Column], Column]) -> Column:
    """`build(value)` with `value` evaluated once, however often `build` refers to it."""
    return F.transform(F.array(value), build)[0]


def _vertex(text: Column) -> Column:
    numbers = F.split(F.trim(text), r"\s+")
    return bound(numbers, lambda n: record(x=F.get(n, F.lit(0)).try_cast("double"), y=F.get(n, F.lit(1)).try_cast("double")))


def parse_rings(wkt: Column) -> Column:
    """Rings of a POLYGON or MULTIPOLYGON text; NULL for other text.

    Within a part the first ring is the outer one and the rest are holes.
    """
    parts = F.split(wkt, PART_BREAK)
    rings = F.flatten(
        F.transform(
            parts,
            lambda part: F.transform(
                F.regexp_extract_all(part, F.lit(RING_BODY), F.lit(0)),
                lambda body, i: record(hole=i > 0, pts=F.transform(F.split(body, ","), _vertex)),
            ),
        )
    )
    return F.when(wkt.rlike(POLYGON_TEXT), rings)


def ring_edges(pts: Column) -> Column:
    """Consecutive vertex pairs as `struct<x1,y1,x2,y2>`."""
    ahead = F.slice(pts, F.lit(2), F.greatest(F.size(pts) - 1, F.lit(0)))
    paired = F.zip_with(
        pts,
        ahead,
        lambda a, b: record(x1=a["x"], y1=a["y"], x2=b["x"], y2=b["y"]),
    )
    return F.slice(paired, F.lit(1), F.greatest(F.size(pts) - 1, F.lit(0)))


def polygon_edges(rings: Column) -> Column:
    """The edges of all rings in one array."""
    return F.flatten(F.transform(rings, lambda ring: ring_edges(ring["pts"])))


def polygon_box(rings: Column) -> Column:
    """`struct<xmin,ymin,xmax,ymax>`."""
    xs = F.flatten(F.transform(rings, lambda ring: ring["pts"]["x"]))
    ys = F.flatten(F.transform(rings, lambda ring: ring["pts"]["y"]))
    return record(xmin=F.array_min(xs), ymin=F.array_min(ys), xmax=F.array_max(xs), ymax=F.array_max(ys))


def polygon_moments(rings: Column) -> Column:
    """`struct<area,cx,cy>`: planar area and centroid, holes subtracted.

    Sums run on offsets from the first vertex, so that coordinates far from
    zero keep their precision. A polygon without area has no centroid.
    """
    return bound(rings, _moments)


def _moments(rings: Column) -> Column:
    origin = rings[0]["pts"][0]
    zero = record(a=F.lit(0.0), mx=F.lit(0.0), my=F.lit(0.0))

    def add(acc: Column, e: Column) -> Column:
        x1, y1 = e["x1"] - origin["x"], e["y1"] - origin["y"]
        x2, y2 = e["x2"] - origin["x"], e["y2"] - origin["y"]
        cross = x1 * y2 - x2 * y1
        return record(
            a=acc["a"] + cross / 2, mx=acc["mx"] + (x1 + x2) * cross / 6, my=acc["my"] + (y1 + y2) * cross / 6
        )

    def ring_sums(ring: Column) -> Column:
        return record(hole=ring["hole"], s=F.aggregate(ring_edges(ring["pts"]), zero, add))

    def fold(acc: Column, ring: Column) -> Column:
        side = F.when(ring["s"]["a"] < 0, F.lit(-1.0)).otherwise(F.lit(1.0))
        weight = F.when(ring["hole"], -side).otherwise(side)
        return record(**{part: acc[part] + weight * ring["s"][part] for part in ("a", "mx", "my")})

    def finish(acc: Column) -> Column:
        total = F.nullif(acc["a"], F.lit(0.0))
        return record(area=acc["a"], cx=origin["x"] + acc["mx"] / total, cy=origin["y"] + acc["my"] / total)

    return F.aggregate(F.transform(rings, ring_sums), zero, fold, finish)


def area(wkt: Column) -> Column:
    """Planar area in the square of the coordinates' unit."""
    return polygon_moments(parse_rings(wkt))["area"]


def centroid(wkt: Column) -> Column:
    """`struct<area,cx,cy>`; use `cx` and `cy`."""
    return polygon_moments(parse_rings(wkt))


def edge_state(edge: Column, px: Column, py: Column) -> Column:
    """1 where a ray from the point to +x crosses the edge, a large number where
    the point lies on it, 0 otherwise. Free of rounding."""
    x1, y1, x2, y2 = edge["x1"], edge["y1"], edge["x2"], edge["y2"]
    apart = (py < F.least(y1, y2)) | (py > F.greatest(y1, y2)) | (px > F.greatest(x1, x2))
    ahead = (px < F.least(x1, x2)) & ((y1 > py) != (y2 > py))

    def near(side: Column) -> Column:
        touching = (side == 0) & (px >= F.least(x1, x2))
        # the point is left of an edge going up where the turn is positive
        crossing = ((y1 > py) != (y2 > py)) & ((side > 0) == (y2 > y1)) & (side != 0)
        return F.when(touching, F.lit(ON_EDGE)).when(crossing, F.lit(1)).otherwise(F.lit(0))

    return F.when(apart, F.lit(0)).when(ahead, F.lit(1)).otherwise(bound(turn(x1, y1, x2, y2, px, py), near))


# larger than any crossing count, small enough to be added a few thousand times
ON_EDGE = 1 << 20


def inside(edges: Column, px: Column, py: Column, boundary: bool = False) -> Column:
    """Even-odd containment; points on the boundary count only with `boundary`.

    For filters on one polygon. To match two tables use
    `wardgrid.operators.spatial.points_in_polygons`.
    """
    score = F.aggregate(edges, F.lit(0), lambda n, e: n + edge_state(e, px, py))
    if boundary:
        return (score % 2 == 1) | (score >= ON_EDGE)
    return (score % 2 == 1) & (score < ON_EDGE)


def ring_text(pts: Column) -> Column:
    inner = F.array_join(
        F.transform(pts, lambda p: F.concat_ws(" ", p["x"].cast("string"), p["y"].cast("string"))), ", "
    )
    return F.concat(F.lit("("), inner, F.lit(")"))


def wkt_from_rings(rings: Column) -> Column:
    """POLYGON text for one part, MULTIPOLYGON text for several."""
    texts = F.transform(
        rings, lambda ring: F.concat(F.when(ring["hole"], F.lit(", ")).otherwise(F.lit("|")), ring_text(ring["pts"]))
    )
    # outer rings start a part, holes continue it
    parts = F.split(F.substring(F.array_join(texts, ""), 2, 1 << 30), r"\|")

    def join(bodies: Column) -> Column:
        return F.when(F.size(bodies) == 1, F.concat(F.lit("POLYGON "), bodies[0])).otherwise(
            F.concat(F.lit("MULTIPOLYGON ("), F.array_join(bodies, ", "), F.lit(")"))
        )

    return bound(F.transform(parts, lambda part: F.concat(F.lit("("), part, F.lit(")"))), join)


def map_vertices(rings: Column, move) -> Column:
    """The same rings with each vertex replaced by `move(x, y)`, a `struct<x,y>`."""
    return F.transform(
        rings,
        lambda ring: record(hole=ring["hole"], pts=F.transform(ring["pts"], lambda p: move(p["x"], p["y"]))),
    )


def wkt_to_wgs84(wkt: Column, epsg: int | None) -> Column:
    """WKT in degrees. Without a coordinate system the text is refused, not guessed."""
    if epsg is None:
        raise ValueError("the source names no coordinate system")
    if epsg == 4326:
        return wkt
    if epsg != 2263:
        raise ValueError(f"no projection for EPSG:{epsg}; known are 2263 and 4326")
    return wkt_from_rings(map_vertices(parse_rings(wkt), state_plane_to_lonlat))
