"""Point-in-polygon join, counts per polygon and centroid crosswalks.

A join on "polygon contains point" alone has no equality Spark could hash on
and would compare every point with every polygon. Here each polygon becomes a
set of strips, and points meet strips through an equi-join on a grid cell:

* Between two neighbouring vertex heights the edges of a polygon do not meet (if
  those of a faulty ring do, the strip is cut there). So the inside is a row of
  pieces, each bounded by one edge on the left and one on the right. Containment
  in a piece is four comparisons on plain columns, which Spark compiles into the
  join; no array is walked per point.
* A polygon picks the grid whose cells are between an eighth of its extent and
  its full extent, whatever its size. Few grids are in use (ten at most); a
  point gets one cell per grid in use.
* Each (point, polygon) pair meets in exactly one piece, so nothing is
  deduplicated afterwards. Points on the boundary are outside.

The strips are broadcast only after their size has been measured. Beyond the
limit both sides are shuffled on the cell, and crowded cells are salted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardgrid.functions.clean import computed_once, valid_sql
from wardgrid.functions.geometry import parse_rings, polygon_box, polygon_edges, polygon_moments
from wardgrid.session import shared_folder

LEVELS = 10
FINEST_EXPONENT = -18
CELLS_ACROSS = 8

BROADCAST_BYTES = 256 << 20

HOT_CELL_ROWS = 2_000_000

STRIP = ["_low", "_high", "_closed", "_lx", "_ly", "_lk", "_rx", "_ry", "_rk"]


def _cell_sql(level: str, cx: str, cy: str) -> str:
    """Level and both indexes in one BIGINT: a join key that needs no further test."""
    return f"(shiftleft({cx} * 16 + {level}, 32) | ({cy} & 4294967295))"


def _x_at(line: str, y: str) -> str:
    """Where an edge is at a height; its end points come out exactly."""
    return (
        f"CASE WHEN {y} = {line}.ya THEN {line}.xa WHEN {y} = {line}.yb THEN {line}.xb "
        f"ELSE {line}.xa + ({y} - {line}.ya) * {line}.k END"
    )


def _pairs(sorted_lines: str, l: str, r: str) -> str:  # noqa: E741
    """Neighbours two by two: the inside lies between an odd edge and the next.
    `l` and `r` say what to keep of an edge `e`."""
    left, right = (f"get({sorted_lines}, 2 * i{step}).line" for step in ("", " + 1"))
    return (
        f"CASE WHEN size({sorted_lines}) > 1 THEN transform(sequence(0, size({sorted_lines}) div 2 - 1), "
        f"i -> named_struct('l', {l.format(e=left)}, 'r', {r.format(e=right)})) END"
    )


def _steps(heights: str) -> str:
    """Neighbouring heights as `_low` and `_high`; NULL for fewer than two."""
    return (
        f"CASE WHEN size({heights}) > 1 THEN transform(sequence(0, size({heights}) - 2), "
        f"j -> named_struct('_low', get({heights}, j), '_high', get({heights}, j + 1))) END"
    )


def _bands(polygons: DataFrame, wkt: str, keep: Sequence[str]) -> DataFrame:
    """One row per polygon and grid row, with the sloped edges that reach into it."""
    # cutting costs time rather than bytes: spread the polygons evenly, whatever their keys
    spread = polygons.select(*keep, wkt).repartition(polygons.sparkSession.sparkContext.defaultParallelism)
    parsed = spread.select(*keep, parse_rings(F.col(wkt)).alias("_rings")).select(
        *keep, polygon_edges(F.col("_rings")).alias("_edges"), polygon_box(F.col("_rings")).alias("_box")
    )
    extent = "greatest(_box.xmax - _box.xmin, _box.ymax - _box.ymin, 1E-12)"
    level = f"CAST(ceil((log2({extent} / {CELLS_ACROSS}) - ({FINEST_EXPONENT})) / 3) AS INT)"
    upward = """transform(filter(_edges, e -> e.y1 <> e.y2), e -> named_struct(
        'xa', CASE WHEN e.y1 < e.y2 THEN e.x1 ELSE e.x2 END, 'ya', least(e.y1, e.y2),
        'xb', CASE WHEN e.y1 < e.y2 THEN e.x2 ELSE e.x1 END, 'yb', greatest(e.y1, e.y2),
        'k', (e.x2 - e.x1) / (e.y2 - e.y1)))"""
    leveled = parsed.selectExpr(
        *keep, "_box", f"{upward} AS _lines", f"greatest(0, least({LEVELS - 1}, {level})) AS _level"
    ).selectExpr("*", f"pow(2D, _level * 3 + ({FINEST_EXPONENT})) AS _size")
    rows = leveled.selectExpr(
        *keep, "_level", "_size", "_lines",
        "explode(sequence(floor(_box.ymin / _size), floor(_box.ymax / _size))) AS _cy",
    )
    return rows.selectExpr(
        *keep, "_level", "_size", "_cy",
        "filter(_lines, v -> v.ya < (_cy + 1) * _size AND v.yb >= _cy * _size) AS _lines",
    )


def polygon_strips(polygons: DataFrame, wkt: str, keep: Sequence[str]) -> DataFrame:
    """One row per (polygon, cell, piece): `keep`, `_level`, `_cell` and `STRIP`.

    A point is in a piece if it lies between the two edge lines and its height is
    above `_low` and below `_high`, or equal to `_low` where the piece is closed.
    """
    base = [*keep, "_level", "_size", "_cy"]
    bands = _bands(polygons, wkt, keep).selectExpr(
        *base, "_lines",
        """array_sort(array_distinct(transform(concat(transform(_lines, v -> v.ya), transform(_lines, v -> v.yb)),
           y -> greatest(_cy * _size, least((_cy + 1) * _size, y))))) AS _heights""",
    )
    strips = bands.selectExpr(*base, "_lines", f"inline({_steps('_heights')})")

    # rings that cross themselves: cut the strip where two of its edges change places
    through = strips.selectExpr(
        *base, "_lines", "_low", "_high",
        f"""transform(filter(_lines, v -> v.ya <= _low AND v.yb >= _high), v -> named_struct(
            'x0', {_x_at('v', '_low')}, 'x9', {_x_at('v', '_high')}, 'line', v)) AS _through""",
    )
    cuts = through.selectExpr(
        *base, "_lines", "_through",
        """array_sort(array_distinct(concat(array(_low, _high), filter(
             flatten(transform(_through, a -> transform(
               filter(_through, b -> a.x0 < b.x0 AND a.x9 > b.x9),
               b -> _low + (_high - _low) * ((b.x0 - a.x0) / ((b.x0 - a.x0) + (a.x9 - b.x9)))))),
             y -> y > _low AND y < _high)))) AS _cuts""",
    )
    strips = cuts.selectExpr(*base, "_lines", "_through", f"inline({_steps('_cuts')})")

    # edges through the strip, and edges that reach its lower border from below
    sides = strips.selectExpr(
        *base, "_low", "_high",
        f"""array_sort(transform(_through, t -> named_struct(
            'x', {_x_at('t.line', '((_low + _high) / 2)')}, 'line', t.line))) AS _across""",
        f"""array_sort(transform(filter(_lines, v -> v.ya < _low AND v.yb >= _low), v -> named_struct(
            'x', {_x_at('v', '_low')}, 'turn', -v.k, 'line', v))) AS _under""",
    )
    at_low = "CASE WHEN _low = {e}.ya THEN {e}.xa WHEN _low = {e}.yb THEN {e}.xb ELSE {e}.xa + (_low - {e}.ya) * {e}.k END"
    pieces = sides.selectExpr(
        *base, "_low", "_high",
        f"{_pairs('_under', at_low, at_low)} AS _under",
        f"inline({_pairs('_across', '{e}', '{e}')})",
    )
    edged = pieces.selectExpr("*", f"{_x_at('l', '_low')} AS _start", f"{_x_at('r', '_low')} AS _end").selectExpr(
        "*",
        # nothing of the boundary lies on the lower border of a closed piece
        "coalesce(exists(_under, u -> u.l <= _start AND u.r >= _end), false) AS _closed",
    )

    def piece(*values: str) -> str:
        return "named_struct(" + ", ".join(f"'{n}', {v}" for n, v in zip([*STRIP, "_x0", "_x9"], values)) + ")"

    whole = piece(
        "_low", "_high", "_closed", "l.xa", "l.ya", "l.k", "r.xa", "r.ya", "r.k",
        f"least(_start, {_x_at('l', '_high')})", f"greatest(_end, {_x_at('r', '_high')})",
    )
    # what is inside on an open lower border: inside above and below it
    on_border = """filter(transform(_under, u -> named_struct('l', greatest(u.l, _start), 'r', least(u.r, _end))),
        u -> u.l < u.r)"""
    border = piece("_low", "_low", "true", "u.l", "_low", "0D", "u.r", "_low", "0D", "u.l", "u.r")
    borders = f"CASE WHEN _closed OR _under IS NULL THEN filter(array({whole}), p -> false) ELSE transform({on_border}, u -> {border}) END"
    placed = edged.selectExpr(*base, f"inline(concat(array({whole}), {borders}))")
    cells = placed.selectExpr(
        *keep, "_level", "_cy", *STRIP, "explode(sequence(floor(_x0 / _size), floor(_x9 / _size))) AS _cx"
    )
    return cells.selectExpr(*keep, "_level", f"{_cell_sql('_level', '_cx', '_cy')} AS _cell", *STRIP)


def _with_cells(points: DataFrame, lon: str, lat: str, levels: Sequence[int]) -> DataFrame:
    """One row per grid in use; points without a valid place drop out here.

    The explode also keeps the optimizer from copying the coordinates' casts
    into a null check on the key.
    """

    def key(level: int) -> str:
        size = 2.0 ** (3 * level + FINEST_EXPONENT)
        return _cell_sql(str(level), f"floor({lon} / {size!r}D)", f"floor({lat} / {size!r}D)")

    keys = ", ".join(key(level) for level in levels)
    return points.selectExpr("*", f"explode(CASE WHEN {valid_sql(lat, lon)} THEN array({keys}) END) AS _cell")


def _salted(points: DataFrame, strips: DataFrame, hot_cell_rows: int) -> tuple[DataFrame, DataFrame]:
    """Spread the points of crowded cells over several tasks, each with a copy of the
    cell's pieces: as many copies as the cell has `hot_cell_rows` points.

    Salts number the rows of a task, so equal points get different ones. Crowded
    cells are a table that Spark joins by its own size check; there are at most as
    many as there are points by `hot_cell_rows`.
    """
    numbered = points.withColumn("_row", F.monotonically_increasing_id())
    crowded = points.groupBy("_cell").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > hot_cell_rows)
    copies = crowded.select("_cell", F.ceil(F.col("n") / hot_cell_rows).alias("_copies"))
    copies_or_one = F.coalesce("_copies", F.lit(1))
    spread = F.pmod(F.xxhash64("_row"), copies_or_one).cast("int")
    return (
        numbered.join(copies, "_cell", "left").withColumn("_salt", spread).drop("_copies", "_row"),
        strips.join(copies, "_cell", "left")
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), (copies_or_one - 1).cast("int"))))
        .drop("_copies"),
    )


def _fixed_strips(polygons: DataFrame, wkt: str, keep: Sequence[str]) -> tuple[DataFrame, list[int], int]:
    """The strips, the grid levels in use and their bytes as rows in memory.

    Checkpointed, so that they are built once and what was measured is what is joined.
    """
    context = polygons.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(shared_folder(polygons.sparkSession, "checkpoints"))
    strips = polygon_strips(polygons, wkt, keep).checkpoint()
    # eight bytes a column, a header, and the texts; a hash table holds as much again
    texts = sum((F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in keep), F.lit(0))
    fixed = 2 * (8 * len(strips.columns) + 32)
    sizes = strips.groupBy("_level").agg(F.sum(fixed + 2 * texts).alias("bytes")).collect()
    return strips, sorted(row["_level"] for row in sizes), sum(row["bytes"] for row in sizes)


def _meet(points: DataFrame, strips: DataFrame, on: list[str], lon: str, lat: str) -> DataFrame:
    inside = (
        f"(({lat} > _low AND {lat} < _high) OR (_closed AND {lat} = _low)) "
        f"AND {lon} > _lx + ({lat} - _ly) * _lk AND {lon} < _rx + ({lat} - _ry) * _rk"
    )
    return points.join(strips.drop("_level"), on).where(inside).drop(*on, *STRIP)


def points_in_polygons(
    points: DataFrame,
    polygons: DataFrame,
    keep: Sequence[str],
    lon: str = "longitude",
    lat: str = "latitude",
    wkt: str = "geometry_wkt",
    broadcast_bytes: int = BROADCAST_BYTES,
    hot_cell_rows: int = HOT_CELL_ROWS,
) -> DataFrame:
    """Inner join: the points' columns and the polygons' `keep` columns.

    Coordinates are degrees; points with a missing or impossible pair match
    nothing, and a point on an edge is outside. `keep` travels with every piece
    of a polygon, so it should be a key; join wide attributes afterwards.
    """
    clash = set(points.columns) & set(keep)
    if clash:
        raise ValueError(f"columns on both sides: {sorted(clash)}")
    strips, levels, size = _fixed_strips(polygons, wkt, keep)
    if not levels:
        kinds = dict(polygons.dtypes)
        return points.select("*", *[F.lit(None).cast(kinds[c]).alias(c) for c in keep]).limit(0)
    placed = _with_cells(points, lon, lat, levels)
    if size <= broadcast_bytes:
        return _meet(placed, F.broadcast(strips), ["_cell"], lon, lat)
    placed, strips = _salted(placed, strips, hot_cell_rows)
    return _meet(placed, strips, ["_cell", "_salt"], lon, lat)


def points_per_polygon(
    points: DataFrame,
    polygons: DataFrame,
    keep: Sequence[str],
    lon: str = "longitude",
    lat: str = "latitude",
    wkt: str = "geometry_wkt",
    broadcast_bytes: int = BROADCAST_BYTES,
    hot_cell_rows: int = HOT_CELL_ROWS,
    count: str = "n",
) -> DataFrame:
    """`keep` and the number of points inside; polygons without a point are left out.

    With broadcast strips the points are never shuffled, only partial counts.
    Beyond the limit equal coordinates are counted first, so a place that holds
    a third of all points is one row by the time it reaches the join.
    """
    strips, levels, size = _fixed_strips(polygons, wkt, keep)
    if not levels:
        return polygons.select(*keep).where(F.lit(False)).withColumn(count, F.lit(0).cast("bigint"))
    places = points.select(F.col(lon).alias("_x"), F.col(lat).alias("_y"))
    if size <= broadcast_bytes:
        met = _meet(_with_cells(places, "_x", "_y", levels), F.broadcast(strips), ["_cell"], "_x", "_y")
        return met.groupBy(*keep).agg(F.count(F.lit(1)).alias(count))
    places = places.groupBy("_x", "_y").agg(F.count(F.lit(1)).alias("_n"))
    placed, strips = _salted(_with_cells(places, "_x", "_y", levels), strips, hot_cell_rows)
    met = _meet(placed, strips, ["_cell", "_salt"], "_x", "_y")
    return met.groupBy(*keep).agg(F.sum("_n").alias(count))


def centroids(polygons: DataFrame, wkt: str = "geometry_wkt", lon: str = "centroid_lon",
              lat: str = "centroid_lat") -> DataFrame:
    """The polygons' columns without the text, and their centroid columns."""
    measured = computed_once(polygons, _moments=polygon_moments(parse_rings(F.col(wkt))))
    return measured.select(
        *[c for c in polygons.columns if c != wkt],
        F.col("_moments.cx").alias(lon),
        F.col("_moments.cy").alias(lat),
    )


def centroid_crosswalk(inner: DataFrame, outer: DataFrame, inner_keep: Sequence[str], outer_keep: Sequence[str],
                       wkt: str = "geometry_wkt", **options) -> DataFrame:
    """Pairs where an `outer` polygon contains the centroid of an `inner` one."""
    spots = centroids(inner.select(*inner_keep, wkt), wkt)
    return points_in_polygons(
        spots, outer, outer_keep, lon="centroid_lon", lat="centroid_lat", wkt=wkt, **options
    ).select(*outer_keep, *inner_keep)
