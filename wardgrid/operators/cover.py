"""Point-in-polygon join over an adaptive cover, without rounding.

A polygon is covered by cells of a tree of squares: a square with many edges is
split, one with few or none is kept. Where nothing of the boundary reaches, one
large cell says "inside" and a point in it is matched by the equi-join alone;
only points in cells along the boundary are tested, against the few edges there.
The number of cells grows with the boundary's vertices, not with their square.

What lies to the right of a cell decides the even-odd count as well, but only by
height: edges that reach the cell's row beyond its right side flip the count
between their two ends. Neighbouring edges cancel out at their common vertex, so
a cell keeps a start value and the few heights that remain.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DoubleType, IntegerType, LongType, StructField, StructType

from wardgrid.functions.clean import computed_once, valid_sql
from wardgrid.functions.geometry import ON_EDGE, bound, edge_state, parse_rings, polygon_edges
from wardgrid.functions.orientation import PLAIN_ERROR
from wardgrid.operators.spatial import BROADCAST_BYTES, HOT_CELL_ROWS, _cell_sql, _salted
from wardgrid.session import shared_folder

# cells are 2 ** (FINEST + STEP * level) degrees wide, so that one is dealt to 16 of the level below
FINEST, STEP, LEVELS = -18, 2, 16
EDGES_PER_CELL = 8

ENDS = ["_x1", "_y1", "_x2", "_y2"]
BOX = ["_west", "_east", "_south", "_north"]
NUMBERS = ArrayType(DoubleType(), containsNull=False)
CELL = [
    StructField("_level", IntegerType()),
    StructField("_cx", LongType()),
    StructField("_cy", LongType()),
    StructField("_within", BooleanType()),
    StructField("_flips", NUMBERS),
    *[StructField(name, NUMBERS) for name in ENDS],
    *[StructField(name, DoubleType()) for name in BOX],
]
TEST = ["_within", "_flips", "_edges", *BOX]
CELLS_PER_BATCH = 4096


def _beside(edges: np.ndarray, left: float, low: float, size: float) -> tuple[np.ndarray, np.ndarray]:
    """Which edges may reach the closed square, and which pass it on the right.

    An edge counts as reaching it unless all corners are on one side of it by more than rounding.
    """
    x1, y1, x2, y2 = edges
    right, high = left + size, low + size
    abreast = (np.maximum(y1, y2) >= low) & (np.minimum(y1, y2) <= high)
    beyond = np.minimum(x1, x2) > right
    near = abreast & ~beyond & (np.maximum(x1, x2) >= left)
    above, below = np.ones(len(x1), bool), np.ones(len(x1), bool)
    for x, y in ((left, low), (right, low), (left, high), (right, high)):
        one, other = (x2 - x1) * (y - y1), (y2 - y1) * (x - x1)
        doubt = PLAIN_ERROR * (np.abs(one) + np.abs(other))
        above &= one - other > doubt
        below &= one - other < -doubt
    reaching = near & ~above & ~below
    # the square lies to the left of an edge that goes up
    passed = near & np.where(y2 > y1, above, below)
    return reaching, (abreast & beyond) | passed


def _tree(edges: np.ndarray, most: int) -> Iterator[tuple]:
    """The cells of one polygon: level, column, row, start value, heights of flips, edges."""
    if not edges.shape[1]:
        return
    xs, ys = edges[[0, 2]], edges[[1, 3]]
    extent = max(xs.max() - xs.min(), ys.max() - ys.min(), 2.0**FINEST)
    level = int(min(LEVELS - 1, max(0, np.ceil((np.log2(extent) - FINEST) / STEP))))
    size = 2.0 ** (FINEST + STEP * level)
    columns = range(int(np.floor(xs.min() / size)), int(np.floor(xs.max() / size)) + 1)
    rows = range(int(np.floor(ys.min() / size)), int(np.floor(ys.max() / size)) + 1)
    open_cells = [(level, cx, cy, edges, False, np.empty(0)) for cx in columns for cy in rows]
    while open_cells:
        level, cx, cy, held, within, flips = open_cells.pop()
        size = 2.0 ** (FINEST + STEP * level)
        low = cy * size
        reaching, passing = _beside(held, cx * size, low, size)
        ends = held[:, passing]
        heights = np.concatenate([flips, ends[1], ends[3]])
        within ^= bool((heights <= low).sum() % 2)
        values, times = np.unique(heights[(heights > low) & (heights < low + size)], return_counts=True)
        flips, held = values[times % 2 == 1], held[:, reaching]
        if not held.shape[1] and not len(flips):
            if within:
                yield level, cx, cy, True, flips, held
        elif held.shape[1] > most and level:
            parts = 1 << STEP
            open_cells += [
                (level - 1, cx * parts + i, cy * parts + j, held, within, flips) for i in range(parts) for j in range(parts)
            ]
        else:
            yield level, cx, cy, within, flips, held


def _box(edges: np.ndarray) -> tuple[float, float, float, float]:
    """Outside of these bounds no point is inside or on the boundary. To the west of rings that
    lack an edge the even-odd count may be odd, so they have no bound there."""
    if not edges.shape[1]:
        return -np.inf, np.inf, -np.inf, np.inf
    xs, ys = edges[[0, 2]], edges[[1, 3]]
    closed = not (np.unique(ys, return_counts=True)[1] % 2).any()
    return xs.min() if closed else -np.inf, xs.max(), ys.min(), ys.max()


def cut_cells(batches: Iterable[pd.DataFrame], keep: Sequence[str], most: int) -> Iterator[pd.DataFrame]:
    """The cells of polygons beside their `keep` columns, those of many polygons in one frame."""
    names = [f.name for f in CELL]
    for batch in batches:
        kept, corners = batch[list(keep)], [batch[name].to_numpy() for name in ENDS]
        rows, cells = [], []
        for at in range(len(batch)):
            ends = np.array([np.asarray(column[at], dtype=float) for column in corners]).reshape(4, -1)
            ends = ends[:, np.isfinite(ends).all(axis=0)]
            box = _box(ends)
            for cell in _tree(ends, most):
                rows.append(at)
                cells.append((*cell[:5], *cell[5], *box))
                if len(cells) == CELLS_PER_BATCH:
                    yield kept.iloc[rows].reset_index(drop=True).join(pd.DataFrame(cells, columns=names))
                    rows, cells = [], []
        if cells:
            yield kept.iloc[rows].reset_index(drop=True).join(pd.DataFrame(cells, columns=names))


def cover(polygons: DataFrame, keep: Sequence[str], wkt: str = "geometry_wkt", most: int = EDGES_PER_CELL) -> DataFrame:
    """One row per polygon and cell: `keep`, `_level`, `_cell`, and what tells the inside there.

    `_edges` is NULL for a cell that lies inside as a whole. Coordinates are degrees. Edges
    without a finite place are left out; a text that is no polygon has no cells. A cell keeps
    more than `most` edges only where that many meet within the finest size.
    """
    kinds = polygons.select(*keep).schema.fields
    # parsing and cutting cost time rather than bytes: spread the polygons evenly, whatever their keys
    spread = polygons.select(*keep, wkt).repartition(polygons.sparkSession.sparkContext.defaultParallelism)
    edges = computed_once(spread, _edges=polygon_edges(parse_rings(F.col(wkt))))
    flat = edges.where("_edges IS NOT NULL").select(
        *keep, *[F.expr(f"transform(_edges, e -> coalesce(e.{name[1:]}, double('nan')))").alias(name) for name in ENDS]
    )
    cells = flat.mapInPandas(lambda batches: cut_cells(batches, keep, most), StructType([*kinds, *CELL]))
    whole = F.size("_x1") + F.size("_flips") == 0
    zipped = F.expr("transform(_x1, (v, i) -> named_struct('x1', v, 'y1', get(_y1, i), 'x2', get(_x2, i), 'y2', get(_y2, i)))")
    return cells.select(
        *keep, "_level", F.expr(_cell_sql("_level", "_cx", "_cy")).alias("_cell"), "_within",
        F.when(~whole, F.col("_flips")).alias("_flips"), F.when(~whole, zipped).alias("_edges"), *BOX,
    )


def _fixed(polygons: DataFrame, wkt: str, keep: Sequence[str], most: int) -> tuple[DataFrame, list[int], int]:
    """The cover, checkpointed, its levels in use and its bytes in memory."""
    context = polygons.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(shared_folder(polygons.sparkSession, "checkpoints"))
    cells = cover(polygons, keep, wkt, most).checkpoint()
    texts = sum((F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in keep), F.lit(0))
    # four ends and a struct for each edge; a hash table holds as much again
    arrays = 56 * F.coalesce(F.size("_edges"), F.lit(0)) + 8 * F.coalesce(F.size("_flips"), F.lit(0))
    sizes = cells.groupBy("_level").agg(F.sum(2 * (160 + arrays + texts)).alias("bytes")).collect()
    return cells, sorted(row["_level"] for row in sizes), sum(row["bytes"] for row in sizes)


def _contains(lon: str, lat: str, boundary: bool) -> Column:
    x, y = F.col(lon).cast("double"), F.col(lat).cast("double")
    flipped = F.size(F.filter("_flips", lambda height: height <= y)) + F.col("_within").cast("int")
    score = F.aggregate("_edges", flipped, lambda n, e: n + edge_state(e, x, y))

    def tell(found: Column) -> Column:
        clear = (found % 2 == 1) & (found < ON_EDGE)
        return clear | (found >= ON_EDGE) if boundary else clear

    # one reference to the score: Spark computes what a condition holds twice before any part of it
    tested = bound(score, tell)
    # plain comparisons first: most polygons that share a cell with a point lie beside it
    near = x.between(F.col("_west"), F.col("_east")) & y.between(F.col("_south"), F.col("_north"))
    return near & (F.col("_edges").isNull() | tested)


def points_in_cover(points: DataFrame, polygons: DataFrame, keep: Sequence[str], lon: str = "longitude", lat: str = "latitude",
                    wkt: str = "geometry_wkt", boundary: bool = False, broadcast_bytes: int = BROADCAST_BYTES,
                    hot_cell_rows: int = HOT_CELL_ROWS, most: int = EDGES_PER_CELL) -> DataFrame:
    """Inner join: the points' columns and the polygons' `keep` columns, exact on slanted edges.

    A point on the boundary matches only with `boundary`, there every polygon it touches.
    Points with a missing or impossible pair match nothing. The cover is broadcast up to
    a measured size; beyond it both sides shuffle on the cell and crowded cells are salted.
    """
    clash = set(points.columns) & set(keep)
    if clash:
        raise ValueError(f"columns on both sides: {sorted(clash)}")
    cells, levels, size = _fixed(polygons, wkt, keep, most)
    if not levels:
        kinds = dict(polygons.dtypes)
        return points.select("*", *[F.lit(None).cast(kinds[c]).alias(c) for c in keep]).limit(0)

    def key(level: int) -> str:
        width = 2.0 ** (FINEST + STEP * level)
        return _cell_sql(str(level), f"floor({lon} / {width!r}D)", f"floor({lat} / {width!r}D)")

    keys = ", ".join(key(level) for level in levels)
    placed = points.selectExpr("*", f"explode(CASE WHEN {valid_sql(lat, lon)} THEN array({keys}) END) AS _cell")
    on, cells = ["_cell"], cells.drop("_level")
    if size <= broadcast_bytes:
        cells = F.broadcast(cells)
    else:
        placed, cells = _salted(placed, cells, hot_cell_rows)
        on = ["_cell", "_salt"]
    return placed.join(cells, on).where(_contains(lon, lat, boundary)).drop(*on, *TEST)
