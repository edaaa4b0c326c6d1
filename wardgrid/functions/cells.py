"""Hexagonal cell keys at several resolutions.

The default keys come from a planar, pointy-top hexagon grid on (lon, lat):
plain arithmetic that stays in generated code. Edge lengths shrink by the
square root of 7 per resolution, so a cell has about seven children. Their ids
are not H3 ids, hence the column prefix `hex`.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardgrid.functions.clean import computed_once, record, valid_sql
from wardgrid.schemas import RESOLUTIONS

# Fixed value: hexagon edge at resolution 0, in degrees.
EDGE_AT_ZERO = 10.0


def edge_length(resolution: int) -> float:
    return EDGE_AT_ZERO / math.pow(7.0, resolution / 2.0)


def _rounded(lon: str, lat: str, resolution: int) -> dict[str, Column]:
    """The three rounded cube coordinates and how far each was moved."""
    edge = edge_length(resolution)
    fq = f"({math.sqrt(3.0) / 3.0 / edge!r}D * {lon} - {1.0 / 3.0 / edge!r}D * {lat})"
    fr = f"({2.0 / 3.0 / edge!r}D * {lat})"
    fs = f"(-{fq} - {fr})"
    # floor(v + 0.5) rounds inside generated code, round() would go through BigDecimal
    axes = {"q": fq, "r": fr, "s": fs}
    return {f"{n}{resolution}": F.expr(f"floor({v} + 0.5D)") for n, v in axes.items()} | {
        f"d{n}{resolution}": F.expr(f"abs(floor({v} + 0.5D) - {v})") for n, v in axes.items()
    }


def _axial_sql(resolution: int) -> tuple[str, str]:
    """The coordinate that was moved most follows from the other two."""
    q, r, s, dq, dr, ds = (f"_hex.{n}{resolution}" for n in ("q", "r", "s", "dq", "dr", "ds"))
    return (
        f"CASE WHEN {dq} > {dr} AND {dq} > {ds} THEN -{r} - {s} ELSE {q} END",
        f"CASE WHEN NOT ({dq} > {dr} AND {dq} > {ds}) AND {dr} > {ds} THEN -{q} - {s} ELSE {r} END",
    )


def _with_rounded(df: DataFrame, lon: str, lat: str, resolutions: Sequence[int]) -> DataFrame:
    parts: dict[str, Column] = {}
    for resolution in resolutions:
        parts |= _rounded(lon, lat, resolution)
    return computed_once(df, _hex=record(**parts))


def with_hex_axial(df: DataFrame, lon: str, lat: str, resolution: int, name: str) -> DataFrame:
    """Add `struct<q,r>` of the hexagon that holds the point, by cube rounding."""
    q, r = _axial_sql(resolution)
    rounded = _with_rounded(df, lon, lat, [resolution])
    return rounded.withColumn(name, F.expr(f"named_struct('q', {q}, 'r', {r})")).drop("_hex")


def hex_center(q: Column, r: Column, resolution: int) -> tuple[Column, Column]:
    """(lon, lat) of a hexagon's centre."""
    edge = edge_length(resolution)
    return F.lit(edge * math.sqrt(3.0)) * (q + r / F.lit(2.0)), F.lit(edge * 1.5) * r


def _with_hex_cells(df: DataFrame, lon: str, lat: str, resolutions: Sequence[int]) -> DataFrame:
    """Add the keys `resolution:q:r`; NULL unless the point is valid."""
    keys = {}
    for resolution in resolutions:
        q, r = _axial_sql(resolution)
        keys[f"hex_r{resolution}"] = F.expr(
            f"CASE WHEN {valid_sql(lat, lon)} THEN concat_ws(':', '{resolution}', {q}, {r}) END"
        )
    return _with_rounded(df, lon, lat, resolutions).withColumns(keys).drop("_hex")


def add_cells(df: DataFrame, lon: str, lat: str, resolutions: Sequence[int] = RESOLUTIONS) -> DataFrame:
    """Add one cell column per resolution; all are NULL where the point is not valid."""
    return _with_hex_cells(df, lon, lat, resolutions)
