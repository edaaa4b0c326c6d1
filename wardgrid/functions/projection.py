"""State-plane feet (EPSG:2263) to WGS84 degrees and back, as column arithmetic.

Lambert conformal conic with two standard parallels; formulae in Snyder, Map
Projections - A Working Manual, USGS Professional Paper 1395, pages 104-110.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from wardgrid.functions.clean import record

# EPSG:2263 parameters and the GRS80 ellipsoid.
PARALLEL_1 = math.radians(41 + 2 / 60)
PARALLEL_2 = math.radians(40 + 40 / 60)
ORIGIN_LAT = math.radians(40 + 10 / 60)
ORIGIN_LON = math.radians(-74.0)
FALSE_EASTING_FT = 984_250.0
FOOT = 1200.0 / 3937.0
SEMI_MAJOR = 6_378_137.0
FLATTENING = 1 / 298.257222101

ECC = math.sqrt(FLATTENING * (2 - FLATTENING))


def _m(phi: float) -> float:
    return math.cos(phi) / math.sqrt(1 - (ECC * math.sin(phi)) ** 2)


def _t(phi: float) -> float:
    wave = ECC * math.sin(phi)
    return math.tan(math.pi / 4 - phi / 2) / ((1 - wave) / (1 + wave)) ** (ECC / 2)


CONE = (math.log(_m(PARALLEL_1)) - math.log(_m(PARALLEL_2))) / (math.log(_t(PARALLEL_1)) - math.log(_t(PARALLEL_2)))
SCALE = _m(PARALLEL_1) / (CONE * _t(PARALLEL_1) ** CONE)
RHO_ORIGIN = SEMI_MAJOR * SCALE * _t(ORIGIN_LAT) ** CONE

LATITUDE_STEPS = 5


def state_plane_to_lonlat(x: Column, y: Column) -> Column:
    """`struct<x,y>` with longitude and latitude in degrees."""
    east = (x - F.lit(FALSE_EASTING_FT)) * F.lit(FOOT)
    north = F.lit(RHO_ORIGIN) - y * F.lit(FOOT)
    rho = F.sqrt(east * east + north * north)
    lon = F.degrees(F.atan2(east, north) / F.lit(CONE)) + F.lit(math.degrees(ORIGIN_LON))

    def latitude(t: Column) -> Column:
        def step(phi: Column) -> Column:
            wave = F.lit(ECC) * F.sin(phi)
            bent = t * F.pow((F.lit(1.0) - wave) / (F.lit(1.0) + wave), F.lit(ECC / 2))
            return F.lit(math.pi / 2) - F.lit(2.0) * F.atan(bent)

        start = F.lit(math.pi / 2) - F.lit(2.0) * F.atan(t)
        # a fold, because nesting the step five deep would double the expression each time
        return F.aggregate(F.sequence(F.lit(1), F.lit(LATITUDE_STEPS)), start, lambda phi, _: step(phi))

    # t through a one-element array, so that the steps share one value of it
    t = F.pow(rho / F.lit(SEMI_MAJOR * SCALE), F.lit(1 / CONE))
    return record(x=lon, y=F.degrees(F.transform(F.array(t), latitude)[0]))


def lonlat_to_state_plane(lon: Column, lat: Column) -> Column:
    """`struct<x,y>` in feet."""
    phi = F.radians(lat)
    wave = F.lit(ECC) * F.sin(phi)
    t = F.tan(F.lit(math.pi / 4) - phi / F.lit(2.0)) / F.pow(
        (F.lit(1.0) - wave) / (F.lit(1.0) + wave), F.lit(ECC / 2)
    )
    rho = F.lit(SEMI_MAJOR * SCALE) * F.pow(t, F.lit(CONE))
    theta = F.lit(CONE) * (F.radians(lon) - F.lit(ORIGIN_LON))
    return record(
        x=rho * F.sin(theta) / F.lit(FOOT) + F.lit(FALSE_EASTING_FT),
        y=(F.lit(RHO_ORIGIN) - rho * F.cos(theta)) / F.lit(FOOT),
    )
