"""The reports over the declared tables, one function each.

Tables are DataFrames with the columns of `wardgrid.schemas`, so a stored table,
a catalog table or any other source will do. Text is cast here, at query time.
Every order has a unique tie-break, so that a top-k has one right answer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardgrid.functions.clean import computed_once, in_box, per_thousand, safe_bigint, safe_double
from wardgrid.functions.geometry import area
from wardgrid.operators.relational import ascending, count_by, top_k
from wardgrid.operators.spatial import centroid_crosswalk, points_per_polygon


def rows_per_year(table: DataFrame) -> DataFrame:
    return ascending(count_by(table, "year"), "year")


def _crash_points(collisions: DataFrame, year: str) -> DataFrame:
    """`lat` and `lon` as numbers, each text cast once whatever is filtered later."""
    rows = collisions.where(F.col("year") == year)
    numbers = computed_once(rows, lat=safe_double("latitude"), lon=safe_double("longitude"))
    return numbers.select("lat", "lon")


def top_coordinates(collisions: DataFrame, year: str = "2024", k: int = 10) -> DataFrame:
    """The most frequent places of a year."""
    points = _crash_points(collisions, year).where(F.col("lat").isNotNull())
    return top_k(count_by(points, "lat", "lon"), "n", k, ["lat", "lon"])


def top_crash_zones(collisions: DataFrame, zones: DataFrame, year: str = "2024", k: int = 10) -> DataFrame:
    points = _crash_points(collisions, year)
    named = zones.select(F.col("locationid").alias("zone_id"), "geometry_wkt")
    counts = points_per_polygon(points, named, ["zone_id"], "lon", "lat", count="crashes")
    return top_k(counts, "crashes", k, ["zone_id"])


def busiest_stations(ridership: DataFrame, year: str = "2024", month: str = "01", k: int = 20) -> DataFrame:
    one_month = ridership.where((F.col("year") == year) & (F.col("month") == month))
    totals = one_month.groupBy("station_complex").agg(F.sum("ridership").alias("total_ridership"))
    return top_k(totals, "total_ridership", k, ["station_complex"])


def busiest_cells(ridership: DataFrame, year: str = "2024", cell: str = "hex_r9", k: int = 10) -> DataFrame:
    rows = ridership.where((F.col("year") == year) & F.col(cell).isNotNull())
    return top_k(count_by(rows, cell), "n", k, [cell])


def row_count(table: DataFrame) -> DataFrame:
    return table.agg(F.count(F.lit(1)).alias("n"))


def largest_zones(zones: DataFrame, k: int = 5) -> DataFrame:
    """The greatest planar areas, in square degrees."""
    areas = zones.select("zone", "borough", area(F.col("geometry_wkt")).alias("area_sqdeg"))
    return top_k(areas, "area_sqdeg", k, ["zone", "borough"])


def _crashes_by_tract(collisions: DataFrame, tracts: DataFrame, year: str) -> DataFrame:
    points = _crash_points(collisions, year).where(in_box(F.col("lat"), F.col("lon")))
    return points_per_polygon(points, tracts, ["geoid"], "lon", "lat", count="crashes")


def crashes_per_tract(collisions: DataFrame, tracts: DataFrame, year: str = "2024", k: int = 20) -> DataFrame:
    counts = _crashes_by_tract(collisions, tracts, year)
    named = counts.join(tracts.select("geoid", "boroname", "ntaname"), "geoid")
    return top_k(named.select("boroname", "ntaname", "geoid", "crashes"), "crashes", k, ["geoid"])


def zone_tract_crosswalk(zones: DataFrame, tracts: DataFrame) -> DataFrame:
    """Each tract with the zone that contains its centroid."""
    named_zones = zones.select(F.col("locationid").alias("zone_id"), "zone", "borough", "geometry_wkt")
    named_tracts = tracts.select(F.col("geoid").alias("tract_geoid"), "ntaname", "geometry_wkt")
    return centroid_crosswalk(
        named_tracts, named_zones, ["tract_geoid", "ntaname"], ["zone_id", "zone", "borough"]
    ).select("zone_id", "zone", "borough", "tract_geoid", "ntaname")


def measure_summary(demographics: DataFrame, measure: str = "median_household_income_2023") -> DataFrame:
    """Least, greatest and approximate median value of a stored measure."""
    values = demographics.select(safe_bigint(measure).alias("v"))
    return values.agg(
        F.min("v").alias("min_income"),
        F.max("v").alias("max_income"),
        F.percentile_approx("v", 0.5, 10000).alias("median_income"),
    )


def top_income_change(demographics: DataFrame, tracts: DataFrame, earlier: int = 2018, later: int = 2023,
                      k: int = 10) -> DataFrame:
    """The greatest changes between two vintages, where both are known."""
    before, after = f"inc_{earlier}", f"inc_{later}"
    incomes = demographics.select(
        "geoid",
        safe_bigint(f"median_household_income_{earlier}").alias(before),
        safe_bigint(f"median_household_income_{later}").alias(after),
    ).where(F.col(before).isNotNull() & F.col(after).isNotNull())
    named = incomes.join(tracts.select("geoid", "ntaname", "boroname"), "geoid")
    changes = named.select(
        "geoid", "ntaname", "boroname", before, after, (F.col(after) - F.col(before)).alias("delta")
    )
    return top_k(changes, "delta", k, ["geoid"])


def crashes_per_1k(collisions: DataFrame, tracts: DataFrame, demographics: DataFrame, year: str = "2024",
                   vintage: int = 2023, least_population: int = 100, k: int = 20) -> DataFrame:
    """Crashes per 1,000 residents, without near-empty tracts."""
    counts = _crashes_by_tract(collisions, tracts, year)
    residents = demographics.select("geoid", safe_bigint(f"total_pop_{vintage}").alias("pop")).where(
        F.col("pop") > least_population
    )
    named = counts.join(residents, "geoid").join(tracts.select("geoid", "ntaname"), "geoid")
    rates = named.select(
        "geoid", "ntaname", "crashes", "pop", per_thousand(F.col("crashes"), F.col("pop")).alias("crashes_per_1k")
    )
    return top_k(rates, "crashes_per_1k", k, ["geoid"])


def fatal_collisions(collisions: DataFrame, year: str = "2024", at_least: int = 1) -> DataFrame:
    killed = safe_bigint("number_of_persons_killed").cast("int")
    return collisions.where((F.col("year") == year) & (killed >= at_least))
