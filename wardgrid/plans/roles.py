"""Civic tables derived from the star-schema test tables.

Each text is plain SQL that Spark and the checking database read alike; it
stands for input data, so both sides of a check start from the same rows. The
`%` terms below decide which rows carry a dirty value or where a row lies on
the map. They never leave a row out.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardgrid.functions.projection import lonlat_to_state_plane
from wardgrid.functions.geometry import map_vertices, parse_rings, wkt_from_rings
from wardgrid.operators.relational import union_resources
from wardgrid.operators.wide import as_stored_text, curated, header_rows, in_counties, merge_vintages
from wardgrid.schemas import COUNTIES, MEASURES, Dataset, Resource
from wardgrid.sources.landing import spread

WEST, SOUTH, WIDTH, HEIGHT = -74.3, 40.4, 0.7, 0.6
# slightly less than the box, and no short fraction of it: no result ends in a digit that rounds either way
TRACT_WIDTH, TRACT_HEIGHT = WIDTH - 1 / 313, HEIGHT - 1 / 777
HOT_LON, HOT_LAT = -73.9871, 40.7557


def num(value: float) -> str:
    """A DOUBLE literal that both engines read to the same bits."""
    return f"{value:.17e}"


def place(key: str) -> tuple[str, str]:
    """(lon, lat) expressions that spread an integer key over the city's box."""
    return (
        f"({num(WEST)} + CAST(({key} * 7919) % 9973 AS DOUBLE) / {num(9973)} * {num(WIDTH)})",
        f"({num(SOUTH)} + CAST(({key} * 5381) % 9967 AS DOUBLE) / {num(9967)} * {num(HEIGHT)})",
    )


def month_parts(moment: str) -> str:
    return (
        f"CAST(year({moment}) AS STRING) AS year, lpad(CAST(month({moment}) AS STRING), 2, '0') AS month"
    )


def iso(moment: str) -> str:
    return f"replace(CAST({moment} AS STRING), ' ', 'T')"


# Crash records. Rows with return flag R all lie on one spot: the hot place.
_LON, _LAT = place("i")
CRASH_NUMBERS = f"""
SELECT *,
  CASE WHEN l_returnflag = 'R' THEN {num(HOT_LON)} ELSE {_LON} END AS true_lon,
  CASE WHEN l_returnflag = 'R' THEN {num(HOT_LAT)} ELSE {_LAT} END AS true_lat
FROM (SELECT *, l_orderkey * 8 + l_linenumber AS i FROM {{lineitem}}) AS keyed
"""

COLLISIONS = f"""
SELECT
  CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) || '-' || CAST(l_partkey AS STRING)
    || '-' || CAST(l_suppkey AS STRING) AS collision_id,
  {iso('l_shipdate')} || '.000' AS crash_date,
  l_linestatus AS borough,
  CASE WHEN i % 97 = 0 THEN '' WHEN i % 101 = 0 THEN 'N/A' WHEN i % 89 = 0 THEN NULL
       WHEN i % 103 = 0 THEN '95.0' ELSE CAST(true_lat AS STRING) END AS latitude,
  CASE WHEN i % 97 = 0 THEN '' WHEN i % 89 = 0 THEN NULL ELSE CAST(true_lon AS STRING) END AS longitude,
  CASE WHEN i % 89 = 0 OR i % 103 = 0 THEN CAST(true_lat AS STRING) END AS location_latitude,
  CASE WHEN i % 89 = 0 OR i % 103 = 0 THEN CAST(true_lon AS STRING) END AS location_longitude,
  CASE WHEN i % 97 = 0 THEN '' WHEN l_quantity >= 49 THEN '1' WHEN l_quantity < 2 THEN 'unknown'
       ELSE '0' END AS number_of_persons_killed,
  {month_parts('l_shipdate')}
FROM ({CRASH_NUMBERS}) AS crashes
"""

# What the texts of COLLISIONS say, as numbers; for the checking side.
CRASHES_AS_NUMBERS = f"""
SELECT *, CAST(year(l_shipdate) AS STRING) AS year,
  CASE WHEN i % 97 = 0 OR i % 101 = 0 OR i % 89 = 0 THEN NULL WHEN i % 103 = 0 THEN {num(95.0)}
       ELSE true_lat END AS lat,
  CASE WHEN i % 97 = 0 OR i % 89 = 0 THEN NULL ELSE true_lon END AS lon
FROM ({CRASH_NUMBERS}) AS crashes
"""

# Ridership records.
_LON, _LAT = place("user_id")
RIDERSHIP_TEXT = f"""
SELECT event_id, ts, {iso('ts')} AS transit_timestamp, 'subway' AS transit_mode,
  CAST(user_id AS STRING) AS station_complex_id, 'Station ' || CAST(user_id AS STRING) AS station_complex,
  event_type AS fare_class_category,
  CASE WHEN event_id % 97 = 0 THEN '' WHEN event_id % 101 = 0 THEN 'N/A' ELSE CAST(value AS STRING) END AS ridership,
  regexp_extract(props, '[0-9]+', 0) AS transfers,
  CASE WHEN event_id % 89 = 0 THEN '' ELSE CAST({_LAT} AS STRING) END AS latitude,
  CASE WHEN event_id % 89 = 0 THEN NULL ELSE CAST({_LON} AS STRING) END AS longitude
FROM {{events}}
"""

RIDES_AS_NUMBERS = f"""
SELECT *, {month_parts('ts')},
  CASE WHEN event_id % 97 = 0 OR event_id % 101 = 0 THEN NULL ELSE value END AS ridership,
  CASE WHEN event_id % 89 = 0 THEN NULL ELSE {_LAT} END AS lat,
  CASE WHEN event_id % 89 = 0 THEN NULL ELSE {_LON} END AS lon
FROM {{events}}
"""

# Service requests.
_LON, _LAT = place("o_orderkey")
REQUESTS = f"""
SELECT CAST(o_orderkey AS STRING) AS unique_key, {iso('o_orderdate')} || '.000' AS created_date,
  o_orderpriority AS complaint_type, o_orderstatus AS status, o_custkey, o_totalprice, o_orderdate,
  {_LAT} AS true_lat, {_LON} AS true_lon, {month_parts('o_orderdate')}
FROM {{orders}}
"""

# Zones: an uneven 5 x 5 tiling of the box.
X_BREAKS = [0.0, 0.15, 0.34, 0.55, 0.78, 1.0]
Y_BREAKS = [0.0, 0.17, 0.37, 0.61, 0.79, 1.0]


def _break(index: str, breaks: list[float], start: float, span: float) -> str:
    whens = " ".join(f"WHEN {j} THEN {num(start + b * span)}" for j, b in enumerate(breaks))
    return f"CASE {index} {whens} END"


ZONE_NUMBERS = f"""
SELECT *, {_break('col', X_BREAKS, WEST, WIDTH)} AS x0, {_break('col + 1', X_BREAKS, WEST, WIDTH)} AS x1,
  {_break('line', Y_BREAKS, SOUTH, HEIGHT)} AS y0, {_break('line + 1', Y_BREAKS, SOUTH, HEIGHT)} AS y1
FROM (
  SELECT CAST(n_nationkey AS STRING) AS locationid, n_name AS zone,
    'Region ' || CAST(n_regionkey AS STRING) AS borough,
    n_nationkey % 5 AS col, CAST(floor(n_nationkey / 5) AS INT) AS line
  FROM {{nation}}
) AS tiles
"""


def _vertex(x: str, y: str) -> str:
    return f"CAST({x} AS STRING) || ' ' || CAST({y} AS STRING)"


def _ring(points: list[tuple[str, str]]) -> str:
    return "'(' || " + " || ', ' || ".join(_vertex(x, y) for x, y in [*points, points[0]]) + " || ')'"


ZONES = f"""
SELECT locationid, zone, borough,
  'POLYGON (' || {_ring([('x0', 'y0'), ('x1', 'y0'), ('x1', 'y1'), ('x0', 'y1')])} || ')' AS geometry_wkt
FROM ({ZONE_NUMBERS}) AS z
"""

# Tracts, one per customer: keys 1-3 share a 2 x 2 grid, 4-15 a 4 x 4 grid, 16-63
# an 8 x 8 grid and so on, so a point lies in few tracts however many there are.
TRACT_NUMBERS = f"""
SELECT *, {num(WEST)} + CAST(slot % side AS DOUBLE) * w AS x0,
  {num(SOUTH)} + CAST(floor(slot / side) AS DOUBLE) * h AS y0
FROM (
  SELECT *, {num(TRACT_WIDTH)} / CAST(side AS DOUBLE) AS w, {num(TRACT_HEIGHT)} / CAST(side AS DOUBLE) AS h
  FROM (
    SELECT *, k - CAST(pow(4, ring) AS BIGINT) AS slot, CAST(pow(2, ring + 1) AS BIGINT) AS side
    FROM (
      SELECT *, c_custkey + 1 AS k, (c_custkey + 1) % 4 AS kind,
        CAST(floor((length(bin(c_custkey + 1)) - 1) / 2) AS INT) AS ring,
        CASE c_nationkey % 5 {' '.join(f"WHEN {i} THEN '{c}'" for i, c in enumerate(COUNTIES))} END AS county,
        lpad(CAST(c_custkey AS STRING), CAST(greatest(6, length(CAST(c_custkey AS STRING))) AS INT), '0') AS tract
      FROM {{customer}}
    ) AS keyed
  ) AS placed
) AS sized
"""


def tx(fraction: float) -> str:
    return f"(x0 + w * {num(fraction)})"


def ty(fraction: float) -> str:
    return f"(y0 + h * {num(fraction)})"


def _shape(*fractions: tuple[float, float]) -> str:
    return _ring([(tx(x), ty(y)) for x, y in fractions])


def _diamond(cx: float, cy: float, rx: float, ry: float) -> str:
    return _shape((cx - rx, cy), (cx, cy - ry), (cx + rx, cy), (cx, cy + ry))


TRACTS = f"""
SELECT '36' || county || tract AS geoid, c_mktsegment AS boroname, c_name AS ntaname,
  CASE kind
    WHEN 0 THEN 'POLYGON (' || {_shape((.05, .05), (.95, .05), (.95, .45), (.55, .45), (.55, .95), (.05, .95))} || ')'
    WHEN 1 THEN 'POLYGON (' || {_shape((.1, .1), (.9, .1), (.9, .9), (.1, .9))} || ', '
      || {_shape((.35, .3), (.7, .3), (.7, .6), (.35, .6))} || ')'
    WHEN 2 THEN 'MULTIPOLYGON ((' || {_shape((.05, .1), (.4, .1), (.4, .9), (.05, .9))} || '), ('
      || {_diamond(.7, .5, .25, .4)} || '))'
    ELSE 'POLYGON (' || {_diamond(.5, .5, .45, .48)} || ')'
  END AS geometry_wkt
FROM ({TRACT_NUMBERS}) AS t
"""

# Census responses: one row per customer and vintage with orders in that year.
RESPONSE_YEARS = {2018: 1997, 2023: 2000}


def measure_text(index: int, name: str) -> str:
    value = f"(cents * {index + 7}) % 100003"
    if name == "total_pop":
        return "CAST(cents % 4001 AS STRING)"
    if name in ("median_age", "median_household_size"):
        return f"CAST(CAST({value} AS DOUBLE) / {num(8)} AS STRING)"
    if name == "median_household_income":
        return f"CASE WHEN cents % 11 = 0 THEN '-666666666' ELSE CAST({value} AS STRING) END"
    if name == "median_gross_rent":
        return f"CASE WHEN cents % 13 = 0 THEN 'abc' WHEN cents % 17 = 0 THEN NULL ELSE CAST({value} AS STRING) END"
    return f"CAST({value} AS STRING)"


def vintage_rows(vintage: int) -> str:
    """Text rows `NAME, <codes>, state, county, tract, k` of one vintage."""
    codes = ", ".join(f'{measure_text(i, name)} AS {code}' for i, (code, name) in enumerate(MEASURES.items()))
    return f"""
SELECT c_name AS NAME, {codes}, '36' AS state, county, tract, k
FROM ({TRACT_NUMBERS}) AS t JOIN (
  SELECT o_custkey, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS cents
  FROM {{orders}} WHERE year(o_orderdate) = {RESPONSE_YEARS[vintage]} GROUP BY o_custkey
) AS o ON c_custkey = o_custkey
"""


# The two resources of the requests table, with years that fit the test tables.
REQUESTS_DATASET = Dataset(
    table="requests",
    date_column="created_date",
    key_column="unique_key",
    resources=(Resource("archive", 1995, 1998), Resource("recent", 1999, 2002)),
    text_columns=("unique_key", "created_date", "complaint_type", "status", "latitude", "longitude",
                  "location_latitude", "location_longitude", "tags"),
)

RESPONSE_ROWS = 500


class Tables:
    """The derived tables of one folder of test tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def sql(self, text: str, dealt: str | None = None) -> DataFrame:
        names = ("region nation customer supplier orders lineitem events").split()
        used = {n: self.raw(n) for n in names if f"{{{n}}}" in text}
        if dealt:  # narrow rows that much is done with
            used[dealt] = used[dealt].repartition(self.spark.sparkContext.defaultParallelism)
        return self.spark.sql(text, **used)

    @cached_property
    def collisions(self) -> DataFrame:
        return self.sql(COLLISIONS)

    @cached_property
    def ridership_text(self) -> DataFrame:
        return self.sql(RIDERSHIP_TEXT)

    @cached_property
    def ridership_lines(self) -> DataFrame:
        """Landed ridership: JSON lines with a nested object; blank keys stay away."""
        rides = spread(self.ridership_text.drop("event_id", "ts"))
        point = F.struct(
            F.lit("Point").alias("type"), F.array(F.col("longitude"), F.col("latitude")).alias("coordinates")
        )
        return rides.select(F.to_json(F.struct(*rides.columns, point.alias("georeference"))).alias("value"))

    @cached_property
    def requests(self) -> DataFrame:
        return self.sql(REQUESTS)

    @cached_property
    def request_lines(self) -> dict[str, DataFrame]:
        """Landed requests in two resources; only the recent one carries `channel`."""
        rows = self.requests

        def lines(part: DataFrame, *extra) -> DataFrame:
            nested = F.struct(
                F.col("true_lat").cast("string").alias("latitude"),
                F.col("true_lon").cast("string").alias("longitude"),
                F.lit("h").alias("human_address"),
            )
            record = F.struct(
                "unique_key", "created_date", "complaint_type", "status",
                F.when(F.col("status") == "F", "").otherwise(F.col("true_lat").cast("string")).alias("latitude"),
                F.when(F.col("status") == "F", "").otherwise(F.col("true_lon").cast("string")).alias("longitude"),
                F.when(F.col("status") != "P", nested).alias("location"),
                F.array(F.col("o_custkey"), F.length("complaint_type")).alias("tags"),
                F.struct(F.lit("Point").alias("type")).alias("shape"),
                *extra,
            )
            return spread(part).select(F.to_json(record).alias("value"))

        channel = F.when(F.col("status") == "O", "PHONE").otherwise("ONLINE").alias("channel")
        return {
            "archive": lines(rows.where(F.col("o_orderdate") < "1999-01-01")),
            "recent": lines(rows.where(F.col("o_orderdate") >= "1999-01-01"), channel),
        }

    @cached_property
    def all_request_lines(self) -> DataFrame:
        return union_resources(*self.request_lines.values())

    @cached_property
    def zones(self) -> DataFrame:
        return self.sql(ZONES)

    @cached_property
    def tracts(self) -> DataFrame:
        return self.sql(TRACTS, dealt="customer")

    @cached_property
    def tracts_in_feet(self) -> DataFrame:
        """The tracts as a source might deliver them: state-plane feet, mixed-case names."""
        moved = wkt_from_rings(map_vertices(parse_rings(F.col("geometry_wkt")), lonlat_to_state_plane))
        return self.tracts.select(F.col("geoid").alias("GeoID"), F.col("ntaname").alias("NTAName"), moved.alias("shape"))

    def vintage_rows(self, vintage: int) -> DataFrame:
        return self.sql(vintage_rows(vintage))

    def responses(self, vintage: int) -> DataFrame:
        """Header-row responses by county, at most `RESPONSE_ROWS` rows in each.

        A page is a range of keys, so no group grows with the table.
        """
        rows = self.vintage_rows(vintage)
        header = ["NAME", *MEASURES, "state", "county", "tract"]
        pages = rows.groupBy("county", F.floor(F.col("k") / RESPONSE_ROWS).alias("page")).agg(
            F.collect_list(F.array(*header)).alias("_rows")
        )
        names = F.array(F.array(*[F.lit(h) for h in header]))
        return pages.select(F.to_json(F.concat(names, "_rows")).alias("value"))

    def landed_measures(self, vintage: int) -> DataFrame:
        return in_counties(header_rows(self.responses(vintage), ["NAME", *MEASURES, "state", "county", "tract"]))

    def measures(self, vintage: int) -> DataFrame:
        return curated(self.landed_measures(vintage))

    @cached_property
    def demographics(self) -> DataFrame:
        return as_stored_text(merge_vintages({v: self.measures(v) for v in RESPONSE_YEARS}))
