"""The expected result of each query as SQL over the raw test tables.

Written apart from the operators: containment by comparing coordinates instead
of counting edge crossings, areas and centroids from the shapes' proportions,
reprojection by the coordinates the shapes had before.
"""

from __future__ import annotations

from wardgrid.functions.cells import edge_length
from wardgrid.plans import roles
from wardgrid.plans.registry import AS_OF, CRASH_YEAR, EDGE_CORNERS, SMALL_BOX, ZONE_LINES
from wardgrid.plans.roles import num, tx, ty
from wardgrid.schemas import MEASURES

_NAMES = {n: n for n in "region nation customer supplier orders lineitem events".split()}


def _role(text: str) -> str:
    return "(" + text.format(**_NAMES) + ")"


CRASHES = _role(roles.CRASHES_AS_NUMBERS)
COLLISIONS = _role(roles.COLLISIONS)
RIDES = _role(roles.RIDES_AS_NUMBERS)
REQUESTS = _role(roles.REQUESTS)
ZONES = _role(roles.ZONE_NUMBERS)
TRACTS = "(SELECT *, '36' || county || tract AS geoid, c_name AS ntaname, c_mktsegment AS boroname FROM " + _role(
    roles.TRACT_NUMBERS
) + " AS tn)"

MONTH_OF_ORDER = roles.month_parts("o_orderdate")


def _diamond(cx: float, cy: float, rx: float, ry: float) -> str:
    return f"abs(p.lon - {tx(cx)}) / (w * {num(rx)}) + abs(p.lat - {ty(cy)}) / (h * {num(ry)}) < 1"


def _within(x0: float, x1: float, y0: float, y1: float) -> str:
    return f"p.lon > {tx(x0)} AND p.lon < {tx(x1)} AND p.lat > {ty(y0)} AND p.lat < {ty(y1)}"


IN_TRACT = f"""
(p.lon > x0 AND p.lon < x0 + w AND p.lat > y0 AND p.lat < y0 + h AND CASE kind
  WHEN 0 THEN {_within(.05, .95, .05, .95)} AND NOT (p.lon >= {tx(.55)} AND p.lat >= {ty(.45)})
  WHEN 1 THEN {_within(.1, .9, .1, .9)}
    AND NOT (p.lon BETWEEN {tx(.35)} AND {tx(.7)} AND p.lat BETWEEN {ty(.3)} AND {ty(.6)})
  WHEN 2 THEN ({_within(.05, .4, .1, .9)}) OR {_diamond(.7, .5, .25, .4)}
  ELSE {_diamond(.5, .5, .45, .48)} END)
"""

# area and centroid as fractions of the tile, by kind
FRACTIONS = {
    0: (0.61, (0.81 * 0.5 - 0.2 * 0.75) / 0.61, (0.81 * 0.5 - 0.2 * 0.7) / 0.61),
    1: (0.535, (0.64 * 0.5 - 0.105 * 0.525) / 0.535, (0.64 * 0.5 - 0.105 * 0.45) / 0.535),
    2: (0.48, (0.28 * 0.225 + 0.2 * 0.7) / 0.48, 0.5),
    3: (0.432, 0.5, 0.5),
}


def _by_kind(place: int) -> str:
    return "CASE kind " + " ".join(f"WHEN {k} THEN {num(v[place])}" for k, v in FRACTIONS.items()) + " END"


CENTROIDS = f"""(SELECT *, w * h * {_by_kind(0)} AS area, x0 + w * {_by_kind(1)} AS lon, y0 + h * {_by_kind(2)} AS lat
FROM {TRACTS} AS t)"""

IN_BOX = "lat BETWEEN 40.4 AND 41.0 AND lon BETWEEN -74.3 AND -73.6"

TRACT_COUNTS = f"SELECT geoid, COUNT(*) AS crashes FROM {CRASHES} AS p, {TRACTS} AS t WHERE {IN_TRACT} GROUP BY geoid"
TRACT_COUNTS_OF_YEAR = f"""SELECT geoid, COUNT(*) AS crashes
FROM (SELECT * FROM {CRASHES} AS c WHERE year = '{CRASH_YEAR}' AND {IN_BOX}) AS p, {TRACTS} AS t
WHERE {IN_TRACT} GROUP BY geoid"""


def _number(text: str) -> str:
    return f"TRY_CAST({text} AS DOUBLE)"


def _vintage(vintage: int, suffix: str = "") -> str:
    """The clean measures of one vintage as DOUBLE."""
    measures = ", ".join(
        f"CASE WHEN {_number(code)} < -100000000 THEN NULL ELSE {_number(code)} END AS {name}{suffix}"
        for code, name in MEASURES.items()
    )
    rows = _role(roles.vintage_rows(vintage))
    return f"(SELECT '36' || county || tract AS geoid, {measures} FROM {rows} AS landed)"


DEMOGRAPHICS = f"""(SELECT * FROM {_vintage(2018, '_2018')} AS a FULL JOIN {_vintage(2023, '_2023')} AS b USING (geoid))"""


def _bigint(name: str) -> str:
    return f"CAST(trunc({name}) AS BIGINT)"


def hex_key(resolution: int, lon: str = "lon", lat: str = "lat") -> str:
    """The cell key by rounding to the nearest of three axes."""
    edge = edge_length(resolution)
    a, b, c = num(3 ** 0.5 / 3.0 / edge), num(1.0 / 3.0 / edge), num(2.0 / 3.0 / edge)
    fq, fr = f"({a} * {lon} - {b} * {lat})", f"({c} * {lat})"
    fs = f"(-{fq} - {fr})"
    q, r, s = (f"floor({v} + 0.5)" for v in (fq, fr, fs))
    dq, dr, ds = f"abs({q} - {fq})", f"abs({r} - {fr})", f"abs({s} - {fs})"
    return f"""CASE WHEN {lat} BETWEEN -90 AND 90 AND {lon} BETWEEN -180 AND 180 THEN '{resolution}:'
      || CAST(CAST(CASE WHEN {dq} > {dr} AND {dq} > {ds} THEN -{r} - {s} ELSE {q} END AS BIGINT) AS VARCHAR) || ':'
      || CAST(CAST(CASE WHEN {dq} > {dr} AND {dq} > {ds} THEN {r} WHEN {dr} > {ds} THEN -{q} - {s} ELSE {r} END AS BIGINT)
         AS VARCHAR) END"""


# the pair that a crash record's coordinates come from
CHOSEN = f"""(SELECT collision_id, crash_date,
  CASE WHEN (i % 97 = 0 OR i % 101 = 0) AND i % 89 <> 0 AND i % 103 <> 0 THEN NULL ELSE true_lat END AS lat,
  CASE WHEN (i % 97 = 0 OR i % 101 = 0) AND i % 89 <> 0 AND i % 103 <> 0 THEN NULL ELSE true_lon END AS lon
FROM (SELECT *, CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) || '-' || CAST(l_partkey AS VARCHAR)
    || '-' || CAST(l_suppkey AS VARCHAR) AS collision_id,
  replace(CAST(l_shipdate AS VARCHAR), ' ', 'T') || '.000' AS crash_date
  FROM {_role(roles.CRASH_NUMBERS)} AS c0) AS c1)"""

LAST_MONTH = "(SELECT max(date_trunc('month', o_orderdate)) FROM orders)"
ALL_MONTHS = f"""(SELECT CAST(m AS DATE) AS first_day, CAST(m + INTERVAL 1 MONTH AS DATE) AS next_first_day,
  strftime(m, '%Y') AS year, strftime(m, '%m') AS month
FROM generate_series((SELECT min(date_trunc('month', o_orderdate)) FROM orders), {LAST_MONTH}, INTERVAL 1 MONTH) AS g(m))"""

ORACLES: dict[str, str] = {}

ORACLES["rows_per_year_requests"] = """
SELECT CAST(year(o_orderdate) AS VARCHAR) AS year, COUNT(*) AS n FROM orders GROUP BY 1"""

ORACLES["rows_per_year_collisions"] = """
SELECT CAST(year(l_shipdate) AS VARCHAR) AS year, COUNT(*) AS n FROM lineitem GROUP BY 1"""

ORACLES["top_coordinates"] = f"""
SELECT lat, lon, COUNT(*) AS n FROM {CRASHES} AS c WHERE year = '{CRASH_YEAR}' AND lat IS NOT NULL
GROUP BY lat, lon ORDER BY n DESC, lat, lon LIMIT 10"""

ORACLES["top_crash_zones"] = f"""
SELECT locationid AS zone_id, COUNT(*) AS crashes FROM {CRASHES} AS p, {ZONES} AS z
WHERE year = '{CRASH_YEAR}' AND lon > x0 AND lon < x1 AND lat > y0 AND lat < y1
GROUP BY 1 ORDER BY crashes DESC, zone_id LIMIT 10"""

ORACLES["rows_per_year_ridership"] = f"SELECT year, COUNT(*) AS n FROM {RIDES} AS r GROUP BY year"

ORACLES["busiest_stations"] = f"""
SELECT 'Station ' || CAST(user_id AS VARCHAR) AS station_complex, round(sum(ridership), 4) AS total_ridership
FROM {RIDES} AS r WHERE year = '2024' AND month = '01'
GROUP BY user_id ORDER BY sum(ridership) DESC, station_complex LIMIT 20"""

ORACLES["stored_busiest_stations"] = ORACLES["busiest_stations"]

ORACLES["busiest_cells"] = f"""
SELECT hex_r9, COUNT(*) AS n FROM (SELECT year, {hex_key(9)} AS hex_r9 FROM {RIDES} AS r) AS k
WHERE year = '2024' AND hex_r9 IS NOT NULL GROUP BY hex_r9 ORDER BY n DESC, hex_r9 LIMIT 10"""

ORACLES["zone_count"] = "SELECT COUNT(*) AS n FROM nation"
ORACLES["tract_count"] = "SELECT COUNT(*) AS n FROM customer"

ORACLES["largest_zones"] = f"""
SELECT zone, borough, round((x1 - x0) * (y1 - y0), 9) AS area_sqdeg FROM {ZONES} AS z
ORDER BY area_sqdeg DESC, zone, borough LIMIT 5"""

ORACLES["crashes_per_tract"] = f"""
SELECT boroname, ntaname, geoid, crashes FROM ({TRACT_COUNTS_OF_YEAR}) AS n JOIN {TRACTS} AS t2 USING (geoid)
ORDER BY crashes DESC, geoid LIMIT 20"""

CROSSWALK = f"""SELECT locationid AS zone_id, zone, borough, geoid AS tract_geoid, ntaname
FROM {CENTROIDS} AS c, (SELECT locationid, zone, borough, x0 AS zx0, x1 AS zx1, y0 AS zy0, y1 AS zy1 FROM {ZONES} AS z0) AS z
WHERE lon > zx0 AND lon < zx1 AND lat > zy0 AND lat < zy1"""
ORACLES["zone_tract_crosswalk"] = CROSSWALK
ORACLES["crosswalk_table"] = f"""
SELECT zone_id, borough, COUNT(*) AS tracts FROM ({CROSSWALK}) AS x GROUP BY zone_id, borough"""

ORACLES["demographics_count"] = """
SELECT COUNT(DISTINCT o_custkey) AS n FROM orders JOIN customer ON o_custkey = c_custkey
WHERE year(o_orderdate) IN (1997, 2000)"""

ORACLES["income_summary"] = f"""
SELECT min(v) AS min_income, max(v) AS max_income, quantile_disc(v, 0.5) AS median_income
FROM (SELECT {_bigint('median_household_income')} AS v FROM {_vintage(2023)} AS m) AS s"""

INCOMES = f"""(SELECT geoid, {_bigint('median_household_income_2018')} AS inc_2018,
  {_bigint('median_household_income_2023')} AS inc_2023 FROM {DEMOGRAPHICS} AS d)"""
ORACLES["top_income_change"] = f"""
SELECT geoid, ntaname, boroname, inc_2018, inc_2023, inc_2023 - inc_2018 AS delta
FROM {INCOMES} AS i JOIN {TRACTS} AS t USING (geoid)
WHERE inc_2018 IS NOT NULL AND inc_2023 IS NOT NULL ORDER BY delta DESC, geoid LIMIT 10"""

ORACLES["crashes_per_1k"] = f"""
SELECT geoid, ntaname, crashes, pop, round(CAST(1000 AS DOUBLE) * crashes / pop, 6) AS crashes_per_1k
FROM ({TRACT_COUNTS_OF_YEAR}) AS n
JOIN (SELECT geoid, {_bigint('total_pop')} AS pop FROM {_vintage(2023)} AS v) AS d USING (geoid)
JOIN {TRACTS} AS t2 USING (geoid)
WHERE pop > 100 ORDER BY CAST(1000 AS DOUBLE) * crashes / pop DESC, geoid LIMIT 20"""

ORACLES["fatal_collisions"] = f"""
SELECT collision_id, crash_date, borough, number_of_persons_killed, year, month FROM {COLLISIONS} AS c
WHERE year = '{CRASH_YEAR}' AND number_of_persons_killed = '1'"""

ORACLES["json_landing_range"] = f"""
SELECT {MONTH_OF_ORDER}, o_orderstatus AS status, COUNT(*) AS n FROM orders
WHERE o_orderdate >= '1996-01-01' AND o_orderdate < '1999-01-01' GROUP BY ALL"""

ORACLES["month_calendar"] = f"""
SELECT year, month, CAST(first_day AS VARCHAR) AS first_day, CAST(next_first_day AS VARCHAR) AS next_first_day,
  next_first_day <= (SELECT max(CAST(o_orderdate AS DATE)) FROM orders) AS closed FROM {ALL_MONTHS} AS m"""

ORACLES["header_row_response"] = f"""
SELECT state, county, tract, B01003_001E AS people, B25064_001E AS rent FROM {_role(roles.vintage_rows(2018))} AS v"""

ORACLES["response_files"] = f"""
SELECT state, county, COUNT(*) AS n FROM (
  SELECT state, county FROM {_role(roles.vintage_rows(2018))} AS a UNION ALL
  SELECT state, county FROM {_role(roles.vintage_rows(2023))} AS b) AS u
GROUP BY state, county"""

ORACLES["record_pages"] = "SELECT o_orderstatus AS status, COUNT(*) AS n FROM orders GROUP BY 1"

ORACLES["month_spot_check"] = """
SELECT COUNT(*) AS rows, 'hex_r8,hex_r9,hex_r10' AS cells, least(COUNT(*), 5) AS head
FROM orders WHERE year(o_orderdate) = 1997 AND month(o_orderdate) = 3"""

ORACLES["stacked_counties"] = f"""
SELECT county, COUNT(*) AS n FROM (
  SELECT county FROM {_role(roles.vintage_rows(2018))} AS a UNION ALL
  SELECT county FROM {_role(roles.vintage_rows(2023))} AS b) AS u
WHERE county IN ('005', '061', '085') GROUP BY county"""

ORACLES["partitioned_scan"] = f"""
SELECT '1997' AS year, lpad(CAST(month(o_orderdate) AS VARCHAR), 2, '0') AS month, COUNT(*) AS n, CAST(0 AS BIGINT) AS n_agency,
  min(replace(CAST(o_orderdate AS VARCHAR), ' ', 'T') || '.000') AS first
FROM orders WHERE year(o_orderdate) = 1997 GROUP BY 2"""

ORACLES["partition_spot_read"] = """
SELECT CAST(o_orderkey AS VARCHAR) AS unique_key, o_orderpriority AS complaint_type, '1997' AS year, '03' AS month
FROM orders WHERE year(o_orderdate) = 1997 AND month(o_orderdate) = 3"""

ORACLES["reference_table"] = "SELECT c_mktsegment AS boroname, COUNT(*) AS n FROM customer GROUP BY 1"

ORACLES["union_resources"] = """
SELECT CAST(year(o_orderdate) AS VARCHAR) AS year, COUNT(*) AS n,
  COUNT(*) FILTER (WHERE o_orderdate >= '1999-01-01') AS n_channel FROM orders GROUP BY 1"""

ORACLES["repeated_keys"] = """
SELECT CAST(o_orderkey AS VARCHAR) AS unique_key, CAST(2 AS BIGINT) AS n FROM orders WHERE year(o_orderdate) = 1999"""

ORACLES["reprojected_polygons"] = f"""
SELECT geoid, ntaname, round(lon, 6) AS centroid_lon, round(lat, 6) AS centroid_lat FROM {CENTROIDS} AS c"""

ORACLES["replace_month_partitions"] = f"""
SELECT {MONTH_OF_ORDER}, CASE WHEN year(o_orderdate) = 1998 THEN 'again' ELSE o_orderstatus END AS status, COUNT(*) AS n
FROM orders GROUP BY ALL"""

ORACLES["page_parts"] = f"""
SELECT {roles.month_parts('l_shipdate')}, COUNT(*) AS n, FALSE AS exceeded, TRUE AS enough FROM lineitem GROUP BY ALL"""

ORACLES["registered_months"] = """
SELECT CAST(year(o_orderdate) AS VARCHAR) AS year, COUNT(*) AS n FROM orders WHERE year(o_orderdate) >= 1997 GROUP BY 1"""

ORACLES["pending_months"] = f"""
SELECT year, month FROM {ALL_MONTHS} AS m WHERE year = '1999' OR month IN ('02', '06')"""

ORACLES["month_load"] = f"""
SELECT {MONTH_OF_ORDER}, COUNT(*) AS n, COUNT(*) FILTER (WHERE o_orderdate >= '1999-01-01') AS n_channel,
  COUNT(*) AS n_tags, COUNT(*) AS n_placed FROM orders GROUP BY ALL"""

ORACLES["load_states"] = f"""
WITH months AS (
  SELECT strftime(m, '%Y') AS year, strftime(m, '%m') AS month, CAST(m + INTERVAL 1 MONTH AS DATE) <= DATE '{AS_OF}' AS closed
  FROM generate_series(TIMESTAMP '1995-01-01', TIMESTAMP '{AS_OF}', INTERVAL 1 MONTH) AS g(m)),
counts AS (SELECT {MONTH_OF_ORDER}, COUNT(*) AS n FROM orders GROUP BY ALL)
SELECT months.year, months.month,
  CASE WHEN NOT closed THEN 'open' WHEN n IS NULL THEN 'empty' ELSE 'loaded' END AS status, COALESCE(n, 0) AS rows
FROM months LEFT JOIN counts ON months.year = counts.year AND months.month = counts.month"""

ORACLES["refused_lines"] = """
SELECT CASE WHEN o_orderkey % 53 = 0 THEN 'malformed' WHEN o_orderkey % 50 = 0 THEN 'undated'
  WHEN year(o_orderdate) NOT BETWEEN 1994 AND 1996 THEN 'outside' ELSE 'stored' END AS reason, COUNT(*) AS n
FROM orders GROUP BY 1"""

ORACLES["emptied_month"] = f"""
WITH months AS (
  SELECT strftime(m, '%Y') AS year, strftime(m, '%m') AS month
  FROM generate_series(TIMESTAMP '1995-01-01', TIMESTAMP '1996-12-01', INTERVAL 1 MONTH) AS g(m)),
counts AS (SELECT {MONTH_OF_ORDER}, COUNT(*) AS n FROM orders WHERE o_orderdate < '1996-12-01' GROUP BY ALL)
SELECT months.year, months.month, CASE WHEN n IS NULL THEN 'empty' ELSE 'loaded' END AS status,
  COALESCE(n, 0) AS rows, COALESCE(n, 0) AS n
FROM months LEFT JOIN counts ON months.year = counts.year AND months.month = counts.month"""

ORACLES["resources_apart"] = f"""
WITH months AS (
  SELECT m, CAST(m + INTERVAL 1 MONTH AS DATE) <= DATE '{AS_OF}' AS closed
  FROM generate_series(TIMESTAMP '1995-01-01', TIMESTAMP '{AS_OF}', INTERVAL 1 MONTH) AS g(m)),
counts AS (SELECT date_trunc('month', o_orderdate) AS m, COUNT(*) AS n FROM orders GROUP BY ALL)
SELECT way, CASE WHEN year(months.m) < 1999 THEN 'archive' ELSE 'recent' END AS resource,
  CASE WHEN NOT closed THEN 'open' WHEN n IS NULL THEN 'empty' ELSE 'loaded' END AS status,
  COUNT(*) AS months, CAST(COALESCE(SUM(n), 0) AS BIGINT) AS n
FROM months LEFT JOIN counts ON months.m = counts.m, (VALUES ('joint'), ('older first'), ('newer first')) AS w(way) GROUP BY ALL"""

ORACLES["published_months"] = f"""
WITH months AS (
  SELECT strftime(m, '%Y') AS year, strftime(m, '%m') AS month, CAST(m + INTERVAL 1 MONTH AS DATE) <= DATE '{AS_OF}' AS closed
  FROM generate_series(TIMESTAMP '1995-01-01', TIMESTAMP '{AS_OF}', INTERVAL 1 MONTH) AS g(m)),
counts AS (
  SELECT {MONTH_OF_ORDER}, COUNT(*) AS n, COUNT(*) FILTER (WHERE year(o_orderdate) = 1995 AND o_orderkey % 11 = 1) AS changed FROM orders GROUP BY ALL)
SELECT year, month, CASE WHEN NOT closed THEN 'open' WHEN n IS NULL THEN 'empty' ELSE 'loaded' END AS status, COALESCE(n, 0) AS rows, n, changed
FROM months LEFT JOIN counts USING (year, month)"""

ORACLES["late_rows"] = """
WITH o AS (SELECT o_orderdate >= '1999-01-01' AS recent, year(o_orderdate) = 1995 AS early, o_orderkey % 11 AS r, month(o_orderdate) AS m FROM orders),
late AS (SELECT COUNT(*) FILTER (WHERE early AND r = 0) AS fresh, COUNT(*) FILTER (WHERE early AND r = 1) AS changed FROM o)
SELECT CAST(1 AS INT) AS load, COUNT(*) AS lines, COUNT(*) AS taken, CAST(0 AS BIGINT) AS late, CAST(NULL AS BIGINT) AS rows_stayed
FROM o WHERE NOT recent AND NOT (early AND r = 0)
UNION ALL
SELECT 2, COUNT(*) FILTER (WHERE recent) + any_value(fresh + changed), COUNT(*) FILTER (WHERE recent) + any_value(fresh + changed),
  any_value(fresh + changed), COUNT(*) FILTER (WHERE NOT recent AND NOT early) FROM o, late"""

ORACLES["earlier_version"] = """
SELECT CAST(year(o_orderdate) AS VARCHAR) AS year, '03' AS month, COUNT(*) AS n FROM orders
WHERE month(o_orderdate) = 3 AND year(o_orderdate) < 1999 AND NOT (year(o_orderdate) = 1995 AND o_orderkey % 11 = 0) GROUP BY 1"""

ORACLES["landed_once"] = "SELECT CAST(year(o_orderdate) AS VARCHAR) AS year, COUNT(*) AS n FROM orders WHERE year(o_orderdate) BETWEEN 1992 AND 1999 GROUP BY 1"

ORACLES["mixed_location_forms"] = """
SELECT keys, CAST(o_orderkey % 3 AS VARCHAR) AS form, COUNT(*) AS n, COUNT(*) AS n_latitude, COUNT(*) AS n_placed
FROM orders, (VALUES ('discovered'), ('declared')) AS k(keys) GROUP BY ALL"""

ORACLES["drifting_keys"] = """
SELECT o_orderstatus AS status_text,
  (o_orderkey % 5) || CASE WHEN o_orderkey % 3 = 0 OR o_orderkey % 5 = 0 THEN '.0' ELSE '0000000000.0' END AS amount,
  COUNT(*) AS rows FROM orders GROUP BY ALL"""

ORACLES["dry_run_preview"] = f"SELECT {MONTH_OF_ORDER}, COUNT(*) AS n FROM orders GROUP BY ALL"

ORACLES["resumed_stream"] = f"""
SELECT year, month, strftime(ts, '%d') AS day, COUNT(*) AS n, round(sum(ridership), 4) AS total
FROM {RIDES} AS r GROUP BY 1, 2, 3"""

ORACLES["streamed_once"] = """
SELECT CAST(year(o_orderdate) AS VARCHAR) AS year, COUNT(*) + COUNT(*) FILTER (WHERE year(o_orderdate) = 1998 AND o_orderkey % 7 = 0) AS stored,
  COUNT(*) AS n, COUNT(*) FILTER (WHERE year(o_orderdate) = 1998 AND o_orderkey % 7 = 0) AS changed FROM orders GROUP BY 1"""

ORACLES["text_records"] = f"""
SELECT unique_key, created_date,
  CASE WHEN o_orderdate >= '1999-01-01' THEN CASE WHEN status = 'O' THEN 'PHONE' ELSE 'ONLINE' END END AS channel,
  '[' || CAST(o_custkey AS VARCHAR) || ',' || CAST(length(complaint_type) AS VARCHAR) || ']' AS tags,
  status = 'F' AS blank_latitude,
  CASE WHEN status <> 'P' THEN round(true_lat, 6) END AS hoisted_latitude,
  CAST(10 AS INT) AS n_columns FROM {REQUESTS} AS r"""

ORACLES["landed_keys"] = """
SELECT key, kind = 's' AS scalar, kind = 'l' AS list, kind IN ('o', 'p') AS object, kind = 'o' AS latitude, kind = 'o' AS longitude
FROM (SELECT DISTINCT unnest(['unique_key', 'created_date', 'complaint_type', 'status', 'latitude', 'longitude', 'channel',
  'tags', 'location', 'shape']) AS key, unnest(['s', 's', 's', 's', 's', 's', 's', 'l', 'o', 'p']) AS kind FROM orders) AS k"""

ORACLES["undeclared_keys"] = """
SELECT 'channel' AS key, COUNT(*) FILTER (WHERE o_orderdate >= '1999-01-01') AS n FROM orders
UNION ALL SELECT 'location', COUNT(*) FILTER (WHERE o_orderstatus <> 'P') FROM orders
UNION ALL SELECT 'shape', COUNT(*) FROM orders"""

ORACLES["nested_json_text"] = f"""
SELECT 'Station ' || CAST(user_id AS VARCHAR) AS station_complex, ts AS transit_timestamp, 'Point' AS kind,
  CAST(2 AS INT) AS n_coordinates FROM events"""

ORACLES["stringified"] = """
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey,
  '[' || CAST(o_orderkey AS VARCHAR) || ',' || CAST(o_custkey AS VARCHAR) || ']' AS keys,
  CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS price, o_totalprice AS at_latitude, CAST(6 AS INT) AS n_columns
FROM orders"""

ORACLES["safe_double"] = """
SELECT event_id, round(CASE WHEN event_id % 8 IN (4, 5) OR event_id % 7 IN (2, 5) THEN NULL
  WHEN event_id % 8 = 6 THEN NULL
  ELSE CASE WHEN event_id % 8 = 3 THEN -value ELSE value END * CASE WHEN event_id % 7 = 3 THEN 100 ELSE 1 END END, 6) AS number
FROM events"""

ORACLES["safe_timestamp"] = """
SELECT event_id, CASE event_id % 8
  WHEN 0 THEN date_trunc('second', ts) WHEN 1 THEN date_trunc('second', ts) WHEN 3 THEN date_trunc('day', ts)
  WHEN 6 THEN date_trunc('second', ts) + INTERVAL 250 MILLISECOND END AS moment FROM events"""

ORACLES["typed_core"] = f"""
SELECT ts AS transit_timestamp, 'Station ' || CAST(user_id AS VARCHAR) AS station_complex, event_type AS fare_class_category,
  CAST(NULL AS VARCHAR) AS payment_method, ridership, CAST(regexp_extract(props, '[0-9]+', 0) AS DOUBLE) AS transfers,
  round(lat, 9) AS latitude, round(lon, 9) AS longitude, year, month FROM {RIDES} AS r"""

ORACLES["coordinate_choice"] = f"""
SELECT collision_id, crash_date, round(lat, 9) AS lat, round(lon, 9) AS lon FROM {CHOSEN} AS c"""

ORACLES["cell_keys"] = f"""
SELECT collision_id, crash_date, {hex_key(8)} AS hex_r8, {hex_key(9)} AS hex_r9, {hex_key(10)} AS hex_r10 FROM {CHOSEN} AS c"""

ORACLES["cell_counts"] = f"""
SELECT hex_r8, COUNT(*) AS n FROM (SELECT {hex_key(8)} AS hex_r8 FROM {CHOSEN} AS c) AS k WHERE hex_r8 IS NOT NULL GROUP BY 1"""

ORACLES["partition_keys"] = f"SELECT {roles.month_parts('l_shipdate')}, COUNT(*) AS n FROM lineitem GROUP BY ALL"

ORACLES["curated_measures"] = f"SELECT * FROM {_vintage(2018)} AS v"

ORACLES["outer_merged_vintages"] = "SELECT geoid, " + ", ".join(
    f"{_bigint(f'{m}_{v}')} AS {m}_{v}"
    for v in (2018, 2023)
    for m in ("total_pop", "median_household_income", "median_gross_rent")
) + f" FROM {DEMOGRAPHICS} AS d"

ORACLES["stored_number_text"] = """
SELECT o_orderkey, TRUE AS plain, round(o_totalprice * o_orderkey, 2) AS read_back FROM orders"""

ORACLES["vintage_delta"] = f"""
SELECT geoid, {_bigint('total_pop_2018')} AS pop_2018, {_bigint('total_pop_2023')} AS pop_2023,
  {_bigint('total_pop_2023')} - {_bigint('total_pop_2018')} AS delta
FROM {DEMOGRAPHICS} AS d WHERE total_pop_2018 IS NOT NULL AND total_pop_2023 IS NOT NULL"""


def _share(part: str, whole: str, name: str) -> str:
    return f"round(({part}) / NULLIF({whole}, 0), 6) AS {name}"


ORACLES["demographic_rates"] = (
    "SELECT geoid, "
    + ", ".join(
        [
            _share("edu_bachelors_2023 + edu_masters_2023 + edu_professional_2023 + edu_doctorate_2023",
                   "edu_universe_25plus_2023", "bachelors_or_more"),
            _share("poverty_below_2023", "poverty_universe_2023", "poverty"),
            _share("housing_owner_occupied_2023", "housing_universe_2023", "owner_occupied"),
            _share("lang_lim_eng_spanish_2023 + lang_lim_eng_other_indo_european_2023"
                   " + lang_lim_eng_asian_pacific_island_2023 + lang_lim_eng_other_2023",
                   "lang_universe_2023", "limited_english"),
        ]
    )
    + f" FROM {DEMOGRAPHICS} AS d"
)

ORACLES["box_filter"] = f"""
SELECT {roles.month_parts('l_shipdate')}, COUNT(*) AS n FROM (SELECT * EXCLUDE (year) FROM {CRASHES} AS c0) AS c
WHERE lat BETWEEN 40.5 AND 40.8 AND lon BETWEEN -74.1 AND -73.8 GROUP BY ALL"""

_SOUTH, _NORTH, _WEST, _EAST = SMALL_BOX
ORACLES["laid_out_box"] = f"""
SELECT {roles.month_parts('l_shipdate')}, COUNT(*) AS n FROM (SELECT * EXCLUDE (year) FROM {CRASHES} AS c0) AS c
WHERE lat BETWEEN {_SOUTH} AND {_NORTH} AND lon BETWEEN {_WEST} AND {_EAST} GROUP BY ALL"""

# in whole numbers of 128 bits
_WHOLE = ", ".join(f"CAST({v.replace(' / ', ' // ')} AS HUGEINT) AS {n}" for n, v in EDGE_CORNERS.items())
ORACLES["slanted_edge_sides"] = f"""
SELECT l_linenumber, CAST(sign((x2 - x1) * (py - y1) - (y2 - y1) * (px - x1)) AS INT) AS side, COUNT(*) AS n
FROM (SELECT l_linenumber, {_WHOLE} FROM lineitem) AS e GROUP BY ALL"""

ORACLES["points_in_zones"] = f"""
SELECT collision_id, crash_date, locationid FROM {CHOSEN} AS p, {ZONES} AS z
WHERE lon > x0 AND lon < x1 AND lat > y0 AND lat < y1"""

ORACLES["crash_counts_by_tract"] = TRACT_COUNTS
ORACLES["crash_counts_by_tract_shuffled"] = TRACT_COUNTS

ORACLES["tract_matches_salted"] = f"""
SELECT geoid, year, COUNT(*) AS n FROM {CRASHES} AS p, {TRACTS} AS t WHERE {IN_TRACT} GROUP BY geoid, year"""

LINES = "[" + ", ".join(num(v) for v in ZONE_LINES) + "]"
LINE_SPOTS = f"""(SELECT ({LINES})[CAST(o_orderkey % {len(ZONE_LINES)} AS INT) + 1] AS lon,
  {num(40.4)} + CAST(o_custkey * 5381 % 9967 AS DOUBLE) / {num(9967)} * {num(0.6)} AS lat FROM orders)"""
ORACLES["line_point_counts"] = f"""
SELECT locationid, COUNT(*) AS n FROM {LINE_SPOTS} AS p, {ZONES} AS z
WHERE lon > x0 AND lon < x1 AND lat > y0 AND lat < y1 GROUP BY locationid"""

ORACLES["border_point_counts"] = f"""
SELECT locationid, COUNT(*) AS n FROM {LINE_SPOTS} AS p, {ZONES} AS z
WHERE lon BETWEEN x0 AND x1 AND lat BETWEEN y0 AND y1 GROUP BY locationid"""

ORACLES["zones_by_cover"] = ORACLES["points_in_zones"]
ORACLES["tract_matches_by_cover"] = ORACLES["tract_matches_salted"]

ORACLES["area_and_centroid"] = f"""
SELECT geoid, round(area, 9) AS area, round(lon, 9) AS cx, round(lat, 9) AS cy FROM {CENTROIDS} AS c"""

ORACLES["rebuilt_text"] = f"""
SELECT geoid, kind = 2 AS several_parts, CAST(CASE WHEN kind IN (1, 2) THEN 2 ELSE 1 END AS INT) AS n_rings,
  CAST(CASE kind WHEN 0 THEN 6 WHEN 3 THEN 4 ELSE 8 END AS INT) AS n_edges, round(area, 9) AS area FROM {CENTROIDS} AS c"""

ORACLES["zone_lookup"] = """
SELECT n_name AS zone, 'Region ' || CAST(n_regionkey AS VARCHAR) AS borough, COUNT(*) AS n,
  CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey GROUP BY 1, 2"""

ORACLES["tract_crash_rates"] = f"""
SELECT geoid, ntaname, crashes, pop, round(CAST(1000 AS DOUBLE) * crashes / NULLIF(pop, 0), 6) AS crashes_per_1k
FROM ({TRACT_COUNTS}) AS n
JOIN (SELECT geoid, {_bigint('total_pop_2023')} AS pop FROM {DEMOGRAPHICS} AS d0) AS d USING (geoid)
JOIN {TRACTS} AS t2 USING (geoid)"""

ORACLES["latest_per_station"] = """
SELECT user_id, event_id, event_type FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS place FROM events) AS e
WHERE place = 1"""

ORACLES["ordered_page"] = """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 1000 OFFSET 1000"""
