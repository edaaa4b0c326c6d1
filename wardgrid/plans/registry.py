"""Every report and operator as a named query over a folder of test tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from wardgrid.functions import clean
from wardgrid.functions.cells import add_cells
from wardgrid.functions.geometry import area, parse_rings, polygon_edges, polygon_moments, wkt_from_rings
from wardgrid.functions.orientation import turn
from wardgrid.operators import normalise, relational, wide
from wardgrid.operators.cover import points_in_cover
from wardgrid.operators.spatial import centroids, points_in_polygons, points_per_polygon
from wardgrid.plans import loads, published, reports
from wardgrid.plans.roles import REQUESTS_DATASET, RESPONSE_YEARS, WEST, WIDTH, X_BREAKS, Tables
from wardgrid.schemas import DATASETS, MEASURES, RESOLUTIONS, Dataset, Resource, ridership_schema, text_schema, with_partitions
from wardgrid.session import apply_settings, shared_folder
from wardgrid.sources import catalog, landing, layout, ledger, sinks, snapshots, tables
from wardgrid.sources.calendar import calendar_of
from wardgrid.streaming.ingest import read_streamed, stream_months

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

CRASH_YEAR = "2000"
AS_OF = date(2002, 1, 15)
PART_ROWS = 20
SMALL_BOX = (40.6, 40.7, -74.0, -73.9)
STORED_PLACE = StructType([StructField("lat", DoubleType()), StructField("lon", DoubleType())])
# an edge from a to b with odd steps that differ by -2, 0 or 2, and the whole-numbered point by its middle
_ACROSS = "(2 * (CAST(l_orderkey AS BIGINT) * 7919 % 1000003 * 17000003 + l_partkey % 17000003) + 1)"
_UP = f"({_ACROSS} + 2 * (l_linenumber % 3 - 1))"
_X, _Y = "(CAST(l_suppkey AS BIGINT) % 1000003 * 1000003)", "(CAST(l_partkey AS BIGINT) % 1000003 * 10007)"
EDGE_CORNERS = {
    "x1": _X,
    "y1": _Y,
    "x2": f"({_X} + {_ACROSS})",
    "y2": f"({_Y} + {_UP})",
    "px": f"({_X} + ({_ACROSS} - 1) / 2)",
    "py": f"({_Y} + ({_UP} - 1) / 2)",
}
PAGE_ROWS = 10_000
# every line between zones, and a place between every two lines
ZONE_LINES = sorted([WEST + b * WIDTH for b in X_BREAKS] + [WEST + (b + 0.03) * WIDTH for b in X_BREAKS[:-1]])
REQUEST_KINDS = {
    "unique_key": {"scalar"},
    "created_date": {"scalar"},
    "complaint_type": {"scalar"},
    "status": {"scalar"},
    "latitude": {"scalar"},
    "longitude": {"scalar"},
    "location": {"object", "latitude", "longitude"},
    "tags": {"list"},
    "channel": {"scalar"},
}


def query(build: Callable[[Tables], DataFrame]) -> Query:
    """Register `build` under its own name."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build(Tables(apply_settings(spark), sf_dir))

    run.__name__, run.__doc__ = build.__name__, build.__doc__
    QUERIES[build.__name__] = run
    return run


def rounded(df: DataFrame, digits: int, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(n, digits) for n in names})


# --- the reports --------------------------------------------------------------


@query
def rows_per_year_requests(t: Tables) -> DataFrame:
    return reports.rows_per_year(t.requests)


@query
def rows_per_year_collisions(t: Tables) -> DataFrame:
    return reports.rows_per_year(t.collisions)


@query
def top_coordinates(t: Tables) -> DataFrame:
    return reports.top_coordinates(t.collisions, CRASH_YEAR)


@query
def top_crash_zones(t: Tables) -> DataFrame:
    return reports.top_crash_zones(t.collisions, t.zones, CRASH_YEAR)


def typed_rides(t: Tables, cells: bool = False) -> DataFrame:
    """The landed ridership lines as the declared typed table, with cells only where asked."""
    data = DATASETS["ridership"]
    kinds = normalise.declared_kinds(["transit_timestamp", *data.text_columns, *data.float_columns, "georeference"])
    rows = loads.clean_records(normalise.parse_records(t.ridership_lines), data, kinds, cells)
    return normalise.to_declared(rows, with_partitions(ridership_schema()))


@query
def rows_per_year_ridership(t: Tables) -> DataFrame:
    return reports.rows_per_year(typed_rides(t))


@query
def busiest_stations(t: Tables) -> DataFrame:
    return rounded(reports.busiest_stations(typed_rides(t)), 4, "total_ridership")


@query
def busiest_cells(t: Tables) -> DataFrame:
    return reports.busiest_cells(typed_rides(t, cells=True))


@query
def stored_busiest_stations(t: Tables) -> DataFrame:
    """The same report over the stored table, of which it reads one month and two columns."""
    root = shared_folder(t.spark, "rides")
    sinks.replace_months(typed_rides(t).drop(*[f"hex_r{r}" for r in RESOLUTIONS]), root)
    stored = tables.read_months(t.spark, root, ridership_schema())
    return rounded(reports.busiest_stations(stored), 4, "total_ridership")


@query
def zone_count(t: Tables) -> DataFrame:
    return reports.row_count(t.zones)


@query
def tract_count(t: Tables) -> DataFrame:
    return reports.row_count(t.tracts)


@query
def largest_zones(t: Tables) -> DataFrame:
    return rounded(reports.largest_zones(t.zones), 9, "area_sqdeg")


@query
def crashes_per_tract(t: Tables) -> DataFrame:
    return reports.crashes_per_tract(t.collisions, t.tracts, CRASH_YEAR)


@query
def zone_tract_crosswalk(t: Tables) -> DataFrame:
    return reports.zone_tract_crosswalk(t.zones, t.tracts)


@query
def demographics_count(t: Tables) -> DataFrame:
    return reports.row_count(t.demographics)


@query
def income_summary(t: Tables) -> DataFrame:
    return reports.measure_summary(t.demographics)


@query
def top_income_change(t: Tables) -> DataFrame:
    return reports.top_income_change(t.demographics, t.tracts)


@query
def crashes_per_1k(t: Tables) -> DataFrame:
    return rounded(reports.crashes_per_1k(t.collisions, t.tracts, t.demographics, CRASH_YEAR), 6, "crashes_per_1k")


@query
def fatal_collisions(t: Tables) -> DataFrame:
    return reports.fatal_collisions(t.collisions, CRASH_YEAR).select(
        "collision_id", "crash_date", "borough", "number_of_persons_killed", "year", "month"
    )


# --- sources ------------------------------------------------------------------


@query
def json_landing_range(t: Tables) -> DataFrame:
    """Landed JSON files read by schema, bounded by a half-open year on the date text."""
    root = shared_folder(t.spark, "landing")
    t.all_request_lines.write.text(root)
    declared = text_schema("unique_key", "created_date", "status")
    rows = landing.in_range(
        landing.read_records(t.spark, root, declared),
        "created_date",
        "1996-01-01T00:00:00.000",
        "1999-01-01T00:00:00.000",
    )
    return relational.count_by(normalise.with_partition_keys(rows, "created_date"), "year", "month", "status")


@query
def month_calendar(t: Tables) -> DataFrame:
    return calendar_of(t.raw("orders"), "o_orderdate").select(
        "year",
        "month",
        F.date_format("start", "yyyy-MM-dd").alias("first_day"),
        F.date_format("end", "yyyy-MM-dd").alias("next_first_day"),
        "closed",
    )


@query
def header_row_response(t: Tables) -> DataFrame:
    rows = wide.header_rows(t.responses(2018), ["state", "county", "tract", "B01003_001E", "B25064_001E"])
    return rows.withColumnsRenamed({"B01003_001E": "people", "B25064_001E": "rent"})


@query
def response_files(t: Tables) -> DataFrame:
    """Header-row responses landed as files of two vintages, all read by one multi-path read."""
    folders = [shared_folder(t.spark, f"responses-{v}") for v in RESPONSE_YEARS]
    for folder, vintage in zip(folders, RESPONSE_YEARS, strict=True):
        t.responses(vintage).write.option("maxRecordsPerFile", 1).text(folder)
    rows = wide.header_rows(landing.read_responses(t.spark, folders), ["state", "county", "tract"])
    return relational.count_by(rows, "state", "county")


def record_arrays(rows: DataFrame, page_rows: int) -> DataFrame:
    """`value`: JSON arrays of the records of a month, of about `page_rows` each. Salts number the rows, so
    neither a crowded month nor a repeated key makes a page larger."""
    months = rows.groupBy("year", "month").agg(F.ceil(F.count(F.lit(1)) / page_rows).alias("_pages"))
    numbered = rows.withColumn("_row", F.monotonically_increasing_id()).alias("r").join(months.alias("m"), same_month("r", "m"))
    salted = numbered.select("r.*", F.pmod(F.xxhash64("_row"), F.col("_pages")).alias("_page"))
    pages = salted.groupBy("year", "month", "_page").agg(F.to_json(F.collect_list(F.struct("unique_key", "status"))).alias("value"))
    return pages.select("value")


def same_month(left: str, right: str) -> Column:
    return F.col(f"{left}.year").eqNullSafe(F.col(f"{right}.year")) & F.col(f"{left}.month").eqNullSafe(F.col(f"{right}.month"))


@query
def record_pages(t: Tables) -> DataFrame:
    """Files that hold one JSON array of records each, as one line per record."""
    folder = shared_folder(t.spark, "pages")
    record_arrays(t.requests, PAGE_ROWS).write.option("maxRecordsPerFile", 1).text(folder)
    lines = landing.read_pages(t.spark, folder)
    return relational.count_by(lines.select(F.get_json_object("value", "$.status").alias("status")), "status")


@query
def month_spot_check(t: Tables) -> DataFrame:
    """One stored month: its rows, its cell columns and how many rows the head shows."""
    root = shared_folder(t.spark, "requests")
    rows = normalise.with_record_cells(t.requests.select("unique_key", "year", "month", F.col("true_lat").alias("latitude"), F.col("true_lon").alias("longitude")))
    sinks.replace_months(rows, root)
    seen = tables.spot_check(t.spark, root, "1997", "03")
    return seen.head.groupBy().agg(
        F.lit(seen.rows).alias("rows"), F.lit(",".join(seen.cell_columns)).alias("cells"), F.count("hex_r8").alias("head")
    )


@query
def stacked_counties(t: Tables) -> DataFrame:
    """All counties of both vintages from one stacked set of responses."""
    stacked = relational.union_resources(*[t.responses(v) for v in RESPONSE_YEARS])
    rows = wide.in_counties(wide.header_rows(stacked, ["state", "county"]), counties=["005", "061", "085"])
    return relational.count_by(rows, "county")


def stored_requests(t: Tables) -> tuple[str, DataFrame]:
    """The requests written by month, and the columns they were written with."""
    root = shared_folder(t.spark, "requests")
    rows = t.requests.select("unique_key", "created_date", "complaint_type", "status", "year", "month")
    sinks.replace_months(rows, root)
    return root, rows


STORED_REQUEST = text_schema("unique_key", "created_date", "complaint_type", "status", "agency")


@query
def partitioned_scan(t: Tables) -> DataFrame:
    """One year of a month-partitioned table; a column that no file has is NULL."""
    root, _ = stored_requests(t)
    rows = tables.read_months(t.spark, root, STORED_REQUEST).where(F.col("year") == "1997")
    return rows.groupBy("year", "month").agg(
        F.count(F.lit(1)).alias("n"), F.count("agency").alias("n_agency"), F.min("created_date").alias("first")
    )


@query
def partition_spot_read(t: Tables) -> DataFrame:
    root, _ = stored_requests(t)
    return tables.read_month(t.spark, root, STORED_REQUEST, "1997", "03").select(
        "unique_key", "complaint_type", "year", "month"
    )


@query
def reference_table(t: Tables) -> DataFrame:
    """A polygon table written as one replaceable unpartitioned table and read back."""
    path = shared_folder(t.spark, "tracts")
    sinks.replace_table(t.tracts, path)
    sinks.replace_table(t.tracts, path)
    stored = tables.read_table(t.spark, path, text_schema("geoid", "boroname", "ntaname", "geometry_wkt"))
    return relational.count_by(stored, "boroname")


@query
def union_resources(t: Tables) -> DataFrame:
    """Two resources with different columns as one table."""
    parts = [normalise.parse_records(lines) for lines in t.request_lines.values()]
    kinds = {k: v for k, v in REQUEST_KINDS.items() if k != "channel"}
    both = relational.union_resources(
        normalise.text_columns(parts[0], kinds), normalise.text_columns(parts[1], REQUEST_KINDS)
    )
    keyed = normalise.with_partition_keys(both, "created_date")
    return keyed.groupBy("year").agg(F.count(F.lit(1)).alias("n"), F.count("channel").alias("n_channel"))


@query
def repeated_keys(t: Tables) -> DataFrame:
    """The duplicate guard on two resources that overlap by a year."""
    rows = t.requests.select("unique_key", "year")
    both = relational.union_resources(rows.where("year <= '1999'"), rows.where("year >= '1999'"))
    return relational.repeated_keys(both, ["unique_key"])


@query
def reprojected_polygons(t: Tables) -> DataFrame:
    """State-plane polygons with mixed-case names to the stored form in degrees."""
    stored = landing.polygon_table(t.tracts_in_feet, "shape", 2263)
    places = centroids(stored).select("geoid", "ntaname", "centroid_lon", "centroid_lat")
    return rounded(places, 6, "centroid_lon", "centroid_lat")


# --- sinks, catalog, load state -----------------------------------------------


@query
def replace_month_partitions(t: Tables) -> DataFrame:
    """A second write of one year replaces its months and leaves the others."""
    root, rows = stored_requests(t)
    again = rows.where(F.col("year") == "1998").withColumn("status", F.lit("again"))
    sinks.replace_months(again, root)
    return relational.count_by(tables.read_months(t.spark, root, STORED_REQUEST), "year", "month", "status")


@query
def page_parts(t: Tables) -> DataFrame:
    """Months cut into files of bounded rows: rows per month, whether a file exceeds the bound,
    and whether there are as many files as that takes."""
    root = shared_folder(t.spark, "parts")
    sinks.replace_months(t.collisions.select("collision_id", "crash_date", "year", "month"), root, rows_per_file=PART_ROWS)
    stored = tables.read_months(t.spark, root, text_schema("collision_id", "crash_date"))
    files = stored.withColumn("_file", F.input_file_name()).groupBy("year", "month", "_file").count()
    return files.groupBy("year", "month").agg(
        F.sum("count").alias("n"),
        F.max(F.col("count") > PART_ROWS).alias("exceeded"),
        (F.count("*") >= F.ceil(F.sum("count") / PART_ROWS)).alias("enough"),
    )


@query
def registered_months(t: Tables) -> DataFrame:
    """An external table that sees its months after discovery, read with SQL."""
    root, _ = stored_requests(t)
    name = "requests_" + root.rsplit("-", 1)[1]
    catalog.register_months(t.spark, name, STORED_REQUEST, root)
    catalog.discover_partitions(t.spark, name)
    return t.spark.sql(f"SELECT year, COUNT(*) AS n FROM {name} WHERE year >= '1997' GROUP BY year")


@query
def crosswalk_table(t: Tables) -> DataFrame:
    """The crosswalk stored by CREATE TABLE AS SELECT and read back by name."""
    path = shared_folder(t.spark, "crosswalk")
    name = "crosswalk_" + path.rsplit("-", 1)[1]
    catalog.create_table_as(t.spark, name, reports.zone_tract_crosswalk(t.zones, t.tracts), path)
    return t.spark.sql(f"SELECT zone_id, borough, COUNT(*) AS tracts FROM {name} GROUP BY zone_id, borough")


@query
def pending_months(t: Tables) -> DataFrame:
    """Calendar months that a ledger does not hold as done: open in the last entry, or never loaded."""
    months = relational.count_by(t.requests, "year", "month", count="rows")
    at = F.to_timestamp(F.concat_ws("-", "year", "month", F.lit("01")))
    entries = months.select(
        F.lit("requests").alias("dataset"),
        "year",
        "month",
        F.when(F.col("month") == "06", "open").otherwise("loaded").alias("status"),
        "rows",
        at.alias("recorded_at"),
    ).where(F.col("year") != "1999")
    reopened = entries.where(F.col("month") == "02").withColumns(
        {"status": F.lit("open"), "recorded_at": F.col("recorded_at") + F.expr("interval 1 day")}
    )
    calendar = calendar_of(t.raw("orders"), "o_orderdate")
    return ledger.pending_months(calendar, entries.union(reopened), "requests").select("year", "month")


@query
def month_load(t: Tables) -> DataFrame:
    """A whole load from landed lines of two resources, then a second one that finds nothing to do."""
    root, book = shared_folder(t.spark, "load"), shared_folder(t.spark, "ledger")
    for _ in range(2):
        loads.load_months(t.spark, t.request_lines, REQUESTS_DATASET, root, book, AS_OF, REQUEST_KINDS)
    stored = tables.read_months(t.spark, root, text_schema("unique_key", "channel", "tags", "hex_r8", "hex_r10"))
    return stored.groupBy("year", "month").agg(
        F.count(F.lit(1)).alias("n"),
        F.count("channel").alias("n_channel"),
        F.count("tags").alias("n_tags"),
        F.count("hex_r8").alias("n_placed"),
    )


@query
def load_states(t: Tables) -> DataFrame:
    """The ledger after a load: loaded, empty and open months with their rows."""
    root, book = shared_folder(t.spark, "load"), shared_folder(t.spark, "ledger")
    loads.load_months(t.spark, t.request_lines, REQUESTS_DATASET, root, book, AS_OF, REQUEST_KINDS)
    return ledger.month_states(ledger.read_ledger(t.spark, book), "requests").select("year", "month", "status", "rows")


def request_dataset(first: int, last: int) -> Dataset:
    """Requests of one resource, `all`."""
    return Dataset("requests", "created_date", "unique_key", (Resource("all", first, last),))


def plain_requests(t: Tables, *columns: Column) -> DataFrame:
    """Requests as JSON lines of a key, a date and `columns`."""
    return t.requests.select(F.to_json(F.struct("unique_key", "created_date", *columns)).alias("value"))


PLAIN = {"unique_key": {"scalar"}, "created_date": {"scalar"}}


@query
def refused_lines(t: Tables) -> DataFrame:
    """Every landed line is stored, or kept with the reason why not."""
    root, book, refused = (shared_folder(t.spark, p) for p in ("load", "ledger", "refused"))
    key = F.col("unique_key").cast("bigint")
    dated = t.requests.withColumn("created_date", F.when(key % 50 == 0, "soon").otherwise(F.col("created_date")))
    line = F.when(key % 53 == 0, '{"broken"').otherwise(F.to_json(F.struct("unique_key", "created_date")))
    loads.load_months(t.spark, {"all": dated.select(line.alias("value"))}, request_dataset(1994, 1996), root, book, AS_OF, PLAIN, refused_path=refused)
    kept = t.spark.read.schema("resource string, reason string, text string").parquet(refused).select("reason")
    stored = tables.read_months(t.spark, root, text_schema("unique_key")).select(F.lit("stored").alias("reason"))
    return relational.count_by(kept.unionByName(stored), "reason")


@query
def emptied_month(t: Tables) -> DataFrame:
    """A month whose rows left the landing folder loses its stored rows; the others stay."""
    root, book = shared_folder(t.spark, "load"), shared_folder(t.spark, "ledger")
    data = request_dataset(1995, 1996)
    lines = plain_requests(t)
    left = lines.where(~F.get_json_object("value", "$.created_date").startswith("1996-12"))
    loads.load_months(t.spark, {"all": lines}, data, root, book, date(1996, 12, 15), PLAIN)
    loads.load_months(t.spark, {"all": left}, data, root, book, date(1997, 2, 1), PLAIN)
    states = ledger.month_states(ledger.read_ledger(t.spark, book), "requests").select("year", "month", "status", "rows")
    stored = relational.count_by(tables.read_months(t.spark, root, text_schema("unique_key")), "year", "month")
    return states.join(stored, ["year", "month"], "left").withColumn("n", F.coalesce("n", F.lit(0)))


@query
def resources_apart(t: Tables) -> DataFrame:
    """Each resource loaded alone, in both orders, and both together: rows stored and months recorded."""
    out = None
    for name, turns in (("joint", [("archive", "recent")]), ("older first", [("archive",), ("recent",)]), ("newer first", [("recent",), ("archive",), ("recent",)])):
        root, book = shared_folder(t.spark, "load"), shared_folder(t.spark, "ledger")
        for names in turns:
            loads.load_months(t.spark, {n: t.request_lines[n] for n in names}, REQUESTS_DATASET, root, book, AS_OF, REQUEST_KINDS, cells=False)
        states = ledger.month_states(ledger.read_ledger(t.spark, book), "requests").select("resource", "year", "month", "status")
        stored = relational.count_by(tables.read_months(t.spark, root, text_schema("unique_key")), "year", "month")
        found = states.join(stored, ["year", "month"], "full").groupBy("resource", "status").agg(F.count("*").alias("months"), F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
        found = found.select(F.lit(name).alias("way"), "*")
        out = found if out is None else out.unionByName(found)
    return out


def land(rows: DataFrame, folder: str) -> None:
    """More landed files, each with a run of keys, whatever their months."""
    files = max(4, rows.sparkSession.sparkContext.defaultParallelism)
    ordered = rows.repartitionByRange(files, F.col("unique_key").cast("bigint"))
    ordered.select(F.to_json(F.struct("unique_key", "created_date", "status")).alias("value")).write.mode("append").text(folder)


def publish_drops(t: Tables, *drops: tuple[DataFrame, date]) -> tuple[str, list[published.Published]]:
    """Drops landed one after another, each followed by a published load as of its day."""
    root, folder = shared_folder(t.spark, "published"), shared_folder(t.spark, "landing")
    reports_ = []
    for rows, day in drops:
        land(rows, folder)
        reports_.append(published.publish_months(t.spark, {"all": folder}, request_dataset(1995, 2002), root, day, PLAIN | {"status": {"scalar"}}, cells=False))
    return root, reports_


def late_drops(t: Tables) -> list[tuple[DataFrame, date]]:
    """Most requests to 1998; then all from 1999 on, with rows of 1995 that come late and others of it changed."""
    number, year = F.col("unique_key").cast("bigint"), F.col("year")
    late = (year == "1995") & (number % 11 == 0)
    changed = t.requests.where((year == "1995") & (number % 11 == 1)).withColumn("status", F.lit("changed"))
    return [
        (t.requests.where((year < "1999") & ~late), date(1999, 1, 15)),
        (t.requests.where((year >= "1999") | late).unionByName(changed), AS_OF),
    ]


@query
def published_months(t: Tables) -> DataFrame:
    """The table and the state of its months after a published load and one with late rows: all in one snapshot."""
    root, _ = publish_drops(t, *late_drops(t))
    rows = snapshots.read_snapshot(t.spark, root, text_schema("unique_key", "created_date", "status"))
    counted = rows.groupBy("year", "month").agg(F.countDistinct("unique_key").alias("n"), F.count_if(F.col("status") == "changed").alias("changed"))
    return published.month_states(t.spark, root).select("year", "month", "status", "rows").join(counted, ["year", "month"], "left")


@query
def late_rows(t: Tables) -> DataFrame:
    """What each of two loads took in, how many rows were late, and whether files of untouched months stayed."""
    root, done = publish_drops(t, *late_drops(t))
    first, second = (snapshots.read_part(t.spark, root, v, "files", snapshots.FILES) for v in (1, 2))
    stayed = second.join(first, "path", "left_semi").agg(F.sum(F.when(F.col("year") != "1995", F.col("rows"))).alias("rows_stayed"))
    taken = t.spark.range(2).select((F.col("id") + 1).cast("int").alias("load"), *[
        F.element_at(F.array(*[F.lit(getattr(d, n)).cast("bigint") for d in done]), (F.col("id") + 1).cast("int")).alias(n) for n in ("lines", "taken", "late")
    ])
    return taken.join(stayed.withColumn("load", F.lit(2)), "load", "left")


@query
def earlier_version(t: Tables) -> DataFrame:
    """A snapshot stays readable after the next load: rows per year as of the first, with one month's files only."""
    root, _ = publish_drops(t, *late_drops(t))
    rows = snapshots.read_snapshot(t.spark, root, text_schema("unique_key"), version=1, months=F.col("month") == "03")
    return relational.count_by(rows, "year", "month")


@query
def landed_once(t: Tables) -> DataFrame:
    """Records that landed in two files are stored once."""
    root, book = shared_folder(t.spark, "load"), shared_folder(t.spark, "ledger")
    lines = plain_requests(t)
    loads.load_months(t.spark, {"all": lines.union(lines)}, request_dataset(1992, 1999), root, book, AS_OF, PLAIN)
    return relational.count_by(tables.read_months(t.spark, root, text_schema("unique_key")), "year")


@query
def mixed_location_forms(t: Tables) -> DataFrame:
    """Nested, flat and doubled coordinates in one table, with keys discovered and declared."""
    form = F.col("unique_key").cast("bigint") % 3
    nested = F.when(form != 1, F.struct(F.col("true_lat").alias("latitude"), F.col("true_lon").alias("longitude")))
    lat, lon = (F.when(form != 0, F.col(c).cast("string")).alias(f"location_{a}") for c, a in (("true_lat", "latitude"), ("true_lon", "longitude")))
    lines = plain_requests(t, nested.alias("location"), lat, lon, form.cast("string").alias("form"))
    records = normalise.parse_records(lines)
    declared = normalise.declared_kinds(["unique_key", "created_date", "form", "location_latitude", "location_longitude"])
    out = None
    for name, kinds in (("discovered", normalise.key_kinds(records)), ("declared", declared)):
        rows = normalise.with_record_cells(normalise.text_columns(records, kinds)).withColumn("keys", F.lit(name))
        found = rows.groupBy("keys", "form").agg(F.count("*").alias("n"), F.count("location_latitude").alias("n_latitude"), F.count("hex_r8").alias("n_placed"))
        out = found if out is None else out.unionByName(found)
    return out


@query
def drifting_keys(t: Tables) -> DataFrame:
    """Keys that differ in case are one column, of repeated keys the last counts, numbers keep plain notation."""
    key = F.col("unique_key").cast("bigint")
    name = F.when(key % 2 == 0, "Status").otherwise("status")
    amount = F.concat((key % 5).cast("string"), F.when(key % 3 == 0, ".0").otherwise("e10"))
    line = F.concat(F.lit('{"'), name, F.lit('": "'), F.col("status"), F.lit('", "n": 0, "n": '), amount, F.lit(', "a\'b\\"c": 1}'))
    records = normalise.parse_records(t.requests.select(line.alias("value")))
    rows = normalise.text_columns(records, normalise.key_kinds(records))
    return rows.groupBy(F.col("Status").alias("status_text"), F.col("n").alias("amount")).agg(F.count("`a'b\"c`").alias("rows"))


@query
def dry_run_preview(t: Tables) -> DataFrame:
    """Rows per month that a load would write."""
    book = shared_folder(t.spark, "ledger")
    return loads.preview_load(t.spark, t.request_lines, REQUESTS_DATASET, book, AS_OF, REQUEST_KINDS).months


@query
def resumed_stream(t: Tables) -> DataFrame:
    """Landed files streamed into months by three runs: the first drop, nothing
    new, and a second drop."""
    land, root, check = (shared_folder(t.spark, p) for p in ("land", "stream", "state"))
    data = DATASETS["ridership"]
    kinds = normalise.declared_kinds(["transit_timestamp", *data.text_columns, *data.float_columns])
    lines = t.ridership_lines
    is_view = F.get_json_object("value", "$.fare_class_category") == "view"
    lines.where(~is_view).write.text(land)
    stream_months(t.spark, land, data, root, check, kinds).awaitTermination()
    stream_months(t.spark, land, data, root, check, kinds).awaitTermination()
    lines.where(is_view).write.mode("append").text(land)
    stream_months(t.spark, land, data, root, check, kinds).awaitTermination()
    rows = read_streamed(t.spark, root, ridership_schema())
    days = rows.groupBy("year", "month", F.date_format("transit_timestamp", "dd").alias("day"))
    return rounded(
        days.agg(F.count(F.lit(1)).alias("n"), F.sum("ridership").alias("total")), 4, "total"
    )


@query
def streamed_once(t: Tables) -> DataFrame:
    """Two drops that overlap by a year, some records of it changed: rows stored, and the latest of each key."""
    land, root, check = (shared_folder(t.spark, p) for p in ("land", "stream", "state"))
    data = request_dataset(1992, 2002)
    year = F.substring("created_date", 1, 4)
    changed = (year == "1998") & (F.col("unique_key").cast("bigint") % 7 == 0)
    drops = [t.requests.where(year <= "1998"), t.requests.where(year >= "1998").withColumn("status", F.when(changed, "changed").otherwise(F.col("status")))]
    for rows in drops:
        rows.select(F.to_json(F.struct("unique_key", "created_date", "status")).alias("value")).write.mode("append").text(land)
        stream_months(t.spark, land, data, root, check, PLAIN | {"status": {"scalar"}}, cells=False, remember="90 days").awaitTermination()
    schema = text_schema("unique_key", "created_date", "status")
    stored = relational.count_by(read_streamed(t.spark, root, schema), "year", count="stored")
    latest = read_streamed(t.spark, root, schema, data).groupBy("year").agg(F.count("*").alias("n"), F.count_if(F.col("status") == "changed").alias("changed"))
    return stored.join(latest, "year")


# --- columns ------------------------------------------------------------------


@query
def text_records(t: Tables) -> DataFrame:
    """Keys found in the records, everything as text: hoisted, listed, absent and empty values."""
    records = normalise.parse_records(t.all_request_lines)
    rows = normalise.text_columns(records, normalise.key_kinds(records))
    shown = rows.select(
        "unique_key",
        "created_date",
        "channel",
        "tags",
        (F.col("latitude") == "").alias("blank_latitude"),
        clean.safe_double("location_latitude").alias("hoisted_latitude"),
        F.lit(len(rows.columns)).alias("n_columns"),
    )
    return rounded(shown, 6, "hoisted_latitude")


@query
def landed_keys(t: Tables) -> DataFrame:
    return normalise.landed_keys(normalise.parse_records(t.all_request_lines))


@query
def undeclared_keys(t: Tables) -> DataFrame:
    """Drift: landed keys that the declared table does not show, with the rows that hold them."""
    records = normalise.parse_records(t.all_request_lines)
    entries = records.lateralJoin(t.spark.tvf.variant_explode(F.col("record").outer()))
    counts = relational.count_by(entries, "key")
    return counts.where(~F.col("key").isin(*REQUESTS_DATASET.text_columns))


@query
def nested_json_text(t: Tables) -> DataFrame:
    """Nested values as JSON text in the typed form, nothing hoisted."""
    records = normalise.parse_records(t.ridership_lines)
    data = DATASETS["ridership"]
    rows = normalise.typed_core(records, normalise.key_kinds(records), data.date_column, data.float_columns)
    return rows.select(
        "station_complex",
        "transit_timestamp",
        F.get_json_object("georeference", "$.type").alias("kind"),
        (F.size(F.from_json("georeference", "coordinates array<string>")["coordinates"])).alias("n_coordinates"),
    )


@query
def stringified(t: Tables) -> DataFrame:
    """A typed table with a nested object and a list as text columns."""
    o = t.raw("orders")
    typed = o.select(
        "o_orderkey",
        "o_custkey",
        "o_orderstatus",
        F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("price"),
        F.struct(F.col("o_totalprice").alias("latitude"), F.lit("x").alias("other")).alias("at"),
        F.array("o_orderkey", "o_custkey").alias("keys"),
    )
    text = normalise.stringify_all(typed)
    return text.select(
        "o_orderkey", "o_custkey", "keys",
        clean.safe_double("price").alias("price"),
        clean.safe_double("at_latitude").alias("at_latitude"),
        F.lit(len(text.columns)).alias("n_columns"),
    )


@query
def safe_double(t: Tables) -> DataFrame:
    """Dirty number texts: only plain numbers survive."""
    e = t.raw("events")
    text = F.concat(
        F.element_at(F.array(*[F.lit(p) for p in ("", " ", "+", "-", "x", "1_", ".", "")]), (e.event_id % 8 + 1).cast("int")),
        e.value.cast("string"),
        F.element_at(F.array(*[F.lit(p) for p in ("", "  ", "d", "e2", " ", "%", "")]), (e.event_id % 7 + 1).cast("int")),
    )
    return e.select("event_id", text.alias("v")).select("event_id", F.round(clean.safe_double("v"), 6).alias("number"))


@query
def safe_timestamp(t: Tables) -> DataFrame:
    """Dirty timestamp texts: ISO texts survive, a trailing Z is dropped without a shift."""
    e = t.raw("events")
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    forms = [iso, F.concat(iso, F.lit("Z")), F.substring(iso, 1, 7), F.substring(iso, 1, 10), F.lit(""), F.lit("soon"),
             F.concat(F.lit("  "), iso, F.lit(".250 ")), F.concat(iso, F.lit("+05:00"))]
    text = F.element_at(F.array(*forms), (e.event_id % 8 + 1).cast("int"))
    return e.select("event_id", text.alias("v")).select("event_id", clean.safe_timestamp("v").alias("moment"))


@query
def typed_core(t: Tables) -> DataFrame:
    rows = typed_rides(t)
    return rows.select(
        "transit_timestamp", "station_complex", "fare_class_category", "payment_method", "ridership", "transfers",
        F.round("latitude", 9).alias("latitude"), F.round("longitude", 9).alias("longitude"), "year", "month",
    )


@query
def coordinate_choice(t: Tables) -> DataFrame:
    """The first valid pair of each crash record, counted by its borough and source."""
    placed = normalise.with_coordinates(t.collisions)
    return rounded(placed.select("collision_id", "crash_date", "lat", "lon"), 9, "lat", "lon")


@query
def cell_keys(t: Tables) -> DataFrame:
    rows = normalise.with_record_cells(t.collisions)
    return rows.select("collision_id", "crash_date", *[f"hex_r{r}" for r in RESOLUTIONS])


@query
def partition_keys(t: Tables) -> DataFrame:
    rows = t.raw("lineitem").select("l_shipdate", "l_orderkey")
    return relational.count_by(normalise.with_partition_keys(rows, "l_shipdate"), "year", "month")


@query
def curated_measures(t: Tables) -> DataFrame:
    """Key, rename, number, sentinel: one clean vintage."""
    return t.measures(2018).select("geoid", *MEASURES.values())


@query
def outer_merged_vintages(t: Tables) -> DataFrame:
    """Both vintages side by side as stored; keys of either one stay."""
    stored = t.demographics
    return stored.select(
        "geoid",
        *[
            clean.safe_bigint(f"{m}_{v}").alias(f"{m}_{v}")
            for v in RESPONSE_YEARS
            for m in ("total_pop", "median_household_income", "median_gross_rent")
        ],
    )


@query
def stored_number_text(t: Tables) -> DataFrame:
    """Doubles as plain text: no exponent, and a point in every number."""
    p = t.raw("orders").select("o_orderkey", (F.col("o_totalprice") * F.col("o_orderkey")).alias("v"))
    text = p.select("o_orderkey", "v", clean.number_text("v").alias("s"))
    return text.select(
        "o_orderkey", (~F.col("s").contains("E") & F.col("s").contains(".")).alias("plain"),
        F.round(F.col("s").cast("double"), 2).alias("read_back"),
    )


@query
def vintage_delta(t: Tables) -> DataFrame:
    """The change of one measure for every key with both vintages."""
    both = t.demographics.select(
        "geoid", *[clean.safe_bigint(f"total_pop_{v}").alias(f"pop_{v}") for v in RESPONSE_YEARS]
    ).where(F.col("pop_2018").isNotNull() & F.col("pop_2023").isNotNull())
    return relational.difference(both, "pop_2023", "pop_2018")


@query
def demographic_rates(t: Tables) -> DataFrame:
    return rounded(
        wide.demographic_rates(t.demographics, 2023), 6, "bachelors_or_more", "poverty", "owner_occupied", "limited_english"
    )


# --- filters, joins, aggregates ------------------------------------------------


def _places(t: Tables) -> DataFrame:
    return clean.computed_once(
        t.collisions.select("collision_id", "year", "month", "latitude", "longitude"),
        lat=clean.safe_double("latitude"),
        lon=clean.safe_double("longitude"),
    ).drop("latitude", "longitude")


@query
def box_filter(t: Tables) -> DataFrame:
    """Crash places inside an inclusive box, by month."""
    return relational.count_by(_places(t).where(clean.in_box(F.col("lat"), F.col("lon"), 40.5, 40.8, -74.1, -73.8)), "year", "month")


@query
def laid_out_box(t: Tables) -> DataFrame:
    """Crash places inside a small box, by month, from a table that is stored in the order of places."""
    root = shared_folder(t.spark, "places")
    layout.replace_months_by_place(_places(t).select("lat", "lon", "year", "month"), root, "lat", "lon")
    stored = tables.read_months(t.spark, root, STORED_PLACE)
    return relational.count_by(stored.where(clean.in_box(F.col("lat"), F.col("lon"), *SMALL_BOX)), "year", "month")


@query
def slanted_edge_sides(t: Tables) -> DataFrame:
    """Sides of points half-way along long slanted edges, on them or off by less than plain doubles can tell."""
    rows = t.sql("SELECT * FROM {lineitem}").select("l_linenumber", *[F.expr(f"CAST({v} AS DOUBLE)").alias(n) for n, v in EDGE_CORNERS.items()])
    side = F.signum(turn(*[F.col(n) for n in EDGE_CORNERS])).cast("int")
    return relational.count_by(rows.withColumn("side", side), "l_linenumber", "side")


@query
def points_in_zones(t: Tables) -> DataFrame:
    """Every crash with the zone that contains it."""
    c = normalise.with_coordinates(t.collisions)
    return points_in_polygons(c, t.zones, ["locationid"], "lon", "lat").select("collision_id", "crash_date", "locationid")


@query
def crash_counts_by_tract(t: Tables) -> DataFrame:
    return points_per_polygon(_places(t), t.tracts, ["geoid"], "lon", "lat", count="crashes")


@query
def crash_counts_by_tract_shuffled(t: Tables) -> DataFrame:
    """The same with a cover over its broadcast limit: pre-counted places and salted cells."""
    return points_per_polygon(
        _places(t), t.tracts, ["geoid"], "lon", "lat", broadcast_bytes=0, hot_cell_rows=1000, count="crashes"
    )


@query
def tract_matches_salted(t: Tables) -> DataFrame:
    """Rows, not counts, through the shuffled join with a third of all points on one spot."""
    met = points_in_polygons(_places(t), t.tracts, ["geoid"], "lon", "lat", broadcast_bytes=0, hot_cell_rows=1000)
    return relational.count_by(met, "geoid", "year")


def _line_spots(t: Tables) -> DataFrame:
    xs = F.array(*[F.lit(v) for v in ZONE_LINES])
    return t.sql("SELECT * FROM {orders}").select(
        xs[(F.col("o_orderkey") % len(ZONE_LINES)).cast("int")].alias("lon"),
        (F.lit(40.4) + (F.col("o_custkey") * 5381 % 9967) / F.lit(9967.0) * F.lit(0.6)).alias("lat"),
    )


@query
def line_point_counts(t: Tables) -> DataFrame:
    """Points on the lines between zones: on an upright line inside neither, elsewhere inside one."""
    return points_per_polygon(_line_spots(t), t.zones, ["locationid"], "lon", "lat")


@query
def zones_by_cover(t: Tables) -> DataFrame:
    """Crashes with their zones, most of them told by a cell that lies inside as a whole."""
    c = normalise.with_coordinates(t.collisions)
    return points_in_cover(c, t.zones, ["locationid"], "lon", "lat").select("collision_id", "crash_date", "locationid")


@query
def tract_matches_by_cover(t: Tables) -> DataFrame:
    """Slanted edges and holes; the cover is over its broadcast limit, and a third of all points is on one spot."""
    met = points_in_cover(_places(t), t.tracts, ["geoid"], "lon", "lat", broadcast_bytes=0, hot_cell_rows=1000)
    return relational.count_by(met, "geoid", "year")


@query
def border_point_counts(t: Tables) -> DataFrame:
    """Points on the lines between zones, borders included: on an upright line they are in both."""
    return relational.count_by(points_in_cover(_line_spots(t), t.zones, ["locationid"], "lon", "lat", boundary=True), "locationid")


@query
def area_and_centroid(t: Tables) -> DataFrame:
    m = polygon_moments(parse_rings(F.col("geometry_wkt")))
    rows = t.tracts.select("geoid", m.alias("m")).select(
        "geoid", F.col("m.area").alias("area"), F.col("m.cx").alias("cx"), F.col("m.cy").alias("cy")
    )
    return rounded(rows, 9, "area", "cx", "cy")


@query
def rebuilt_text(t: Tables) -> DataFrame:
    """WKT built from vertices: parts, rings, edges and area survive the round trip."""
    texts = clean.computed_once(t.tracts.select("geoid", "geometry_wkt"), wkt=wkt_from_rings(parse_rings(F.col("geometry_wkt"))))
    built = clean.computed_once(texts.drop("geometry_wkt"), rings=parse_rings(F.col("wkt")))
    rings = F.col("rings")
    return built.select(
        "geoid",
        F.col("wkt").startswith("MULTIPOLYGON").alias("several_parts"),
        F.size(rings).alias("n_rings"),
        F.size(polygon_edges(rings)).alias("n_edges"),
        F.round(area(F.col("wkt")), 9).alias("area"),
    )


@query
def zone_lookup(t: Tables) -> DataFrame:
    """Zone names for facts that carry the zone's id as a number."""
    facts = t.raw("lineitem").join(t.raw("supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
    named = relational.lookup(facts.select("s_nationkey", "l_quantity"), t.zones, "s_nationkey", "locationid")
    return named.groupBy("zone", "borough").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("l_quantity").cast("bigint")).alias("quantity")
    )


@query
def tract_crash_rates(t: Tables) -> DataFrame:
    """Counts joined to two tables by key, as a rate, for every tract with residents."""
    counts = points_per_polygon(_places(t), t.tracts, ["geoid"], "lon", "lat", count="crashes")
    residents = t.demographics.select("geoid", clean.safe_bigint("total_pop_2023").alias("pop"))
    named = counts.join(residents, "geoid").join(t.tracts.select("geoid", "ntaname"), "geoid")
    rate = clean.per_thousand(F.col("crashes"), F.col("pop"))
    return named.select("geoid", "ntaname", "crashes", "pop", F.round(rate, 6).alias("crashes_per_1k"))


@query
def latest_per_station(t: Tables) -> DataFrame:
    """The newest ride of each station."""
    rides = t.raw("events").select("user_id", "event_id", "event_type", "ts")
    return normalise.latest_per_key(rides, ["user_id"], ["ts", "event_id"]).select("user_id", "event_id", "event_type")


@query
def ordered_page(t: Tables) -> DataFrame:
    """The second page of an ordered table."""
    rows = t.raw("orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return relational.ordered_page(rows, ["o_orderkey"], offset=1000, rows=1000)


@query
def cell_counts(t: Tables) -> DataFrame:
    """Crashes per coarse cell, the cheap stand-in for a polygon join."""
    known = normalise.with_coordinates(t.collisions)
    return relational.count_by(add_cells(known, "lon", "lat", [8]).where(F.col("hex_r8").isNotNull()), "hex_r8")
