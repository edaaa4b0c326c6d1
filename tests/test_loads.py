import json
from datetime import date

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from wardgrid.operators.normalise import declared_kinds
from wardgrid.plans import registry
from wardgrid.plans.loads import clean_resources, load_months, preview_load
from wardgrid.plans.roles import Tables
from wardgrid.schemas import DATASETS, Dataset, Resource, collisions_schema, requests_schema, ridership_schema
from wardgrid.sources import catalog, landing, ledger, sinks, tables
from wardgrid.sources.calendar import calendar_of, month_calendar
from wardgrid.streaming.ingest import read_streamed, stream_months

CRASHES = Dataset("crashes_table", "crash_date", "collision_id", (Resource("crashes", 2019, 2020),))


def crash(i, day, **more):
    return json.dumps({"collision_id": str(i), "crash_date": f"{day}T00:00:00.000", "latitude": "40.7", "longitude": "-73.9"} | more)


def frame(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def months(df):
    return {(r["year"], r["month"]): r["n"] for r in df.groupBy("year", "month").agg(F.count(F.lit(1)).alias("n")).collect()}


def test_calendar(spark):
    got = [(r["year"], r["month"], r["closed"]) for r in month_calendar(spark, 2026, 2027, date(2026, 5, 20)).collect()]
    assert got == [("2026", f"{m:02d}", m < 5) for m in range(1, 6)]
    december = month_calendar(spark, 2026, 2027, date(2026, 12, 31)).collect()
    assert len(december) == 12 and str(december[-1]["end"]) == "2027-01-01 00:00:00" and not december[-1]["closed"]
    assert month_calendar(spark, 2026, 2027, date(2027, 1, 1)).where("closed").count() == 12
    assert month_calendar(spark, 2028, 2029, date(2026, 1, 1)).count() == 0
    assert month_calendar(spark, 2010, 2019, date(2026, 1, 1)).count() == 120


def test_calendar_of_a_table(spark):
    df = spark.sql("select timestamp_ntz'2020-11-30 05:00:00' d union all select timestamp_ntz'2021-01-01'")
    assert [(r["year"], r["month"]) for r in calendar_of(df, "d").collect()] == [("2020", "11"), ("2020", "12"), ("2021", "01")]


def test_range_is_half_open(spark):
    df = spark.sql("select * from values ('2020-01-31T23:59:59.999'),('2020-02-01T00:00:00.000'),('2020-03-01T00:00:00.000') t(d)")
    assert landing.in_range(df, "d", "2020-02-01T00:00:00.000", "2020-03-01T00:00:00.000").count() == 1


def test_load_resumes_and_replaces_only_open_months(spark, tmp_path):
    root, book = str(tmp_path / "t"), str(tmp_path / "ledger")
    first = frame(spark, crash(1, "2019-12-05"), crash(2, "2020-02-01"), crash(3, "2020-02-28", extra="x"))
    report = load_months(spark, {"crashes": first}, CRASHES, root, book, date(2020, 2, 28))
    assert report.rows == 3
    states = {(r["year"], r["month"]): (r["status"], r["rows"]) for r in report.months.collect()}
    assert states[("2019", "12")] == ("loaded", 1) and states[("2020", "01")] == ("empty", 0) and states[("2020", "02")] == ("open", 2)
    assert sum(s == "empty" for s, _ in states.values()) == 12

    more = frame(spark, crash(1, "2019-12-05"), crash(2, "2020-02-01"), crash(3, "2020-02-28"), crash(4, "2020-02-29"),
                 crash(9, "2019-12-06"))
    again = load_months(spark, {"crashes": more}, CRASHES, root, book, date(2020, 3, 2))
    assert again.rows == 3
    stored = tables.read_months(spark, root, collisions_schema())
    assert months(stored) == {("2019", "12"): 1, ("2020", "02"): 3}
    third = load_months(spark, {"crashes": more}, CRASHES, root, book, date(2020, 3, 2))
    assert third.rows == 0 and months(stored) == {("2019", "12"): 1, ("2020", "02"): 3}
    done = ledger.completed_months(ledger.read_ledger(spark, book), "crashes_table")
    assert done.count() == 14


def test_dry_run_leaves_no_trace(spark, tmp_path):
    root, book = tmp_path / "t", tmp_path / "ledger"
    landed = {"crashes": frame(spark, crash(1, "2019-12-05"), crash(2, "2020-02-01"))}
    seen = preview_load(spark, landed, CRASHES, str(book), date(2020, 3, 1))
    assert seen.first_partition == ("2019", "12") and months(seen.months.drop("n")) and not root.exists() and not book.exists()
    assert "hex_r9" in seen.schema.names
    assert load_months(spark, landed, CRASHES, str(root), str(book), date(2020, 3, 1)).rows == 2


def test_two_resources_keep_to_their_years(spark, tmp_path):
    def request(i, day):
        return json.dumps({"unique_key": str(i), "created_date": f"{day}T01:00:00.000"})

    landed = {
        "311_legacy": frame(spark, request(1, "2019-12-31"), request(2, "2020-01-01")),
        "311_current": frame(spark, request(2, "2020-01-01"), request(3, "2019-12-31")),
    }
    data = DATASETS["requests"]
    load_months(spark, landed, data, str(tmp_path / "t"), str(tmp_path / "l"), date(2020, 2, 1), declared_kinds(data.text_columns))
    stored = tables.read_months(spark, str(tmp_path / "t"), requests_schema())
    assert sorted(r["unique_key"] for r in stored.collect()) == ["1", "2"]
    assert stored.where("agency is null and hex_r8 is null").count() == 2
    with pytest.raises(ValueError, match="no landed resource"):
        load_months(spark, {"x": landed["311_legacy"]}, data, str(tmp_path / "u"), str(tmp_path / "m"), date(2020, 2, 1))


def ride(i, moment, station="A"):
    return json.dumps({"transit_timestamp": moment, "ridership": str(i), "station_complex": station,
                       "latitude": "40.7", "longitude": "-73.9", "georeference": {"type": "Point"}})


def test_stream_picks_up_only_new_files(spark, tmp_path):
    land, root, check = tmp_path / "land", str(tmp_path / "t"), str(tmp_path / "c")
    land.mkdir()
    data = DATASETS["ridership"]
    (land / "a.json").write_text("\n".join([ride(1, "2024-01-01T00:00:00.000"), ride(2, "2024-02-01T00:00:00.000")]))

    def run():
        stream_months(spark, str(land), data, root, check).awaitTermination()
        rows = read_streamed(spark, root, ridership_schema())
        return rows.count(), rows.agg(F.sum("ridership")).first()[0]

    assert run() == (2, 3.0)
    assert run() == (2, 3.0)
    (land / "b.json").write_text(ride(5, "2024-01-15T00:00:00.000") + "\n" + json.dumps({"transit_timestamp": "2024-01-16T00:00:00Z", "novel": 1}))
    assert run() == (4, 8.0)
    assert "novel" in spark.read.option("mergeSchema", "true").parquet(root).columns


def test_replace_months_and_page_parts(spark, tmp_path):
    root = str(tmp_path / "t")
    df = spark.range(1000).selectExpr("cast(id as string) k", "'2020' year", "lpad(cast(id % 2 + 1 as string), 2, '0') month")
    sinks.replace_months(df, root, rows_per_file=100)
    assert len(list((tmp_path / "t" / "year=2020" / "month=01").glob("*.parquet"))) >= 5
    sinks.replace_months(df.where("month = '02'").limit(7), root)
    assert months(spark.read.schema("k string, year string, month string").parquet(root)) == {("2020", "01"): 500, ("2020", "02"): 7}


def test_all_null_columns_keep_their_type(spark, tmp_path):
    root = str(tmp_path / "t")
    from wardgrid.operators.normalise import to_declared
    from wardgrid.schemas import with_partitions

    df = spark.sql("select '1' collision_id, '2020' year, '01' month")
    sinks.replace_months(to_declared(df, with_partitions(collisions_schema())), root)
    assert set(dict(spark.read.parquet(f"{root}/year=2020/month=01").dtypes).values()) == {"string"}
    check = tables.spot_check(spark, root, "2020", "01")
    assert (check.rows, check.cell_columns, check.head.count()) == (1, ["hex_r8", "hex_r9", "hex_r10"], 1)
    assert tables.read_month(spark, root, collisions_schema(), "2020", "01").first()["month"] == "01"


def test_catalog(spark, tmp_path):
    root = str(tmp_path / "t")
    df = spark.sql("select '1' collision_id, '2020' year, '01' month")
    sinks.replace_months(df, root)
    catalog.register_months(spark, "cat_crashes", collisions_schema(), root)
    catalog.register_months(spark, "cat_crashes", collisions_schema(), root)
    assert spark.table("cat_crashes").count() == 0
    catalog.discover_partitions(spark, "cat_crashes")
    assert spark.table("cat_crashes").where("year = '2020' and borough is null").count() == 1
    sinks.replace_table(df, str(tmp_path / "plain"))
    catalog.register_table(spark, "cat_plain", df.schema, str(tmp_path / "plain"))
    assert spark.table("cat_plain").count() == 1
    catalog.create_table_as(spark, "cat_made", df, str(tmp_path / "made"))
    catalog.create_table_as(spark, "cat_made", df.union(df), str(tmp_path / "made"))
    assert spark.read.parquet(str(tmp_path / "made")).count() == 1
    for name in ("cat_crashes", "cat_plain", "cat_made"):
        spark.sql(f"drop table {name}")


def test_json_array_pages(spark, tmp_path):
    (tmp_path / "p.json").write_text(json.dumps([{"a": 1}, {"a": 2}]))
    assert sorted(r["value"] for r in landing.read_pages(spark, str(tmp_path)).collect()) == ['{"a":1}', '{"a":2}']


def test_pages_are_bounded_in_a_crowded_month(spark, monkeypatch, tmp_path):
    month = F.when(F.col("id") < 20000, "01").when(F.col("id") < 20500, "02")
    key = F.when(F.col("id") % 2 == 0, "same").when(F.col("id") % 3 > 0, F.col("id").cast("string"))
    rows = spark.range(21000).select(key.alias("unique_key"), F.lit("O").alias("status"), F.lit("1997").alias("year"), month.alias("month"))
    tables = type("Requests", (), {"spark": spark, "requests": rows})()
    monkeypatch.setattr(registry, "Tables", lambda spark, sf_dir: tables)
    monkeypatch.setattr(registry, "PAGE_ROWS", 1000, raising=False)
    monkeypatch.setattr(registry, "shared_folder", lambda spark, purpose: str(tmp_path / purpose))
    assert [tuple(r) for r in registry.QUERIES["record_pages"](spark, "").collect()] == [("O", 21000)]
    sizes = [len(json.loads(p.read_text())) for p in (tmp_path / "pages").glob("*.txt")]
    assert sum(sizes) == 21000 and max(sizes) < 1200 and len(sizes) == 22


def test_polygon_table(spark):
    shapes = spark.sql("select 7 LocationID, 0.5D Shape_Area, cast(null as string) zone, 'POLYGON ((0 0, 1 0, 1 1, 0 0))' shape")
    out = landing.polygon_table(shapes, "shape", 4326)
    assert out.first().asDict() == {"locationid": "7", "shape_area": "0.5", "zone": None, "geometry_wkt": "POLYGON ((0 0, 1 0, 1 1, 0 0))"}
    with pytest.raises(ValueError):
        landing.polygon_table(shapes, "shape", None)


def test_refused_lines_are_counted_and_kept(spark, tmp_path):
    root, book, refused = (str(tmp_path / n) for n in ("t", "l", "r"))
    lines = frame(spark, crash(1, "2020-01-05"), "{broken", "[1]", crash(2, "05/01/2020"), json.dumps({"collision_id": "3"}), crash(4, "2018-12-31"), crash(5, "2021-01-01"), " ")
    report = load_months(spark, {"crashes": lines}, CRASHES, root, book, date(2020, 2, 1), refused_path=refused)
    assert report.rows == 1 and report.refused == {"crashes": {"malformed": 2, "undated": 2, "outside": 2}}
    kept = spark.read.parquet(refused)
    assert kept.count() + report.rows == 7 and kept.where("text = '{broken'").first()["reason"] == "malformed"
    nothing = load_months(spark, {"crashes": frame(spark, "{broken")}, CRASHES, str(tmp_path / "u"), str(tmp_path / "m"), date(2020, 2, 1))
    assert nothing.rows == 0 and nothing.refused == {"crashes": {"malformed": 1}}


def test_an_open_last_year_goes_on(spark, tmp_path):
    data = Dataset("crashes_table", "crash_date", "collision_id", (Resource("crashes", 2019),))
    lines = {"crashes": frame(spark, crash(1, "2031-05-01"), crash(2, "2019-05-01"))}
    assert load_months(spark, lines, data, str(tmp_path / "t"), str(tmp_path / "l"), date(2031, 6, 1)).rows == 2


def test_an_emptied_month_loses_its_rows(spark, tmp_path):
    root, book = str(tmp_path / "t"), str(tmp_path / "l")
    load_months(spark, {"crashes": frame(spark, crash(1, "2020-01-05"), crash(2, "2020-02-05"))}, CRASHES, root, book, date(2020, 2, 10))
    after = load_months(spark, {"crashes": frame(spark, crash(1, "2020-01-05"))}, CRASHES, root, book, date(2020, 3, 1))
    state = {(r["year"], r["month"]): (r["status"], r["rows"]) for r in after.months.collect()}
    assert state[("2020", "02")] == ("empty", 0)
    assert months(tables.read_months(spark, root, collisions_schema())) == {("2020", "01"): 1}


def request(i, day):
    return json.dumps({"unique_key": str(i), "created_date": f"{day}T01:00:00.000"})


def test_idle_resources_are_not_read(spark):
    from wardgrid.plans.loads import clean_resources

    landed = {"311_legacy": frame(spark, request(9, "2019-01-01")), "311_current": spark.range(1).select(F.lit(request(1, "2020-12-05")).alias("value"))}
    data = DATASETS["requests"]
    pending = spark.createDataFrame([("311_current", "2020", "12")], "resource string, year string, month string").collect()
    rows = clean_resources(landed, data, declared_kinds(data.text_columns), pending=pending)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "Range (0, 1" in plan and "Scan ExistingRDD" not in plan
    assert [r["unique_key"] for r in rows.collect()] == ["1"]
    assert clean_resources(landed, data, declared_kinds(data.text_columns), pending=[]) is None


def test_a_resource_loaded_alone_leaves_the_other_alone(spark, tmp_path):
    data = DATASETS["requests"]
    kinds = declared_kinds(data.text_columns)
    old = {"311_legacy": frame(spark, request(1, "2019-12-05"))}
    new = {"311_current": frame(spark, request(2, "2020-03-05"), request(3, "2020-06-05"))}
    root, book = str(tmp_path / "t"), str(tmp_path / "l")

    def load(landed, as_of=date(2020, 6, 10)):
        load_months(spark, landed, data, root, book, as_of, kinds, cells=False)
        return months(tables.read_months(spark, root, requests_schema()))

    assert load(old) == {("2019", "12"): 1}
    states = ledger.month_states(ledger.read_ledger(spark, book), data.table)
    assert {r["resource"] for r in states.collect()} == {"311_legacy"} and states.count() == 120
    everything = {("2019", "12"): 1, ("2020", "03"): 1, ("2020", "06"): 1}
    assert load(new) == everything
    assert load(old) == everything and load(new) == everything
    assert load(old, date(2020, 8, 1)) == everything
    assert months(tables.read_months(spark, root, requests_schema())) == everything


def test_a_line_in_another_months_folder_is_loaded(spark, tmp_path):
    folder = tmp_path / "land" / "year=2020" / "month=05"
    folder.mkdir(parents=True)
    (folder / "a.json").write_text(crash(1, "2020-05-05") + "\n" + crash(2, "2020-06-05"))
    lines = spark.read.schema("value string, year string, month string").text(str(tmp_path / "land"))
    root, book = str(tmp_path / "t"), str(tmp_path / "l")
    assert load_months(spark, {"crashes": lines}, CRASHES, root, book, date(2020, 6, 1)).rows == 2
    report = load_months(spark, {"crashes": lines}, CRASHES, root, book, date(2020, 6, 20))
    assert report.rows == 1 and report.refused == {"crashes": {"closed": 1}}
    assert months(tables.read_months(spark, root, collisions_schema())) == {("2020", "05"): 1, ("2020", "06"): 1}


def test_preview_of_a_finished_resource_has_no_months(spark, tmp_path):
    data = DATASETS["requests"]
    landed, book = {"311_legacy": frame(spark, request(1, "2019-12-05"))}, str(tmp_path / "l")
    kinds = declared_kinds(data.text_columns)
    load_months(spark, landed, data, str(tmp_path / "t"), book, date(2020, 6, 10), kinds)
    seen = preview_load(spark, landed, data, book, date(2020, 6, 10), kinds)
    assert seen.months.count() == 0 and seen.first_partition is None and "unique_key" in seen.schema.names


def test_resources_that_share_a_year_are_refused(spark, tmp_path):
    data = Dataset("t", "crash_date", "collision_id", (Resource("a", 2019, 2020), Resource("b", 2020)))
    with pytest.raises(ValueError, match="share the year 2020"):
        load_months(spark, {"a": frame(spark, crash(1, "2020-01-01"))}, data, str(tmp_path / "t"), str(tmp_path / "l"), date(2020, 2, 1))


def test_a_record_landed_twice_is_stored_once(spark, tmp_path):
    lines = frame(spark, crash(1, "2020-01-05"), crash(1, "2020-01-07", borough="X"), json.dumps({"crash_date": "2020-01-01T00:00:00"}), json.dumps({"crash_date": "2020-01-01T00:00:00"}))
    load_months(spark, {"crashes": lines}, CRASHES, str(tmp_path / "t"), str(tmp_path / "l"), date(2020, 2, 1))
    stored = tables.read_months(spark, str(tmp_path / "t"), collisions_schema())
    assert sorted((r["collision_id"] or "", r["borough"] or "") for r in stored.collect()) == [("", ""), ("", ""), ("1", "X")]


def test_stream_counts_what_it_refuses(spark, tmp_path):
    land, refused = tmp_path / "land", str(tmp_path / "r")
    land.mkdir()
    (land / "a.json").write_text("\n".join([ride(1, "2024-01-01T00:00:00.000"), "{broken", ride(2, "soon")]))
    stream_months(spark, str(land), DATASETS["ridership"], str(tmp_path / "t"), str(tmp_path / "c"), refused_path=refused).awaitTermination()
    assert read_streamed(spark, str(tmp_path / "t"), ridership_schema()).count() == 1
    assert sorted(r["reason"] for r in spark.read.parquet(refused).collect()) == ["malformed", "undated"]


def test_a_record_landed_in_two_batches_is_stored_once(spark, tmp_path):
    land, root, check = tmp_path / "land", str(tmp_path / "t"), str(tmp_path / "c")
    land.mkdir()
    keyless = json.dumps({"crash_date": "2020-01-01T00:00:00"})

    def run(name, *lines):
        (land / name).write_text("\n".join(lines))
        stream_months(spark, str(land), CRASHES, root, check, declared_kinds(["collision_id", "crash_date", "borough"]), cells=False,
                      refused_path=str(tmp_path / "r"), remember="1 day").awaitTermination()
        rows = read_streamed(spark, root, collisions_schema())
        return sorted((r["collision_id"] or "", r["borough"] or "") for r in rows.collect())

    first = [("", ""), ("", ""), ("1", ""), ("2", "")]
    assert run("a.json", crash(1, "2020-01-05"), crash(2, "2020-01-06"), keyless, keyless, "{broken") == first
    # each run is a new query on the same checkpoint; an old date is no reason to drop a record
    assert run("b.json", crash(1, "2020-01-05"), crash(3, "2010-01-06"), "{broken") == [*first, ("3", "")]
    assert run("c.json", crash(2, "2020-01-06", borough="X"), crash(3, "2010-01-06")) == sorted([*first, ("2", "X"), ("3", "")])
    latest = read_streamed(spark, root, collisions_schema(), CRASHES)
    assert sorted((r["collision_id"] or "", r["borough"] or "") for r in latest.collect()) == [("", ""), ("", ""), ("1", ""), ("2", "X"), ("3", "")]
    assert spark.read.parquet(str(tmp_path / "r")).where("reason = 'malformed'").count() == 2
    state = spark.read.format("statestore").load(check)
    assert state.count() > 0


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_preview_is_counted_once(spark, tmp_path):
    """Months of the preview are rows, no second pass over the lines; a key counts in the month of its latest date."""
    landed = {"crashes": frame(spark, crash(1, "2019-12-05"), crash(1, "2020-02-01"), crash(2, "2020-02-03"), crash(3, "2018-02-03"))}
    for kinds in (None, declared_kinds(["collision_id", "crash_date", "latitude", "longitude"])):
        seen = preview_load(spark, landed, CRASHES, str(tmp_path / "ledger"), date(2020, 3, 1), kinds)
        assert [tuple(r) for r in seen.months.collect()] == [("2020", "02", 2)] and "json" not in plan_of(seen.months)
        assert seen.first_partition == ("2020", "02") and "latitude" in seen.schema.names


def test_done_months_are_left_out_before_columns_are_read(spark):
    """The filter by month lies below what reads the other columns and makes cells; the date may have two spellings."""
    lines = frame(spark, crash(1, "2019-12-05"), crash(2, "2020-02-01"), json.dumps({"collision_id": "3", "Crash_Date": "2020-02-07", "latitude": "40.7"}))
    kinds = {k: {"scalar"} for k in ("collision_id", "crash_date", "latitude", "longitude")}
    pending = [Row(resource="crashes", year="2020", month="02")]
    rows = clean_resources({"crashes": lines}, CRASHES, kinds, True, pending)
    plan = plan_of(rows)
    assert plan.rindex("hex_r9") < plan.index("2020-02")
    assert [r["collision_id"] for r in rows.collect()] == ["2"] and rows.columns[-2:] == ["year", "month"]


def test_tracts_are_dealt_to_all_cores(spark, tmp_path):
    """Customers of one file with one row group; polygons are parsed by all cores."""
    spark.range(40).selectExpr("id AS c_custkey", "'n' AS c_name", "int(id % 25) AS c_nationkey", "0D AS c_acctbal", "'s' AS c_mktsegment").coalesce(1).write.parquet(f"{tmp_path}/customer.parquet")
    tracts = Tables(spark, str(tmp_path)).tracts
    assert tracts.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism and tracts.select("geoid").distinct().count() == 40
