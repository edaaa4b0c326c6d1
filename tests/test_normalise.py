import json

import pytest
from pyspark.sql import functions as F

from wardgrid import schemas
from wardgrid.operators import normalise as n
from wardgrid.operators import wide
from wardgrid.operators.relational import ordered_page, repeated_keys, top_k, union_resources


def lines(spark, *records):
    return spark.createDataFrame([(json.dumps(r),) for r in records], "value string")


def parsed(spark, *records):
    return n.parse_records(lines(spark, *records))


def as_text(spark, *records):
    r = parsed(spark, *records)
    return n.text_columns(r, n.key_kinds(r))


def test_keys_are_the_union_over_rows(spark):
    out = as_text(spark, {"a": 1}, {"a": 2, "b": "x"}, {"c": True})
    assert out.columns == ["a", "b", "c"]
    assert {tuple(r) for r in out.collect()} == {("1", None, None), ("2", "x", None), (None, None, "true")}


def test_nested_location_is_hoisted(spark):
    out = as_text(spark, {"location": {"latitude": "40.7", "longitude": "-73.9", "human_address": "h"}})
    assert out.first().asDict() == {"location_latitude": "40.7", "location_longitude": "-73.9"}


def test_object_without_coordinates_vanishes(spark):
    out = as_text(spark, {"id": "1", "geo": {"type": "Point", "coordinates": [1, 2]}})
    assert out.columns == ["id"]


def test_lists_become_json_and_lookalikes_stay_text(spark):
    out = as_text(spark, {"l": [1, 2], "t": '{"latitude": 1}', "e": "", "z": None}).first()
    assert (out["l"], out["t"], out["e"], out["z"]) == ("[1,2]", '{"latitude": 1}', "", None)


def test_a_key_may_hold_an_object_in_some_rows(spark):
    out = as_text(spark, {"k": "x"}, {"k": {"latitude": 1.5, "longitude": None}}, {"k": [3]})
    assert out.columns == ["k", "k_latitude", "k_longitude"]
    assert {tuple(r) for r in out.collect()} == {("x", None, None), (None, "1.5", None), ("[3]", None, None)}


def test_malformed_lines_fail(spark):
    with pytest.raises(Exception, match="MALFORMED"):
        n.parse_records(spark.createDataFrame([('{"a": ',)], "value string")).collect()


def test_awkward_key_names(spark):
    assert as_text(spark, {"it's": "1", "a b": "2", ":x.y": "3"}).first().asDict() == {"it's": "1", "a b": "2", ":x.y": "3"}


def test_typed_core(spark):
    r = parsed(
        spark,
        {"transit_timestamp": "2020-02-01T00:00:00.000", "ridership": "7", "latitude": "40.7", "longitude": "-73.9",
         "station_complex": "A", "georeference": {"type": "Point", "coordinates": [-73.9, 40.7]}},
        {"transit_timestamp": "soon", "ridership": "", "transfers": "1.5", "latitude": "x", "extra": 5},
    )
    out = n.with_record_cells(
        n.typed_core(r, n.key_kinds(r), "transit_timestamp", schemas.RIDERSHIP_FLOAT_COLUMNS), pairs=n.COORDINATE_PAIRS[:1]
    )
    assert out.columns[:5] == ["transit_timestamp", "ridership", "transfers", "latitude", "longitude"]
    assert out.columns[5:8] == ["extra", "georeference", "station_complex"]
    assert dict(out.dtypes)["transit_timestamp"] == "timestamp_ntz"
    a, b = out.orderBy(F.asc_nulls_last("transit_timestamp")).collect()
    assert a["georeference"] == '{"coordinates":[-73.9,40.7],"type":"Point"}'
    assert a["hex_r9"] is not None and b["hex_r9"] is None
    assert (b["transit_timestamp"], b["ridership"], b["transfers"], b["extra"]) == (None, None, 1.5, "5")


def test_stringify_a_typed_frame(spark):
    df = spark.sql("""select 1 a, 2.5D b, cast(null as int) c, true d, array(1,2) l, '' e,
        named_struct('latitude', 40.5D, 'longitude', 'x', 'other', 1) location, named_struct('x', 1) gone""")
    hoisted = n.stringify_all(df)
    assert hoisted.first().asDict() == {
        "a": "1", "b": "2.5", "c": None, "d": "true", "l": "[1,2]", "e": "",
        "location_latitude": "40.5", "location_longitude": "x",
    }
    assert set(dict(hoisted.dtypes).values()) == {"string"}
    assert n.stringify_all(df, "json").first()["gone"] == '{"x":1}'


def test_lower_case_names(spark):
    assert n.lower_case_names(spark.sql("select 1 AbC, 2 d")).columns == ["abc", "d"]
    with pytest.raises(ValueError, match="case"):
        n.lower_case_names(spark.sql("select 1 a").withColumn("b", F.lit(1)).toDF("a", "A"))


def test_declared_columns_and_drift(spark):
    df = spark.sql("select '1' unique_key, 'x' newcomer")
    assert n.undeclared_columns(df, schemas.requests_schema()) == ["newcomer"]
    out = n.to_declared(df, schemas.requests_schema())
    assert out.columns == schemas.requests_schema().names and len(out.columns) == 45
    assert all(t == "string" for _, t in out.dtypes)


def test_declared_schemas_have_the_stated_sizes():
    assert len(schemas.collisions_schema()) == 33
    assert len(schemas.ridership_schema()) == 14
    assert len(schemas.zones_schema()) == 8
    assert len(schemas.tracts_schema()) == 13
    assert len(schemas.demographics_schema()) == 47
    assert "lang_lim_eng_asian_pacific_island_2018" in schemas.demographics_schema().names


def test_latest_per_key(spark):
    df = spark.sql("select * from values (1,'a',1),(1,'b',2),(2,'c',1),(2,'d',1) t(k,v,at)")
    got = n.latest_per_key(df, ["k"], ["at"])
    assert got.columns == df.columns
    assert sorted(tuple(r) for r in got.collect()) == [(1, "b", 2), (2, "d", 1)]


RESPONSE = json.dumps([["NAME", "X1", "X2", "state", "county", "tract"], ["n", "10", "-666666666", "36", "061", "000100"],
                       ["n", "abc", "-5", "36", "999", "000200"]])
TURNED = json.dumps([["state", "tract", "county", "X2"], ["36", "000300", "005", "85000"]])


def test_header_rows_follow_their_own_header(spark):
    rows = wide.header_rows(spark.createDataFrame([(RESPONSE,), (TURNED,)], "value string"),
                            ["X1", "X2", "state", "county", "tract"])
    got = wide.curated(wide.in_counties(rows), {"X1": "one", "X2": "two"}).orderBy("geoid").collect()
    assert [tuple(r) for r in got] == [("36005000300", None, 85000.0), ("36061000100", 10.0, None)]


def test_header_only_response(spark):
    assert wide.header_rows(spark.createDataFrame([('[["state"]]',)], "value string"), ["state"]).count() == 0


def test_outer_merge_keeps_both_sides(spark):
    a = spark.createDataFrame([(str(k), float(k)) for k in (1, 2, 3)], "geoid string, m double")
    b = spark.createDataFrame([(str(k), k * 1e4) for k in (2, 3, 4)], "geoid string, m double")
    merged = wide.as_stored_text(wide.merge_vintages({2018: a, 2023: b})).orderBy("geoid")
    assert [tuple(r) for r in merged.collect()] == [
        ("1", "1.0", None), ("2", "2.0", "20000.0"), ("3", "3.0", "30000.0"), ("4", None, "40000.0")]


def test_rates(spark):
    names = {f"{m}_2023": "10.0" for m in schemas.MEASURES.values()} | {"lang_universe_2023": "0.0", "geoid": "g"}
    row = wide.demographic_rates(spark.createDataFrame([names]), 2023).first()
    assert (row["bachelors_or_more"], row["poverty"], row["owner_occupied"], row["limited_english"]) == (4.0, 1.0, 1.0, None)


def test_union_and_repeated_keys(spark):
    a, b = spark.sql("select '1' k, 'x' a"), spark.sql("select '1' k, 'y' b union all select '2', 'z'")
    u = union_resources(a, b)
    assert u.columns == ["k", "a", "b"] and u.count() == 3
    assert [tuple(r) for r in repeated_keys(u, ["k"]).collect()] == [("1", 2)]


def test_top_k_and_pages(spark):
    df = spark.sql("select * from values ('a',1),('b',3),('c',3),('d',null) t(k,n)")
    assert [r["k"] for r in top_k(df, "n", 3, ["k"]).collect()] == ["b", "c", "a"]
    assert [r["k"] for r in ordered_page(df, ["k"], 1, 2).collect()] == ["b", "c"]


def test_flat_and_nested_forms_in_one_table(spark):
    rows = [{"location": {"latitude": "1", "longitude": 2}}, {"location_latitude": "3", "location_longitude": "4"}, {"location": "here", "location_latitude": "5"}]
    for kinds in (None, n.declared_kinds(["location", "location_latitude", "location_longitude"])):
        records = n.parse_records(spark.createDataFrame([(json.dumps(r),) for r in rows], "value string"))
        out = n.text_columns(records, n.key_kinds(records) if kinds is None else kinds)
        assert out.columns == ["location", "location_latitude", "location_longitude"]
        assert {tuple(r) for r in out.collect()} == {(None, "1", "2"), (None, "3", "4"), ("here", "5", None)}


def test_drifting_keys_and_number_text(spark):
    lines = ['{"Status": "a", "n": 10.0}', '{"status": "b", "n": 1.50}', '{"k": 1, "k": 2, "n": 1e10}', "{\"a'b\\\"c\": \"q\", \"n\": 7}", '{"n": "1.0E10"}']
    records = n.parse_records(spark.createDataFrame([(x,) for x in lines], "value string"))
    out = n.text_columns(records, n.key_kinds(records))
    assert sorted(out.columns) == ["Status", "a'b\"c", "k", "n"]
    assert sorted(r["n"] for r in out.collect()) == ["1.0E10", "1.5", "10.0", "10000000000.0", "7"]
    assert {r["Status"] for r in out.collect()} == {"a", "b", None} and {r["k"] for r in out.collect()} == {"2", None}
    assert {r["a'b\"c"] for r in out.collect()} == {"q", None}
