from datetime import datetime

import pytest
from pyspark.sql import functions as F

from wardgrid.functions import clean


def column(spark, values, build, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(build("v")).collect()]


def test_safe_double(spark):
    given = ["1", " 2.5 ", "", "  ", None, "N/A", "1e3", "1_000", "1.0d", "nan", "inf", "\t7\n", "0x1p3", "-.5", "5."]
    wanted = [1.0, 2.5, None, None, None, None, 1000.0, None, None, None, None, 7.0, None, -0.5, 5.0]
    assert column(spark, given, clean.safe_double) == wanted


def test_safe_timestamp(spark):
    given = ["2020-02-01T00:00:00.000", "2020-02-01T05:00:00Z", "2020-02-01", "", None, "2020-02", "soon",
             "2020-13-01", "2020-02-01T05:00:00+05:00"]
    wanted = [datetime(2020, 2, 1), datetime(2020, 2, 1, 5), datetime(2020, 2, 1)] + [None] * 6
    assert column(spark, given, clean.safe_timestamp) == wanted


def test_sentinel_is_strictly_below(spark):
    given = ["-666666666", "-100000000", "-5", "abc", None]
    built = column(spark, given, lambda v: clean.sentinel_to_null(f"({clean.number_sql(v)})"))
    assert built == [None, -100000000.0, -5.0, None, None]


def test_stored_numbers_read_back(spark):
    assert column(spark, ["85000.0", "-12.9", "x"], clean.safe_bigint) == [85000, -12, None]


def test_number_text(spark):
    given = [85000.0, 10000000.0, 12345678.125, 0.0, -3.5, None, 0.5, 0.000123]
    wanted = ["85000.0", "10000000.0", "12345678.125", "0.0", "-3.5", None, "0.5", "0.000123"]
    assert column(spark, given, clean.number_text, "double") == wanted


@pytest.mark.parametrize(
    "a, b, wanted",
    [
        (("40.7", "-73.9"), ("41", "-74"), (40.7, -73.9)),
        (("40.7", None), ("41", "-74"), (41.0, -74.0)),
        (("95", "-73.9"), ("41", "-74"), (41.0, -74.0)),
        (("", ""), ("x", "-74"), None),
        (("0", "0"), ("41", "-74"), (0.0, 0.0)),
        (("nan", "0"), (None, None), None),
    ],
)
def test_first_valid_point(one, a, b, wanted):
    def build(lat, lon, lat2, lon2):
        pairs = [tuple(f"({clean.number_sql(v)})" for v in pair) for pair in (("v0", "v1"), ("v2", "v3"))]
        return clean.first_valid_point(*pairs)

    got = one(build, *a, *b)
    assert (tuple(got) if got else None) == wanted


def test_nan_is_not_a_valid_point(spark):
    df = spark.createDataFrame([(float("nan"), 1.0), (1.0, float("nan")), (1.0, 2.0)], "lat double, lon double")
    assert [r[0] for r in df.select(clean.valid_point("lat", "lon")).collect()] == [False, False, True]


def test_geoid_and_rates(one):
    assert one(clean.geoid, "36", "061", "000100") == "36061000100"
    assert one(clean.geoid, "36", None, "000100") is None
    assert one(lambda a, b: clean.per_thousand(a, b), "5", "200") == 25.0
    assert one(lambda a, b: clean.per_thousand(a, b), "5", "0") is None
    assert one(lambda a, b: clean.share(a, b), "1", "4") == 0.25


def test_partition_keys(one):
    assert one(lambda v: F.concat_ws("/", clean.year_key(clean.safe_timestamp("v0")), clean.month_key(clean.safe_timestamp("v0"))),
               "2020-02-01T00:00:00.000") == "2020/02"
