"""Points stored along a space-filling curve."""

from pathlib import Path

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from wardgrid.sources.layout import by_place, place_key, replace_months_by_place


def scattered(spark, n):
    at = F.col("id")
    return spark.range(n).select(
        "id",
        (F.lit(40.0) + F.pmod(at * 5381, F.lit(99991)) / F.lit(99991.0)).alias("lat"),
        (F.lit(-74.0) + F.pmod(at * 7919 + at * at % 31, F.lit(99989)) / F.lit(99989.0)).alias("lon"),
        F.lit("2020").alias("year"),
        F.format_string("%02d", at % 2 + 1).alias("month"),
    )


def groups(root):
    """(month, rows, box) of every row group, from the footers."""
    for file in sorted(Path(root).rglob("*.parquet")):
        meta = pq.ParquetFile(file).metadata
        names = [meta.schema.column(c).name for c in range(meta.num_columns)]
        for g in range(meta.num_row_groups):
            stats = {n: meta.row_group(g).column(names.index(n)).statistics for n in ("lat", "lon")}
            box = {n: (s.min, s.max) if s is not None and s.has_min_max else None for n, s in stats.items()}
            yield file.parent.name, meta.row_group(g).num_rows, box


def meets(box, lat, lon):
    return all(box[n] is not None and box[n][0] <= hi and box[n][1] >= lo for n, (lo, hi) in (("lat", lat), ("lon", lon)))


def test_box_meets_few_row_groups(spark, tmp_path):
    points, root = scattered(spark, 200_000), str(tmp_path / "places")
    replace_months_by_place(points, root, "lat", "lon", rows_per_group=1_000, tasks=4)
    lat, lon = (40.4, 40.5), (-73.6, -73.5)
    found = list(groups(root))
    assert len(found) >= 200 and max(n for _, n, _ in found) <= 1_000
    assert sum(meets(box, lat, lon) for _, _, box in found) <= len(found) / 10
    box = F.col("lat").between(*lat) & F.col("lon").between(*lon)
    stored = spark.read.parquet(root)
    assert stored.count() == 200_000 and stored.where(box).count() == points.where(box).count()


def test_months_are_replaced_and_others_stay(spark, tmp_path):
    root = str(tmp_path / "months")
    replace_months_by_place(scattered(spark, 1000), root, "lat", "lon")
    replace_months_by_place(scattered(spark, 100).where("month = '02'"), root, "lat", "lon")
    rows = spark.read.schema("id long, year string, month string").parquet(root).groupBy("month").count().collect()
    assert {r["month"]: r["count"] for r in rows} == {"01": 500, "02": 50}


def test_key_order_and_odd_places(spark):
    rows = [(-90.0, -180.0), (90.0, 180.0), (0.0, 0.0), (None, 1.0), (1.0, None), (91.0, 0.0), (float("nan"), 0.0), (0.0, -1e-9)]
    keys = [r[0] for r in spark.createDataFrame(rows, "lat double, lon double").select(place_key("lat", "lon")).collect()]
    assert keys[0] == 0 and keys[1] == 2**62 - 1 and keys[2] == 3 << 60
    assert keys[3:7] == [None] * 4 and keys[7] < keys[2]


def test_key_interleaves_bits(spark):
    rows = [(k * 1.7 - 80, k * 3.1 - 170) for k in range(90)]
    got = [r[0] for r in spark.createDataFrame(rows, "lat double, lon double").select(place_key("lat", "lon")).collect()]

    def plainly(lat, lon):
        y, x = int((lat + 90.0) / 180.0 * 2.0**31), int((lon + 180.0) / 360.0 * 2.0**31)
        return sum((x >> b & 1) << 2 * b | (y >> b & 1) << 2 * b + 1 for b in range(31))

    assert got == [plainly(*r) for r in rows]


def test_a_crowded_place_is_split(spark):
    crowd = spark.range(30_000).selectExpr("id", "40.5D lat", "-73.5D lon", "'2020' year", "'01' month")
    dealt = by_place(scattered(spark, 30_000).union(crowd), "lat", "lon", tasks=8)
    sizes = [r["count"] for r in dealt.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 60_000 and max(sizes) < 15_000
    assert by_place(scattered(spark, 0), "lat", "lon").count() == 0
