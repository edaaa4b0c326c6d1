"""Files of few rows: what Arrow writes on a local disk is what Spark's writer would."""

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from wardgrid.sources import sinks

MONTHS = ("year", "month")


def files(root):
    return sorted(root.rglob("*.parquet"))


def stored(spark, root, *columns):
    return sorted(map(tuple, spark.read.parquet(str(root)).select(*columns, *MONTHS).collect()), key=repr)


def staged(root):
    return [p for p in root.iterdir() if p.name.startswith(".")]


def dated(spark, rows):
    return spark.range(rows).selectExpr("cast(id as string) k", "'2020' year", "lpad(cast(id % 3 + 1 as string), 2, '0') month")


def test_small_files_are_made_without_processes(spark, tmp_path):
    # Hadoop's local file system starts two for each file that Spark's writer makes
    sinks.replace_months(dated(spark, 300), str(tmp_path / "t"), rows_per_file=20)
    found = files(tmp_path / "t")
    assert {pq.read_metadata(f).created_by.split()[0] for f in found} == {"parquet-cpp-arrow"}
    assert sum(pq.read_metadata(f).num_rows for f in found) == 300
    assert max(pq.read_metadata(f).num_rows for f in found) == 20 and 15 <= len(found) <= 27
    assert stored(spark, tmp_path / "t", "k") == sorted(map(tuple, dated(spark, 300).collect()), key=repr)


def test_same_table_as_from_spark(spark, tmp_path, monkeypatch):
    odd = ["01", "a b/c:d=%{}", "", None, "é\n'", "..", "02"]
    text = [None, "", "x", "é", "'", "\n", "1.0"]
    rows = [(text[i % 7], i - 40, i / 7 if i % 5 else float("nan"), None if i % 4 else i % 8 == 0, odd[i % 7], ["2020", None][i % 11 == 0]) for i in range(400)]
    df = spark.createDataFrame(rows, "k string, n int, x double, b boolean, month string, year string")
    df = df.select("k", "n", "month", "x", "b", "year", F.lit(5).alias("five"), F.expr("date_add(date'1969-12-01', n)").alias("d"))
    columns = ["k", "n", "x", "b", "d", "five"]
    sinks.replace_months(df, str(tmp_path / "new"), rows_per_file=7)
    monkeypatch.setattr(sinks, "fits", lambda *of: False)
    sinks.replace_months(df, str(tmp_path / "old"), rows_per_file=7)
    assert repr(stored(spark, tmp_path / "new", *columns)) == repr(stored(spark, tmp_path / "old", *columns))
    assert spark.read.parquet(str(tmp_path / "new")).schema == spark.read.parquet(str(tmp_path / "old")).schema
    folders = [{f.parent.relative_to(tmp_path / name) for f in files(tmp_path / name)} for name in ("new", "old")]
    assert folders[0] == folders[1] and len(folders[0]) == 12
    assert pq.read_schema(files(tmp_path / "new")[0]).names == pq.read_schema(files(tmp_path / "old")[0]).names


def test_only_written_months_are_replaced(spark, tmp_path):
    root = tmp_path / "t"
    sinks.replace_months(dated(spark, 90), str(root), rows_per_file=10)
    sinks.replace_months(dated(spark, 90).where("month = '02'").limit(3), str(root), rows_per_file=10)
    assert [len([r for r in stored(spark, root, "k") if r[2] == m]) for m in ("01", "02", "03")] == [30, 3, 30]
    # read and replaced at once
    sinks.replace_months(spark.read.parquet(str(root)).where("month < '03'").withColumn("k", F.lit("again")), str(root), rows_per_file=10)
    assert [r[0] for r in stored(spark, root, "k")].count("again") == 33 and len(stored(spark, root, "k")) == 63
    sinks.replace_months(dated(spark, 0), str(root), rows_per_file=10)
    assert len(stored(spark, root, "k")) == 63 and staged(root) == []


def test_month_of_several_tasks_is_whole(spark, tmp_path):
    # as months are split that hold much of the data
    settings = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k"}
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        df = spark.range(0, 3000, 1, 6).selectExpr("uuid() k", "'2020' year", "if(id % 100 > 0, '01', '02') month")
        sinks.replace_months(df, str(tmp_path / "t"), rows_per_file=20)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    crowded = list((tmp_path / "t/year=2020/month=01").glob("*.parquet"))
    assert len({f.name.split("-")[1] for f in crowded}) > 1
    assert max(pq.read_metadata(f).num_rows for f in crowded) <= 20
    kept = stored(spark, tmp_path / "t", "k")
    assert (len(kept), len({r[0] for r in kept})) == (3000, 3000)


def test_failed_write_leaves_the_table(spark, tmp_path):
    root = tmp_path / "t"
    sinks.replace_months(dated(spark, 90), str(root), rows_per_file=10)
    before = files(root)
    bad = dated(spark, 90).withColumn("k", F.when(F.col("k") == "80", F.raise_error(F.lit("no"))).otherwise(F.col("k")))
    with pytest.raises(Exception, match="no"):
        sinks.replace_months(bad, str(root), rows_per_file=10)
    assert files(root) == before and staged(root) == []


def test_damage_is_found(spark, tmp_path):
    sinks.replace_months(dated(spark, 30), str(tmp_path / "t"), rows_per_file=30)
    file = files(tmp_path / "t")[0]
    content = bytearray(file.read_bytes())
    content[6] ^= 1
    file.write_bytes(content)
    with pytest.raises(Exception, match="[Cc]hecksum"):
        stored(spark, tmp_path / "t", "k")


def test_other_kinds_are_left_to_spark(spark, tmp_path):
    df = dated(spark, 30).withColumn("at", F.expr("timestamp'2020-01-01 00:00:00'"))
    sinks.replace_months(df, str(tmp_path / "t"), rows_per_file=4)
    assert all("parquet-mr" in pq.read_metadata(f).created_by for f in files(tmp_path / "t"))
    assert len(stored(spark, tmp_path / "t", "k", "at")) == 30
