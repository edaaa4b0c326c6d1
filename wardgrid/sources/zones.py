"""The landing zone map: which landed file holds records of which months.

Files are read once when they are new (or changed) for the least and greatest month of their records, wherever they
lie; from then on a load reads only the files whose span meets a month it needs.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from wardgrid.operators.normalise import parse_records, text_at, with_partition_keys

LANDED = "resource string, path string, name string, length bigint, modified timestamp, lines bigint, low string, high string"
SAME = ["resource", "name", "length", "modified"]


def listed(spark: SparkSession, folder: str, resource: str) -> DataFrame:
    """The files under a folder as (resource, path, name, length, modified); their content is not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    return files.select(
        F.lit(resource).alias("resource"),
        "path",
        F.col("_metadata.file_path").alias("name"),
        F.col("_metadata.file_size").alias("length"),
        F.col("_metadata.file_modification_time").alias("modified"),
    )


def spans(spark: SparkSession, files: DataFrame, date_column: str) -> DataFrame:
    """`LANDED` for new files: their lines, and the first and last month of their dated records. A file without
    one has no span and is not read again."""
    paths = [r["path"] for r in files.select("path").collect()]
    if not paths:
        return spark.createDataFrame([], LANDED)
    lines = spark.read.text(paths).select("value", F.col("_metadata.file_path").alias("_name"))
    filled = lines.where(F.length(F.trim("value")) > 0)
    records = filled.select("_name", F.try_parse_json("value").alias("record"))
    dated = with_partition_keys(records.select("_name", text_at(date_column).alias("_date")), "_date")
    month = F.concat_ws("-", "year", "month")
    found = dated.groupBy(F.col("_name").alias("name")).agg(
        F.count("*").alias("lines"), *[f(F.when(F.col("year").isNotNull(), month)).alias(n) for f, n in ((F.min, "low"), (F.max, "high"))]
    )
    joined = files.join(found, "name", "left").withColumn("lines", F.coalesce("lines", F.lit(0)))
    return joined.select(*[f.split()[0] for f in LANDED.split(", ")])


def meets(months: Iterable[Row]) -> Column:
    """Whether a file's span takes in one of the months (resource, year, month) of its own resource."""
    wanted: dict[str, list[str]] = {}
    for m in months:
        wanted.setdefault(m["resource"], []).append(f"{m['year']}-{m['month']}")
    out = F.lit(False)
    for resource, names in wanted.items():
        inside = F.exists(F.array(*map(F.lit, sorted(names))), lambda m: (m >= F.col("low")) & (m <= F.col("high")))
        out = out | ((F.col("resource") == resource) & inside)
    return F.coalesce(out, F.lit(False))


def line_file(spark: SparkSession, paths: list[str]) -> DataFrame:
    """The records of some files, parsed once."""
    lines = spark.read.text(paths) if paths else spark.createDataFrame([], "value string")
    return parse_records(lines.select("value"), strict=False)
