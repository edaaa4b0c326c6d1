"""Landed files: JSON records, header-row responses, polygons as WKT."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from wardgrid.functions.geometry import wkt_to_wgs84
from wardgrid.operators.normalise import lower_case_names, stringify_all


def read_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """JSON lines as text; one read over all paths, split by file and block."""
    return spark.read.text(paths)


def spread(lines: DataFrame) -> DataFrame:
    """Lines that came in fewer splits than there are cores, dealt to all of them: what is
    done with a line costs far more than moving it. Others stay where they are."""
    cores = lines.sparkSession.sparkContext.defaultParallelism
    return lines.repartition(cores) if lines.rdd.getNumPartitions() < cores else lines


def read_pages(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Files that each hold one JSON array of records, as one line per record.

    A page is one value, so keep pages to the size an open-data service sends
    (tens of thousands of records); larger drops belong in JSON lines.
    """
    pages = spark.read.text(paths, wholetext=True)  # a file is one split
    entries = pages.select(F.parse_json("value").alias("page")).lateralJoin(
        spark.tvf.variant_explode(F.col("page").outer())
    )
    return entries.select(F.to_json("value").alias("value"))


def read_records(spark: SparkSession, paths: str | Sequence[str], schema: StructType) -> DataFrame:
    """JSON lines read by a declared schema; keys it does not name are not parsed."""
    return spark.read.schema(schema).json(paths)


def in_range(df: DataFrame, column: str, start: datetime | str, end: datetime | str) -> DataFrame:
    """Half-open range: `start <= column < end`. Kept as two plain comparisons,
    which reach the scan; on ISO text they compare in date order as well."""
    return df.where((F.col(column) >= F.lit(start)) & (F.col(column) < F.lit(end)))


def read_responses(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Header-row responses, one file each; all areas in one multi-path read."""
    return spark.read.text(paths, wholetext=True)


def polygon_table(shapes: DataFrame, wkt: str, epsg: int | None) -> DataFrame:
    """A polygon table in stored form: lower-case names, attributes as text and
    `geometry_wkt` in degrees as the last column."""
    names = [c for c in shapes.columns if c != wkt]
    attributes = stringify_all(
        shapes.select(*names, F.col(wkt).alias("_geometry_wkt"))
    ).withColumn("_geometry_wkt", wkt_to_wgs84(F.col("_geometry_wkt"), epsg))
    return lower_case_names(attributes).withColumnRenamed("_geometry_wkt", "geometry_wkt")
