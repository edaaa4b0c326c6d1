"""Stored tables: month-partitioned or plain Parquet, read by declared schema."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from wardgrid.schemas import with_partitions


def read_months(spark: SparkSession, root: str, schema: StructType) -> DataFrame:
    """A month-partitioned table. Columns that older files lack are NULL; `year`
    and `month` are text, and filters on them prune folders."""
    return spark.read.schema(with_partitions(schema)).parquet(root)


def read_month(spark: SparkSession, root: str, schema: StructType, year: str, month: str) -> DataFrame:
    """One partition, without listing the others."""
    return (
        spark.read.schema(with_partitions(schema))
        .option("basePath", root)
        .parquet(f"{root}/year={year}/month={month}")
    )


def read_table(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """An unpartitioned reference table."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def read_if_present(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """A table that may not have been written yet; without it there are no rows."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


@dataclass(frozen=True)
class SpotCheck:
    """What one stored month looks like."""

    rows: int
    columns: list[str]
    cell_columns: list[str]
    head: DataFrame


def spot_check(spark: SparkSession, root: str, year: str, month: str, rows: int = 5) -> SpotCheck:
    """Row count, file columns, cell columns if any, and the first rows of a month."""
    df = spark.read.parquet(f"{root}/year={year}/month={month}")
    cells = [c for c in df.columns if c.startswith("hex_r")]
    return SpotCheck(df.select(F.count(F.lit(1))).first()[0], df.columns, cells, df.limit(rows))
