"""Parquet sinks that can be repeated without changing the result."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from wardgrid.schemas import PARTITION_COLUMNS
from wardgrid.sources.pages import fits, replace_pages


def replace_months(df: DataFrame, root: str, rows_per_file: int = 0, partitions: list[str] = PARTITION_COLUMNS) -> None:
    """Write snappy Parquet by partition, replacing exactly the partitions present in `df`.

    The rebalance hint gathers each month into files of the advisory size and
    splits a month that holds a large share of all rows over several tasks.
    Files of few rows on a local disk are written by Arrow, as making them is
    what takes the time.
    """
    if fits(df, root, rows_per_file, partitions):
        return replace_pages(df, root, rows_per_file, partitions)
    writer = (
        df.hint("rebalance", *partitions)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "snappy")
        .partitionBy(*partitions)
    )
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    writer.parquet(root)


def month_files(spark: SparkSession, root: str, months: Iterable[tuple[str, str]]) -> dict[tuple[str, str], set[str]]:
    """The names of the files that hold each month, in any store Spark writes to."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    files = path(root).getFileSystem(spark._jsc.hadoopConfiguration())
    found = {}
    for year, month in months:
        folder = path(f"{root}/year={year}/month={month}")
        listed = files.listStatus(folder) if files.exists(folder) else []
        found[year, month] = {s.getPath().getName() for s in listed}
    return found


def remove_months(spark: SparkSession, root: str, months: Iterable[tuple[str, str]]) -> None:
    """Delete whole months of a partitioned table."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    files = path(root).getFileSystem(spark._jsc.hadoopConfiguration())
    for year, month in months:
        files.delete(path(f"{root}/year={year}/month={month}"), True)


def replace_table(df: DataFrame, path: str) -> None:
    """Write an unpartitioned table: one file while it is small, more as it grows."""
    df.hint("rebalance").write.mode("overwrite").option("compression", "snappy").parquet(path)
