"""The months a data set can have, and which of them are over."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardgrid.functions.clean import month_key, year_key


def _months(base: DataFrame, first: Column, last: Column, as_of: Column) -> DataFrame:
    """Rows `year, month, start, end, closed`, one per month that has begun by `as_of`."""
    starts = base.select(
        F.explode(
            F.sequence(F.trunc(first, "month"), F.trunc(F.least(last, as_of), "month"), F.expr("interval 1 month"))
        ).alias("start"),
        as_of.alias("_as_of"),
    )
    end = F.add_months("start", 1)
    return starts.select(
        year_key(F.col("start")).alias("year"),
        month_key(F.col("start")).alias("month"),
        F.col("start").cast("timestamp_ntz").alias("start"),
        end.cast("timestamp_ntz").alias("end"),
        (end <= F.col("_as_of")).alias("closed"),
    )


def month_calendar(spark: SparkSession, first_year: int, last_year: int, as_of: date) -> DataFrame:
    """All months from January of the first year, cut after the month of `as_of`.

    `end` is exclusive. A month is closed once its end is not after `as_of`; an
    open month is loaded again by each run.
    """
    if date(first_year, 1, 1) > as_of:
        return month_calendar(spark, as_of.year, as_of.year, as_of).where(F.lit(False))
    return _months(
        spark.range(1), F.lit(date(first_year, 1, 1)), F.lit(date(last_year, 12, 31)), F.lit(as_of)
    )


def calendar_of(df: DataFrame, date_column: str) -> DataFrame:
    """The calendar that spans a table, with its greatest date as `as_of`."""
    day = F.col(date_column).cast("date")
    span = df.agg(F.min(day).alias("first"), F.max(day).alias("last")).where(F.col("first").isNotNull())
    return _months(span, F.col("first"), F.col("last"), F.col("last"))
