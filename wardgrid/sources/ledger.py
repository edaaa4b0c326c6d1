"""The load ledger: which months of a data set are done.

An append-only Parquet table; the newest entry of a month of a resource counts, so a
resource that is loaded alone says nothing about the others. Its size is the number
of months times the number of runs, never the number of rows loaded.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardgrid.sources.tables import read_if_present

LEDGER = "dataset string, resource string, year string, month string, status string, rows bigint, recorded_at timestamp"
DONE = ("loaded", "empty")


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """All entries; none if the ledger was not written yet."""
    return read_if_present(spark, path, LEDGER)


def _month(frame: DataFrame) -> list[str]:
    return [c for c in ("resource", "year", "month") if c in frame.columns]


def month_states(ledger: DataFrame, dataset: str) -> DataFrame:
    """The newest entry of each month, of each resource where the ledger names them."""
    keys = _month(ledger)
    return (
        ledger.where(F.col("dataset") == dataset)
        .groupBy(*keys)
        .agg(F.max(F.struct("recorded_at", "status", "rows")).alias("_last"))
        .select(*keys, "_last.status", "_last.rows", "_last.recorded_at")
    )


def completed_months(ledger: DataFrame, dataset: str) -> DataFrame:
    return month_states(ledger, dataset).where(F.col("status").isin(*DONE)).select(*_month(ledger))


def pending_months(calendar: DataFrame, ledger: DataFrame, dataset: str) -> DataFrame:
    """Months of the calendar that are not completed: open ones always, closed ones until loaded.
    A calendar that names resources is compared by resource."""
    return calendar.join(completed_months(ledger, dataset), _month(calendar), "left_anti")


def load_entries(pending: DataFrame, counts: DataFrame, dataset: str) -> DataFrame:
    """Ledger rows for a finished run: `loaded` or `empty` for closed months, `open` for others."""
    known = pending.join(counts.withColumnRenamed("n", "rows"), ["year", "month"], "left")
    status = F.when(~F.col("closed"), "open").when(F.col("rows").isNull(), "empty").otherwise("loaded")
    return known.select(
        F.lit(dataset).alias("dataset"),
        "resource",
        "year",
        "month",
        status.alias("status"),
        F.coalesce("rows", F.lit(0)).cast("bigint").alias("rows"),
        F.current_timestamp().alias("recorded_at"),
    )


def record(entries: DataFrame, path: str) -> None:
    entries.coalesce(1).write.mode("append").parquet(path)
