"""Stored points in the order of a space-filling curve, so that a box reads few row groups.

Rows of a month are range-partitioned and sorted by a Z-order key of their place:
neighbours on the map become neighbours in the files, and the least and greatest
coordinates in a Parquet footer let a reader skip the groups outside a box. A
reader needs to know nothing of this; a plain filter on the coordinates does it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardgrid.functions.clean import valid_point
from wardgrid.schemas import PARTITION_COLUMNS

AXIS_BITS = 31
ROWS_PER_GROUP = 100_000


def _spread(value: Column) -> Column:
    """The bits of a number of `AXIS_BITS` bits, each followed by a zero."""
    for step in (16, 8, 4, 2, 1):
        mask = sum(((1 << step) - 1) << at for at in range(0, 64, 2 * step))
        value = value.bitwiseOR(F.shiftleft(value, step)).bitwiseAND(F.lit(mask))
    return value


def place_key(lat: str, lon: str) -> Column:
    """A BIGINT along the Z-order curve over the globe; NULL without a valid place."""

    def steps(degrees: str, half: float) -> Column:
        share = (F.col(degrees) + F.lit(half)) / F.lit(2 * half)
        return F.least(F.floor(share * F.lit(2.0**AXIS_BITS)), F.lit((1 << AXIS_BITS) - 1))

    key = F.shiftleft(_spread(steps(lat, 90.0)), 1).bitwiseOR(_spread(steps(lon, 180.0)))
    return F.when(valid_point(lat, lon), key)


def by_place(df: DataFrame, lat: str, lon: str, first: list[str] = PARTITION_COLUMNS, tasks: int | None = None) -> DataFrame:
    """`df` dealt to tasks by ranges of `first` and place, and sorted by them in each.

    Rows without a valid place come first. Rows at one place are told apart by a hash
    of all their columns, so a place that holds much of the data is split as well;
    only rows equal in every column stay together.
    """
    order = [*first, "_place", "_row"]
    keyed = df.withColumns({"_place": place_key(lat, lon), "_row": F.xxhash64(*df.columns)})
    dealt = keyed.repartitionByRange(tasks, *order) if tasks else keyed.repartitionByRange(*order)
    return dealt.sortWithinPartitions(*order).drop("_place", "_row")


def replace_months_by_place(df: DataFrame, root: str, lat: str, lon: str, rows_per_group: int = ROWS_PER_GROUP,
                            partitions: list[str] = PARTITION_COLUMNS, tasks: int | None = None) -> None:
    """As `sinks.replace_months`, with each month laid out by place.

    The writer sorts by partition again, and loses the order within, unless it can see
    that its rows come by partition. So the partition columns are made free of NULL (an
    empty text is the same folder), and pass through an array, which hides constants.
    """
    kinds = dict(df.dtypes)
    keys = [F.coalesce(c, F.lit("")).alias(c) if kinds[c] == "string" else F.col(c) for c in partitions]
    filled = df.select(*[c for c in df.columns if c not in partitions], F.inline(F.array(F.struct(*keys))))
    (
        by_place(filled, lat, lon, partitions, tasks)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "snappy")
        .option("parquet.block.row.count.limit", rows_per_group)
        .partitionBy(*partitions)
        .parquet(root)
    )
