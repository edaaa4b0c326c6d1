"""Counts, top-k, unions and lookups used by the reports.

Equi-joins carry no hint: Spark broadcasts a side by its own size check and
AQE splits skewed partitions otherwise.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def count_by(df: DataFrame, *keys: str | Column, count: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count))


def top_k(df: DataFrame, metric: str, k: int, tie_break: Sequence[str]) -> DataFrame:
    """The k greatest by `metric`, NULL last, ties settled by `tie_break`."""
    return df.orderBy(F.desc_nulls_last(metric), *[F.asc_nulls_last(c) for c in tie_break]).limit(k)


def ascending(df: DataFrame, *keys: str) -> DataFrame:
    return df.orderBy(*[F.asc_nulls_last(c) for c in keys])


def ordered_page(df: DataFrame, order: Sequence[str], offset: int, rows: int) -> DataFrame:
    """One page of an ordered table. `order` should be a unique key: ties on a
    page border would otherwise be repeated or missed."""
    return ascending(df, *order).offset(offset).limit(rows)


def union_resources(*frames: DataFrame) -> DataFrame:
    """Union by name; columns that a resource lacks are NULL."""
    first, *rest = frames
    for frame in rest:
        first = first.unionByName(frame, allowMissingColumns=True)
    return first


def repeated_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their counts; empty for a sound union."""
    return count_by(df, *key).where(F.col("n") > 1)


def lookup(facts: DataFrame, dimension: DataFrame, fact_key: str, dimension_key: str) -> DataFrame:
    """Inner equi-join on keys of different types, compared as text."""
    keyed = dimension.withColumn("_key", F.col(dimension_key).cast("string"))
    return facts.withColumn("_key", F.col(fact_key).cast("string")).join(keyed, "_key").drop("_key")


def difference(df: DataFrame, later: str, earlier: str, name: str = "delta") -> DataFrame:
    return df.withColumn(name, F.col(later) - F.col(earlier))
