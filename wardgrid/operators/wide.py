"""Header-row responses, curated measures and the wide multi-vintage table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardgrid.functions.clean import geoid, number_text, safe_double, sentinel_to_null, share
from wardgrid.schemas import COUNTIES, MEASURES, STATE


def header_rows(responses: DataFrame, columns: Sequence[str], text: str = "value") -> DataFrame:
    """Rows of JSON arrays-of-arrays whose first array holds the column names.

    Each response is read by its own header, so the order of columns may differ
    between responses; a name that a response lacks is NULL.
    """
    tables = responses.select(F.from_json(F.col(text), "array<array<string>>").alias("_t"))
    rows = tables.select(
        F.col("_t")[0].alias("_header"),
        F.explode(F.slice("_t", F.lit(2), F.greatest(F.size("_t") - 1, F.lit(0)))).alias("_row"),
    )
    return rows.selectExpr(*[f"get(_row, CAST(array_position(_header, '{name}') AS INT) - 1) AS {name}" for name in columns])


def in_counties(rows: DataFrame, state: str = STATE, counties: Sequence[str] = COUNTIES) -> DataFrame:
    return rows.where((F.col("state") == state) & F.col("county").isin(*counties))


def curated(rows: DataFrame, measures: Mapping[str, str] = MEASURES) -> DataFrame:
    """`geoid` and the renamed measures as DOUBLE, missing-value codes as NULL."""
    numbers = rows.select(
        geoid(F.col("state"), F.col("county"), F.col("tract")).alias("geoid"),
        *[safe_double(code).alias(name) for code, name in measures.items()],
    )
    return numbers.select("geoid", *[sentinel_to_null(name).alias(name) for name in measures.values()])


def suffixed(df: DataFrame, suffix: object, key: str = "geoid") -> DataFrame:
    """Add `_<suffix>` to every column but the key."""
    return df.withColumnsRenamed({c: f"{c}_{suffix}" for c in df.columns if c != key})


def merge_vintages(vintages: Mapping[object, DataFrame], key: str = "geoid") -> DataFrame:
    """Full outer merge, so a key found in one vintage only keeps its row."""
    frames = [suffixed(df, name, key) for name, df in vintages.items()]
    return reduce(lambda left, right: left.join(right, key, "full_outer"), frames)


def as_stored_text(df: DataFrame, key: str = "geoid") -> DataFrame:
    """The stored form: doubles as plain text, `85000.0`."""
    return df.select(*[F.col(c) if c == key else number_text(c).alias(c) for c in df.columns])


def demographic_rates(df: DataFrame, vintage: int) -> DataFrame:
    """Rates from the counts of one vintage of the stored table."""
    def m(name: str):
        return safe_double(f"{name}_{vintage}")

    degrees = m("edu_bachelors") + m("edu_masters") + m("edu_professional") + m("edu_doctorate")
    limited = (
        m("lang_lim_eng_spanish")
        + m("lang_lim_eng_other_indo_european")
        + m("lang_lim_eng_asian_pacific_island")
        + m("lang_lim_eng_other")
    )
    return df.select(
        "geoid",
        share(degrees, m("edu_universe_25plus")).alias("bachelors_or_more"),
        share(m("poverty_below"), m("poverty_universe")).alias("poverty"),
        share(m("housing_owner_occupied"), m("housing_universe")).alias("owner_occupied"),
        share(limited, m("lang_universe")).alias("limited_english"),
    )
