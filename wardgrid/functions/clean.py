"""Casts, text forms and small measures for loosely typed records.

Functions that take a `str` want a column name or an SQL expression. Text is
handed to the parser in one piece, which spares wide tables thousands of small
calls to the JVM while a plan is built.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DoubleType, FloatType

from wardgrid.schemas import SENTINEL_BELOW

# The accepted spellings of a number and of a zone-less timestamp.
NUMBER = r"r'^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$'"
TIMESTAMP = r"r'^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d+)?)?)?$'"
BLANKS = r"' \t\n\r\u000B\u000C'"


def record(**fields: Column) -> Column:
    """A struct with these field names; unlike aliases they survive next to an explode."""
    return F.named_struct(*[part for name, value in fields.items() for part in (F.lit(name), value)])


def computed_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that later filters refer to instead of repeating them.

    The optimizer moves a filter below the projection it reads from by copying
    the projection's expressions into it. It does not do that through a generator,
    so costly expressions with many uses pass through a one-element inline.
    """
    return df.select("*", F.inline(F.array(record(**columns))))


def _stripped(text: str) -> str:
    return f"btrim({text}, {BLANKS})"


def number_sql(text: str) -> str:
    value = _stripped(text)
    return f"CASE WHEN {value} RLIKE {NUMBER} THEN try_cast({value} AS DOUBLE) END"


def safe_double(text: str) -> Column:
    """Text to DOUBLE; NULL for NULL, blank and anything that is not a plain number.

    The guard keeps out spellings that only some engines take: `1_000`, `1.0d`,
    `nan`, `inf`.
    """
    return F.expr(number_sql(text))


def safe_timestamp(text: str) -> Column:
    """ISO text to TIMESTAMP_NTZ; a trailing `Z` is dropped without shifting."""
    value = f"regexp_replace({_stripped(text)}, 'Z$', '')"
    return F.expr(f"CASE WHEN {value} RLIKE {TIMESTAMP} THEN try_cast({value} AS TIMESTAMP_NTZ) END")


def safe_bigint(text: str) -> Column:
    """Text to BIGINT through DOUBLE, because `'85000.0'` is how counts are stored."""
    return F.expr(f"try_cast({number_sql(text)} AS BIGINT)")


def sentinel_to_null(value: str, below: int = SENTINEL_BELOW) -> Column:
    """NULL for values strictly below the missing-value threshold."""
    return F.expr(f"CASE WHEN {value} >= CAST({below} AS DOUBLE) THEN {value} END")


def number_text_sql(value: str) -> str:
    """DOUBLE to plain text: `10.0`, and no exponent from 0.0001 up to 1e16."""
    wide = rf"regexp_replace(CAST(CAST({value} AS DECIMAL(38, 12)) AS STRING), r'(\.\d+?)0+$', '$1')"
    plain = f"abs({value}) >= 1E-3 AND abs({value}) < 1E7 OR abs({value}) < 1E-4 OR abs({value}) >= 1E16"
    return f"CASE WHEN {plain} THEN CAST({value} AS STRING) ELSE {wide} END"


def number_text(value: str) -> Column:
    return F.expr(number_text_sql(value))


def scalar_text(name: str, data_type: DataType) -> Column:
    """A scalar as text; NULL stays NULL and an empty string stays empty."""
    if isinstance(data_type, FloatType):
        return number_text(f"CAST(CAST({name} AS STRING) AS DOUBLE)")
    if isinstance(data_type, DoubleType):
        return number_text(name)
    return F.col(name).cast("string")


def valid_sql(lat: str, lon: str) -> str:
    return f"({lat} BETWEEN -90D AND 90D AND {lon} BETWEEN -180D AND 180D)"


def valid_point(lat: str, lon: str) -> Column:
    """True where both are present, finite and inside ±90 / ±180."""
    return F.expr(valid_sql(lat, lon))


def first_valid_point(*pairs: tuple[str, str]) -> Column:
    """`struct<lat,lon>` of the first (lat, lon) pair that is valid; pairs are never mixed."""
    choices = [
        f"CASE WHEN {valid_sql(lat, lon)} THEN named_struct('lat', {lat}, 'lon', {lon}) END" for lat, lon in pairs
    ]
    return F.expr(f"coalesce({', '.join(choices)})")


def in_box(lat: Column, lon: Column, south: float = 40.4, north: float = 41.0,
           west: float = -74.3, east: float = -73.6) -> Column:
    """Inclusive bounding-box test."""
    return lat.between(F.lit(south), F.lit(north)) & lon.between(F.lit(west), F.lit(east))


def year_key(moment: Column) -> Column:
    return F.date_format(moment, "yyyy")


def month_key(moment: Column) -> Column:
    """Two digits, `01` to `12`."""
    return F.date_format(moment, "MM")


def geoid(state: Column, county: Column, tract: Column) -> Column:
    """The composite key; NULL if a part is NULL."""
    return F.concat(state, county, tract)


def share(part: Column, whole: Column) -> Column:
    """part / whole in DOUBLE; NULL where the whole is zero or NULL."""
    return part.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0))


def per_thousand(count: Column, population: Column) -> Column:
    """1000 * count / population in DOUBLE; NULL for an empty population."""
    return F.lit(1000.0) * count.cast("double") / F.nullif(population.cast("double"), F.lit(0.0))
