"""From loosely typed, drifting records to text or typed columns.

Raw JSON is parsed once into a VARIANT, which keeps every key and its type, so
that a list, an object and a text that merely looks like one stay apart.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType, VariantType

from wardgrid.functions.cells import add_cells
from wardgrid.functions.clean import (
    computed_once,
    first_valid_point,
    month_key,
    number_text_sql,
    safe_double,
    safe_timestamp,
    scalar_text,
    year_key,
)

# The coordinate pairs of a record, in order of preference.
COORDINATE_PAIRS = [("latitude", "longitude"), ("location_latitude", "location_longitude")]

HOISTED = ("latitude", "longitude")
PLAIN = "plain"
NESTED = (StructType, ArrayType, MapType, VariantType)


# --- typed input: the schema says what is nested -----------------------------


def _hoist(df: DataFrame, name: str, data_type: StructType) -> list[Column]:
    fields = {f.name: f.dataType for f in data_type.fields}
    return [
        scalar_text(f"`{name}`.{part}", fields[part]).alias(f"{name}_{part}") for part in HOISTED if part in fields
    ]


def stringify_all(df: DataFrame, nested: str = "hoist") -> DataFrame:
    """Every column as text.

    `nested="hoist"`: an object gives `<name>_latitude` and `<name>_longitude`
    where it has them and nothing else; a list becomes JSON text.
    `nested="json"`: objects become JSON text as well.
    """
    out: list[Column] = []
    for f in df.schema.fields:
        if isinstance(f.dataType, StructType) and nested == "hoist":
            out.extend(_hoist(df, f.name, f.dataType))
        elif isinstance(f.dataType, NESTED):
            out.append(F.to_json(F.col(f.name)).alias(f.name))
        else:
            out.append(scalar_text(f"`{f.name}`", f.dataType).alias(f.name))
    return df.select(*out)


def lower_case_names(df: DataFrame) -> DataFrame:
    """Lower-case column names; two that become equal are refused."""
    names = [c.lower() for c in df.columns]
    if len(set(names)) < len(names):
        raise ValueError(f"column names differ in case only: {sorted(df.columns)}")
    return df.toDF(*names)


# --- raw JSON: the records say what they hold --------------------------------


def parse_records(lines: DataFrame, column: str = "value", strict: bool = True) -> DataFrame:
    """One `record` VARIANT per JSON object. A malformed line fails the job, or with
    `strict=False` is kept as a NULL record beside its text `line`.

    Of a key that an object repeats the last value counts.
    """
    lines.sparkSession.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    filled = lines.where(F.length(F.trim(F.col(column))) > 0)
    # once: a later filter on a field must not parse the line again
    if strict:
        return computed_once(filled, record=F.parse_json(F.col(column))).select("record")
    read = computed_once(filled.select(F.col(column).alias("line")), record=F.try_parse_json("line"))
    whole = F.startswith(F.schema_of_variant("record"), F.lit("OBJECT"))
    return read.select(F.when(whole, F.col("record")).alias("record"), F.when(~F.coalesce(whole, F.lit(False)), F.col("line")).alias("line"))


def landed_keys(records: DataFrame) -> DataFrame:
    """The distinct keys of all records: `key`, `scalar`, `list`, `object`,
    `latitude`, `longitude` - whether it ever held that kind of value.

    One pass with a map-side combine; what is shuffled is the number of keys.
    """
    return _key_flags(records).drop(PLAIN)


def _key_flags(records: DataFrame) -> DataFrame:
    spark = records.sparkSession
    entries = records.lateralJoin(spark.tvf.variant_explode(F.col("record").outer()))
    kind = F.schema_of_variant("value")
    return entries.groupBy("key").agg(
        F.max(~kind.startswith("OBJECT") & ~kind.startswith("ARRAY")).alias("scalar"),
        F.max(kind.startswith("ARRAY")).alias("list"),
        F.max(kind.startswith("OBJECT")).alias("object"),
        F.min(~kind.rlike("^(DECIMAL|DOUBLE|FLOAT)")).alias(PLAIN),
        *[F.max(F.try_variant_get("value", f"$.{part}", "variant").isNotNull()).alias(part) for part in HOISTED],
    )


def key_kinds(records: DataFrame) -> dict[str, set[str]]:
    """`landed_keys` on the driver: column names, not data. Keys that never held a number
    with a fraction or exponent are marked as well, which spares a test per value."""
    flags = ("scalar", "list", "object", PLAIN, *HOISTED)
    return {row["key"]: {f for f in flags if row[f]} for row in _key_flags(records).collect()}


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _value_sql(kind: str, *keys: str) -> str:
    """The value at nested keys. A path can't spell a key with both quote signs; such
    objects are read as maps."""
    value, path = "record", "$"
    for key in keys:
        if "'" in key and '"' in key:
            value = f"element_at(try_variant_get({value}, {_literal(path)}, 'map<string,variant>'), {_literal(key)})"
            path = "$"
        else:
            path += f"['{key}']" if "'" not in key else f'["{key}"]'
    return f"try_variant_get({value}, {_literal(path)}, '{kind}')"


def _text_sql(*keys: str) -> str:
    """A value as text; numbers with a fraction or exponent in plain notation."""
    text, kind = _value_sql("string", *keys), f"schema_of_variant({_value_sql('variant', *keys)})"
    number = f"{text} RLIKE r'^-?[0-9.]+(E-?[0-9]+)?$' AND ({kind} LIKE 'DECIMAL%' OR {kind} IN ('DOUBLE', 'FLOAT'))"
    return f"CASE WHEN {number} THEN {number_text_sql(_value_sql('double', *keys))} ELSE {text} END"


def text_at(*keys: str) -> Column:
    return F.expr(_text_sql(*keys))


def _text_unless_object(key: str, kinds: set[str]) -> Column:
    text = _value_sql("string", key) if PLAIN in kinds else _text_sql(key)
    if "object" not in kinds:
        return F.expr(text)
    kind = f"schema_of_variant({_value_sql('variant', key)})"
    return F.expr(f"CASE WHEN NOT startswith({kind}, 'OBJECT') THEN {text} END")


def _one_per_name(columns: Mapping[str, Sequence[Column]]) -> list[Column]:
    """One column for all sources of a name, the first that is not NULL. Names that differ
    in case only are one column, under the first spelling in order."""
    merged: dict[str, tuple[str, list[Column]]] = {}
    for name in sorted(columns):
        merged.setdefault(name.lower(), (name, []))[1].extend(columns[name])
    return [F.coalesce(*sources).alias(name) for name, sources in merged.values()]


def text_columns(records: DataFrame, kinds: Mapping[str, set[str]]) -> DataFrame:
    """All-text columns over the union of keys, sorted by name, NULL where absent.

    A column may have a flat and a nested source; each row takes what it has.
    """
    columns: dict[str, list[Column]] = {}
    for key, seen in kinds.items():
        if seen & {"scalar", "list"} or not seen - {PLAIN}:
            columns.setdefault(key, []).insert(0, _text_unless_object(key, seen))
        for part in HOISTED:
            if part in seen:
                columns.setdefault(f"{key}_{part}", []).append(text_at(key, part))
    return records.select(*_one_per_name(columns), *_carried(records))


def _carried(records: DataFrame) -> list[str]:
    """Marks that a caller put beside the records."""
    return [c for c in records.columns if c.startswith("_")]


def declared_kinds(columns: Iterable[str]) -> dict[str, set[str]]:
    """Kinds for a declared table, which saves the pass that discovers the keys.

    `location_latitude` and its twin may be flat keys or what a nested `location` is
    hoisted to.
    """
    kinds: dict[str, set[str]] = {}
    for name in columns:
        kinds.setdefault(name, set()).add("scalar")
        for part in HOISTED:
            if name == f"location_{part}":
                kinds.setdefault("location", set()).update({"object", part})
    return kinds


def feeding(kinds: Mapping[str, set[str]], names: Iterable[str]) -> dict[str, set[str]]:
    """The keys that columns of these names are made of, under any spelling."""
    wanted = {name.lower() for name in names}
    made = {key: {key.lower(), *(f"{key}_{part}".lower() for part in HOISTED if part in seen)} for key, seen in kinds.items()}
    return {key: seen for key, seen in kinds.items() if made[key] & wanted}


def typed_core(records: DataFrame, kinds: Mapping[str, set[str]], time_column: str,
               float_columns: Sequence[str]) -> DataFrame:
    """A timestamp, the float columns, then every other key as text sorted by name.

    Nested values become JSON text; unlike in the all-text form nothing is hoisted.
    """
    tail = sorted(set(kinds) - {time_column} - set(float_columns))
    columns = {c: [F.expr(_value_sql("string", c)) if PLAIN in kinds[c] else text_at(c)] for c in tail} | {c: [safe_double(_value_sql("string", c))] for c in float_columns}
    columns[time_column] = [safe_timestamp(_value_sql("string", time_column))]
    first = [columns[c][0].alias(c) for c in (time_column, *float_columns)]
    return records.select(*first, *_one_per_name({c: columns[c] for c in tail}), *_carried(records))


# --- shared by both forms ----------------------------------------------------


def with_coordinates(df: DataFrame, lat: str = "lat", lon: str = "lon",
                     pairs: Sequence[tuple[str, str]] = COORDINATE_PAIRS) -> DataFrame:
    """Add DOUBLE columns with the first valid pair of a row, both NULL without one."""
    present = [(a, o) for a, o in pairs if a in df.columns and o in df.columns]
    if not present:
        return df.withColumns({lat: F.lit(None).cast("double"), lon: F.lit(None).cast("double")})

    types = dict(df.dtypes)
    names = [name for pair in present for name in pair]
    numbers = df.withColumns({f"_{n}": F.col(n) if types[n] == "double" else safe_double(f"`{n}`") for n in names})
    point = first_valid_point(*[(f"`_{a}`", f"`_{o}`") for a, o in present])
    chosen = computed_once(numbers, _point=point).drop(*[f"_{name}" for name in names])
    return chosen.withColumns({lat: F.col("_point.lat"), lon: F.col("_point.lon")}).drop("_point")


def with_record_cells(df: DataFrame, pairs: Sequence[tuple[str, str]] = COORDINATE_PAIRS) -> DataFrame:
    """Add the cell columns for the row's coordinates."""
    placed = add_cells(with_coordinates(df, "_lat", "_lon", pairs), "_lon", "_lat")
    return placed.drop("_lat", "_lon")


def with_partition_keys(df: DataFrame, date_column: str) -> DataFrame:
    """Add text columns `year` and `month` from a timestamp or ISO text column."""
    is_text = dict(df.dtypes)[date_column] == "string"
    moment = safe_timestamp(f"`{date_column}`") if is_text else F.col(date_column)
    return computed_once(df, _at=moment).withColumns(
        {"year": year_key(F.col("_at")), "month": month_key(F.col("_at"))}
    ).drop("_at")


def to_declared(df: DataFrame, schema: StructType) -> DataFrame:
    """Exactly the declared columns with their declared types; absent ones are NULL.

    An all-NULL column keeps its type this way and never lands as a bare NULL column.
    """
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def undeclared_columns(df: DataFrame, schema: StructType) -> list[str]:
    """Drift report: landed columns that the declared table does not show."""
    return sorted(set(df.columns) - set(schema.names))


def latest_per_key(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, the greatest by `order` and then by the whole row.

    A max over structs combines on the map side, so copies of one key never
    gather in one task the way a row_number() window would make them.
    """
    rest = [c for c in df.columns if c not in key]
    ranked = F.struct(*[F.col(c) for c in order], *[F.col(c) for c in rest if c not in order])
    return df.groupBy(*key).agg(F.max(ranked).alias("_row")).select(
        *[F.col(c) if c in key else F.col(f"_row.{c}").alias(c) for c in df.columns]
    )
