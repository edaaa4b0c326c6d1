"""Month loads: landed records to partitioned tables, resumable by ledger."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field, replace
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from wardgrid.operators.normalise import (
    COORDINATE_PAIRS,
    feeding,
    key_kinds,
    latest_per_key,
    parse_records,
    text_at,
    text_columns,
    typed_core,
    with_partition_keys,
    with_record_cells,
)
from wardgrid.operators.relational import count_by, union_resources
from wardgrid.schemas import PARTITION_COLUMNS, Dataset, Resource, text_schema
from wardgrid.sources.calendar import month_calendar
from wardgrid.sources.ledger import load_entries, pending_months, read_ledger, record
from wardgrid.sources.sinks import month_files, remove_months, replace_months, replace_table
from wardgrid.sources.tables import read_if_present

Kinds = Mapping[str, set[str]]

REASONS = ("malformed", "undated", "outside")
CLOSED = "closed"
# a record's month where it is known before its columns are read
MONTH = ("_of_year", "_of_month")


def clean_records(records: DataFrame, dataset: Dataset, kinds: Kinds, cells: bool = True) -> DataFrame:
    """Parsed records as the data set's columns, with cell (if asked for) and partition keys."""
    kinds = {dataset.date_column: {"scalar"}} | dict(kinds)
    pairs = COORDINATE_PAIRS
    if dataset.typed:
        rows, pairs = typed_core(records, kinds, dataset.date_column, dataset.float_columns), COORDINATE_PAIRS[:1]
    else:
        rows = text_columns(records, kinds)
    rows = with_record_cells(rows, pairs) if cells else rows
    if set(MONTH) <= set(records.columns):
        return rows.withColumns({"year": F.col(MONTH[0]), "month": F.col(MONTH[1])}).drop(*MONTH)
    return with_partition_keys(rows, dataset.date_column)


def _narrowed(dataset: Dataset, kinds: Kinds, names: Iterable[str]) -> tuple[Dataset, Kinds]:
    """What the columns of these names and the date take, of a data set and its keys."""
    floats = tuple(c for c in dataset.float_columns if c in set(names))
    return replace(dataset, float_columns=floats), feeding(kinds, [dataset.date_column, *names])


def dated_records(records: DataFrame, dataset: Dataset, kinds: Kinds) -> DataFrame:
    """The records and marks with `year` and `month`; no other column is read from a record yet."""
    dated = clean_records(records.withColumn("_record", F.col("record")), *_narrowed(dataset, kinds, []), cells=False)
    marks = [c for c in records.columns if c.startswith("_")]
    return dated.select(F.col("_record").alias("record"), *marks, *PARTITION_COLUMNS)


def in_years(resource: Resource) -> Column:
    """Whether a row's year is one of the resource's; the last year may be open."""
    inside = F.col("year") >= f"{resource.first_year:04d}"
    return inside if resource.last_year is None else inside & (F.col("year") <= f"{resource.last_year:04d}")


def refusal(resource: Resource) -> Column:
    """Why a row is not loaded, or NULL: `malformed` line, `undated` record, or `outside`
    the resource's years."""
    return (
        F.when(F.col("_malformed"), "malformed").when(F.col("year").isNull(), "undated").when(~in_years(resource), "outside")
    )


def refused_rows(landed: Mapping[str, DataFrame], dataset: Dataset) -> DataFrame:
    """(resource, reason, text) of every landed line that no load stores. Reads the date only."""
    frames = []
    for resource in dataset.resources:
        if resource.name in landed:
            records = parse_records(landed[resource.name], strict=False)
            dated = records.select("record", "line", F.col("record").isNull().alias("_malformed"), text_at(dataset.date_column).alias("_date"))
            reason = with_partition_keys(dated, "_date").withColumn("reason", refusal(resource)).where("reason is not null")
            frames.append(reason.select(F.lit(resource.name).alias("resource"), "reason", F.coalesce("line", F.to_json("record")).alias("text")))
    return reduce(DataFrame.unionByName, frames)


def refused_counts(landed: Mapping[str, DataFrame], dataset: Dataset) -> dict[str, dict[str, int]]:
    """The number of refused lines by resource and reason."""
    counts: dict[str, dict[str, int]] = {name: {} for name in landed}
    if landed:
        for row in refused_rows(landed, dataset).groupBy("resource", "reason").count().collect():
            counts[row["resource"]][row["reason"]] = row["count"]
    return counts


def one_per_key(rows: DataFrame, dataset: Dataset) -> DataFrame:
    """Of rows that share the data set's key the latest; rows without a key all stay."""
    if dataset.key_column not in rows.columns:
        return rows
    unnamed = rows.withColumn("_unnamed", F.when(F.col(dataset.key_column).isNull(), F.monotonically_increasing_id()))
    return latest_per_key(unnamed, [dataset.key_column, "_unnamed"], [dataset.date_column]).drop("_unnamed")


def clean_resources(landed: Mapping[str, DataFrame], dataset: Dataset, kinds: Kinds | None = None, cells: bool = True,
                    pending: Iterable[Row] | None = None, watch: dict[str, Observation] | None = None,
                    columns: Iterable[str] | None = None) -> DataFrame | None:
    """All resources of a data set as one table, each held to its own years.

    Without `kinds` the keys are discovered first, which reads the records twice;
    for a known table pass `declared_kinds(dataset.text_columns)`. With `pending`
    months (resource, year, month) only their rows are kept, and resources without one
    are not read. Where a line landed says nothing about the month of its record, so
    folders are not pruned; `plans.published` knows which files hold which months.
    `watch` gets an observation a resource: the rows of the pass that are refused, by
    reason, and those of months that are done (`closed`). Only rows that stay are read beyond
    their date. With `columns` no others than these and the date are made, nor cells.
    """
    frames = []
    for resource in landed_resources(landed, dataset):
        wanted = None if pending is None else [m for m in pending if m["resource"] == resource.name]
        if wanted == []:
            continue
        records = parse_records(landed[resource.name], strict=False)
        found = key_kinds(records) if kinds is None else kinds
        flagged = records.withColumn("_malformed", F.col("record").isNull())
        reason = refusal(resource) if wanted is None else F.coalesce(refusal(resource), F.when(~in_months(wanted), CLOSED))
        rows = dated_records(flagged, dataset, found).withColumn("_reason", reason)
        if watch is not None:
            watch[resource.name] = Observation()
            rows = rows.observe(watch[resource.name], *[F.count_if(F.col("_reason") == r).alias(r) for r in (*REASONS, CLOSED)])
        staying = rows.where("_reason is null").drop("_reason", "_malformed").withColumnsRenamed(dict(zip(PARTITION_COLUMNS, MONTH, strict=True)))
        shape = (dataset, found) if columns is None else _narrowed(dataset, found, columns)
        frames.append(clean_records(staying, *shape, cells=cells and columns is None))
    return union_resources(*frames) if frames else None


def landed_resources(landed: Iterable[str], dataset: Dataset) -> list[Resource]:
    """The resources that landed. Years of a data set's resources must not overlap: a month
    is replaced whole, so it has to belong to one resource."""
    spans = sorted((r.first_year, r.last_year or 9999, r.name) for r in dataset.resources)
    for (_, last, one), (first, _, other) in zip(spans, spans[1:], strict=False):
        if first <= last:
            raise ValueError(f"resources {one} and {other} of {dataset.table} share the year {first}")
    known = [r for r in dataset.resources if r.name in set(landed)]
    if not known:
        raise ValueError(f"no landed resource of {dataset.table}; known are {[r.name for r in dataset.resources]}")
    return known


def dataset_calendar(spark: SparkSession, resources: Iterable[Resource], as_of: date) -> DataFrame:
    """The months of each resource (resource, year, month, closed); an open one goes on to the present."""
    spans = [
        month_calendar(spark, r.first_year, r.last_year or max(r.first_year, as_of.year), as_of).withColumn("resource", F.lit(r.name))
        for r in resources
    ]
    return reduce(DataFrame.union, spans).select("resource", "year", "month", "closed")


def _pending(spark: SparkSession, landed: Iterable[str], dataset: Dataset, ledger_path: str, as_of: date) -> DataFrame:
    """Pending months of the resources that landed; what is absent stays as it is."""
    calendar = dataset_calendar(spark, landed_resources(landed, dataset), as_of)
    return pending_months(calendar, read_ledger(spark, ledger_path), dataset.table)


@dataclass(frozen=True)
class LoadPreview:
    """What a load would write."""

    schema: StructType
    months: DataFrame
    first_partition: tuple[str, str] | None


@dataclass(frozen=True)
class LoadReport:
    """What a load wrote: rows in all, the ledger entries of its months, and the lines it
    left out, by resource and reason; `closed` are those of months that are done."""

    rows: int
    months: DataFrame
    refused: dict[str, dict[str, int]] = field(default_factory=dict)


def preview_load(spark: SparkSession, landed: Mapping[str, DataFrame], dataset: Dataset, ledger_path: str,
                 as_of: date, kinds: Kinds | None = None, cells: bool = True) -> LoadPreview:
    """A dry run: schema, rows per pending month and the first partition. Nothing is
    written, the ledger included, so a later load still sees every month as pending."""
    pending = _pending(spark, landed, dataset, ledger_path, as_of).collect()
    rows = clean_resources(landed, dataset, kinds, cells, pending)
    if rows is None:  # nothing is pending: the columns of a load, and no row
        rows = clean_resources(landed, dataset, kinds, cells).where(F.lit(False))
    # the latest row of a key is told by its date, and so is its month
    keyed = clean_resources(landed, dataset, kinds, cells, pending, columns=[dataset.key_column] if dataset.key_column else [])
    counts = count_by(one_per_key(rows if keyed is None else keyed, dataset), "year", "month")
    # counted once; a row per pending month at most
    found = sorted(counts.collect())
    return LoadPreview(rows.schema, spark.createDataFrame(found, counts.schema), tuple(found[0][:2]) if found else None)


def in_months(months: Iterable[Row]) -> Column:
    """Whether a row is of one of the months; twelve values a year at most. On a stored table
    this prunes folders."""
    return F.concat_ws("-", "year", "month").isin([f"{m['year']}-{m['month']}" for m in months])


def load_months(spark: SparkSession, landed: Mapping[str, DataFrame], dataset: Dataset, root: str, ledger_path: str,
                as_of: date, kinds: Kinds | None = None, cells: bool = True, refused_path: str | None = None) -> LoadReport:
    """Load every pending month of the landed resources and record it by resource.

    Resources that did not land keep their months and their state. Months are replaced whole from all landed rows, so a run that died between
    the write and the ledger entry is simply repeated. A pending month of which no
    row is left loses its old files. Refused lines are counted in the same pass,
    and kept as a table at `refused_path` where one is given.
    """
    calendar = _pending(spark, landed, dataset, ledger_path, as_of)
    pending = calendar.collect()
    watch: dict[str, Observation] = {}
    rows = clean_resources(landed, dataset, kinds, cells, pending, watch)
    names = [(m["year"], m["month"]) for m in pending]
    before = month_files(spark, root, names)
    if rows is not None:
        replace_months(one_per_key(rows, dataset), root, dataset.rows_per_file)
    # files have new names with each write: those that are still there belong to months without rows
    after = month_files(spark, root, names)
    remove_months(spark, root, [m for m in names if before[m] and before[m] == after[m]])
    if before != after:
        refused = {name: {r: n for r, n in seen.get.items() if n} for name, seen in watch.items()}
    else:  # Spark drops observations from a plan that turns out to be empty
        refused = refused_counts({n: landed[n] for n in watch}, dataset)
    if refused_path and any(r in REASONS for seen in refused.values() for r in seen):
        replace_table(refused_rows({n: landed[n] for n in refused}, dataset), refused_path)
    closed = spark.createDataFrame(pending, calendar.schema)
    entries = load_entries(closed, stored_counts(spark, root, pending), dataset.table)
    # one row per month, fixed before the ledger grows
    months = entries.collect()
    entries = spark.createDataFrame(months, entries.schema)
    if months:
        record(entries, ledger_path)
    return LoadReport(sum(m["rows"] for m in months), entries, refused)


def stored_counts(spark: SparkSession, root: str, pending: Iterable[Row]) -> DataFrame:
    """Rows per pending month as stored; reads file footers and no column."""
    keys = text_schema(*PARTITION_COLUMNS)
    stored = read_if_present(spark, root, keys)
    return count_by(stored.where(in_months(pending)), "year", "month")
