"""Loads that are published as one whole: months, late rows and the state of the load in one snapshot.

Compared with `plans.loads`, which replaces months in place and keeps a ledger beside them:

* Readers of `sources.snapshots.read_snapshot` never see half a load, and two loads cannot both win.
* Landed files are known by the span of their months, so only new files and those that meet a pending month are
  read, in whatever folder a record lies.
* Rows of months that are done, from files that are new, are merged: files that hold one of their keys are written
  again, all others stay as they are. A record whose date moved leaves its old month.
* Every line of a new file is taken in or refused, and counted once over all loads.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from wardgrid.operators.normalise import key_kinds, latest_per_key
from wardgrid.operators.relational import union_resources
from wardgrid.plans.loads import REASONS, Kinds, clean_records, dataset_calendar, in_months, landed_resources, refusal
from wardgrid.schemas import PARTITION_COLUMNS, Dataset
from wardgrid.session import shared_folder
from wardgrid.sources import snapshots, zones

MONTHS = "resource string, year string, month string, status string, rows bigint"
DONE = ("loaded", "empty")
RANGES = 64
MARKS = ("_fresh", "_pending")


@dataclass(frozen=True)
class Published:
    """What a load published: `lines` of new files, of which `taken` were loaded and the others `refused` by
    resource and reason; `late` rows for months that were done; files read, written again, and left alone."""

    version: int
    lines: int
    taken: int
    late: int
    refused: dict[str, dict[str, int]]
    files_read: int
    files_rewritten: int
    files_kept: int


def month_states(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """The state of every month that a load has looked at, by resource."""
    return snapshots.read_part(spark, root, snapshots.latest(spark, root) if version is None else version, "months", MONTHS)


def _kept(df: DataFrame, purpose: str) -> DataFrame:
    path = shared_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _landing(spark: SparkSession, folders: Mapping[str, str], dataset: Dataset, known: DataFrame) -> DataFrame:
    """`zones.LANDED` and `fresh`: the files that lie in the folders now; only new ones are read."""
    present = reduce(DataFrame.unionByName, [zones.listed(spark, folders[r.name], r.name) for r in landed_resources(folders, dataset)])
    present = _kept(present, "listing")
    old = known.join(present, zones.SAME, "left_semi").withColumn("fresh", F.lit(False))
    new = zones.spans(spark, present.join(known, zones.SAME, "left_anti"), dataset.date_column).withColumn("fresh", F.lit(True))
    return _kept(old.unionByName(new), "zones")


def _one_per_key(rows: DataFrame, dataset: Dataset) -> DataFrame:
    """The latest row of each key, of equal dates that from a new file; rows without a key all stay."""
    if dataset.key_column not in rows.columns:
        return rows
    unnamed = rows.withColumn("_unnamed", F.when(F.col(dataset.key_column).isNull(), F.monotonically_increasing_id()))
    return latest_per_key(unnamed, [dataset.key_column, "_unnamed"], [dataset.date_column, "_fresh"]).drop("_unnamed")


def _staged(spark: SparkSession, landing: DataFrame, dataset: Dataset, folders: Mapping[str, str], pending: list, kinds: Kinds | None,
            cells: bool) -> tuple[DataFrame | None, dict[str, Observation], int]:
    """Rows of pending months from all files that have some, and all rows of new files, parsed once and written
    to the scratch folder."""
    frames, watch, read = [], {}, 0
    needed = landing.where(F.col("fresh") | zones.meets(pending)).select("resource", "path", "fresh").collect()
    for resource in landed_resources(folders, dataset):
        parts = []
        for fresh in (False, True):
            paths = [f["path"] for f in needed if f["resource"] == resource.name and f["fresh"] == fresh]
            read += len(paths)
            if paths:
                parts.append(zones.line_file(spark, paths).withColumn("_fresh", F.lit(fresh)))
        if not parts:
            continue
        records = reduce(DataFrame.unionByName, parts).withColumn("_malformed", F.col("record").isNull())
        found = key_kinds(records) if kinds is None else kinds
        wanted = [m for m in pending if m["resource"] == resource.name]
        rows = clean_records(records, dataset, found, cells).withColumns({"_reason": refusal(resource), "_pending": in_months(wanted)})
        watch[resource.name] = Observation()
        counts = [F.count_if(F.col("_fresh") & (F.col("_reason") == r)).alias(r) for r in REASONS]
        rows = rows.observe(watch[resource.name], *counts, F.count_if("_fresh").alias("lines"))
        frames.append(rows.where(F.col("_reason").isNull() & (F.col("_fresh") | F.coalesce("_pending", F.lit(False)))).drop("_reason", "_malformed"))
    return (_kept(union_resources(*frames), "staged") if frames else None), watch, read


def _near_keys(keys: DataFrame, key: str) -> Column:
    """Whether a file's range of keys may hold one of `keys`: compared with the ranges of a few parts of them."""
    parts = keys.repartitionByRange(RANGES, key).groupBy(F.spark_partition_id()).agg(F.min(key).alias("low"), F.max(key).alias("high"))
    near = [(F.col("low") <= r["high"]) & (F.col("high") >= r["low"]) for r in parts.collect()]
    return reduce(Column.__or__, near, F.lit(False))


def _touched(spark: SparkSession, root: str, files: DataFrame, rows: DataFrame, key: str) -> list[str]:
    """The files that hold a key of new rows: by their ranges first, then by their key column alone."""
    keys = _kept(rows.where(F.col("_fresh") & F.col(key).isNotNull()).select(key).distinct(), "keys")
    near = [r["path"] for r in files.where(_near_keys(keys, key)).select("path").collect()]
    return [r["path"] for r in snapshots.named_files(spark, root, near, key).join(keys, key, "left_semi").select("path").distinct().collect()]


def publish_months(spark: SparkSession, folders: Mapping[str, str], dataset: Dataset, root: str, as_of: date,
                   kinds: Kinds | None = None, cells: bool = True) -> Published:
    """Load the pending months of the resources in `folders` (name to landing folder) and merge late rows.

    Raises `snapshots.PublishConflict` if another load published meanwhile; the table then is as that load left it,
    and this one can be repeated. Resources that are not in `folders` keep their months and their state.
    """
    base = snapshots.latest(spark, root)
    states = snapshots.read_part(spark, root, base, "months", MONTHS)
    files = snapshots.read_part(spark, root, base, "files", snapshots.FILES)
    known = snapshots.read_part(spark, root, base, "landing", zones.LANDED)
    calendar = dataset_calendar(spark, landed_resources(folders, dataset), as_of)
    done = states.where(F.col("status").isin(*DONE))
    pending = calendar.join(done, ["resource", *PARTITION_COLUMNS], "left_anti").collect()
    landing = _landing(spark, folders, dataset, known)
    rows, watch, read = _staged(spark, landing, dataset, folders, pending, kinds, cells)
    refused, lines, late, touched = {}, 0, 0, []
    left = files.where(~in_months(pending))
    if rows is not None:
        for name, seen in watch.items():
            counts = seen.get
            lines += counts["lines"]
            refused[name] = {r: counts[r] for r in REASONS if counts[r]}
        rows = _one_per_key(rows, dataset)
        if dataset.key_column in rows.columns:
            touched = _touched(spark, root, left, rows, dataset.key_column)
        if touched:
            before = snapshots.read_files(spark, root, touched).withColumns({"_fresh": F.lit(False), "_pending": F.lit(False)})
            rows = _one_per_key(before.unionByName(rows, allowMissingColumns=True), dataset)
            left = left.join(spark.createDataFrame([(p,) for p in touched], "path string"), "path", "left_anti")
        # written once: dealing rows out by ranges reads them twice
        rows = _kept(rows, "rows")
        late = rows.where(F.col("_fresh") & ~F.col("_pending")).count()
        key = dataset.key_column if dataset.key_column in rows.columns else None
        stored = rows.drop(*MARKS)
        load = snapshots.write_load(stored, root, key, dataset.rows_per_file)
        left = left.unionByName(snapshots.files_of(spark, root, load, key, stored.schema))
    left = _kept(left, "files")
    held = left.groupBy(*PARTITION_COLUMNS).agg(F.sum("rows").alias("n"))
    # months of absent resources, and months that were done, stay done
    kept = states.join(calendar.select("resource", *PARTITION_COLUMNS), ["resource", *PARTITION_COLUMNS], "left_anti").select("resource", *PARTITION_COLUMNS, (F.col("status") != "open").alias("closed"))
    months = calendar.unionByName(kept).join(held, PARTITION_COLUMNS, "left")
    status = F.when(~F.col("closed"), "open").when(F.col("n").isNull(), "empty").otherwise("loaded")
    months = months.select("resource", *PARTITION_COLUMNS, status.alias("status"), F.coalesce("n", F.lit(0)).cast("bigint").alias("rows"))
    others = known.where(~F.col("resource").isin(list(folders)))
    version = snapshots.publish(spark, root, base, {"files": left, "months": months, "landing": others.unionByName(landing.drop("fresh"))})
    untouched = left.join(files, "path", "left_semi").count()
    return Published(version, lines, lines - sum(sum(r.values()) for r in refused.values()), late, refused, read, len(touched), untouched)
