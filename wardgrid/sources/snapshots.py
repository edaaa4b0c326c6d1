"""Snapshots of a month-partitioned table: which files are the table, published as one whole.

A load writes its files under a folder of its own, `load=<id>/year=Y/month=M`, where no reader looks yet. Then it
writes the tables of the next snapshot beside the others and renames their folder to the next version. The rename
fails if that version exists, so of two loads that started from the same version one wins and the other raises
`PublishConflict`; whatever else dies on the way leaves files that no snapshot names. Readers take one version and
see all of its months or, before the rename, all of the old ones.

The part `files` of a snapshot has a row for each file: its month, rows and range of keys. Other parts are up to the
load. What the driver holds is names of files, as Spark's own file index does.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from wardgrid.schemas import PARTITION_COLUMNS, text_schema, with_partitions

FOLDER = "_snapshots"
LOAD = "load"
# in_folder: the files that the load wrote into the same folder, to tell whole folders
FILES = "year string, month string, path string, rows bigint, low string, high string, in_folder bigint"


class PublishConflict(RuntimeError):
    """Another load has published the next version first; read again and repeat."""


def _store(spark: SparkSession, root: str):
    path = spark._jvm.org.apache.hadoop.fs.Path
    return path, path(root).getFileSystem(spark._jsc.hadoopConfiguration())


def versions(spark: SparkSession, root: str) -> list[int]:
    path, store = _store(spark, root)
    folder = path(f"{root}/{FOLDER}")
    names = [s.getPath().getName() for s in store.listStatus(folder)] if store.exists(folder) else []
    return sorted(int(n[1:]) for n in names if n[0] == "v")


def latest(spark: SparkSession, root: str) -> int:
    """The newest version; 0 if nothing was published."""
    return max(versions(spark, root), default=0)


def read_part(spark: SparkSession, root: str, version: int, part: str, schema: str) -> DataFrame:
    if not version:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{root}/{FOLDER}/v{version:08d}/{part}")


def publish(spark: SparkSession, root: str, base: int, parts: Mapping[str, DataFrame]) -> int:
    """Make `parts` the version after `base`, or raise `PublishConflict` and change nothing."""
    draft = f"{root}/{FOLDER}/_draft-{uuid.uuid4().hex}"
    for name, table in parts.items():
        table.hint("rebalance").write.parquet(f"{draft}/{name}")
    path, store = _store(spark, root)
    contexts = spark._jvm.org.apache.hadoop.fs.FileContext
    target = path(f"{root}/{FOLDER}/v{base + 1:08d}")
    never_over = spark.sparkContext._gateway.new_array(getattr(spark._jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        contexts.getFileContext(store.getUri(), spark._jsc.hadoopConfiguration()).rename(path(draft), target, never_over)
    except Py4JJavaError as error:
        if not store.exists(target):
            raise
        store.delete(path(draft), True)
        raise PublishConflict(f"version {base + 1} of {root} is there already") from error
    return base + 1


# --- files -------------------------------------------------------------------


def write_load(rows: DataFrame, root: str, key: str | None, rows_per_file: int = 0) -> str:
    """Write rows (with `year` and `month`) as files of a new load and return its id. Files hold ranges of keys of
    a month; a month or key that holds much of the data is spread."""
    load = uuid.uuid4().hex
    order = [F.col(c) for c in (*PARTITION_COLUMNS, *([key] if key else []))]
    spread = F.when(F.col(key).isNull(), F.monotonically_increasing_id()) if key else F.monotonically_increasing_id()
    dealt = rows.withColumn("_spread", spread).repartitionByRange(*order, "_spread").sortWithinPartitions(*order).drop("_spread")
    writer = dealt.write.option("compression", "snappy").partitionBy(*PARTITION_COLUMNS)
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    writer.parquet(f"{root}/{LOAD}={load}")
    return load


def _inside(path: Column) -> Column:
    return F.concat(F.lit(f"{LOAD}="), F.substring_index(path, f"/{LOAD}=", -1))


def files_of(spark: SparkSession, root: str, load: str, key: str | None, schema: StructType) -> DataFrame:
    """`FILES` of a load; reads the key column only."""
    rows = _read(spark, root, schema, [f"{root}/{LOAD}={load}"])
    named = rows.select(*PARTITION_COLUMNS, _inside(F.col("_metadata.file_path")).alias("path"), (F.col(key) if key else F.lit(None)).cast("string").alias("_key"))
    files = named.groupBy(*PARTITION_COLUMNS, "path").agg(F.count("*").alias("rows"), F.min("_key").alias("low"), F.max("_key").alias("high"))
    folders = files.groupBy(*PARTITION_COLUMNS).agg(F.count("*").alias("in_folder"))
    return files.join(folders, PARTITION_COLUMNS).select(*[f.split()[0] for f in FILES.split(", ")])


def _read(spark: SparkSession, root: str, schema: StructType, paths: list[str], merge: bool = False) -> DataFrame:
    if not paths:
        return spark.createDataFrame([], schema)
    reader = spark.read.option("basePath", root)
    if merge:
        return reader.option("mergeSchema", "true").parquet(*paths).drop(LOAD)
    declared = StructType([*[f for f in schema.fields if f.name not in PARTITION_COLUMNS], *text_schema(LOAD, *PARTITION_COLUMNS).fields])
    return reader.schema(declared).parquet(*paths).drop(LOAD)


def read_files(spark: SparkSession, root: str, paths: list[str]) -> DataFrame:
    """Files by their paths in the table, with all columns that any of them has."""
    return _read(spark, root, StructType(), [f"{root}/{p}" for p in paths], merge=True)


def named_files(spark: SparkSession, root: str, paths: list[str], column: str) -> DataFrame:
    """(column, path) of the rows of some files; reads that column only."""
    rows = _read(spark, root, text_schema(column), [f"{root}/{p}" for p in paths])
    return rows.select(column, _inside(F.col("_metadata.file_path")).alias("path")) if paths else spark.createDataFrame([], f"{column} string, path string")


def read_snapshot(spark: SparkSession, root: str, schema: StructType, version: int | None = None, months: Column | None = None) -> DataFrame:
    """The table as of a version, the newest without one. `months` (a condition on year and month) leaves other
    months' files out before anything is listed."""
    files = read_part(spark, root, latest(spark, root) if version is None else version, "files", FILES)
    if months is not None:
        files = files.where(months)
    folder = F.substring_index("path", "/", 5 - 2)  # load, year and month
    live = files.groupBy(folder.alias("folder")).agg(F.count("*").alias("n"), F.max("in_folder").alias("of"), F.collect_list("path").alias("paths"))
    paths = [p for r in live.collect() for p in ([r["folder"]] if r["n"] == r["of"] else r["paths"])]
    return _read(spark, root, with_partitions(schema), [f"{root}/{p}" for p in paths]).select(*with_partitions(schema).names)


def remove_unused(spark: SparkSession, root: str, keep: int = 2, hours: int = 24) -> int:
    """Delete the files that none of the last `keep` versions names and that are older than `hours`, which
    covers loads that are still writing. Returns how many."""
    path, store = _store(spark, root)
    found = versions(spark, root)
    used = spark.createDataFrame([], "path string")
    for version in found[-keep:]:
        used = used.unionByName(read_part(spark, root, version, "files", FILES).select("path"))
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(root)
    old = F.col("_metadata.file_modification_time") < F.current_timestamp() - F.make_dt_interval(F.lit(0), F.lit(hours))
    data = listed.where(old & F.col("path").contains(f"/{LOAD}=")).select(_inside(F.col("path")).alias("path"))
    unused = [r["path"] for r in data.join(used.distinct(), "path", "left_anti").collect()]
    for name in unused:
        store.delete(path(f"{root}/{name}"), False)
    for version in found[:-keep]:
        store.delete(path(f"{root}/{FOLDER}/v{version:08d}"), True)
    return len(unused)
