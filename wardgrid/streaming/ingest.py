"""Resumable load of landed files: the stream's checkpoint knows what was read.

Each micro-batch writes its own partition `load_batch=<id>` inside the months it
touches. A batch that is replayed after a failure carries the same id and the
same files, so it replaces its own output and nothing else: rows are stored
exactly once without a lock or a sink log.

A record that lands again in a later batch is recognised by keyed state, which the
checkpoint keeps over restarts. State is bounded by a watermark on the time at which
records were taken in: that time never runs back, so no record is late and none is
dropped for its date, and a key is forgotten `remember` after it came. A record with a
known key and other content is a new version; `read_streamed` shows the latest.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from wardgrid.operators.normalise import key_kinds, latest_per_key, parse_records, text_at
from wardgrid.plans.loads import clean_records, one_per_key, refused_rows
from wardgrid.schemas import PARTITION_COLUMNS, Dataset, Resource, with_partitions
from wardgrid.sources.sinks import replace_months

BATCH = "load_batch"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def stream_months(spark: SparkSession, landing: str, dataset: Dataset, root: str, checkpoint: str,
                  kinds: Mapping[str, set[str]] | None = None, cells: bool = True,
                  files_per_batch: int | None = None, refused_path: str | None = None,
                  remember: str | None = None) -> StreamingQuery:
    """Start a load of all files landed since the last run; it stops by itself.

    Without `kinds` each batch stores the union of the keys it holds. Of the rows of a key
    within a batch the latest is stored. With `remember` (an interval, such as `90 days`)
    copies of a record in later batches are left out as well; a checkpoint keeps to the
    choice it was started with. Lines that are malformed or undated go to a table
    at `refused_path`, if one is given, also by batch.
    """
    reader = spark.readStream
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)

    def write(batch: DataFrame, batch_id: int) -> None:
        records = parse_records(batch, strict=False)
        found = key_kinds(records) if kinds is None else kinds
        if found:
            rows = clean_records(records, dataset, found, cells).where(F.col("year").isNotNull())
            replace_months(
                one_per_key(rows, dataset).withColumn(BATCH, F.lit(str(batch_id))),
                root,
                dataset.rows_per_file,
                [*PARTITION_COLUMNS, BATCH],
            )
        if refused_path:
            everything = Dataset(dataset.table, dataset.date_column, dataset.key_column, (Resource("stream", 0),))
            refused = refused_rows({"stream": batch}, everything).drop("resource")
            replace_months(refused.withColumn(BATCH, F.lit(str(batch_id))), refused_path, 0, [BATCH])

    lines = reader.text(landing)
    if remember and dataset.key_column:
        # state beside the memory of the executors, as it grows with the keys of the interval
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
        lines = landed_once(lines, dataset.key_column, remember)
    return (
        lines
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def landed_once(lines: DataFrame, key_column: str, remember: str) -> DataFrame:
    """A stream of lines without the copies of records it has had within `remember`. Records without a key,
    and lines that are no record, are never copies of each other."""
    record = lines.select("value", F.try_parse_json("value").alias("record"))
    key = record.select("value", text_at(key_column).alias("_key"))
    named = F.concat_ws(":", F.sha2(F.col("value"), 256), "_key")
    # the time of the batch, the same when a batch is replayed
    known = key.select("value", F.coalesce(F.when(F.col("_key").isNotNull(), named), F.expr("uuid()")).alias("_name"), F.current_timestamp().alias("_taken"))
    return known.withWatermark("_taken", remember).dropDuplicatesWithinWatermark(["_name"]).select("value")


def read_streamed(spark: SparkSession, root: str, schema: StructType, dataset: Dataset | None = None) -> DataFrame:
    """The streamed table without its batch column; with `dataset` the latest version of each key: by date,
    then by batch. Rows without a key all stay."""
    declared = StructType([*with_partitions(schema).fields, StructField(BATCH, StringType())])
    rows = spark.read.schema(declared).parquet(root)
    if dataset is not None and dataset.key_column in rows.columns:
        # the same order as within a batch, which compares the rest of the row last
        unnamed = rows.withColumns({"_unnamed": F.when(F.col(dataset.key_column).isNull(), F.monotonically_increasing_id()), "_batch": F.col(BATCH).cast("bigint")})
        rows = latest_per_key(unnamed, [dataset.key_column, "_unnamed"], [dataset.date_column, "_batch"]).drop("_unnamed", "_batch")
    return rows.drop(BATCH)
