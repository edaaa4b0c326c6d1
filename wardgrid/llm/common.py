"""What the operators of this folder share: tables, row identity, written intermediate results."""

from __future__ import annotations

from collections.abc import Callable
from typing import TypeVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardgrid.session import shared_folder
from wardgrid.sources.tables import read_if_present

T = TypeVar("T")

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII_LOWER = "abcdefghijklmnopqrstuvwxyz"


# rows go to Python in batches of this size: texts are long, and a batch is held several times over
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": "512", "spark.sql.execution.arrow.maxBytesPerBatch": "4194304"}


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """A table of the test data; sets the session's `BATCH`."""
    for key, value in BATCH.items():
        spark.conf.set(key, value)
    frame = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return frame.select(*columns) if columns else frame


def lower_ascii(text: Column) -> Column:
    return F.translate(text, ASCII_UPPER, ASCII_LOWER)


def stored(df: DataFrame, purpose: str, together: bool = True) -> DataFrame:
    """`df` written once to the shared folder and read back: work is not repeated when an
    executor is lost, and later plans start from the files.

    Small partitions are written one after another by a few tasks a core, which saves
    files; `together=False` leaves each to its own task, for functions that use its number.
    """
    spark = df.sparkSession
    path = shared_folder(spark, purpose)
    if together:
        df = df.coalesce(8 * spark.sparkContext.defaultParallelism)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


TIDY = {
    # shuffle files of a step go when it is written, not when the driver happens to collect garbage
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    # rows of a few folders are written without a sort
    "spark.sql.maxConcurrentOutputFileWriters": "32",
}


def tidily(df: DataFrame, write: Callable[[], T]) -> T:
    """What `write` gives, run with the settings `TIDY`, for jobs of many steps."""
    conf = df.sparkSession.conf
    before = {key: conf.get(key) for key in TIDY}
    try:
        for key, value in TIDY.items():
            conf.set(key, value)
        return write()
    finally:
        for key, value in before.items():
            conf.set(key, value)


def tidily_stored(df: DataFrame, purpose: str) -> DataFrame:
    return tidily(df, lambda: stored(df, purpose))


def stored_by(df: DataFrame, purpose: str, column: str, values: range) -> list[DataFrame]:
    """`df` written once by each partition's own task; a frame, without `column`, for each of its few values."""
    spark = df.sparkSession
    path = shared_folder(spark, purpose)
    # a task has a file open for each value, so each holds little in memory
    writer = df.write.option("compression", "zstd").option("parquet.block.size", 4 << 20).partitionBy(column)
    tidily(df, lambda: writer.parquet(path))
    return [read_if_present(spark, f"{path}/{column}={value}", df.drop(column).schema) for value in values]


def discard(*frames: DataFrame) -> None:
    """Delete the files that frames from `stored` read, once no result needs them."""
    for frame in frames:
        spark = frame.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path
        for folder in {name.rsplit("/", 1)[0] for name in frame.inputFiles()}:
            path(folder).getFileSystem(spark._jsc.hadoopConfiguration()).delete(path(folder), True)


FEW = 100_000  # a table of so many short rows is broadcast
SALTS = 64


def beside(rows: DataFrame, table: DataFrame, keys: list[str], draw: str, few: int = FEW, how: str = "inner") -> DataFrame:
    """`rows` joined with a table of one row a key (`how`: inner, left_semi or left_anti). The table is broadcast
    if it is counted to be small, else the join goes over salts from the hash column `draw`, as a third of all
    rows may share one key."""
    right = [c for c in table.columns if c not in keys] if how == "inner" else []
    if table.count() <= few:
        salted, copies, on = rows, F.broadcast(table), keys
    else:
        salted = rows.withColumn("_salt", F.pmod(draw, F.lit(SALTS)))
        copies, on = table.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))).hint("merge"), [*keys, "_salt"]
    joined = salted.alias("r").join(copies.alias("t"), same("r", "t", *on), how)
    return joined.select(*[f"r.{c}" for c in rows.columns], *[f"t.{c}" for c in right])


def same(left: str, right: str, *columns: str) -> Column:
    """Null-safe equality of the columns under two aliases."""
    out = F.lit(True)
    for name in columns:
        out = out & F.col(f"{left}.{name}").eqNullSafe(F.col(f"{right}.{name}"))
    return out
