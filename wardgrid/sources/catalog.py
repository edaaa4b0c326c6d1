"""External tables in the session catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from wardgrid.schemas import PARTITION_COLUMNS, with_partitions


def _ddl(schema: StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def register_months(spark: SparkSession, name: str, schema: StructType, root: str) -> None:
    """Declare a month-partitioned external table unless it exists."""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({_ddl(with_partitions(schema))}) USING PARQUET "
        f"PARTITIONED BY ({', '.join(PARTITION_COLUMNS)}) LOCATION '{root}'"
    )


def register_table(spark: SparkSession, name: str, schema: StructType, path: str) -> None:
    """Declare an unpartitioned external table unless it exists."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({_ddl(schema)}) USING PARQUET LOCATION '{path}'")


def discover_partitions(spark: SparkSession, name: str) -> None:
    """Make newly written months visible."""
    spark.sql(f"MSCK REPAIR TABLE {name}")


def create_table_as(spark: SparkSession, name: str, df: DataFrame, path: str) -> None:
    """Store a result as an external Parquet table unless the table exists."""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} USING PARQUET LOCATION '{path}' AS SELECT * FROM {{rows}}",
        rows=df.hint("rebalance"),
    )
