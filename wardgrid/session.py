"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# What the tables and loads of this package rely on. Reads and writes in the
# package also set the ones they need themselves, so that a session built
# elsewhere gives the same results.
SETTINGS = {
    # month=01 must stay the text '01' (inference would make it the integer 1)
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    # a load replaces the months it writes and leaves the others alone
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.compression.codec": "snappy",
    # AQE: runtime broadcast decisions, skew-join splitting, rebalanced writes
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # the JVM never compiles a method over 8000 bytes of code: past that a stage of
    # smaller, compiled projections beats one large interpreted method by far
    "spark.sql.codegen.hugeMethodLimit": "8000",
}

_local_roots: dict[str, str] = {}


def build_session(app_name: str = "wardgrid", master: str | None = None, **extra: str) -> SparkSession:
    """A session with `SETTINGS`; `extra` keys use `__` for the dots of a setting."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = SETTINGS | {k.replace("__", "."): v for k, v in extra.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def apply_settings(spark: SparkSession) -> SparkSession:
    """`SETTINGS` for a session that was built elsewhere."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder name under `spark.checkpoint.dir`, which all executors can reach.

    Only a local session without that setting falls back to a folder of this
    machine; a cluster session without it is refused.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        context = spark.sparkContext
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = _local_roots.setdefault(context.applicationId, "")
        if not root:
            root = _local_roots[context.applicationId] = tempfile.mkdtemp(prefix="wardgrid-")
    return f"{root.rstrip('/')}/wardgrid/{purpose}-{uuid.uuid4().hex}"
