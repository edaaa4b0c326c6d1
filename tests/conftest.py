import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).resolve().parents[1]), str(Path(__file__).resolve().parent)]

from wardgrid.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "wardgrid-tests",
        "local[4]",
        spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
        spark__driver__memory="4g",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def one(spark):
    """Evaluate a Column built from text values: one(fn, value, ...) -> value."""
    from pyspark.sql import functions as F

    def evaluate(build, *values):
        row = spark.createDataFrame([tuple(values)], ", ".join(f"v{i} string" for i in range(len(values))))
        return row.select(build(*[F.col(f"v{i}") for i in range(len(values))]).alias("out")).first()["out"]

    return evaluate
