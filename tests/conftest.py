from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from clickloom.session import configure  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("clickloom-tests")
        .config("spark.sql.shuffle.partitions", "3")
        # Many small plans: compiling each takes longer than running it.
        .config("spark.sql.codegen.wholeStage", "false")
        .config("spark.sql.codegen.factoryMode", "NO_CODEGEN")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield configure(session)
    session.stop()


def rows(df, *order):
    """Rows as tuples, sorted by the given columns or by all of them."""
    columns = list(order) or df.columns
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=lambda r: tuple((v is not None, v) for v in r))
