from __future__ import annotations

import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from omnishelf.session import configure  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield configure(session)
    session.stop()


def plan_of(df) -> str:
    """The physical plan before adaptive changes, whether or not the query has run."""
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.rpartition("== Initial Plan ==")[2]


def rows(df, *columns) -> list[tuple]:
    """Sorted tuples, NULLs first."""
    picked = [tuple(r) for r in (df.select(*columns) if columns else df).collect()]
    return sorted(picked, key=lambda r: [(v is not None, str(v)) for v in r])
