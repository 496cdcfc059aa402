"""The registered queries on the smallest data folder."""

import duckdb
import pytest

import __spark_entry__ as entry
from omnishelf.llm import registry
from verification.compare import compare
from verification.derived import TABLES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(registry.ORACLE))
def test_query_matches_sql(spark, name):
    with duckdb.connect() as duck:
        for table in TABLES:
            duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
        got, _, _, verdict = compare(
            spark, duck, entry.queries()[name], entry.oracle_sql()[name], SF
        )
    assert verdict == "ok" and got


@pytest.mark.parametrize("name", sorted({*registry.QUERIES} - {*registry.ORACLE}))
def test_query_runs(spark, name):
    assert entry.queries()[name](spark, SF).count() > 0
