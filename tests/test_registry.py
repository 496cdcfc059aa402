"""The registered queries against their SQL on the smallest data folder."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from verification.compare import compare
from verification.derived import TABLES
from verification.model_queries import QUERIES as MODELS
from verification.operator_queries import QUERIES as OPERATORS

SF = "/root/testdata/sf0.001"
DOMAINS = [
    "unify_books", "unify_books_strict", "unify_movies", "unify_movies_strict", "unify_music",
    "unify_anime_strict", "country_index_models",
]

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no driver tables here")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    yield connection
    connection.close()


def test_every_query_has_sql():
    own = {*OPERATORS, *MODELS}
    assert own <= set(entry.queries()) and own <= set(entry.oracle_sql())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", [*OPERATORS, *DOMAINS])
def test_query_matches_sql(spark, duck, name):
    got, _, _, verdict = compare(spark, duck, entry.queries()[name], entry.oracle_sql()[name], SF)
    assert verdict == "ok"
    assert got


def test_flagship(spark):
    assert entry.entry(spark).count() == 5
