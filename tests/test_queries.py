"""Every registered query against its SQL on the given tables."""

import pytest

import __spark_entry__ as registry
from check import TABLES, connect, difference, spark_rows
from conftest import TESTDATA

SMALL = f"{TESTDATA}/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


SQL_TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
    "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN",
}


@pytest.mark.parametrize("name", registry.oracle_sql())
def test_query_equals_sql(spark, con, name):
    df, sql = registry.queries()[name](spark, SMALL), registry.oracle_sql()[name]
    types = {row[0]: row[1] for row in con.execute("DESCRIBE " + sql).fetchall()}
    assert {column: SQL_TYPES[kind] for column, kind in df.dtypes} == types
    assert difference(df, con, sql) is None


# Models over more titles and users, where neighbouring singular values lie closer.
MODELS = ["single_ratings_factors", "item_latent_neighbors_50", "latent_corner_block", "graded_predictions", "graded_recommend", "graded_top_unseen"]


@pytest.mark.parametrize("name", MODELS)
def test_models_equal_sql_on_more_data(spark, name):
    larger = f"{TESTDATA}/sf0.01"
    assert difference(registry.queries()[name](spark, larger), connect(larger), registry.oracle_sql()[name]) is None


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - set(registry.oracle_sql())))
def test_query_without_sql_is_stable(spark, name):
    first, second = (spark_rows(registry.queries()[name](spark, SMALL)) for _ in range(2))
    assert first[1] and first == second


def test_entry(spark):
    assert registry.entry(spark).columns == ["qid", "rank", "pid", "name", "score"]


def test_sql_reads_given_tables_only(con):
    for sql in registry.oracle_sql().values():
        assert any(t in sql for t in TABLES)
