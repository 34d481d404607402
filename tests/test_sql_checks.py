"""Every registered query that has SQL gives the same rows on the small tables."""
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from panelwise import catalog
from tests.check_sql import compare, connect


@pytest.fixture(scope="module")
def con(small):
    return connect(small)


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_same_rows_as_sql(spark, con, small, name):
    assert compare(spark, con, name, queries()[name], oracle_sql()[name], small) == ""


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.SQL)))
def test_model_queries_give_rows(spark, small, name):
    assert queries()[name](spark, small).count() > 0


def test_entry_module_has_all_of_the_catalog():
    assert set(catalog.QUERIES) <= set(queries()) and set(catalog.SQL) <= set(oracle_sql())


def test_entry(spark):
    df = entry(spark)
    assert df.count() > 0 and len(df.columns) == 23 + 72 + 13 + 1
