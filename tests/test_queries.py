"""Every registered query against its SQL, on the smallest data set."""

import pytest

from igarape.queries import QUERIES, SQL
from tests.oracle import connect, differences

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


@pytest.mark.parametrize("name", [n for n in QUERIES if n in SQL])
def test_same_as_sql(spark, duck, name):
    actual = QUERIES[name](spark, FOLDER).toPandas()
    assert differences(actual, duck.sql(SQL[name]).df()) is None


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in SQL])
def test_has_rows(spark, name):
    assert QUERIES[name](spark, FOLDER).count() > 0


def test_entry_is_the_gold_table(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).columns[:3] == ["cod_mun", "municipio", "ano"]
    assert set(entry.oracle_sql()) <= set(entry.queries())
