"""Every registered query against its SQL, and the layout of the package."""

import os

import pytest
from oracle_check import connect, differences

import __spark_entry__ as entry_module

NAMES = sorted(entry_module.queries())


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, sf_dir, con, name):
    got = entry_module.queries()[name](spark, sf_dir).toPandas()
    sql = entry_module.oracle_sql().get(name)
    if sql is None:
        assert len(got) > 0
    else:
        assert differences(got, con.execute(sql).fetchdf()) == ""


def test_sql_belongs_to_queries():
    assert set(entry_module.oracle_sql()) <= set(NAMES)


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0


def test_workers_need_no_copy_of_the_package():
    import gridstats
    from pyspark import cloudpickle

    assert gridstats.__name__ in cloudpickle.list_registry_pickle_by_value()
    assert os.path.isdir(os.path.dirname(gridstats.__file__))
