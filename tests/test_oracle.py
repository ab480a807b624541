"""Every registered query against its SQL on the same files."""

import re

import pytest

import __spark_entry__ as driver
from compare import connect, difference

QUERIES = driver._registry()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def _compared(name):
    """Queries with SQL, and those without that no test file of their own covers."""
    return QUERIES[name].sql is not None or not re.match(r"op\d+_|pipeline$", name)


@pytest.mark.parametrize("name", list(filter(_compared, QUERIES)))
def test_query(spark, con, sf_dir, name):
    rows, different = difference(spark, con, QUERIES[name], sf_dir)
    assert different is None, different
    assert rows > 0 or name in {"min_history_train"}


def test_contract(spark):
    assert set(driver.oracle_sql()) <= set(driver.queries())
    assert driver.entry(spark).limit(1).count() == 1
