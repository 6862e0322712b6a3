"""Every registered query with SQL gives the same rows as DuckDB on the small tables."""

import importlib.util
import os
import pathlib

import pytest

import __spark_entry__ as entry

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")

path = pathlib.Path(__file__).parent.parent / "tools" / "check.py"
spec = importlib.util.spec_from_file_location("check", path)
check = importlib.util.module_from_spec(spec)
spec.loader.exec_module(check)


@pytest.fixture(scope="module")
def duck():
    return check.connect(FOLDER)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    got = entry.queries()[name](spark, FOLDER).toPandas()
    assert check.compare(got, duck.execute(entry.oracle_sql()[name]).df()) is None


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0
