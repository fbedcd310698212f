"""Every registered query against its SQL twin, and the driver contract."""

import pytest

import __spark_entry__ as entry
from millrace.plans import PLANS
from oracle_check import compare, connect

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", list(PLANS))
def test_query(name, spark, con):
    df = entry.queries()[name](spark, FOLDER)
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert df.collect()
        return
    problem, n = compare(df, con, sql)
    assert problem is None, problem
    assert n > 0 or name in ("filter_long_frequent_words", "parameterized_sql_named")


def test_entry(spark):
    top = entry.entry(spark)
    assert top.columns == ["word", "n", "rank"]
    assert top.count() == 20


def test_few_queries_lack_sql():
    assert set(PLANS) - set(entry.oracle_sql()) == {
        "limit_unordered", "ml_tree_regressor", "ml_tree_stats"}
