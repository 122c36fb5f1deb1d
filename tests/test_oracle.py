"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
import check

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return check.duck(SF)


@pytest.mark.parametrize("name", list(entry.queries()))
def test_query(spark, con, name):
    df = entry.queries()[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    text, good = check.compare(con, name, df)
    assert good, text


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns[0] == "city" and df.limit(1).count() == 1
