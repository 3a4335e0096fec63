"""Every registered query against its DuckDB oracle at sf0.01 (the driver's correctness gate)."""

import pytest

import __spark_entry__ as E
from conftest import SF001, SF0001
from tools.oracle_check import duck, normalise

NAMES = sorted(E.oracle_sql())


@pytest.fixture(scope="module")
def con():
    return duck(SF001)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    s = E.queries()[name](spark, SF001).toPandas()
    d = con.execute(E.oracle_sql()[name]).df()
    assert sorted(s.columns) == sorted(d.columns)
    assert len(s) == len(d)
    assert normalise(s) == normalise(d)


def test_every_metric_query_has_an_oracle():
    from pulseboard.queries import QUERIES
    assert set(QUERIES) <= set(E.oracle_sql())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "platform" in df.columns
    assert SF0001.endswith("0.001")
