"""Every registered query of the library against its DuckDB SQL on sf0.001."""

import pytest

import __spark_entry__ as ent
from oracle_check import compare, duck

from tokenledger.plans import oracle
from tokenledger.plans.queries import QUERIES

from conftest import SF0001

NAMES = list(QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck(SF0001)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    info = compare(spark, con, name, SF0001, oracle.ORACLES[name](), QUERIES[name])
    assert info["ok"], info


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(oracle.ORACLES)
    assert set(QUERIES) <= set(ent.queries()) and set(QUERIES) <= set(ent.oracle_sql())


def test_entry_runs(spark):
    df = ent.entry(spark)
    rows = df.collect()
    assert len(rows) == 4
    assert set(df.columns) >= {"lang", "before", "after", "reduction_pct"}
