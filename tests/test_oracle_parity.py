"""Every registered query against its DuckDB oracle on the driver tables
(the same check the driver runs), plus the smoke entry point."""

import os

import pytest
from compare import compare

import __spark_entry__ as E
from entiscore.plans.catalog import CATALOG

SF = os.environ.get("ENTISCORE_TEST_SF", "/root/testdata/sf0.01")
QUERIES = {k: v for k, v in E.queries().items() if k in CATALOG}
ORACLES = E.oracle_sql()


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(ORACLES)


@pytest.mark.skipif(not os.path.exists(SF), reason="driver tables missing")
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, name):
    problems, n_spark, n_duck = compare(QUERIES[name](spark, SF), ORACLES[name], SF)
    assert not problems, problems
    assert n_spark == n_duck


@pytest.mark.skipif(not os.path.exists(E.SMOKE_DIR), reason="driver tables missing")
def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[0] == "targetid"
