"""Every registered query against its DuckDB oracle on the small fixture."""

import pytest

from lendgrid.plans import ORACLE, QUERIES
from lendgrid.plans.compare import compare_rows, oracle_types, run_oracle, spark_types

SF = "/root/testdata/sf0.001"


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, name):
    df = QUERIES[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    ocols, orows = run_oracle(ORACLE[name], SF)
    ok, msg = compare_rows(df.columns, rows, ocols, orows)
    assert ok, msg
    assert spark_types(df) == oracle_types(ORACLE[name], SF)
