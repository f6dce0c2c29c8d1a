"""Every catalogue query on the smallest tables, against DuckDB where SQL exists."""
import pytest
from oracle_check import compare

from tablewarden.plans.catalog import QUERIES
from tablewarden.plans.oracles import ORACLES


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, small, name):
    if name in ORACLES:
        assert compare(spark, small, QUERIES[name], ORACLES[name]) is None
    else:
        assert QUERIES[name](spark, small).count() > 0


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
