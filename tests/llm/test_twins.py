"""The registered queries that SQL can express against their DuckDB texts."""

import pytest
from test_oracles import SMALL, compare

from hustings.llm import queries


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_twin(spark, name):
    assert compare(spark, SMALL, name, queries.queries(), queries.oracle_sql()) > 0
