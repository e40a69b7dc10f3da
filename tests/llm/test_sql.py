"""Queries with SQL, against DuckDB."""

import pytest

from linkloom.llm.oracle import ORACLE
from linkloom.llm.queries import QUERIES
from tests.compare import connect, difference

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query(spark, name):
    assert difference(QUERIES[name](spark, SF), connect(SF), ORACLE[name]) is None
