"""Every registered query against its SQL."""

import pytest

from registry.oracle import ORACLE
from registry.queries import QUERIES
from tests.compare import duck, duck_rows, spark_rows

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, con, name):
    columns, rows = spark_rows(QUERIES[name](spark, SF))
    want_columns, want = duck_rows(con, ORACLE[name])
    assert columns == want_columns
    assert rows == want
    assert rows
