"""Every registered query against its SQL, on the smallest tables."""

import os

import pytest
from compare import connect, difference

from checkmart.oracle import ORACLE
from checkmart.registry import QUERIES

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.usefixtures("compiled")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    assert difference(QUERIES[name](spark, SF_DIR), ORACLE[name], con) == []
