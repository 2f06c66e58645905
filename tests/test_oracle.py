"""Every registered query against its SQL, on the smallest tables."""

import os

import pytest

from dossierlake.plans.queries import CATALOG
from tests.oracle import compare, connect

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def db():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(CATALOG))
def test_query_equals_sql(spark, db, name):
    query, sql = CATALOG[name]
    assert compare(spark, db, query, sql, SF_DIR) is None
