"""Every query with SQL gives the same rows as the SQL, on the smallest tables."""

import os

import pytest

from folioscope.plans import catalog
from tests import oracle

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")


@pytest.fixture(scope="module")
def con():
    return oracle.connection(SF)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_same_rows_as_sql(spark, con, name):
    assert name in catalog.ORACLE_SQL
    assert oracle.difference(spark, con, SF, catalog.QUERIES[name], catalog.ORACLE_SQL[name]) is None


def test_entry(spark):
    import __spark_entry__

    df = __spark_entry__.entry(spark)
    assert df.columns == ["doc_id", "score"] and df.count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
