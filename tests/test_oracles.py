"""Every registered query against its SQL twin on the smallest benchmark tables."""
import os

import pytest
from oracle import compare, connect

from __spark_entry__ import entry, oracle_sql, queries

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="benchmark tables are not here")


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_twin_has_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry_has_rows(spark):
    df = entry(spark)
    assert df.columns and df.limit(1).count() == 1


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_matches_its_twin(name, spark, duck):
    df = queries()[name](spark, SF_DIR)
    if name in oracle_sql():
        assert compare(df, duck, oracle_sql()[name]) is None
    else:
        assert df.count() > 0
