"""Every query that has an SQL twin against it, on the smallest tables."""

import os

import pytest

import __spark_entry__ as contract
from oracle import compare

SF_DIR = os.environ.get("FEEDFOLD_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables here")


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query_equals_its_sql_twin(spark, name):
    assert compare(spark, SF_DIR, contract.queries()[name], contract.oracle_sql()[name]) is None


def test_flagship(spark):
    assert contract.entry(spark).columns[:2] == ["PostId", "Partdate"]
