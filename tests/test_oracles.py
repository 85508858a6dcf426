"""Every registered query against an independent engine, at the smallest scale."""

from __future__ import annotations

import pytest
from check_oracles import compare, duck
from conftest import SF_DIR

from __spark_entry__ import entry
from souklake.queries import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_its_oracle(spark, con, name):
    verdict = compare(spark, con, name, QUERIES[name], ORACLES[name], SF_DIR)
    assert verdict.startswith("ok"), verdict


def test_entry(spark):
    df = entry(spark)
    assert df.count() == 6_000
    assert df.columns[0] == "sales_item_key"
