"""The subpackage's queries against their SQL, and all of them on the smallest tables."""

import pytest

from linkweave.llm.registry import ORACLE, QUERIES
from tests.test_oracle import compare


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, sf, name):
    compare(spark, sf, QUERIES[name], ORACLE[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_query_runs(spark, sf, name):
    df = QUERIES[name](spark, sf)
    assert df.count() > 0 and len(set(df.columns)) == len(df.columns)
