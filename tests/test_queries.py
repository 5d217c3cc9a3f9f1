"""Every registered query against its DuckDB oracle on sf0.001."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry  # noqa: E402
from oracle_check import compare  # noqa: E402

from conftest import SF  # noqa: E402


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query_matches_oracle(spark, name):
    sql = entry.oracle_sql().get(name)
    if sql is None:
        pytest.skip("no oracle")
    result = compare(spark, SF, name, entry.queries()[name], sql)
    assert result["match"], result


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
