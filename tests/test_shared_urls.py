"""The lookup queries over pages that share a URL."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry  # noqa: E402
from oracle_check import compare  # noqa: E402


def write_tables(folder):
    """Four pages, two of them (one in the stream's first run, one not) under one URL."""
    con = duckdb.connect()
    tables = {
        "pages": "SELECT p AS page_id, CASE WHEN p IN (2, 4) THEN 'http://h/shared' ELSE 'http://h/' || p END AS url, '<p>' || p AS html FROM range(2, 6) t(p)",
        "orders": "SELECT o AS o_orderkey, o % 7 AS o_custkey, 'O' AS o_orderstatus, o * 1.5 AS o_totalprice, DATE '2024-01-01' AS o_orderdate, '1-URGENT' AS o_orderpriority FROM range(14) t(o)",
        "events": """SELECT e AS event_id, TIMESTAMP '2024-01-02' + INTERVAL 1 DAY * (e // 5 * 11) AS ts, e % 5 AS user_id,
                     CASE WHEN e % 5 = 3 THEN 'error' ELSE 'view' END AS event_type, e * 0.5 AS value, '{"k":' || e || '}' AS props
                     FROM range(7) t(e)""",
    }
    for name, rows in tables.items():
        con.execute(f"COPY ({rows}) TO '{folder}/{name}.parquet'")
    return folder


@pytest.mark.parametrize("name", ["bulk_lookup", "bulk_lookup_join", "stream_lookup", "stream_lookup_pruned"])
def test_pages_that_share_a_url(spark, tmp_dir, name):
    result = compare(spark, write_tables(tmp_dir), name, entry.queries()[name], entry.oracle_sql()[name])
    assert result["match"], result
