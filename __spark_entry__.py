"""

``entry(spark)`` runs the flagship query (three change batches upserted into
a fresh target) on sf0.001. ``queries()`` lists every test query of the
engine; ``oracle_sql()`` gives, for each, DuckDB SQL over the same tables
that computes the same columns. Change records are built from ``events``
(key ``user_id``; signup = INSERT, error = REMOVE, else MODIFY), export
lines from ``orders`` and lookup records from ``pages``.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidewater.plans import catalog  # noqa: E402

try:  # the training-data operators are an optional part
    import corpus_pipeline  # noqa: E402
    from tidewater.llm import catalog as llm_catalog  # noqa: E402
except ImportError as missing:  # a broken dependency of theirs is an error
    if missing.name not in ("corpus_pipeline", "tidewater.llm"):
        raise
    corpus_pipeline = llm_catalog = None

SMOKE_DIR = "/root/testdata/sf0.001"


def entry(spark: SparkSession) -> DataFrame:
    return catalog.upsert_batches(spark, SMOKE_DIR)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "envelope_parse": catalog.envelope_parse,
        "decode_images": catalog.decode_images,
        "decode_deep": catalog.decode_deep,
        "normalize_changes": catalog.normalize_changes_query,
        "parse_errors": catalog.parse_errors,
        "latest_per_key": catalog.latest_per_key_query,
        "upsert_batches": catalog.upsert_batches,
        "upsert_out_of_order": catalog.upsert_out_of_order,
        "upsert_order_guard": catalog.upsert_order_guard,
        "upsert_deltas": catalog.upsert_deltas,
        "upsert_deltas_order_guard": catalog.upsert_deltas_order_guard,
        "bulk_load": catalog.bulk_load,
        "soft_deletes": catalog.soft_deletes,
        "lookup_left_join": catalog.lookup_left_join,
        "bulk_lookup_join": catalog.bulk_lookup_join,
        "bulk_lookup": catalog.bulk_lookup,
        "stream_lookup": catalog.stream_lookup,
        "stream_lookup_pruned": catalog.stream_lookup_pruned,
        "stream_lookup_followed": catalog.stream_lookup_followed,
        "lookup_fanout_rows": catalog.lookup_fanout_rows,
        "lookup_fanout_array": catalog.lookup_fanout_array,
        "typed_view": catalog.typed_view_query,
        "stream_replay": catalog.stream_replay,
        "stream_deltas": catalog.stream_deltas,
        "stream_change_log": catalog.stream_change_log,
        **_llm_queries(),
    }


def _llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {**llm_catalog.QUERIES, "pipeline": corpus_pipeline.run} if llm_catalog else {}


def _llm_oracles() -> dict[str, str]:
    if not llm_catalog:
        return {}
    return {**llm_catalog.ORACLES, **({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})}


# Shared pieces of the oracle SQL.
_NAME = "CASE WHEN event_type = 'signup' THEN 'INSERT' WHEN event_type = 'error' THEN 'REMOVE' ELSE 'MODIFY' END"
_KEYS = """'{"user_id": "' || CAST(user_id AS VARCHAR) || '"}'"""
_MILLIS = "epoch_us(ts) // 1000"
_VALUE = "CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR)"
_NEWEST = "row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, CAST(event_id AS VARCHAR) DESC)"
_BATCH = (
    "CASE WHEN ts < TIMESTAMP '2024-01-11 00:00:00' THEN 1 "
    "WHEN ts < TIMESTAMP '2024-01-21 00:00:00' THEN 2 ELSE 3 END"
)

_LATEST = f"""
SELECT {_KEYS} AS keys, CAST(event_id AS VARCHAR) AS event_id, {_NAME} AS last_event_name,
       {_MILLIS} AS approx_creation_timestamp_millis, event_type = 'error' AS is_deleted
FROM events
QUALIFY {_NEWEST} = 1
"""

_LOOKUP_LATEST = """
WITH linked AS (
  SELECT e.*, p.url FROM events e LEFT JOIN pages p ON p.page_id = e.user_id * 2
), latest AS (
  SELECT * FROM linked
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, CAST(event_id AS VARCHAR) DESC) = 1
)
"""

_BULK_LINKED = """
SELECT '{"o_orderkey": "' || CAST(o.o_orderkey AS VARCHAR) || '"}' AS keys, p.url AS s3_uri,
       CAST(p.page_id AS VARCHAR) AS page_id, p.url IS NULL AS payload_empty,
       COALESCE(p.url, 'missing://page/' || CAST(o.o_custkey AS VARCHAR)) AS link
FROM orders o LEFT JOIN pages p ON p.page_id = o.o_custkey
"""

_STREAM_LOOKUP = (
    _LOOKUP_LATEST
    + f"""
SELECT {_KEYS} AS keys, CAST(l.event_id AS VARCHAR) AS event_id, p.url AS s3_uri,
       CAST(p.page_id AS VARCHAR) AS page_id, p.url IS NULL AS payload_empty
FROM latest l LEFT JOIN pages p
  ON l.event_type <> 'error' AND p.url = l.url AND (l.ts >= TIMESTAMP '2024-01-11 00:00:00' OR p.page_id % 4 = 0)
"""
)


def oracle_sql() -> dict[str, str]:
    return {
        "envelope_parse": f"""
SELECT CAST(event_id AS VARCHAR) AS event_id, {_NAME} AS last_event_name, 'events' AS table_name,
       event_type = 'error' AS is_deleted
FROM events""",
        "decode_images": f"""
SELECT CAST(event_id AS VARCHAR) AS event_id,
       CASE WHEN event_type <> 'error' THEN CAST(user_id AS VARCHAR) END AS new_user_id,
       CASE WHEN event_type <> 'error' THEN event_type END AS new_event_type,
       CASE WHEN event_type <> 'error' THEN {_VALUE} END AS new_value,
       CASE WHEN event_type <> 'error' THEN props->>'$.k' END AS new_k,
       CASE WHEN event_type <> 'error' THEN event_type END AS tag0,
       CASE WHEN event_type <> 'error' THEN props->>'$.k' END AS tag1,
       CASE WHEN event_type = 'error' THEN NULL WHEN event_type = 'purchase' THEN 'true' ELSE 'false' END AS flag,
       event_type = 'error' AS new_empty,
       CASE WHEN event_type <> 'signup' THEN {_VALUE} END AS old_value,
       event_type = 'signup' AS old_empty
FROM events""",
        "decode_deep": """
WITH decoded AS (
  SELECT *, event_id % 53 = 0 AS deep, event_id % 53 = 0 AND (event_id // 53) % 2 = 1 AS bad,
         '"' || event_type || '\\u001F\u00e9"' AS leaf FROM events
)
SELECT CASE WHEN NOT bad THEN '{"user_id": "' || user_id || '"}' END AS keys, CAST(event_id AS VARCHAR) AS event_id,
       CASE WHEN NOT bad THEN '{"user_id": "' || user_id || '", "d": '
         || CASE WHEN deep THEN repeat('{"d": ', 12) || leaf || repeat('}', 12) ELSE leaf END || '}' END AS new_image,
       bad AS has_parsing_error
FROM decoded
QUALIFY bad OR row_number() OVER (PARTITION BY user_id, bad ORDER BY ts DESC, CAST(event_id AS VARCHAR) DESC) = 1""",
        "normalize_changes": f"""
SELECT CAST(event_id AS VARCHAR) AS event_id, {_NAME} AS last_event_name, 'events' AS table_name,
       {_MILLIS} AS approx_creation_timestamp_millis, {_KEYS} AS keys, CAST(NULL AS VARCHAR) AS error,
       false AS has_parsing_error, event_type = 'error' AS is_deleted,
       CAST(100 + length(event_type) + length(props) AS INTEGER) AS raw_payload_size_bytes,
       CAST(CAST(ts AS DATE) AS VARCHAR) AS change_date
FROM events""",
        "parse_errors": f"""
SELECT CASE WHEN event_id % 97 = 0 AND (event_id // 97) % 3 = 0 THEN NULL
            ELSE CAST(event_id AS VARCHAR) END AS event_id,
       CASE WHEN event_id % 97 = 0 THEN NULL ELSE {_KEYS} END AS keys,
       event_id % 97 = 0 AS has_parsing_error,
       CASE WHEN event_id % 97 <> 0 THEN NULL
            WHEN (event_id // 97) % 3 = 0 THEN 'malformed record'
            WHEN (event_id // 97) % 3 = 1 THEN 'invalid attribute value'
            ELSE 'missing Keys' END AS error_reason
FROM events""",
        "latest_per_key": _LATEST,
        "upsert_batches": _LATEST,
        "upsert_out_of_order": f"""
WITH arrived AS (
  SELECT *, CASE {_BATCH} WHEN 3 THEN 1 WHEN 1 THEN 2 ELSE 3 END AS arrival FROM events
)
SELECT {_KEYS} AS keys, CAST(event_id AS VARCHAR) AS event_id, {_NAME} AS last_event_name,
       {_MILLIS} AS approx_creation_timestamp_millis, event_type = 'error' AS is_deleted
FROM arrived
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY arrival DESC, ts DESC, CAST(event_id AS VARCHAR) DESC) = 1
""",
        "upsert_order_guard": _LATEST,
        "upsert_deltas": _LATEST,
        "upsert_deltas_order_guard": _LATEST,
        "bulk_load": """
SELECT '{"o_orderkey": "' || CAST(o_orderkey AS VARCHAR) || '"}' AS keys,
       'run-0001' AS event_id, 'BULK_LOAD' AS last_event_name, 'orders' AS table_name,
       CAST(1700000000000 AS BIGINT) AS approx_creation_timestamp_millis, '{}' AS old_image,
       false AS has_parsing_error, false AS is_deleted,
       CAST(4 * length('{"Item":{"o_orderkey":{"N":"' || CAST(o_orderkey AS VARCHAR)
         || '"},"o_custkey":{"N":"' || CAST(o_custkey AS VARCHAR)
         || '"},"o_orderstatus":{"S":"' || o_orderstatus
         || '"},"o_totalprice":{"N":"' || CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR)
         || '"},"o_orderdate":{"S":"' || strftime(o_orderdate, '%Y-%m-%d')
         || '"},"o_orderpriority":{"S":"' || o_orderpriority || '"}}}') AS INTEGER) AS raw_payload_size_bytes,
       CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderstatus,
       CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS o_totalprice,
       strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_orderpriority
FROM orders""",
        "soft_deletes": f"""
SELECT {_KEYS} AS keys, event_type = 'error' AS is_deleted, event_type <> 'error' AS live,
       event_type = 'error' AS new_empty,
       CASE WHEN event_type <> 'signup' THEN CAST(user_id AS VARCHAR) END AS old_user_id
FROM events
QUALIFY {_NEWEST} = 1
""",
        "lookup_left_join": _LOOKUP_LATEST
        + f"""
SELECT {_KEYS} AS keys, CAST(l.event_id AS VARCHAR) AS event_id, p.url AS s3_uri,
       CAST(p.page_id AS VARCHAR) AS page_id, p.url IS NULL AS payload_empty,
       l.event_type = 'error' AS new_empty
FROM latest l LEFT JOIN pages p ON l.event_type <> 'error' AND p.url = l.url
""",
        "bulk_lookup_join": _BULK_LINKED,
        "bulk_lookup": _BULK_LINKED,
        "stream_lookup": _STREAM_LOOKUP,
        "stream_lookup_pruned": _STREAM_LOOKUP,
        "stream_lookup_followed": f"""
WITH files AS (
  SELECT page_id // 20 AS file, count(*) AS n, string_agg('{{"page_id":' || page_id || '}}', ',' ORDER BY '{{"page_id":' || page_id || '}}') AS records
  FROM pages GROUP BY 1
), latest AS (
  SELECT *, user_id * 2 // 20 AS file FROM events QUALIFY {_NEWEST} = 1
)
SELECT {_KEYS} AS keys, CAST(l.event_id AS VARCHAR) AS event_id, f.file IS NOT NULL AS matched,
       CAST(coalesce(f.n, 0) AS INTEGER) AS n_records,
       CASE WHEN f.file IS NULL THEN '{{}}' ELSE '[' || f.records || ']' END AS records
FROM latest l LEFT JOIN files f
  ON l.event_type <> 'error' AND f.file = l.file AND (l.ts >= TIMESTAMP '2024-01-11 00:00:00' OR f.file % 2 = 0)""",
        "lookup_fanout_rows": _LOOKUP_LATEST
        + f"""
SELECT {_KEYS} AS keys, CAST(l.event_id AS VARCHAR) AS event_id, p.url AS s3_uri,
       CAST(p.page_id AS VARCHAR) AS page_id, CAST(p.part AS VARCHAR) AS part
FROM latest l
LEFT JOIN (SELECT page_id, url, unnest([1, 2]) AS part FROM pages) p
  ON l.event_type <> 'error' AND p.url = l.url
""",
        "lookup_fanout_array": _LOOKUP_LATEST
        + f"""
SELECT {_KEYS} AS keys, CAST(l.event_id AS VARCHAR) AS event_id, p.url AS s3_uri,
       CASE WHEN p.url IS NULL THEN 0 ELSE 2 END AS n_records,
       CASE WHEN p.url IS NULL THEN '{{}}' ELSE '[{{"page_id":' || p.page_id || ',"part":1}},{{"page_id":' || p.page_id || ',"part":2}}]'
       END AS records
FROM latest l LEFT JOIN pages p ON l.event_type <> 'error' AND p.url = l.url
""",
        "typed_view": f"""
SELECT {_KEYS} AS keys,
       CASE WHEN event_type <> 'error' THEN user_id END AS user_id,
       CASE WHEN event_type <> 'error' THEN event_type END AS event_type,
       CASE WHEN event_type <> 'error' THEN CAST(CAST(value AS DECIMAL(18,2)) AS DOUBLE) END AS value,
       CASE WHEN event_type <> 'error' THEN CAST(props->>'$.k' AS BIGINT) END AS k,
       CASE WHEN event_type <> 'error' THEN event_type = 'purchase' END AS flag
FROM events
QUALIFY {_NEWEST} = 1
""",
        "stream_replay": _LATEST,
        "stream_deltas": _LATEST,
        "stream_change_log": f"""
SELECT CAST(event_id AS VARCHAR) AS event_id, {_KEYS} AS keys, {_NAME} AS last_event_name,
       CAST(CAST(ts AS DATE) AS VARCHAR) AS change_date, {_NEWEST} = 1 AS is_latest
FROM events""",
        **_llm_oracles(),
    }
