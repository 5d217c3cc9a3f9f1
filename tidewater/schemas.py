"""Fixed schemas: the target row (the envelope is parsed in ``functions/record.py``).

The target row is the public contract of the engine: every job writes these
columns, in this order, with these types.
"""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

# Event names of the change stream and the bulk load.
EVENT_INSERT = "INSERT"
EVENT_MODIFY = "MODIFY"
EVENT_REMOVE = "REMOVE"
EVENT_BULK_LOAD = "BULK_LOAD"

# Target table columns and types, in table order.
TARGET_SCHEMA = StructType(
    [
        StructField("event_id", StringType(), True),
        StructField("last_event_name", StringType(), True),
        StructField("table_name", StringType(), True),
        StructField("approx_creation_timestamp_millis", LongType(), True),
        StructField("keys", StringType(), True),
        StructField("new_image", StringType(), True),
        StructField("old_image", StringType(), True),
        StructField("error", StringType(), True),
        StructField("has_parsing_error", BooleanType(), True),
        StructField("is_deleted", BooleanType(), True),
        StructField("raw_payload_size_bytes", IntegerType(), True),
        StructField("raw_payload", StringType(), True),
    ]
)

# Extra columns when records are joined to lookup files.
LOOKUP_FIELDS = StructType(
    [
        StructField("s3_uri", StringType(), True),
        StructField("raw_s3_payload", StringType(), True),
    ]
)

TARGET_COLUMNS = tuple(f.name for f in TARGET_SCHEMA.fields)
TARGET_WITH_LOOKUP_SCHEMA = StructType(TARGET_SCHEMA.fields + LOOKUP_FIELDS.fields)


def target_schema(with_lookup: bool = False) -> StructType:
    return TARGET_WITH_LOOKUP_SCHEMA if with_lookup else TARGET_SCHEMA


def target_ddl(with_lookup: bool = False) -> str:
    """Column list for CREATE TABLE statements."""
    return ", ".join(f"`{f.name}` {f.dataType.simpleString().upper()}" for f in target_schema(with_lookup).fields)
