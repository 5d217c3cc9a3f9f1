"""Change records / export lines -> target rows (the 12 columns).

Both functions are pure projections: no shuffle and no Python on the
common path. They are safe to run on a stream micro-batch or on a whole
export.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.config import DecodeOptions
from tidewater.functions import record as R
from tidewater.schemas import EVENT_BULK_LOAD, EVENT_REMOVE


def single_text_column(df: DataFrame, column: str | None = None) -> Column:
    """The input text column; without a name the frame must have exactly one column."""
    if column is not None:
        return F.col(column).cast("string")
    if len(df.schema.fields) != 1:
        raise ValueError(f"change input must have exactly one column, got {df.schema.simpleString()}")
    return F.col(f"`{df.schema.fields[0].name}`").cast("string")


def normalize_changes(df: DataFrame, column: str | None = None, opts: DecodeOptions | None = None) -> DataFrame:
    """Change-stream records (JSON text) -> target rows.

    Envelope fields come from the record, body fields from its ``dynamodb``
    object. A record that cannot be decoded keeps its envelope fields and
    its raw text, gets NULL keys/images/timestamp/size and an ``error``.
    """
    opts = opts or DecodeOptions()
    raw = single_text_column(df, column)
    env = df.select(raw.alias("raw_payload")).withColumn("_env", R.parse_change(F.col("raw_payload")))
    fields = env.select(
        "raw_payload",
        F.col("_env.eventID").alias("event_id"),
        F.col("_env.eventName").alias("last_event_name"),
        F.col("_env.tableName").alias("table_name"),
        R.malformed_change(F.col("_env")).alias("_malformed"),
        F.col("_env.dynamodb").alias("_body"),
    )
    decoded = R.decode_change_bodies(fields, "_body", opts)
    reason = F.when(F.col("_malformed"), F.lit(R.ERR_MALFORMED)).otherwise(F.col("_reason"))
    # The error keeps the text it failed on: the change body, or the whole record.
    # (read again only for error rows)
    body_text = F.get_json_object(F.col("raw_payload"), "$.dynamodb")
    data = F.when(F.col("_malformed") | body_text.isNull(), F.col("raw_payload")).otherwise(body_text)
    with_error = decoded.withColumn("error", R.error_json(reason, data))
    return with_error.select(
        "event_id",
        "last_event_name",
        "table_name",
        F.col("_ts").alias("approx_creation_timestamp_millis"),
        F.col("_keys").alias("keys"),
        F.col("_new").alias("new_image"),
        F.col("_old").alias("old_image"),
        "error",
        F.col("error").isNotNull().alias("has_parsing_error"),
        F.coalesce(F.col("last_event_name") == F.lit(EVENT_REMOVE), F.lit(False)).alias("is_deleted"),
        F.col("_size").alias("raw_payload_size_bytes"),
        "raw_payload",
    )


def normalize_export(
    df: DataFrame,
    key_names: tuple[str, ...],
    table_name: str,
    run_id: str,
    load_time_millis: int | None = None,
    column: str | None = None,
    opts: DecodeOptions | None = None,
) -> DataFrame:
    """Export lines ``{"Item": {...}}`` -> target rows of a bulk load.

    Keys are the configured attributes; every row carries the run id, the
    ``BULK_LOAD`` event name and the load time (now, at second precision,
    unless given). The size is the 4-bytes-per-character estimate.
    """
    opts = opts or DecodeOptions()
    if not key_names:
        raise ValueError("a bulk load needs at least one key attribute")
    raw = single_text_column(df, column)
    load_ms = (
        F.lit(int(load_time_millis)).cast("bigint")
        if load_time_millis is not None
        else (F.unix_timestamp(F.current_timestamp()) * 1000).cast("bigint")
    )
    env = df.select(raw.alias("raw_payload")).withColumn("_env", R.parse_export(F.col("raw_payload")))
    items = env.select("raw_payload", R.malformed(F.col("_env")).alias("_malformed"), F.col("_env.Item").alias("_item"))
    decoded = R.decode_export_items(items, "_item", tuple(key_names), opts)
    reason = F.when(F.col("_malformed"), F.lit(R.ERR_MALFORMED)).otherwise(F.col("_reason"))
    with_error = decoded.withColumn("error", R.error_json(reason, F.col("raw_payload")))
    return with_error.select(
        F.lit(run_id).cast("string").alias("event_id"),
        F.lit(EVENT_BULK_LOAD).alias("last_event_name"),
        F.lit(table_name).cast("string").alias("table_name"),
        load_ms.alias("approx_creation_timestamp_millis"),
        F.col("_keys").alias("keys"),
        F.col("_new").alias("new_image"),
        F.lit("{}").alias("old_image"),
        "error",
        F.col("error").isNotNull().alias("has_parsing_error"),
        F.lit(False).alias("is_deleted"),
        (F.length("raw_payload").cast("bigint") * 4).try_cast("int").alias("raw_payload_size_bytes"),
        "raw_payload",
    )

